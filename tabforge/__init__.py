"""tabforge — Spark-native operators for the data work around a tabular model.

Every public operator is ``DataFrame -> DataFrame`` (or returns a small
metadata object), takes its column lists as arguments and triggers no Spark
action unless its name says so.
"""

__version__ = "0.1.0"
