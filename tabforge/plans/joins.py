"""Lineage cuts, and joins with sides that are usually small.

No broadcast hint is given where a side has no bound by construction: adaptive
execution measures the side's bytes after its shuffle and broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``, else splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabforge.session import ensure_checkpoint_dir


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint dir."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
