"""Distributed training and batch scoring (M4, M5).

Training uses ``pyspark.ml``'s gradient-boosted trees: each boosting round
is a distributed tree build (histogram aggregation per level on the
executors), so the training table never goes through the driver.  1000
rounds mean 1000 sequential tree builds — ``checkpointInterval`` cuts the
lineage (in ``spark.checkpoint.dir``) so a lost executor does not replay
the whole history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.features import apply_codes, assemble, fit_codes, prepare_codes
from tabforge.plans.joins import materialise
from tabforge.session import ensure_checkpoint_dir


@dataclass
class BoostParams:
    """Learning rate, rounds and depth (the monitored model: 0.01, 1000, 6)."""

    learning_rate: float = 0.01
    n_estimators: int = 1000
    max_depth: int = 6
    seed: int = 42
    max_bins: int = 64
    checkpoint_interval: int = 10
    cache_node_ids: bool | None = None  # None: on for deep trees (depth >= 5)


@dataclass
class TabularModel:
    """Fitted dictionary + assembled-feature GBT pipeline."""

    codes: DataFrame | None
    cat: list[str]
    num: list[str]
    pipeline: PipelineModel
    code_sizes: dict[str, int] | None = None
    bins: int = 64

    def transform(self, df: DataFrame) -> DataFrame:
        return score(df, self)


def _features(df: DataFrame, codes, cat: list[str], num: list[str], sizes=None, bins: int = 64) -> DataFrame:
    enc = apply_codes(df, codes, cat, suffix="_code", sizes=sizes, nominal_bins=bins) if cat else df
    return assemble(enc, [f"{c}_code" for c in cat], num)


def train(df: DataFrame, cat: list[str], num: list[str], label: str, params: BoostParams | None = None) -> TabularModel:
    """Fit the dictionary on the training rows, assemble, train GBT (M4)."""
    params = params or BoostParams()
    ensure_checkpoint_dir(df.sparkSession)
    codes, sizes = prepare_codes(fit_codes(df, cat), cat) if cat else (None, None)
    feats = _features(df, codes, cat, num, sizes, params.max_bins).withColumn("_label", F.col(label).cast("double"))
    feats = materialise(feats.select("features", "_label"))  # every boosting round reads it again
    gbt = GBTClassifier(
        featuresCol="features",
        labelCol="_label",
        stepSize=params.learning_rate,
        maxIter=params.n_estimators,
        maxDepth=params.max_depth,
        maxBins=params.max_bins,
        seed=params.seed,
        checkpointInterval=params.checkpoint_interval,
        cacheNodeIds=params.cache_node_ids if params.cache_node_ids is not None else params.max_depth >= 5,
    )
    model = Pipeline(stages=[gbt]).fit(feats)
    return TabularModel(codes, cat, num, model, sizes, params.max_bins)


def score(df: DataFrame, model: TabularModel, keep: list[str] | None = None) -> DataFrame:
    """Batch scoring (M5): ``probability`` of class 1 and ``prediction``.

    Narrow where the dictionary is small enough to be broadcast; the tree
    ensemble is evaluated row by row inside the JVM.
    """
    feats = _features(df, model.codes, model.cat, model.num, model.code_sizes, model.bins)
    out = model.pipeline.transform(feats)
    cols = keep if keep is not None else df.columns
    return out.select(
        *cols,
        F.get(vector_to_array(F.col("probability")), 1).alias("probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def score_foreign(df: DataFrame, load_model, feature_cols: list[str], out_type: str = "double") -> DataFrame:
    """Score with a model object that Spark does not know (M5, foreign).

    ``load_model()`` is called once per task (not per row, not on the
    driver with data); batches arrive as Arrow → pandas, the model's
    ``predict`` runs vectorised, results stream back as Arrow.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("prediction", T._parse_datatype_string(out_type))])

    def run(batches):
        model = load_model()
        for pdf in batches:
            yield pdf.assign(prediction=model.predict(pdf[feature_cols]))

    return df.mapInPandas(run, schema)
