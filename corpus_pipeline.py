"""Corpus pipeline: documents through five stages, each one operator of ``tabforge.llm``.

language ID -> toxicity -> SimHash near-dedup -> mixing sources -> piece encoding.
Every stage but the last returns the columns of ``documents``; every stage's
result is written as Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm import langid, mixing, simhash, spdropout, toxicity
from tabforge.llm.common import free_name
from tabforge.session import remove_scratch, scratch_path

#: Rows of an Arrow batch in the stages' Python tasks, unless the session says otherwise.
BATCH_ROWS = 2000


def _apart(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with own columns of these names renamed, and the way back: a stage's operator
    replaces columns that are named like its results."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if docs.sparkSession.conf.get(key, "10000") == "10000":
        docs.sparkSession.conf.set(key, str(BATCH_ROWS))
    moved = {c: free_name(docs, f"{c}_of_document") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(moved), {v: k for k, v in moved.items()}


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects only undetermined texts (``und``: null, empty or without a letter).  No language
    is rejected, nor is a text that the network is unsure of: mixed texts and repeated words are
    as unsure as any other.  Without any labelled language to learn from there is no network, and texts with a
    letter pass all the same."""
    net = langid.train(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own, back = _apart(docs, "lang_pred", "score")
    return langid.identify(own, net).where(F.col("lang_pred") != "und").select(*own.columns).withColumnsRenamed(back)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a toxicity score below 0.5."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own, back = _apart(docs, "score", "spans")
    return toxicity.score_docs(own, model).where(F.col("score") < 0.5).select(*own.columns).withColumnsRenamed(back)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources does (possibly not at all)."""
    own, back = _apart(docs, "size", "source_size", "target", "copies", "taken")
    return mixing.repeated(mixing.mix(own), own.columns).withColumnsRenamed(back)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document: doc_id, source, pieces, n_pieces, lossless.  The copies
    that the mix makes of a document are numbered, so that each is segmented anew."""
    own, _ = _apart(docs)
    alike = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source")
    numbered = own.select("doc_id", "source", "text", F.row_number().over(alike).alias("_copy"))
    return spdropout.encode_docs(numbered, copy_col="_copy").drop("text")


STAGES = [
    ("language ID", language_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", dedup_stage),
    ("mixing sources", mixing_stage),
    ("piece encoding", encoding_stage),
]

#: The stages train models and hash with XXH64, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and removed when the
    next one is written.  What the last stage reads stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{place}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{place}/{k}")
        if k:
            remove_scratch(spark, f"{place}/{k - 1}")
    raise AssertionError("no stages")
