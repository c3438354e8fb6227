"""Scans and sinks.

Reads go through the DataFrame reader so Catalyst sees the scan and can
push filters and prune columns into Parquet.  Nothing here collects data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.casts import try_cast_text
from tabforge.functions.nulls import PANDAS_NA_TOKENS, na_token_to_null, nan_to_null

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TEST_TABLES) -> None:
    """Register the test tables as temp views (for ``spark.sql`` scans, S3)."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path
    names (local, HDFS, object stores) — metadata only."""
    try:
        return spark.read.schema("_ int").parquet(path).schema is not None
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table by name, or a parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def sql_scan(spark: SparkSession, text: str) -> DataFrame:
    """SQL text scan (S3) — plain ``spark.sql``; Catalyst optimises it."""
    return spark.sql(text)


def normalise_na(df: DataFrame, cols: list[str] | None = None, tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Turn missing-value tokens into NULL in string columns (S1 semantics)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    targets = [c for c in (cols or strings) if c in strings]
    if not targets:
        return df
    return df.withColumns({c: na_token_to_null(F.col(c), tokens) for c in targets})


def read_csv_na(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_tokens=PANDAS_NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV scan with pandas-style missing tokens.

    All columns are first read as strings so that every token can be
    recognised (Spark's ``nullValue`` takes a single token); typed columns
    are then produced with ``try_cast`` so a stray token never fails a job.
    Without a ``schema`` the types are inferred (:func:`infer_types`).
    Files are split across tasks; ``multi_line`` (quoted line breaks) makes
    each file one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    raw = reader.csv(path)
    raw = normalise_na(raw, tokens=na_tokens)
    if schema is None:
        schema = infer_types(raw)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    cols = []
    for f in schema.fields:
        if f.name in raw.columns:
            cols.append(try_cast_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def infer_types(raw: DataFrame) -> T.StructType:
    """Types of text columns, from one aggregate over them: long if every non-null
    value is a whole number, else double if every one is a number, else boolean if
    all are true / false, else text (also for columns without any value)."""
    kinds = [(T.LongType(), "l"), (T.DoubleType(), "d")]
    aggs = []
    for i, name in enumerate(raw.columns):
        c = F.col("`" + name.replace("`", "``") + "`")
        aggs.append(F.count(c).alias(f"n{i}"))
        aggs += [F.count(try_cast_text(c, t)).alias(f"{k}{i}") for t, k in kinds]
        aggs.append(F.count_if(F.lower(c).isin("true", "false")).alias(f"b{i}"))
    row = raw.agg(*aggs).first()
    out = T.StructType()
    for i, name in enumerate(raw.columns):
        n = row[f"n{i}"]
        kind = next((t for t, k in [*kinds, (T.BooleanType(), "b")] if n and row[f"{k}{i}"] == n), T.StringType())
        out.add(name, kind)
    return out


def from_local(spark: SparkSession, pdf, schema=None) -> DataFrame:
    """Local rows → distributed table with NaN normalised to NULL.

    For small driver-side inputs only (fixtures, parameters); bulk data
    must be read with a reader, never shipped through the driver.
    """
    df = spark.createDataFrame(pdf, schema=schema)
    return nan_to_null(df)


def write_snapshot(df: DataFrame, target: str, mode: str = "overwrite", partition_by=None, location: str | None = None) -> None:
    """Overwrite sink (S5): a parquet path (has a ``/``) or a catalog table by name,
    optionally partitioned.  ``location`` places a new table's files."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.parquet(target)
        return
    w = w.format("parquet")
    (w.option("path", location) if location else w).saveAsTable(target)


def append(df: DataFrame, target: str, partition_by=None, location: str | None = None) -> None:
    """Append sink (S6), by path or table name; with ``partition_by`` only those
    folders are touched.  A table's columns are matched by name."""
    write_snapshot(df, target, mode="append", partition_by=partition_by, location=location)


def overwrite_partitions(df: DataFrame, target: str, partition_by: list[str], location: str | None = None) -> None:
    """Reload sink (S6): replaces the partitions that ``df`` has rows of and leaves all others
    as they are, by path (has a ``/``) or table name.  Run again with the same rows it gives
    the same table; without rows nothing changes.

    Dynamic overwrite is asked for on this one write, whatever the session's setting, and the
    folders are swapped when the job commits, so a failed reload leaves the old ones.  Rows
    are rebalanced by partition: a day's rows go to few files, and a large day to many tasks."""
    df = df.hint("rebalance", *partition_by)
    spark = df.sparkSession
    if "/" not in target and spark.catalog.tableExists(target):
        columns = spark.table(target).columns  # insertInto goes by position
        df.select(*[f"`{c}`" for c in columns]).write.option("partitionOverwriteMode", "dynamic").insertInto(target, overwrite=True)
        return
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if "/" in target:
        w.parquet(target)
        return
    w = w.format("parquet")
    (w.option("path", location) if location else w).saveAsTable(target)


def preview(df: DataFrame, n: int = 20):
    """Bounded hand-off to local memory (S12): never more than ``n`` rows."""
    return df.limit(n).toPandas()


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON documents with an explicit schema, no inference pass.

    ``multi_line`` for one pretty-printed document per file; line-delimited
    documents (as ``write.json`` produces) split across tasks.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
