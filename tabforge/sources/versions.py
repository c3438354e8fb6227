"""Versions of a table, change feeds, incremental loads, lineage.

A versioned table is one Parquet table with two partition columns: every write has a
``version``, and a ``snapshot``, the version of the last overwrite.  Version v is the rows of
its snapshot up to v, so an append writes only its own rows, and reading a version is a
filter on partition columns.  Each write holds one marker row (operation and time) beside
its data, committed with it by the same job; the history is a grouping of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.plans.joins import materialise
from tabforge.plans.prefix import row_print
from tabforge.sources.tables import path_exists

#: Columns that a versioned table has beside its data.
OWN = "_operation string, _at timestamp, snapshot long, version long"


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """The marker rows: one per version."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], OWN)
    return spark.read.schema(OWN).parquet(path).where("_operation is not null")


def history(spark: SparkSession, path: str) -> DataFrame:
    """version, operation, at, num_rows of a versioned table, newest first.

    Rows are counted from the files' footers by partition; a version's rows are those of its
    snapshot so far, a running sum over the versions."""
    marks = _marks(spark, path)
    if not path_exists(spark, path):
        return marks.select("version", F.col("_operation").alias("operation"), F.col("_at").alias("at"), F.lit(0).cast("long").alias("num_rows"))
    each = spark.read.schema(OWN).parquet(path).groupBy("snapshot", "version").agg((F.count(F.lit(1)) - 1).alias("rows"))
    upto = Window.partitionBy("snapshot").orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    each = each.select("version", F.sum("rows").over(upto).alias("num_rows"))
    out = marks.join(each, "version").select("version", F.col("_operation").alias("operation"), F.col("_at").alias("at"), "num_rows")
    return out.orderBy(F.desc("version"))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Highest version, or None."""
    return _marks(spark, path).agg(F.max("version")).first()[0]


def write_version(df: DataFrame, path: str, operation: str = "WRITE", mode: str = "overwrite") -> int:
    """Write ``df`` as the next version (one writer at a time) and return its number:
    the table's rows from now on (``overwrite``, S5) or further rows (``append``, S6).
    A version without rows is a version too."""
    spark = df.sparkSession
    if taken := {c.lower() for c in df.columns} & {"_operation", "_at", "snapshot", "version"}:
        raise ValueError(f"a versioned table has columns of its own named {sorted(taken)}")
    last = _marks(spark, path).agg(F.max("snapshot"), F.max("version")).first()
    version = 0 if last[1] is None else last[1] + 1
    snapshot = version if mode == "overwrite" or last[0] is None else last[0]
    mark = spark.range(1).select(F.lit(operation).alias("_operation"), F.current_timestamp().alias("_at"))
    rows = df.withColumns({"_operation": F.lit(None).cast("string"), "_at": F.lit(None).cast("timestamp")})
    both = rows.unionByName(mark, allowMissingColumns=True).withColumns({"snapshot": F.lit(snapshot), "version": F.lit(version)})
    both.write.mode("append").partitionBy("snapshot", "version").parquet(path)
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (default: the latest) (S9); only its own folders are read."""
    told = _marks(spark, path)
    chosen = told.where(F.col("version") == version) if version is not None else told
    row = chosen.orderBy(F.desc("version")).select("snapshot", "version").first()
    if row is None:
        raise ValueError(f"no version {version} in {path}")
    rows = spark.read.option("mergeSchema", False).parquet(path)
    rows = rows.where((F.col("snapshot") == row["snapshot"]) & (F.col("version") <= row["version"]) & F.col("_operation").isNull())
    return rows.drop("_operation", "_at", "snapshot", "version")


def log_input(spark: SparkSession, lineage: str, run_id: str, context: str, path: str, version: int | None = None) -> None:
    """Note that a run used a version (default: the latest) of a table in a context such as
    ``training``: one row (run_id, context, path, snapshot, version) of the lineage table."""
    told = _marks(spark, path).where(F.col("version") == version) if version is not None else _marks(spark, path)
    row = told.orderBy(F.desc("version")).limit(1)
    row = row.select(F.lit(run_id).alias("run_id"), F.lit(context).alias("context"), F.lit(path).alias("path"), "snapshot", "version")
    row.coalesce(1).write.mode("append").parquet(lineage)


def read_by_lineage(spark: SparkSession, lineage: str, run_id: str, context: str) -> DataFrame:
    """The rows that a run used in a context, of the version it used."""
    used = spark.read.parquet(lineage).where((F.col("run_id") == run_id) & (F.col("context") == context))
    row = used.select("path", "version").first()
    if row is None:
        raise ValueError(f"run {run_id} has no input {context}")
    return read_version(spark, row["path"], row["version"])


def rows_by_lineage(lineage: DataFrame, path: str) -> DataFrame:
    """The rows of one table for every run and context that used it: ``run_id, context`` and the
    data.  One join of the lineage with the table on its partition columns."""
    spark = lineage.sparkSession
    rows = spark.read.parquet(path).where(F.col("_operation").isNull())
    used = lineage.where(F.col("path") == path).select("run_id", "context", F.col("snapshot").alias("_of"), F.col("version").alias("_upto")).distinct()
    met = rows.join(used, (rows["snapshot"] == used["_of"]) & (rows["version"] <= used["_upto"]))
    return met.select("run_id", "context", *[c for c in rows.columns if c not in ("_operation", "_at", "snapshot", "version")])


def change_feed(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Row-level changes between two versions.

    ``_change_type`` ∈ {insert, delete, update_preimage, update_postimage}.
    One full outer join on the keys (shuffle on a unique key: no skew; a NULL
    key is a key like any other), null-safe comparison of the other columns, and pre/post images emitted
    by one ``explode`` of a per-row array — a single pass, no union of scans.
    """
    cols = cols or [c for c in new.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"_ok_{k}") for k in keys], *[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(*[F.col(k).alias(f"_nk_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_in_new"))
    j = o.join(n, [F.col(f"_ok_{k}").eqNullSafe(F.col(f"_nk_{k}")) for k in keys], "full_outer")
    j = j.withColumns({k: F.when(F.col("_in_new"), F.col(f"_nk_{k}")).otherwise(F.col(f"_ok_{k}")) for k in keys})
    in_old, in_new = F.coalesce(F.col("_in_old"), F.lit(False)), F.coalesce(F.col("_in_new"), F.lit(False))
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))

    def image(prefix: str, kind: str):
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in cols], F.lit(kind).alias("_change_type"))

    images = (
        F.when(in_new & ~in_old, F.array(image("_n_", "insert")))
        .when(in_old & ~in_new, F.array(image("_o_", "delete")))
        .when(~same, F.array(image("_o_", "update_preimage"), image("_n_", "update_postimage")))
    )
    changed = j.filter(~(in_old & in_new & same))
    return changed.select(*keys, F.explode(images).alias("_img")).select(*keys, "_img.*")


#: Ranges of a digest's first level, and of each of them at its second.
COARSE, FINE = 256, 4096


def _ranged(df: DataFrame, keys: list[str], cols: list[str], coarse: int, fine: int) -> DataFrame:
    """``df`` with the two range numbers of its key's hash."""
    h = F.xxhash64(F.lit(11), *[F.col(k) for k in keys])
    return df.select(
        *keys, *cols, F.pmod(h, F.lit(coarse)).cast("int").alias("_coarse"), F.pmod(F.shiftrightunsigned(h, 16), F.lit(fine)).cast("int").alias("_fine")
    )


def _digest(df: DataFrame, groups: list[str], prints: DataFrame) -> DataFrame:
    """Rows and two order-free sums of row hashes by group; a partial aggregate, no row is shuffled."""
    whole = prints.drop("_coarse", "_fine")
    rows = prints.withColumns({"_a": row_print(whole), "_b": F.xxhash64(F.lit(5), row_print(whole), *_hashables(whole))})
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_a").alias("a"), F.sum(F.col("_b").cast("decimal(20,0)")).alias("b")
    )


def _hashables(df: DataFrame) -> list[Column]:
    return [F.to_json(F.struct(c)) if "map<" in t or "variant" in t else F.col(f"`{c}`") for c, t in df.dtypes]


def digests(df: DataFrame, keys: list[str], cols: list[str] | None = None, coarse: int = COARSE, fine: int = FINE) -> DataFrame:
    """Digests of a version by range of its keys' hash, at most ``coarse * fine`` rows: _coarse,
    _fine, n, a, b.  Stored beside a version, they tell what changed without reading it."""
    cols = cols or [c for c in df.columns if c not in keys]
    return _digest(df, ["_coarse", "_fine"], _ranged(df, keys, cols, coarse, fine))


def _differing(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """Ranges whose digests differ, or that one side lacks."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    alike = both.groupBy(*on).agg(
        F.count(F.lit(1)).alias("sides"), F.count_distinct(F.struct("n", "a", "b")).alias("kinds")
    )
    return alike.where((F.col("sides") < 2) | (F.col("kinds") > 1)).select(*on)


def changed_ranges(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    cols: list[str] | None = None,
    old_digests: DataFrame | None = None,
    new_digests: DataFrame | None = None,
    coarse: int = COARSE,
    fine: int = FINE,
) -> DataFrame:
    """(_coarse, _fine) of the key ranges that differ between two versions.

    With stored digests of both versions neither is read.  Else the first level finds the
    coarse ranges that differ (at most ``coarse`` rows come to the driver) and the second
    looks only at the rows of those."""
    cols = cols or [c for c in new.columns if c not in keys]
    if old_digests is not None and new_digests is not None:
        return _differing(old_digests, new_digests, ["_coarse", "_fine"])
    o, n = (_ranged(df, keys, cols, coarse, fine) for df in (old, new))
    first = _differing(_digest(old, ["_coarse"], o), _digest(new, ["_coarse"], n), ["_coarse"])
    some = [r["_coarse"] for r in first.collect()]
    part = F.col("_coarse").isin(some) if some else F.lit(False)
    second = (_digest(df, ["_coarse", "_fine"], r.where(part)) for df, r in ((old, o), (new, n)))
    return _differing(*second, ["_coarse", "_fine"])


def change_feed_digest(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    cols: list[str] | None = None,
    old_digests: DataFrame | None = None,
    new_digests: DataFrame | None = None,
    coarse: int = COARSE,
    fine: int = FINE,
) -> DataFrame:
    """:func:`change_feed` that joins only the key ranges whose digests differ.

    Where few rows change, nearly all of both versions is neither shuffled nor joined.  A
    range's digest has its number of rows, an xor and a sum of two 64-bit row hashes; a change
    that leaves all three alike goes unseen (chance about 2 ** -128)."""
    cols = cols or [c for c in new.columns if c not in keys]
    ranges = materialise(changed_ranges(old, new, keys, cols, old_digests, new_digests, coarse, fine))
    table = F.broadcast(ranges)  # at most coarse * fine pairs of numbers
    o, n = (_ranged(df, keys, cols, coarse, fine).join(table, ["_coarse", "_fine"], "left_semi") for df in (old, new))
    return change_feed(o.drop("_coarse", "_fine"), n.drop("_coarse", "_fine"), keys, cols)


def new_rows(src: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``src`` whose key is not yet in ``target`` (S11): a left-anti
    join — re-running a load over the same log adds nothing.  NULL is a key value
    like any other; of several rows with one key, one is kept (the smallest by a
    hash of the row)."""
    known = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    fresh = src.join(known, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")
    return one_per_key(fresh, keys)


def _any_null(cols: list[Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c.isNull()
    return out


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key (the smallest by a hash of the row); NULL is a key value like any other."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    one = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), row_print(df)).alias("_one"))
    return one.select(*keys, "_one.*").select(*df.columns)


def new_rows_bucketed(src: DataFrame, table: str, keys: list[str], day_col: str | None = None) -> DataFrame:
    """Rows of ``src`` whose key is not yet in the bucketed ``table`` (S11), one per key.

    The table is bucketed by ``keys``, so its side of the join is read in place: only ``src``,
    the new part of the log, is shuffled, to the table's buckets.  Keys without NULLs meet by
    plain equality (which bucketing serves); keys with a NULL are looked up among the stored
    keys with a NULL, a pushed-down filter.

    ``day_col`` names a partition column of the table that every key has one value of; then
    only the partitions between the first and the last day of ``src`` are read."""
    known = src.sparkSession.table(table)
    if day_col is not None:
        first, last = src.agg(F.min(day_col), F.max(day_col)).first()
        near = F.col(day_col).isNull() if first is None else F.col(day_col).isNull() | F.col(day_col).between(F.lit(first), F.lit(last))
        known = known.where(near)
    whole = src.where(~_any_null([F.col(k) for k in keys]))
    odd = src.where(_any_null([F.col(k) for k in keys]))
    fresh = whole.join(known.select(*keys), keys, "left_anti").select(*src.columns)
    lost = known.where(_any_null([F.col(k) for k in keys])).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    fresh_odd = odd.join(lost, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")
    return one_per_key(fresh, keys).unionAll(one_per_key(fresh_odd, keys))


def load_new_bucketed(
    src: DataFrame,
    table: str,
    keys: list[str],
    buckets: int = 16,
    location: str | None = None,
    partition_by: list[str] | None = None,
    day_col: str | None = None,
) -> int:
    """Append only the new rows of ``src`` to a table bucketed by ``keys`` (made if there is
    none); returns the number appended, from an Observation of the write.

    The new rows are dealt to the buckets before they are written, so a load adds one file a
    bucket (and partition).  For a large history take as many buckets as give files of some
    hundred MB."""
    spark = src.sparkSession
    if spark.catalog.tableExists(table):
        fresh = new_rows_bucketed(src, table, keys, day_col)
        fresh = fresh.select(*spark.table(table).columns)
    else:
        fresh = one_per_key(src, keys)
    obs = Observation("appended")
    dealt = fresh.repartition(buckets, *keys).observe(obs, F.count(F.lit(1)).alias("n"))
    w = dealt.write.format("parquet").mode("append").bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location and not spark.catalog.tableExists(table):
        w = w.option("path", location)
    w.saveAsTable(table)
    return int(obs.get["n"])


def load_new(src: DataFrame, target_path: str, keys: list[str], partition_by=None) -> int:
    """Append only the new rows of ``src`` to the parquet table at
    ``target_path``; returns the number appended (from an Observation)."""
    spark = src.sparkSession
    # an explicit schema: a target without files yet is an empty table
    known = spark.read.schema(src.schema).parquet(target_path) if path_exists(spark, target_path) else src.limit(0)
    fresh = new_rows(src, known, keys)
    obs = Observation("appended")
    w = fresh.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target_path)
    return int(obs.get["n"])
