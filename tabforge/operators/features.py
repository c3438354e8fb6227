"""Categorical dictionaries, feature assembly and schema contracts
(M1-M3, M9).

A dictionary is a DataFrame ``(column_name, value, code)``: sorted distinct
non-null values per column mapped to ``0..k-1``.  It is built with ONE
``stack`` over all columns and a dense index per column computed with the
bucketed prefix pattern (no one-task window even for a high-cardinality
column).  Applying it is one left join per column, which adaptive execution
broadcasts when that column's dictionary is small in bytes; unseen and NULL get
``-1``.  Codes carry their categories as ``pyspark.ml`` metadata, so the tree
learner splits on sets of categories, not on the alphabetical order of codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.casts import try_cast_col
from tabforge.plans.joins import materialise
from tabforge.plans.prefix import dense_index

UNSEEN = -1


def quoted(name: str) -> str:
    """A column name as ``F.col`` needs it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def fit_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sorted distinct non-null values per column → codes 0..k-1 (M1)."""
    pairs = [a for c in cols for a in (F.lit(c), F.col(quoted(c)).cast("string"))]
    long = df.select(F.stack(F.lit(len(cols)), *pairs).alias("column_name", "value"))
    distinct = long.filter(F.col("value").isNotNull()).distinct()
    coded = dense_index(distinct, "value", groups=["column_name"], into="code")
    return coded.select("column_name", "value", "code")


def prepare_codes(codes: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Materialise a dictionary once (reliable checkpoint) and fetch its size
    per column (one tiny aggregate) — reusable across many applications."""
    codes_m = materialise(codes.filter(F.col("column_name").isin(cols)))
    sizes = {r["column_name"]: r["count"] for r in codes_m.groupBy("column_name").count().collect()}
    return codes_m, sizes


def apply_codes(
    df: DataFrame,
    codes: DataFrame,
    cols: list[str],
    suffix: str = "",
    sizes: dict[str, int] | None = None,
    nominal_bins: int = 0,
) -> DataFrame:
    """Replace each categorical column by its code; unseen / NULL → -1 (M2).

    Pass ``sizes`` from :func:`prepare_codes` to reuse an already materialised
    dictionary.  With ``nominal_bins`` codes are shifted by one (0 = unseen or
    NULL) and columns of fewer categories than that get nominal metadata.
    """
    if sizes is None:
        codes, sizes = prepare_codes(codes, cols)
    out = df
    for c in cols:
        d = codes.filter(F.col("column_name") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_code_{c}")
        )
        out = out.join(d, F.col(quoted(c)).cast("string") == F.col(quoted(f"_v_{c}")), "left")
        code = F.coalesce(F.col(quoted(f"_code_{c}")), F.lit(UNSEEN).cast("long"))
        if nominal_bins:
            code = (code + 1).cast("double")
            known = sizes.get(c, 0) + 1
            if known <= nominal_bins:
                kinds = {"type": "nominal", "name": c + suffix, "num_vals": known}
                code = code.alias(c + suffix, metadata={"ml_attr": kinds})
        out = out.withColumn(c + suffix, code).drop(f"_v_{c}", f"_code_{c}")
    return out


def assemble(df: DataFrame, cat_codes: list[str], num: list[str], into: str = "features",
             sentinel: float = -999.0) -> DataFrame:
    """Feature vector: encoded categoricals first, then numerics (M3).

    Spark's tree learners reject NULL/NaN, so every numeric gets a missing
    indicator and a sentinel value — the learner can still split missing
    rows apart, as the monitored model's learner does natively.
    """
    from pyspark.ml.feature import VectorAssembler

    filled, inputs = df, [*cat_codes]
    for c in num:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        filled = filled.withColumns(
            {f"_{c}_missing": x.isNull().cast("double"), f"_{c}_value": F.coalesce(x, F.lit(sentinel))}
        )
        inputs += [f"_{c}_value", f"_{c}_missing"]
    va = VectorAssembler(inputCols=inputs, outputCol=into, handleInvalid="keep")
    out = va.transform(filled)
    return out.drop(*[f"_{c}_missing" for c in num], *[f"_{c}_value" for c in num])


# ------------------------------------------------------------------ M9


def infer_contract(df: DataFrame) -> dict[str, str]:
    """Column → type name (driver-side schema metadata, no data read)."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def check_schema(df: DataFrame, contract: dict[str, str]) -> list[tuple[str, str, str | None]]:
    """Schema differences ``(column, expected, actual)`` — metadata only."""
    actual = infer_contract(df)
    return [(c, t, actual.get(c)) for c, t in contract.items() if actual.get(c) != t]


def contract_violations(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Per contract column: present?, rows whose non-null value does not
    convert to the contract type (``try_cast`` → NULL).  One aggregate over
    all columns, unpivoted with ``stack`` (M9)."""
    aggs, rows = [], []
    src = {f.name: f.dataType for f in df.schema.fields}
    for i, (c, t) in enumerate(contract.items()):
        if c in df.columns:
            v = F.col(quoted(c))
            aggs.append(F.count_if(v.isNotNull() & try_cast_col(v, src[c], t).isNull()).alias(f"v{i}"))
            rows += [F.lit(c), F.lit(t), F.lit(True), F.col(f"v{i}")]
        else:
            rows += [F.lit(c), F.lit(t), F.lit(False), F.lit(None).cast("long")]
    one = df.agg(*aggs) if aggs else df.sparkSession.range(1).select(F.lit(0).alias("_"))
    return one.select(
        F.stack(F.lit(len(rows) // 4), *rows).alias("column_name", "expected_type", "present", "n_violations")
    )


def schema_of(contract: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, T._parse_datatype_string(t)) for c, t in contract.items()])
