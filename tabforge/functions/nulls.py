"""Null / NaN normalisation shared by every ingestion point.

Spark keeps NaN and NULL apart (``isnull`` ignores NaN, ``avg`` is poisoned
by NaN, ``NaN = NaN`` is true); pandas treats both as missing.  Operators
that accept pandas-origin data normalise floats with :func:`nan_to_null`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# pandas' default missing-value tokens that a header CSV scan
# must turn into NULL (the lower-case word "none" is NOT one of them).
PANDAS_NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_token_to_null(c: Column, tokens=PANDAS_NA_TOKENS) -> Column:
    """NULL when the string value is one of the missing-value tokens."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def nan_to_null_col(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in the given (default: all floating) columns."""
    floating = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    targets = [c for c in (cols or floating) if c in floating]
    if not targets:
        return df
    return df.withColumns({c: nan_to_null_col(F.col(c)) for c in targets})
