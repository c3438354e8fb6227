"""Partition-independent pseudo-randomness.

All draws in the package (splits, routing, resampling, synthetic tables)
come from an md5 of the row's key text plus a seed and a salt, never from
``rand()``.  The result therefore does not depend on partitioning, task
retries or executor loss, and every draw has a plain-SQL equivalent
(``md5`` + hex parsing) that an independent engine can evaluate.

SQL equivalents (DuckDB):
    hash52(k)  = ('0x' || substr(md5(<key text>), 1, 13))::BIGINT
    uniform(k) = hash52(k) / 4503599627370496.0            -- 2**52
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2**52)


def key_text(*cols: Column | str, seed: int | str | None = None, salt: str | None = None) -> Column:
    """``concat_ws('|', key..., salt, seed)`` with every part cast to string."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.concat_ws("|", *parts)


def key_sql(*cols: str, seed: int | str | None = None, salt: str | None = None) -> str:
    """The same key text as :func:`key_text`, written as SQL for an oracle."""
    parts = [f"CAST({c} AS VARCHAR)" for c in cols]
    if salt is not None:
        parts.append(f"'{salt}'")
    if seed is not None:
        parts.append(f"'{seed}'")
    return "concat_ws('|', " + ", ".join(parts) + ")"


def hash52(text: Column) -> Column:
    """First 13 hex digits of md5(text) as a non-negative 52-bit long."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def hash52_sql(text_sql: str) -> str:
    return f"('0x' || substr(md5({text_sql}), 1, 13))::BIGINT"


def uniform(text: Column) -> Column:
    """Uniform double in [0, 1), exact: 52-bit integer / 2**52."""
    return hash52(text).cast("double") / F.lit(TWO_POW_52)


def uniform_sql(text_sql: str) -> str:
    return f"(CAST({hash52_sql(text_sql)} AS DOUBLE) / 4503599627370496.0)"


def uniform_pair(text: Column) -> tuple[Column, Column]:
    """Two independent uniforms from ONE md5: hex digits 1-13 and 14-26."""
    h = F.md5(text)
    u1 = F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") / F.lit(TWO_POW_52)
    u2 = F.conv(F.substring(h, 14, 13), 16, 10).cast("long").cast("double") / F.lit(TWO_POW_52)
    return u1, u2


def uniform_pair_sql(text_sql: str) -> tuple[str, str]:
    a = f"(CAST(('0x' || substr(md5({text_sql}), 1, 13))::BIGINT AS DOUBLE) / 4503599627370496.0)"
    b = f"(CAST(('0x' || substr(md5({text_sql}), 14, 13))::BIGINT AS DOUBLE) / 4503599627370496.0)"
    return a, b


def md5_parity(text: Column) -> Column:
    """Parity of the full 128-bit md5 integer = parity of its last hex digit
    (odd digits: 1 3 5 7 9 b d f) — a character test, no hex parsing."""
    return F.substring(F.md5(text), 32, 1).isin(*"13579bdf").cast("int")
