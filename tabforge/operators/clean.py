"""Cleaning operators (P1-P24) and the configurable cleaning chain.

All row-level rules compile to built-in expressions (CASE WHEN, IN,
contains, coalesce) that stay inside whole-stage codegen; a chain of them is
one narrow stage.  The only wide step is :func:`collapse_rare`, whose counts
are taken over the *whole* input before any row filter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.casts import try_cast_col


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def project(df: DataFrame, num=(), cat=(), target=None, id_col=None) -> DataFrame:
    """Select numeric + categorical + target + id, in that order."""
    cols = [*num, *cat] + ([target] if target else []) + ([id_col] if id_col else [])
    return df.select(*[F.col(f"`{c}`") for c in cols])


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill NULLs with a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def presence(df: DataFrame, col: str, into: str | None = None) -> DataFrame:
    """1 when the value is present, 0 when NULL."""
    return df.withColumn(into or col, F.col(col).isNotNull().cast("int"))


def keep_in(df: DataFrame, col: str, values) -> DataFrame:
    """Keep rows whose value is in the allow-list; NULL fails (P5)."""
    return df.filter(F.col(col).isin(list(values)))


def in_or_else(df: DataFrame, col: str, values, other: str = "Other", into: str | None = None) -> DataFrame:
    """Keep the value if it is in the list, else a constant."""
    return df.withColumn(into or col, F.when(F.col(col).isin(list(values)), F.col(col)).otherwise(F.lit(other)))


def replace_values(df: DataFrame, col: str, mapping: dict, into: str | None = None) -> DataFrame:
    """Exact value replacement; values not in the map are kept."""
    c = F.col(col)
    expr = None
    for old, new in mapping.items():
        expr = (F.when(c == F.lit(old), F.lit(new)) if expr is None else expr.when(c == F.lit(old), F.lit(new)))
    return df.withColumn(into or col, expr.otherwise(c) if expr is not None else c)


def contains_any(c: Column, words) -> Column:
    """Case-insensitive substring test, OR over the words (NULL → false)."""
    low = F.lower(c)
    cond = F.lit(False)
    for w in words:
        cond = cond | low.contains(w.lower())
    return F.coalesce(cond, F.lit(False))


def keyword_flag(df: DataFrame, col: str, words, into: str) -> DataFrame:
    """1 when the text contains any keyword, case-insensitive."""
    return df.withColumn(into, contains_any(F.col(col), words).cast("int"))


def classify(df: DataFrame, col: str, rules, default: str = "Other", into: str | None = None) -> DataFrame:
    """First-match keyword classification.

    ``rules`` is an ordered list of ``(words, label)``; the first rule whose
    any-word substring test matches wins (case-insensitive).
    """
    expr = None
    for words, label in rules:
        cond = contains_any(F.col(col), words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(into or col, expr.otherwise(F.lit(default)) if expr is not None else F.lit(default))


def frequent_values(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Values of ``col`` occurring at least ``min_count`` times: ``(col, _keep)``.

    Partial aggregation before the shuffle: a hot value costs one counter
    per map task, not a skewed partition.
    """
    return df.groupBy(col).count().filter(F.col("count") >= min_count).select(col, F.lit(True).alias("_keep"))


def collapse_rare(
    df: DataFrame,
    col: str,
    min_count: int = 50,
    other: str = "Other",
    fill_value: str | None = "Unknown",
    into: str | None = None,
) -> DataFrame:
    """Fill NULLs, then replace values seen fewer than ``min_count`` times by
    ``other`` (P10).  Counts are over the whole input passed in.

    Plan: ``groupBy.count`` (partial + final hash aggregate) → keep-set of
    at most N/min_count values → left join that adaptive execution broadcasts if its measured bytes allow.  No
    ``count() over (partition by col)``, which would shuffle every row by a
    possibly hot value.
    """
    src = fill(df, {col: fill_value}) if fill_value is not None else df
    keep = frequent_values(src, col, min_count)
    joined = src.join(keep, col, "left")
    target = into or col
    out = joined.withColumn(target, F.when(F.col("_keep"), F.col(col)).otherwise(F.lit(other)))
    order = src.columns + ([target] if target not in src.columns else [])
    return out.select(*[F.col(f"`{c}`") for c in order])


def collapse_to_top(df: DataFrame, col: str, n: int, other: str = "Other", fill_value: str | None = "Unknown", into: str | None = None) -> DataFrame:
    """Fill NULLs, then keep the ``n`` most frequent values and replace all others by ``other``
    (P10 by rank).  The values to keep come from :func:`tabforge.operators.metrics.value_counts_top`:
    ``n`` rows, however many distinct values there are."""
    from tabforge.operators.metrics import value_counts_top

    src = fill(df, {col: fill_value}) if fill_value is not None else df
    keep = value_counts_top(src, col, n).select(F.col(col).alias("_kept"), F.lit(True).alias("_keep"))
    joined = src.join(F.broadcast(keep), F.col(f"`{col}`").eqNullSafe(F.col("_kept")), "left")  # n rows
    target = into or col
    out = joined.withColumn(target, F.when(F.col("_keep"), F.col(f"`{col}`")).otherwise(F.lit(other)))
    order = src.columns + ([target] if target not in src.columns else [])
    return out.select(*[F.col(f"`{c}`") for c in order])


def binarise(df: DataFrame, col: str, positive, negative, into: str | None = None) -> DataFrame:
    """Keep rows with one of the two labels, map positive → 1, negative → 0."""
    return df.filter(F.col(col).isin([positive, negative])).withColumn(
        into or col, (F.col(col) == F.lit(positive)).cast("int")
    )


def cast_cols(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """Cast columns; ``safe`` uses ``try_cast`` (bad value → NULL) (P12),
    with the fast path for text sources."""
    src = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: (try_cast_col(F.col(c), src[c], t) if safe else F.col(c).cast(t)) for c, t in types.items()}
    )


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


def stamp(df: DataFrame, name: str = "update_timestamp_utc") -> DataFrame:
    """Load timestamp, identical in every row of one query."""
    return df.withColumn(name, F.current_timestamp())


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows NULL in any of ``cols``."""
    return df.dropna(subset=cols)


def decode(df: DataFrame, col: str, mapping: dict, default, into: str | None = None) -> DataFrame:
    """Decode codes to labels; anything unmapped (and NULL) → default."""
    c = F.col(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    expr = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return df.withColumn(into or col, expr)


def floor_at(c: Column, lo: float) -> Column:
    """``max(lo, x)``; NULL stays NULL."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(lo), c))


def scale(c: Column, k: float) -> Column:
    """``x * k``."""
    return c * F.lit(float(k))


# --------------------------------------------------------------------------
# The cleaning chain, as configuration.
# --------------------------------------------------------------------------


@dataclass
class CleanSpec:
    """Declarative cleaning recipe; every step is optional.

    Steps run in this order (the order of the monitored model's cleaning):
    rename → rare-collapse (counts over the unfiltered input) → presence
    flags → fills → allow-list filters → in-or-else → replacements →
    keyword flags → keyword classification → binary target → projection →
    id to text.
    """

    rename: dict[str, str] = field(default_factory=dict)
    rare: dict[str, int] = field(default_factory=dict)  # col -> min_count
    rare_fill: str = "Unknown"
    rare_other: str = "Other"
    presence: dict[str, str] = field(default_factory=dict)  # col -> into
    fills: dict[str, object] = field(default_factory=dict)
    allow: dict[str, list] = field(default_factory=dict)  # col -> kept values (applied after replace)
    in_or_else: dict[str, list] = field(default_factory=dict)
    other: str = "Other"
    replace: dict[str, dict] = field(default_factory=dict)
    flags: list[tuple[str, list[str], str]] = field(default_factory=list)  # (src, words, into)
    classify: dict[str, list] = field(default_factory=dict)  # col -> [(words, label)]
    target: tuple[str, object, object] | None = None  # (col, positive, negative)
    num: list[str] = field(default_factory=list)
    cat: list[str] = field(default_factory=list)
    id_col: str | None = None
    id_into: str | None = None


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a :class:`CleanSpec`; one narrow stage plus one small
    aggregation per rare-collapsed column."""
    out = rename(df, spec.rename)
    for col, n in spec.rare.items():
        out = collapse_rare(out, col, n, other=spec.rare_other, fill_value=spec.rare_fill)
    for col, into in spec.presence.items():
        out = presence(out, col, into)
    if spec.fills:
        out = fill(out, spec.fills)
    for col, mapping in spec.replace.items():
        out = replace_values(out, col, mapping)
    for col, values in spec.allow.items():
        out = keep_in(out, col, values)
    for col, values in spec.in_or_else.items():
        out = in_or_else(out, col, values, spec.other)
    for src, words, into in spec.flags:
        out = keyword_flag(out, src, words, into)
    for col, rules in spec.classify.items():
        out = classify(out, col, rules, spec.other)
    target = None
    if spec.target:
        target, pos, neg = spec.target
        out = binarise(out, target, pos, neg)
    if spec.num or spec.cat:
        out = project(out, spec.num, spec.cat, target, spec.id_col)
    if spec.id_col:
        out = out.withColumn(spec.id_col, F.col(spec.id_col).cast("string"))
        if spec.id_into:
            out = out.withColumnRenamed(spec.id_col, spec.id_into)
    return out


# The character-table cleaning rules of the monitored model
# (column names, allow-lists, replacements, keyword rules in priority order).
ENTITY_ORIGIN_RULES = [
    (["human"], "Human"),
    (["mutate", "mutant"], "Mutant"),
    (["asgardian"], "Asgardian"),
    (["alien"], "Alien"),
    (["symbiote"], "Symbiote"),
    (["robot"], "Robot"),
    (["cosmic being"], "Cosmic Being"),
]


def entity_spec(num: list[str], cat: list[str], target: str = "Alive", min_count: int = 50) -> CleanSpec:
    """The character-table recipe with the given feature lists."""
    return CleanSpec(
        rename={"Height (m)": "Height", "Weight (kg)": "Weight", "Marital Status": "Marital_Status"},
        rare={"Universe": min_count},
        presence={"Teams": "Teams"},
        fills={"Origin": "Unknown", "Identity": "Unknown", "Gender": "Unknown", "Marital_Status": "Unknown"},
        replace={"Marital_Status": {"Widow": "Widowed"}},
        allow={
            "Identity": ["Public", "Secret", "Unknown"],
            "Marital_Status": ["Single", "Married", "Widowed", "Engaged", "Unknown"],
        },
        in_or_else={"Gender": ["Male", "Female"]},
        flags=[("Origin", ["magic"], "Magic"), ("Origin", ["mutate", "mutant"], "Mutant")],
        classify={"Origin": ENTITY_ORIGIN_RULES},
        target=(target, "Alive", "Dead"),
        num=num,
        cat=cat,
        id_col="PageID",
        id_into="Id",
    )
