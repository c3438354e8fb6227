"""Golden output of the character-table cleaning recipe (own rows, one for each
rule, plus the boundary rows), and the single cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import clean

RAW_SCHEMA = (
    "PageID long, `Height (m)` double, `Weight (kg)` double, Universe string, Teams string, Origin string, "
    "Identity string, Gender string, `Marital Status` string, Alive string"
)
# feature lists follow from the recipe: measures, presence and keyword flags; then every cleaned category
SPEC = clean.entity_spec([], [])
NUM = [*[v for k, v in SPEC.rename.items() if "(" in k], *SPEC.presence.values(), *[into for *_, into in SPEC.flags]]
CAT = [*SPEC.rare, *SPEC.classify, *SPEC.allow, *SPEC.in_or_else]

# giant robot without a team; widowed sorcerer; god of unknown measures; a row of gaps; dead demon of a rare gender
FIVE = [
    (11, 2.44, 310.5, "Dimension Q", None, "Android", "Public", "Agender", "Separated", "Alive"),
    (12, 1.63, 54.2, None, "Night Watch", "Human (Magic user)", "Secret", "Female", "Widow", "Alive"),
    (13, None, None, "Dimension Q", "Sky Court", "God/Eternal", None, "Male", "Married", "Dead"),
    (14, 0.95, 12.0, "Pocket Realm", None, None, "Secret", None, None, "Alive"),
    (15, 3.1, 700.0, "Pocket Realm", "Ash Circle", "Demon", "Unknown", "Female", "Single", "Dead"),
]
# 11 goes (its marital status is on no list); every universe is rare
EXPECTED = [
    (1.63, 54.2, 1, 1, 0, "Other", "Human", "Secret", "Widowed", "Female", 1, "12"),
    (None, None, 1, 0, 0, "Other", "Other", "Unknown", "Married", "Male", 0, "13"),
    (0.95, 12.0, 0, 0, 0, "Other", "Other", "Secret", "Unknown", "Other", 1, "14"),
    (3.1, 700.0, 1, 0, 0, "Other", "Other", "Unknown", "Single", "Female", 0, "15"),
]


def test_five_row_golden(spark):
    df = spark.createDataFrame(FIVE, RAW_SCHEMA)
    out = clean.clean(df, clean.entity_spec(NUM, CAT))
    assert out.columns == NUM + CAT + ["Alive", "Id"]
    assert dict(out.dtypes)["Id"] == "string" and dict(out.dtypes)["Alive"] == "int"
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(EXPECTED, key=repr)


def test_boundary_rows(spark):
    rows = list(FIVE)
    rows += [
        (6, 1.8, 70.0, "Earth-1", None, "Inhuman", "Public", "Male", "Single", "Alive"),
        (7, 1.8, 70.0, "Earth-1", None, "Mutate (Magic)", "Public", "Male", "Single", "Alive"),
        (8, 1.8, 70.0, "Earth-1", None, "Human", "Public", "Male", "Divorced", "Alive"),
        (9, 1.8, 70.0, "Earth-1", None, "Human", "No Dual Identity", "Male", "Single", "Alive"),
        (10, 1.8, 70.0, "Earth-1", None, "Human", "Public", "Male", "Single", None),
    ]
    # Earth-1: 50 rows in total (counted before the filters drop 8, 9, 10) → kept;
    # Earth-2: 49 rows → collapsed to Other.
    rows += [(100 + i, 1.7, 60.0, "Earth-1", None, "Robot", "Public", "Male", "Single", "Dead") for i in range(45)]
    rows += [(200 + i, 1.7, 60.0, "Earth-2", None, "Robot", "Public", "Male", "Single", "Dead") for i in range(49)]
    out = clean.clean(spark.createDataFrame(rows, RAW_SCHEMA), clean.entity_spec(NUM, CAT))
    got = {r["Id"]: r for r in out.collect()}
    assert got["6"]["Origin"] == "Human" and got["6"]["Magic"] == 0 and got["6"]["Mutant"] == 0
    assert got["7"]["Origin"] == "Mutant" and got["7"]["Magic"] == 1 and got["7"]["Mutant"] == 1
    assert "8" not in got and "9" not in got and "10" not in got
    assert got["6"]["Universe"] == "Earth-1"
    assert got["200"]["Universe"] == "Other"
    assert len(got) == 4 + 2 + 45 + 49


def test_collapse_rare_counts_before_filter(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, "a").otherwise("b").alias("v"), "id")
    out = clean.collapse_rare(df, "v", min_count=50).filter(F.col("id") < 10)
    assert {r["v"] for r in out.collect()} == {"a"}
    out2 = clean.collapse_rare(df, "v", min_count=50)
    assert out2.filter(F.col("v") == "Other").count() == 40


def test_keyword_rules_are_case_insensitive_and_ordered(spark):
    df = spark.createDataFrame([("Inhuman Mutant",), ("COSMIC BEING",), (None,)], "o string")
    out = clean.classify(df, "o", clean.ENTITY_ORIGIN_RULES, "Other").collect()
    assert [r["o"] for r in out] == ["Human", "Cosmic Being", "Other"]
