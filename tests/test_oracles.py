"""Every catalog query against its DuckDB oracle on the smallest tables
(rows-only queries must run and return rows)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert res["status"] in ("match", "rows-only"), res
    if res["status"] == "rows-only":
        assert res["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "window_start" in df.columns


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_column_types_match_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(entry.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
