"""The driver's contract: queries and SQL, with and without the optional subpackage."""

from __future__ import annotations

import re
import subprocess
import sys

import __spark_entry__ as entry


def test_core_queries_survive_a_missing_library():
    """Without a library that only the optional queries need, all others are there."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); print('N', len(q), any(x.startswith('op') for x in q), 'window_profile' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=entry.ROOT, capture_output=True, text=True, timeout=120)
    found = re.search(r"N (\d+) (\w+) (\w+)", out.stdout)
    assert found and int(found[1]) >= 100 and found[2] == "False" and found[3] == "True", out.stderr[-500:]


def test_every_sql_sum_of_whole_numbers_is_cast():
    """DuckDB sums whole numbers to HUGEINT: each aggregate of them in a core oracle's result is cast."""
    from tests.oracle_harness import duck

    con = duck("/root/testdata/sf0.001")
    for name, sql in entry.oracle_sql().items():
        types = [str(t) for t in con.sql(sql).types]
        assert "HUGEINT" not in types, name


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scratch_folders_can_be_removed(spark):
    import os
    import uuid

    import pytest

    from tabforge.session import remove_scratch, scratch_path

    path = scratch_path(spark, f"gone/{uuid.uuid4().hex}")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.replace("file:", ""))
    remove_scratch(spark, path)
    assert not os.path.exists(path.replace("file:", ""))
    with pytest.raises(ValueError):
        remove_scratch(spark, "/tmp/else")
