"""Run catalog queries on Spark and their SQL oracles on DuckDB; compare.

Comparison: row count, column-name set, loose type family per column and an
order-insensitive hash of the values (columns sorted by name, floats
rounded to 6 significant decimals, NaN == NULL).

    python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import numpy as np

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return _norm(v.to_pydatetime())
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def _family(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, (int, float)):
        return "num"
    return type(v).__name__


def fingerprint(columns: list[str], rows: list[tuple]):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = [tuple(_norm(r[i]) for i in order) for r in rows]
    fams = []
    for j in range(len(order)):
        fam = {_family(r[j]) for r in normed} - {None}
        fams.append(",".join(sorted(fam)))
    lines = sorted(repr(r) for r in normed)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], fams, h, lines


def spark_rows(df):
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def compare(spark, con, name, fn, sql, sf_dir, show_diff: int = 5):
    t0 = time.time()
    cols, rows = spark_rows(fn(spark, sf_dir))
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    res["oracle_rows"] = len(orows)
    res["oracle_sec"] = round(time.time() - t0, 2)
    sc, sf, sh, sl = fingerprint(cols, rows)
    oc, of, oh, ol = fingerprint(ocols, orows)
    res["schema_match"] = sc == oc
    res["type_match"] = sf == of
    res["hash_match"] = sh == oh
    ok = res["schema_match"] and sh == oh and len(rows) == len(orows)
    res["status"] = "match" if ok else "MISMATCH"
    if not ok:
        res["spark_cols"], res["oracle_cols"] = sc, oc
        if sf != of:
            res["types"] = (sf, of)
        a, b = set(sl), set(ol)
        res["only_spark"] = sorted(a - b)[:show_diff]
        res["only_oracle"] = sorted(b - a)[:show_diff]
    return res


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    bare = "--bare" in argv
    names = [a for a in argv[1:] if not a.startswith(("/", "--"))]
    import __spark_entry__ as entry

    if bare:  # a plain session, as an outside caller would build it
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        from tabforge.session import build_session

        spark = build_session("local[8]", shuffle_partitions=8)
    qs, orc = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": "ERROR", "error": str(e)[:600]}
        if r["status"] in ("MISMATCH", "ERROR"):
            bad += 1
        print(r, flush=True)
    print(f"checked {len(names or qs)} queries, {bad} bad", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
