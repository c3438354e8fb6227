"""Summarise the physical plan of every catalog query into PLANS.md.

Per query: shuffle exchanges, join strategies, aggregate kinds, windows,
Python evaluation nodes, and each Parquet scan's pushed filters / read
schema — taken from the executed (AQE final) plans of all checkpoints that the
query makes and of its result, after running it into the ``noop`` sink.

    python -m tests.plan_report [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

NODES = [
    "Exchange hashpartitioning",
    "Exchange rangepartitioning",
    "Exchange SinglePartition",
    "BroadcastExchange",
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "HashAggregate",
    "ObjectHashAggregate",
    "SortAggregate",
    "Window",
    "Generate",
    "ArrowEvalPython",
    "MapInPandas",
    "MapInArrow",
    "BatchEvalPython",
    "FlatMapGroupsInArrow",
    "FlatMapCoGroupsInArrow",
]


def summarise(plan: str) -> dict:
    out = {n: plan.count(n) for n in NODES if plan.count(n)}
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
        scans.append(
            (pushed.group(1) if pushed else "", (schema.group(1) if schema else "")[:80])
        )
    out["scans"] = scans
    return out


def recorded(plans: list[str]):
    """From now on every checkpoint's executed plan is added to ``plans``."""
    from pyspark.sql.classic.dataframe import DataFrame

    kept = DataFrame.checkpoint

    def checkpoint(self, eager=True):
        out = kept(self, eager)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return out

    DataFrame.checkpoint = checkpoint


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from tabforge.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8, extra_conf={"spark.sql.maxMetadataStringLength": "1000"})
    plans: list[str] = []
    recorded(plans)
    print(f"# Physical plans of the catalog queries ({sf_dir.rsplit('/', 1)[-1]})\n")
    print("Generated by `python -m tests.plan_report`; counts are of nodes in the executed")
    print("(AQE final) plans of all checkpoints that a query makes and of its result. Other jobs")
    print("that a query runs while it is built (writes, size checks, histograms) are not included.\n")
    print("| query | checkpoints | exchanges (hash / range / single / broadcast) | joins (BHJ / SMJ / SHJ) | aggregates | windows | python | scans: pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(entry.queries().items()):
        plans.clear()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        every = [*plans, df._jdf.queryExecution().executedPlan().toString()]
        s = summarise("\n".join(every))
        ex = "/".join(
            str(s.get(k, 0))
            for k in ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
                      "BroadcastExchange")
        )
        joins = "/".join(str(s.get(k, 0)) for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"))
        aggs = s.get("HashAggregate", 0) + s.get("ObjectHashAggregate", 0) + s.get("SortAggregate", 0)
        py = s.get("ArrowEvalPython", 0) + s.get("MapInPandas", 0) + s.get("MapInArrow", 0) + s.get("BatchEvalPython", 0)
        py += s.get("FlatMapGroupsInArrow", 0) + s.get("FlatMapCoGroupsInArrow", 0)
        pushed = "; ".join(dict.fromkeys(p for p, _ in s["scans"] if p)) or "—"
        print(f"| `{name}` | {len(plans)} | {ex} | {joins} | {aggs} | {s.get('Window', 0)} | {py} | {pushed[:120]} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
