"""End-to-end walkthrough on the test tables.

The flow of a tabular-model project, as Spark jobs: clean → exact split →
versioned save → train → evaluate → champion gate → A/B routing → request
payloads → monitoring refresh → 30-minute profile → drift.

    python examples/walkthrough.py /root/testdata/sf0.01
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tabforge.operators import drift, experiment, metrics, model, payload, profile, sampling  # noqa: E402
from tabforge.plans.monitoring import monitoring_table, refresh_monitoring  # noqa: E402
from tabforge.session import build_session, scratch_path  # noqa: E402
from tabforge.sources import versions  # noqa: E402
from tabforge.sources.tables import load  # noqa: E402


def main(sf_dir: str) -> dict:
    spark = build_session("local[8]", shuffle_partitions=8)
    root = scratch_path(spark, f"walkthrough/{uuid.uuid4().hex}")

    # 1. the modelling table: documents with a quality label
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    table = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y")).join(docs, "doc_id")

    # 2. exact 80/20 split, saved as versions and noted in the run's lineage
    labelled = sampling.assign_split_exact(table, ["doc_id"], 0.2, 42)
    train_path, test_path = f"{root}/train_set", f"{root}/test_set"
    versions.write_version(labelled.filter(F.col("split") == "train").drop("split"), train_path)
    versions.write_version(labelled.filter(F.col("split") == "test").drop("split"), test_path)
    for context, path in (("training", train_path), ("testing", test_path)):
        versions.log_input(spark, f"{root}/lineage", "walkthrough", context, path)
    train = versions.read_by_lineage(spark, f"{root}/lineage", "walkthrough", "training")
    test = versions.read_by_lineage(spark, f"{root}/lineage", "walkthrough", "testing")

    # 3. train a challenger and a champion, evaluate on the same rows
    params = model.BoostParams(learning_rate=0.1, n_estimators=10, max_depth=3)
    challenger = model.train(train, ["lang", "source"], ["n_chars"], "y", params)
    champion = model.train(train, ["lang"], ["n_chars"], "y", params)
    scored = model.score(test, challenger, keep=["doc_id", "y"])
    report = metrics.class_metrics(scored, "y", "probability").first().asDict()
    report["roc_auc"] = metrics.roc_auc(scored, "y", "probability").first()["roc_auc"]

    # 4. champion / challenger gate on one DataFrame of both models' scores
    both = model.score(test, champion, keep=["doc_id", "y"]).withColumn("model", F.lit("champion")).unionByName(
        scored.withColumn("model", F.lit("challenger"))
    )
    gate = metrics.champion_gate(both, "model", "challenger", "champion", "y", "probability").first()

    # 5. A/B routing and request payloads, one record per request
    routed = experiment.route(test, "doc_id", ("A", "B"))
    requests = payload.to_payload(routed, ["lang", "source", "n_chars"], keep=["doc_id", "arm"])

    # 6. a request log (payload + response per request) → monitoring table
    ab = experiment.score_routed(routed, "arm", {"A": challenger, "B": champion})
    log = requests.join(ab.select("doc_id", "prediction"), "doc_id").select(
        F.concat(F.lit("req-"), F.col("doc_id").cast("string")).alias("databricks_request_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(mins=F.col("doc_id").cast("int")))
        .alias("request_time"),
        F.lit(5).cast("long").alias("execution_duration_ms"),
        F.col("payload").alias("request"),
        F.to_json(F.struct(F.array("prediction").alias("predictions"))).alias("response"),
    )
    record = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    counts = refresh_monitoring(log, f"{root}/monitoring", "doc-quality", record)
    mon = monitoring_table(spark, f"{root}/monitoring")

    # 7. 30-minute profile of the monitoring table and drift first vs second half
    prof = profile.window_profile(mon, "timestamp", "30 minutes", ["model_name"], ["n_chars"], ["lang"])
    cut = mon.agg(F.percentile_approx("timestamp_ms", 0.5)).first()[0]
    d = drift.drift_categorical(mon.filter(F.col("timestamp_ms") < cut), mon.filter(F.col("timestamp_ms") >= cut),
                                ["lang", "source"])
    out = {
        "train_rows": train.count(),
        "test_rows": test.count(),
        "metrics": report,
        "gate_improved": gate["improved"],
        "monitoring": counts.__dict__,
        "profile_windows": prof.count(),
        "drift": [r.asDict() for r in d.collect()],
    }
    spark.stop()
    return out


if __name__ == "__main__":
    import json

    print(json.dumps(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"), default=str, indent=1))
