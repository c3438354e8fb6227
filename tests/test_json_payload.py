"""Malformed request / response JSON (PERMISSIVE parsing, ANSI on)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators import payload

RESP = [
    ('{"predictions":[1,0]}', [1, 0]),
    ('{"predictions":[]}', []),
    ('{"predictions":["alive"]}', None),
    ('{"predictions":["1"]}', None),
    ('{"predictions":[1.7]}', None),
    ('{"predictions":{"Survival prediction":["alive"]}}', [1]),
    ('{"predictions":{"Survival prediction":["dead","alive"]},"databricks_output":{"trace":"t"}}', [0, 1]),
    ("not json", None),
    (None, None),
]


def test_response_envelopes(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RESP)], "i int, response string")
    out = payload.parse_response(df, "response", into="r").orderBy("i").collect()
    got = [r["r"]["predictions"] for r in out]
    assert got == [e for _, e in RESP]
    assert out[6]["r"]["databricks_output"]["trace"] == "t"


def test_first_prediction_of_empty_array_is_null(spark):
    df = spark.createDataFrame([('{"predictions":[]}',)], "response string")
    r = payload.parse_response(df).select(F.get(F.col("parsed_response.predictions"), 0).alias("p")).first()
    assert r["p"] is None


def test_request_records_and_explode(spark):
    schema = T.StructType([T.StructField("Height", T.DoubleType()), T.StructField("Teams", T.StringType()),
                           T.StructField("Magic", T.StringType())])
    reqs = [
        '{"dataframe_records":[{"Height":1.7,"Teams":1,"Magic":null},{"Height":"x","Teams":"Avengers"}]}',
        '{"dataframe_records":[]}',
        "{}",
        "bad",
    ]
    df = spark.createDataFrame(list(enumerate(reqs)), "i int, request string")
    parsed = payload.parse_json(df, "request", payload.request_schema(schema), into="p")
    inner = payload.explode_records(parsed, "p.dataframe_records", into="rec").orderBy("i", "pos").collect()
    assert [(r["i"], r["rec"]["Height"], r["rec"]["Teams"]) for r in inner] == [(0, 1.7, "1"), (0, None, "Avengers")]
    outer = payload.explode_records(parsed, "p.dataframe_records", into="rec", outer=True)
    assert outer.count() == 2 + 3


def test_flatten_matches_position_or_first(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    log = spark.createDataFrame(
        [("r1", "2024-01-01 00:00:01.999", 5, '{"dataframe_records":[{"a":1},{"a":2}]}', '{"predictions":[0,1]}')],
        "databricks_request_id string, request_time string, execution_duration_ms long, request string, "
        "response string",
    ).withColumn("request_time", F.col("request_time").cast("timestamp"))
    first = payload.flatten_payload(log, "m", schema, first_prediction_only=True).orderBy("a").collect()
    pos = payload.flatten_payload(log, "m", schema, first_prediction_only=False).orderBy("a").collect()
    assert [r["prediction"] for r in first] == [0, 0]
    assert [r["prediction"] for r in pos] == [0, 1]
    assert first[0]["timestamp_ms"] == 1704067201000  # whole seconds × 1000: the .999 s is dropped
    assert first[0]["model_name"] == "m"


def test_drop_null_or_keep(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "k int, p int")
    assert payload.drop_null_or_keep(df, ["p"]).count() == 1
    none = spark.createDataFrame([(1, None), (2, None)], "k int, p int")
    assert payload.drop_null_or_keep(none, ["p"]).count() == 2


def test_payload_keeps_explicit_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    body = payload.to_payload(df, ["a", "b"]).first()["payload"]
    assert body == '{"dataframe_records":[{"a":1,"b":null}]}'


def test_drop_null_or_keep_lazy_plan(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "k int, p int")
    assert payload.drop_null_or_keep(df, ["p"], lazy=True).count() == 1
    none = spark.createDataFrame([(1, None), (2, None)], "k int, p int")
    assert payload.drop_null_or_keep(none, ["p"], lazy=True).count() == 2


def test_fast_text_cast_equals_try_cast(spark):
    from tabforge.functions.casts import try_cast_text

    vals = [" 12 ", "+7", "-0", "1.5", "1e3", "\t42\n", "x1", '{"k": 1}', "", None, "9" * 30, ".5", "1.", "--1",
            " 3", "3 ", "NaN", "inf", "-Infinity", "1d", "0x10"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("int", "bigint", "decimal(10,2)", "double", "float", "smallint"):
        got = df.select(try_cast_text(F.col("s"), t).alias("a"), F.col("s").try_cast(t).alias("b")).collect()
        assert all((r["a"] == r["b"]) or (r["a"] != r["a"] and r["b"] != r["b"]) for r in got), (t, got)
