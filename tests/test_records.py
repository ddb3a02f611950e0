"""Scans, record shaping, payloads, positions and times."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import cdcframe as c
from cdcframe.functions.columns import MissingColumn
from cdcframe.functions.times import micros_ntz, ntz_micros, rfc3339
from cdcframe.plans.replicate import replicate
from checks import inputs
from tests.inspect_plan import fails


def log(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, `METADATA$ACTION` string, `METADATA$ISUPDATE` boolean")


def test_worked_example(spark):
    rows = log(spark, [(2, "Ada", "DELETE", False), (5, "Grace", "INSERT", False), (7, "a", "DELETE", True), (7, "b", "INSERT", True)])
    found = c.classify(c.collapse_pairs(rows)).select("id", "name", "operation").collect()
    assert sorted(map(tuple, found)) == [(2, "Ada", "delete"), (5, "Grace", "create"), (7, "b", "update")]


@pytest.mark.parametrize("action,is_update", [("UPSERT", False), (None, False), ("INSERT", None), ("DELETE", True)])
def test_unknown_actions_are_refused(spark, action, is_update):
    assert "no operation for change action" in fails(c.classify(log(spark, [(1, "a", action, is_update)])))


def test_collapse_keeps_rows_it_cannot_judge(spark):
    assert c.collapse_pairs(log(spark, [(1, "a", "INSERT", None)])).count() == 1


def test_payload_json(spark):
    df = spark.sql(
        "select 1 b, cast(null as string) a, X'00ff' bin, true t, timestamp'2024-03-10 07:30:00.5Z' ts, "
        "timestamp_ntz'2024-01-01 00:00:00.000120' ntz, date'2020-02-29' d, array(1, 2) arr, named_struct('y', 1, 'x', null) nested"
    )
    text = df.select(c.payload_json(df)).first()[0]
    assert list(json.loads(text)) == sorted(df.columns)
    assert json.loads(text) == {
        "a": None,
        "arr": [1, 2],
        "b": 1,
        "bin": "AP8=",
        "d": "2020-02-29T00:00:00Z",
        "nested": {"y": 1, "x": None},
        "ntz": "2024-01-01T00:00:00.00012Z",
        "t": True,
        "ts": "2024-03-10T07:30:00.5Z",
    }


def test_key_columns_must_exist(spark):
    with pytest.raises(MissingColumn):
        c.record_key(spark.range(1), ["id", "other"])
    assert c.key_columns(["a"], ["b"], "o") == ["a"]
    assert c.key_columns([], ["b"], "o") == ["b"]
    assert c.key_columns([], [], "o") == ["o"]


def test_position_round_trip(spark):
    made = spark.range(1).select(c.position_json("s", F.lit(12), F.lit(40), time=F.lit(None).cast("timestamp"))).first()[0]
    assert c.parse_position(made) == c.Position("s", 12, 40)
    made = spark.range(1).select(c.position_json("c", index=F.lit(99), batch=F.lit(103))).first()[0]
    assert c.parse_position(made) == c.Position("c", index=99, batch=103)
    assert json.loads(made)["Time"].endswith("Z")
    assert c.parse_position(None) is None
    with pytest.raises(ValueError):
        c.parse_position('{"IteratorType":"i"}')
    with pytest.raises(ValueError):
        c.position_json("i")


def test_snapshot_bounds(spark):
    df = spark.createDataFrame([(n,) for n in [1, 2, 2, 3, None]], "o int")

    def values(**bounds):
        return sorted((r[0] for r in c.snapshot(df, "o", **bounds).collect()), key=str)

    assert values() == [1, 2, 2, 3, None]
    assert values(maximum=2) == [1, 2, 2]
    assert values(after=1, maximum=3) == [2, 2, 3]
    assert c.high_watermark_value(df, "o") == 3
    assert c.high_watermark_value(df.limit(0), "o") is None
    for bounds in ({}, {"maximum": 3}, {"after": 0}):
        assert "NULL in ordering column" in fails(c.snapshot(df, "o", nulls="error", **bounds))
    assert [r[0] for r in c.snapshot_page(df, "o", 2, maximum=3, after=1).collect()] == [2, 2]
    with pytest.raises(ValueError):
        c.resume_snapshot(df, "o", c.Position("c"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_a_time_bound_in_another_session_zone(spark, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(f"select explode(array({kind}'2024-01-01 00:00:00', {kind}'2024-06-01 00:00:00.5')) t")
        assert c.snapshot(df, "t", c.high_watermark_value(df, "t")).count() == 2
        assert c.snapshot(df, "t", after=c.high_watermark_value(df, "t")).count() == 0
        positions = [c.parse_position(r["position"]) for r in c.snapshot_records(df, "t", "t", "x", inputs.SNAPSHOT_AT).collect()]
        assert sorted(c.resume_snapshot(df, "t", p).count() for p in positions) == [0, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_snapshot_by_time_is_resumed_from_its_position(spark):
    df = spark.sql("select explode(sequence(timestamp_ntz'2024-03-10 02:00:00', timestamp_ntz'2024-03-10 03:00:00', interval 15 minutes)) t")
    records = c.snapshot_records(df, "t", "t", "times", inputs.SNAPSHOT_AT).orderBy("after").collect()
    position = c.parse_position(records[1]["position"])
    assert [str(r[0]) for r in c.resume_snapshot(df, "t", position).orderBy("t").collect()] == [
        "2024-03-10 02:30:00",
        "2024-03-10 02:45:00",
        "2024-03-10 03:00:00",
    ]


def test_decode(spark):
    schema = T.StructType.fromDDL("i bigint, d date, ts timestamp, ntz timestamp_ntz, b binary, s string")
    text = '{"i":5,"d":"2020-02-29T00:00:00Z","ts":"2024-03-10T07:30:00.5Z","ntz":"2024-03-10T02:30:00Z","b":"AP8=","s":null}'
    df = spark.createDataFrame([(text,)], "p string").select(c.decode_payload(F.col("p"), schema).alias("r")).select("r.*")
    row = df.selectExpr("i", "d", "unix_micros(ts) ts", "cast(ntz as string) ntz", "hex(b) b", "s").first()
    assert tuple(map(str, row)) == ("5", "2020-02-29", "1710055800500000", "2024-03-10 02:30:00", "00FF", "None")
    for bad in ("{", '{"i":"x"}', '{"d":"soon"}'):
        fails(spark.createDataFrame([(bad,)], "p string").select(c.decode_payload(F.col("p"), schema)))


def test_flatten_takes_structs_and_deletes_without_payload(spark):
    rows = [
        (0, "create", {"readAt": "5"}, ("1",), None, ("1", "a")),
        (1, "delete", {"readAt": "6"}, ("2",), None, None),
        (2, "delete", {"readAt": "7"}, ("3",), ("3", "c"), None),
    ]
    payload = "struct<id: string, name: string>"
    schema = f"seq bigint, operation string, metadata map<string, string>, key struct<id: string>, before {payload}, after {payload}"
    flat = c.flatten_records(spark.createDataFrame(rows, schema), "id")
    assert sorted(map(tuple, flat.collect())) == [
        (0, "create", 5, "1", "a"),
        (1, "delete", 6, "2", None),
        (2, "delete", 7, "3", "c"),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Lord_Howe"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' a, timestamp_ntz'1969-12-31 23:59:59.999999' b")
        row = df.select(
            ntz_micros(F.col("a")),
            ntz_micros(F.col("b")),
            micros_ntz(ntz_micros(F.col("a"))).cast("string"),
            rfc3339(F.col("b"), T.TimestampNTZType()),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (1710037800123456, -1, "2024-03-10 02:30:00.123456", "1969-12-31T23:59:59.999999Z")


def test_replicate_without_a_snapshot(spark, folder):
    old = spark.createDataFrame([(1, "Ada"), (2, "Grace")], "id bigint, name string")
    new = spark.createDataFrame([(2, "Edsger")], "id bigint, name string")
    for with_snapshot, expected in (
        (True, {1: ("delete", "Ada"), 2: ("update", "Edsger")}),
        (False, {1: ("delete", None), 2: ("update", "Edsger")}),
    ):
        at = f"{folder}/{with_snapshot}"
        table = replicate(
            old, new, "id", "id", "people", f"{at}/t", f"{at}/log", inputs.SNAPSHOT_AT, inputs.FIRST_CONSUME,
            with_snapshot=with_snapshot, buckets=2,
        )
        assert {r["id"]: (r["cdc_operation"], r["name"]) for r in table.read().collect()} == expected


def test_replicate_after_a_failed_snapshot(spark, folder):
    old = spark.createDataFrame([(1, 10, "Ada"), (2, None, "Grace"), (3, 30, "Mary")], "id bigint, at bigint, name string")
    new = spark.createDataFrame([(1, 10, "Ada"), (2, None, "Edsger"), (3, 30, "Mary")], "id bigint, at bigint, name string")

    def call(before, after, **more):
        return replicate(
            before, after, "id", "at", "people", f"{folder}/t", f"{folder}/log", inputs.SNAPSHOT_AT, inputs.FIRST_CONSUME, buckets=2, **more,
        )

    with pytest.raises(Exception, match="NULL|null"):
        call(old, new)
    shown = lambda table: {r["id"]: (r["cdc_operation"], r["name"]) for r in table.read().collect()}
    rows = {1: ("snapshot", "Ada"), 2: ("update", "Edsger"), 3: ("snapshot", "Mary")}
    assert shown(call(old, new, nulls="keep")) == rows
    # Once the snapshot is there, it is not taken again.
    assert shown(call(new, old, nulls="keep")) == rows | {2: ("update", "Grace")}
