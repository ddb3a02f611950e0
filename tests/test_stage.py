"""Staged rows come back as they went in."""

import pytest

from cdcframe import decode_text, encode_text, stage_read, stage_write
from tests.inspect_plan import fails

ODD = [' lead', 'trail ', 'a,b', 'say "hi"', '"', '""', 'line\nbreak', 'carriage\r\nreturn', 'tab\there', '\\', '\\"', "'", 'é漢😀', '#x', 'null', '0']


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def staged(spark, values):
    data = [("create" if n % 2 else "update", n, v, v) for n, v in enumerate(values)]
    return spark.createDataFrame(data, "cdc_operation string, id int, a string, z string")


@pytest.mark.parametrize("fmt,codec", [("csv", "gzip"), ("csv", "none"), ("parquet", "zstd"), ("parquet", "gzip"), ("parquet", None)])
def test_text_survives(spark, folder, fmt, codec):
    df = staged(spark, ODD)
    stage_write(df, f"{folder}/s", fmt, codec)
    back = stage_read(spark, f"{folder}/s", df.schema, fmt)
    assert rows(back) == rows(df)
    assert rows(stage_read(spark, f"{folder}/s", df.schema, fmt, ("inserts",))) == rows(df.filter("cdc_operation = 'create'"))


def test_csv_does_not_tell_null_from_empty_and_parquet_does(spark, folder):
    df = staged(spark, ["", None])
    stage_write(df, f"{folder}/c", "csv")
    assert {r["a"] for r in stage_read(spark, f"{folder}/c", df.schema, "csv").collect()} == {None}
    stage_write(df, f"{folder}/p", "parquet")
    assert {r["a"] for r in stage_read(spark, f"{folder}/p", df.schema).collect()} == {None, ""}


def test_types_survive_text(spark):
    df = spark.sql(
        "select 1L i, 1.5d d, true b, X'00ff' bin, date'2020-02-29' day, timestamp'2024-03-10 07:30:00.000001Z' ts, "
        "timestamp_ntz'2024-03-10 02:30:00.5' ntz, array(1, 2) arr, named_struct('x', 1) st, cast(null as timestamp) gone, 12.34BD dec"
    )
    text = encode_text(df)
    assert text.first()["ts"] == "1710055800000001" and text.first()["day"] == "2020-02-29" and text.first()["gone"] == ""
    assert rows(decode_text(text, df.schema)) == rows(df)


def test_unknown_formats_codecs_and_operations(spark, folder):
    df = staged(spark, ["a"])
    for fmt, codec in (("avro", None), ("csv", "zstd"), ("parquet", "lzo")):
        with pytest.raises(ValueError):
            stage_write(df, f"{folder}/x", fmt, codec)
    from cdcframe import route_inserts

    assert "unknown operation" in fails(route_inserts(df.selectExpr("'merge' cdc_operation", "id")))
