"""Staged rows: a batch written to files before it is merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdcframe.functions.columns import col
from cdcframe.functions.text import decode_text, encode_text
from cdcframe.operators.render import route

ROUTE = "_cdc_route"
ROUTES = ("inserts", "updates")

# The codecs of each format. Spark has no zstd codec for text files.
CODECS = {"csv": ("gzip", "none"), "parquet": ("zstd", "gzip", "none")}

# Every field quoted only as needed, quotes doubled, blanks kept, NULL and '' both empty, no header.
_CSV_WRITE = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "header": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
_CSV_READ = {**_CSV_WRITE, "multiLine": "true", "mode": "FAILFAST"}


def _check(fmt: str, codec: str | None) -> str:
    if fmt not in CODECS:
        raise ValueError(f"unknown stage format {fmt!r}")
    codec = CODECS[fmt][0] if codec is None else codec
    if codec not in CODECS[fmt]:
        raise ValueError(f"unknown codec {codec!r} for {fmt}")
    return codec


def stage_write(rows: DataFrame, path: str, fmt: str = "parquet", codec: str | None = None, prefix: str = "cdc") -> None:
    """Write rendered rows to `path` in one pass, inserts and updates apart.

    `csv` holds text fields in table order and does not tell NULL from ''. `parquet` keeps both.
    """
    codec = _check(fmt, codec)
    routed = rows.withColumn(ROUTE, route(rows, prefix))
    if fmt == "csv":
        routed = encode_text(routed)
    writer = routed.write.mode("overwrite").partitionBy(ROUTE).option("compression", codec)
    if fmt == "csv":
        writer.options(**_CSV_WRITE).csv(path)
    else:
        writer.parquet(path)


def stage_read(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", routes: tuple[str, ...] = ROUTES
) -> DataFrame:
    """Staged rows as typed columns. The columns of a CSV stage go by position."""
    _check(fmt, None)
    stored = schema if fmt == "parquet" else T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(schema))])
    reader = spark.read.schema(T.StructType([*stored, T.StructField(ROUTE, T.StringType())]))
    rows = reader.parquet(path) if fmt == "parquet" else reader.options(**_CSV_READ).csv(path)
    rows = rows.filter(col(ROUTE).isin(*routes)).drop(ROUTE)
    return rows if fmt == "parquet" else decode_text(rows, schema)
