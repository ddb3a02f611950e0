"""Inputs derived from the given tables: a change batch, two versions of a table, a stored change log."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe import compact, consume, net_changes, payload_json, read_log, render
from cdcframe.functions.columns import col
from cdcframe.functions.times import ntz_micros
from cdcframe.sources.feed import ACTION, CONSUMED_AT, IS_UPDATE, ROW_ID
from cdcframe.sources.log import ROW_NUMBER
from cdcframe.workspace import work_folder

FIRST_CONSUME = datetime(2024, 3, 1, 12, 0, 0, tzinfo=timezone.utc)
SECOND_CONSUME = datetime(2024, 3, 2, 12, 0, 0, 250000, tzinfo=timezone.utc)
SNAPSHOT_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _operation() -> Column:
    kind = col("event_type")
    return (
        F.when(kind == "signup", "create")
        .when(kind == "view", "snapshot")
        .when(kind == "error", "delete")
        .otherwise("update")
    )


def _read_at() -> Column:
    """The time of the event less a delay of up to a week, so that many updates are read late."""
    return ntz_micros(col("ts")) - (col("event_id") * 7919 % 1009) * 600_000_000


def event_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a flat batch: one record per event, keyed by user."""
    return table(spark, sf_dir, "events").select(
        col("event_id").alias("_seq"),
        _operation().alias("_operation"),
        _read_at().alias("_read_at"),
        col("user_id").alias("id"),
        "value",
        "props",
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as change records with JSON payloads. A delete has its row in `before`."""
    events = table(spark, sf_dir, "events")
    row = payload_json(events, ["event_id", "event_type", "props", "user_id", "value"])
    is_delete = _operation() == "delete"
    return events.select(
        col("event_id").alias("seq"),
        _operation().alias("operation"),
        F.create_map(F.lit("readAt"), _read_at().cast("string"), F.lit("avro.schema"), _avro_schema()).alias("metadata"),
        F.to_json(F.struct(col("user_id").alias("id"))).alias("key"),
        F.when(is_delete, row).alias("before"),
        F.when(~is_delete, row).alias("after"),
    )


# Three schemas, so that the batch changes its schema midway.
AVRO_PLAIN = (
    '{"type":"record","name":"plain","fields":[{"name":"flag","type":"boolean"},{"name":"small","type":"int"},'
    '{"name":"big","type":"long"},{"name":"single","type":"float"},{"name":"twice","type":"double"},'
    '{"name":"raw","type":"bytes"},{"name":"text","type":"string"}]}'
)
AVRO_LOGICAL = (
    '{"type":"record","name":"logical","fields":[{"name":"price","type":{"type":"bytes","logicalType":"decimal",'
    '"precision":10,"scale":2}},{"name":"cents","type":{"type":"fixed","name":"c","size":8,"logicalType":"decimal",'
    '"precision":10}},{"name":"uid","type":{"type":"string","logicalType":"uuid"}},{"name":"day","type":{"type":"int",'
    '"logicalType":"date"}},{"name":"clock","type":{"type":"long","logicalType":"time-micros"}},{"name":"at","type":'
    '{"type":"long","logicalType":"timestamp-millis"}},{"name":"plainlong","type":{"type":"long"}}]}'
)
AVRO_NESTED = (
    '{"type":"record","name":"nested","fields":[{"name":"maybe","type":["null","string"]},{"name":"maybe_at","type":'
    '["null",{"type":"long","logicalType":"timestamp-micros"}]},{"name":"list","type":{"type":"array","items":"int"}},'
    '{"name":"lookup","type":{"type":"map","values":"string"}},{"name":"inner","type":{"type":"record","name":"i",'
    '"fields":[{"name":"x","type":"int"}]}},{"name":"kind","type":{"type":"enum","name":"k","symbols":["A","B"]}}]}'
)


def _avro_schema() -> Column:
    kind = col("event_type")
    return (
        F.when(kind.isin("signup", "view"), AVRO_PLAIN).when(kind == "error", AVRO_LOGICAL).otherwise(AVRO_NESTED)
    )


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as JSON payloads whose fields have every kind of type, some of them more than one."""
    kind, value, user = col("event_type"), col("value").cast("variant"), col("user_id").cast("variant")
    row = F.struct(
        user.alias("whole"),
        value.alias("number"),
        F.when(kind == "purchase", value).otherwise(user).alias("whole_or_number"),
        F.when(kind == "view", user).otherwise(col("props").cast("variant")).alias("whole_or_text"),
        F.when(kind != "error", user).alias("sometimes"),
        F.lit(None).cast("variant").alias("never"),
        (kind == "click").cast("variant").alias("flag"),
        F.parse_json(col("props")).alias("nested"),
        kind.alias("text"),
    )
    return table(spark, sf_dir, "events").select(
        col("event_id").alias("seq"), F.to_json(row, {"ignoreNullFields": "false"}).alias("after")
    )


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as records with nested JSON payloads: objects in objects, arrays of numbers and of objects, and a field whose
    values disagree."""
    kind, user = col("event_type"), col("user_id")
    both = F.array(
        F.to_json(F.struct(user.alias("a"))), F.to_json(F.struct(user.alias("a"), col("value").alias("b")))
    )
    parts = [
        F.lit('{"id":'), col("event_id").cast("string"),
        F.lit(',"inner":{"k":'), F.get_json_object("props", "$.k"), F.lit(',"deep":{"flag":'), (kind == "click").cast("string"), F.lit("}}"),
        F.lit(',"numbers":['), user.cast("string"), F.lit(","), F.when(kind == "view", col("value").cast("decimal(18,2)").cast("string")).otherwise("7"), F.lit("]"),
        F.lit(',"objects":'), F.when(kind == "error", "[]").otherwise(F.concat(F.lit("["), F.array_join(F.when(kind == "view", F.reverse(both)).otherwise(both), ","), F.lit("]"))),
        F.lit(',"mixed":'), F.when(kind == "signup", user.cast("string")).otherwise(F.concat(F.lit('"'), kind, F.lit('"'))), F.lit("}"),
    ]
    return table(spark, sf_dir, "events").select(col("event_id").alias("seq"), F.concat(*parts).alias("after"))


AVRO_DEEP = (
    '{"type":"record","name":"deep","fields":[{"name":"id","type":"long"},{"name":"maybe","type":["null","string"]},'
    '{"name":"maybe_at","type":["null",{"type":"long","logicalType":"timestamp-micros"}]},{"name":"list","type":'
    '{"type":"array","items":"long"}},{"name":"lookup","type":{"type":"map","values":"double"}},{"name":"inner","type":'
    '{"type":"record","name":"i","fields":[{"name":"x","type":"int"},{"name":"deep","type":{"type":"array","items":'
    '{"type":"record","name":"j","fields":[{"name":"y","type":["double","null"]}]}}}]}},{"name":"kind","type":'
    '{"type":"enum","name":"k","symbols":["click","view","purchase","signup","error"]}}]}'
)


def avro_nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as records that carry a nested Avro schema, with payloads that go by it."""
    kind, user, value = col("event_type"), col("user_id"), col("value")
    row = F.struct(
        col("event_id").alias("id"),
        F.when(kind != "error", col("props")).alias("maybe"),
        F.when(kind != "view", F.date_format(col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("maybe_at"),
        F.array(user, col("event_id")).alias("list"),
        F.create_map(F.lit("a"), value).alias("lookup"),
        F.struct(user.alias("x"), F.array(F.struct(F.when(kind != "click", value).alias("y"))).alias("deep")).alias("inner"),
        kind.alias("kind"),
    )
    metadata = F.create_map(F.lit("avro.schema"), F.lit(AVRO_DEEP)).alias("metadata")
    return table(spark, sf_dir, "events").select(col("event_id").alias("seq"), metadata, F.to_json(row, {"ignoreNullFields": "false"}).alias("after"))


CONSUMES = 3


def consumed_at(batch_id: int) -> datetime:
    return FIRST_CONSUME + timedelta(hours=batch_id)


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`orders` as it is, and a later version of it.

    In between, pending orders have become dearer by 1, low-priority orders have been purged, and urgent
    orders have been placed a second time under new keys.
    """
    orders = table(spark, sf_dir, "orders")
    price = F.when(col("o_orderstatus") == "P", col("o_totalprice") + 1).otherwise(col("o_totalprice"))
    kept = orders.filter(col("o_orderpriority") != "5-LOW").withColumn("o_totalprice", price)
    again = orders.filter(col("o_orderpriority") == "1-URGENT").withColumn("o_orderkey", -1 - col("o_orderkey"))
    return orders, kept.unionByName(again)


_LOGS: dict[tuple[str, str], str] = {}


def order_log_path(spark: SparkSession, sf_dir: str) -> str:
    """A stored change log of `orders`: to the later version in one consume, and back in another."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _LOGS:
        old, new = order_versions(spark, sf_dir)
        path = work_folder(spark, "log")
        consume(net_changes(old, new, "o_orderkey"), path, 0, FIRST_CONSUME)
        consume(net_changes(new, old, "o_orderkey"), path, 1, SECOND_CONSUME)
        _LOGS[at] = path
    return _LOGS[at]


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_log(spark, order_log_path(spark, sf_dir))


def shown_log(log: DataFrame) -> DataFrame:
    """A change log with plain column names and the consume time in microseconds."""
    names = {ACTION: "action", IS_UPDATE: "is_update", ROW_ID: "row_id", ROW_NUMBER: "row_number"}
    columns = [col(name).alias(names.get(name, name)) for name in log.columns if name != CONSUMED_AT]
    stamp = [F.unix_micros(col(CONSUMED_AT)).alias("consumed_at")] if CONSUMED_AT in log.columns else []
    return log.select(*columns, *stamp)


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as a target table that has been through inserts, updates (O) and soft deletes (P)."""
    placed = ntz_micros(col("o_orderdate"))
    status = col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.when(status == "O", "update").when(status == "P", "delete").otherwise("snapshot").alias("cdc_operation"),
        F.timestamp_micros(placed).alias("cdc_created_at"),
        F.when(status == "O", F.timestamp_micros(placed + 86_400_000_000)).alias("cdc_updated_at"),
        F.when(status == "P", F.timestamp_micros(placed + 172_800_000_000)).alias("cdc_deleted_at"),
        "o_custkey",
        "o_orderkey",
        "o_orderpriority",
        "o_totalprice",
    )


CHANGES_READ_AT = 1_009_843_200_000_000


def order_changes(spark: SparkSession, sf_dir: str, known: dict[str, str], unknown: dict[str, str]) -> DataFrame:
    """Compacted and rendered changes to `order_target`.

    `known` and `unknown` map a priority to the operation its orders undergo: under their own keys, or
    under keys that the target does not have.
    """
    orders = table(spark, sf_dir, "orders")

    def part(operations: dict[str, str], key: Column) -> DataFrame:
        operation = F.create_map(*[F.lit(item) for pair in operations.items() for item in pair])[col("o_orderpriority")]
        return orders.filter(col("o_orderpriority").isin(*operations)).select(
            ntz_micros(col("o_orderdate")).alias("_seq"),
            operation.alias("_operation"),
            (F.lit(CHANGES_READ_AT).cast("bigint") + col("o_orderkey")).alias("_read_at"),
            key.alias("o_orderkey"),
            "o_custkey",
            "o_orderpriority",
            (col("o_totalprice") + 1).alias("o_totalprice"),
        )

    parts = [part(known, col("o_orderkey"))] if known else []
    parts += [part(unknown, -1 - col("o_orderkey"))] if unknown else []
    batch = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return render(compact(batch, "o_orderkey"), "o_orderkey")


def shown_target(rows: DataFrame) -> DataFrame:
    """Table rows with plain bookkeeping names and their times in microseconds."""
    times = ("cdc_created_at", "cdc_updated_at", "cdc_deleted_at")
    return rows.select(
        *[
            (F.unix_micros(col(name)) if name in times else col(name)).alias(name.removeprefix("cdc_"))
            for name in rows.columns
        ]
    )
