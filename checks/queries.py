"""The registered queries: one or more for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import cdcframe as c
from cdcframe.functions.columns import col
from cdcframe.functions.times import micros_ntz, micros_of, ntz_micros
from cdcframe.operators.infer import first_record
from cdcframe.sources.feed import ACTION, CONSUMED_AT, IS_UPDATE
from cdcframe.sources.log import BATCH_ID, INDEX_IN_BATCH, ROW_NUMBER
from cdcframe.workspace import work_folder
from checks import inputs as i

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE = 1000
SAVED = '{"IteratorType":"c","IndexInBatch":249,"BatchID":1000}'


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Snapshots


@query
def snapshot_high_watermark(spark, sf):
    return c.high_watermark(i.table(spark, sf, "lineitem"), "l_orderkey")


@query
def snapshot_bounded(spark, sf):
    lines = i.table(spark, sf, "lineitem")
    rows = c.snapshot(lines, "l_shipdate", c.high_watermark_value(lines, "l_shipdate"))
    return rows.withColumn("l_shipdate", ntz_micros(col("l_shipdate")))


@query
def snapshot_resume(spark, sf):
    customers = i.table(spark, sf, "customer")
    maximum = c.high_watermark_value(customers, "c_custkey")
    saved = customers.agg(F.floor(F.avg("c_custkey")).alias("last")).select(
        c.position_json("s", col("last"), F.lit(maximum)).alias("position")
    )
    return c.resume_snapshot(customers, "c_custkey", c.parse_position(saved.first()["position"]))


@query
def snapshot_page(spark, sf):
    customers = i.table(spark, sf, "customer")
    return c.snapshot_page(customers, "c_custkey", 100, c.high_watermark_value(customers, "c_custkey"), after=49)


@query
def snapshot_projection(spark, sf):
    parts = i.table(spark, sf, "part")
    return c.snapshot(parts, "p_partkey", columns=["p_partkey", "p_brand", "p_retailprice"])


@query
def snapshot_records(spark, sf):
    rows = c.snapshot_records(i.table(spark, sf, "supplier"), "s_suppkey", "s_suppkey", "supplier", i.SNAPSHOT_AT)
    return _shown_records(rows)


@query
def snapshot_records_resume(spark, sf):
    suppliers = i.table(spark, sf, "supplier")
    maximum = c.high_watermark_value(suppliers, "s_suppkey")
    saved = suppliers.agg(F.floor(F.avg("s_suppkey")).alias("last")).select(
        c.position_json("s", col("last"), F.lit(maximum)).alias("position")
    )
    position = c.parse_position(saved.first()["position"])
    rows = c.snapshot_records(suppliers, "s_suppkey", [], "supplier", i.SNAPSHOT_AT, position=position, primary_keys=["s_suppkey"])
    return _shown_records(rows)


def _shown_records(records: DataFrame) -> DataFrame:
    return records.select(
        "seq",
        "position",
        "operation",
        col("metadata")["table"].alias("table_name"),
        col("metadata")["readAt"].cast("bigint").alias("read_at"),
        F.to_json("key").alias("key"),
        "before",
        "after",
    )


# Change feed and change log


@query
def table_net_changes(spark, sf):
    old, new = i.order_versions(spark, sf)
    rows = i.shown_log(c.net_changes(old, new, "o_orderkey"))
    return rows.withColumn("o_orderdate", ntz_micros(col("o_orderdate")))


@query
def table_net_change_counts(spark, sf):
    old, new = i.order_versions(spark, sf)
    changes = c.net_changes(old, new, "o_orderkey")
    return changes.groupBy(col(ACTION).alias("action"), col(IS_UPDATE).alias("is_update")).agg(F.count(F.lit(1)).alias("n"))


@query
def change_log_consume(spark, sf):
    old, new = i.order_versions(spark, sf)
    path = work_folder(spark, "log")
    c.consume(c.net_changes(old, new, "o_orderkey"), path, 0, i.FIRST_CONSUME)
    rows = i.shown_log(c.read_log(spark, path))
    return rows.withColumn("o_orderdate", ntz_micros(col("o_orderdate")))


def _log_row(log: DataFrame, *more: str) -> DataFrame:
    return i.shown_log(log).select("o_orderkey", "o_totalprice", "action", "is_update", "consumed_at", *more)


@query
def change_log_page(spark, sf):
    return _log_row(c.log_page(spark, i.order_log_path(spark, sf), 2500, PAGE), "row_number")


@query
def change_log_batches(spark, sf):
    return _log_row(c.number_batches(i.order_log(spark, sf), PAGE), BATCH_ID, INDEX_IN_BATCH)


@query
def change_log_resume(spark, sf):
    return _log_row(c.log_after(spark, i.order_log_path(spark, sf), c.parse_position(SAVED), PAGE), BATCH_ID, INDEX_IN_BATCH)


@query
def cdc_collapse_pairs(spark, sf):
    return _log_row(c.collapse_pairs(i.order_log(spark, sf)))


@query
def cdc_classify(spark, sf):
    rows = c.classify(c.collapse_pairs(i.order_log(spark, sf)))
    return rows.select("o_orderkey", F.unix_micros(col(CONSUMED_AT)).alias("consumed_at"), "operation")


@query
def cdc_payload_json(spark, sf):
    orders = i.table(spark, sf, "orders")
    return orders.select("o_orderkey", c.payload_json(orders).alias("payload"))


@query
def cdc_record_key(spark, sf):
    turns = i.table(spark, sf, "conversations")
    return turns.select(F.to_json(c.record_key(turns, ["conv_id", "turn"])).alias("key"), "role")


@query
def record_position(spark, sf):
    rows = c.number_batches(i.order_log(spark, sf), PAGE)
    position = c.position_json("c", index=col(INDEX_IN_BATCH), batch=col(BATCH_ID), time=col(CONSUMED_AT))
    return rows.select("o_orderkey", ACTION, position.alias("position")).withColumnRenamed(ACTION, "action")


def _order_records(spark, sf):
    return c.change_records(c.number_batches(i.order_log(spark, sf), PAGE), "o_orderkey", "orders")


@query
def cdc_records(spark, sf):
    return _shown_records(_order_records(spark, sf))


@query
def snapshot_then_cdc(spark, sf):
    orders = i.table(spark, sf, "orders")
    first = c.snapshot_records(orders, "o_orderkey", "o_orderkey", "orders", i.SNAPSHOT_AT)
    rows = c.snapshot_then_changes(first, _order_records(spark, sf))
    return rows.select("phase", "seq", "operation", col("key")["o_orderkey"].alias("o_orderkey"), "after")


@query
def stream_change_log(spark, sf):
    out = work_folder(spark, "stream")

    def shown(log):
        rows = c.classify(c.collapse_pairs(log))
        return rows.select("o_orderkey", F.unix_micros(col(CONSUMED_AT)).alias("consumed_at"), "operation")

    stream = c.stream_log(spark, i.order_log_path(spark, sf), max_consumes=1)
    c.run_to_end(c.stream_append(stream, f"{out}/rows", f"{out}/checkpoint", change=shown))
    return spark.read.parquet(f"{out}/rows").drop("_batch")


@query
def stream_resume(spark, sf):
    out = work_folder(spark, "resume")
    stream = c.stream_log(spark, i.order_log_path(spark, sf), c.parse_position(SAVED))
    shown = lambda log: _log_row(c.number_batches(log, PAGE), BATCH_ID, INDEX_IN_BATCH)
    c.run_to_end(c.stream_append(stream, f"{out}/rows", f"{out}/checkpoint", change=shown))
    return spark.read.parquet(f"{out}/rows").drop("_batch")


@query
def stream_consume(spark, sf):
    changes, folder = c.net_changes(*i.order_versions(spark, sf), "o_orderkey"), work_folder(spark, "consume")
    changes.write.parquet(f"{folder}/changes")
    changes = spark.read.parquet(f"{folder}/changes")
    stream = c.stream_changes(spark, f"{folder}/in/*", changes.schema)
    # Each third of the changes arrives as new files, and the stream is asked again.
    for n in range(i.CONSUMES):
        changes.filter(F.pmod(col("o_orderkey"), F.lit(i.CONSUMES)) == n).write.parquet(f"{folder}/in/{n}")
        c.run_to_end(c.stream_consume(stream, f"{folder}/log", f"{folder}/checkpoint", at=i.consumed_at))
    rows = i.shown_log(c.read_log(spark, f"{folder}/log"))
    return rows.withColumn("o_orderdate", ntz_micros(col("o_orderdate")))


@query
def number_any_log(spark, sf):
    events = i.table(spark, sf, "events")
    numbered, _ = c.number_rows(events, ["event_type", "ts", "event_id"], "row_number", rows_per_range=PAGE // 2)
    return c.number_batches(numbered.withColumnRenamed("row_number", ROW_NUMBER), PAGE).select(
        "event_id", col(ROW_NUMBER).alias("row_number"), BATCH_ID, INDEX_IN_BATCH
    )


# Batches


@query
def payload_side(spark, sf):
    records = i.event_records(spark, sf)
    return records.select("seq", "operation", c.payload_side(records).alias("payload"))


@query
def decode_payload(spark, sf):
    records = i.event_records(spark, sf)
    row = T.StructType.fromDDL("event_id bigint, event_type string, props string, user_id bigint, value double")
    decoded = records.select(c.decode_payload(c.payload_side(records), row).alias("row")).select("row.*")
    props = c.decode_payload(col("props"), T.StructType.fromDDL("k bigint"))
    return decoded.select("event_id", "event_type", "user_id", "value", props["k"].alias("k"))


@query
def payload_field_types(spark, sf):
    return c.field_types(i.mixed_payloads(spark, sf))


@query
def infer_schema_first(spark, sf):
    return c.field_types(first_record(i.mixed_payloads(spark, sf)))


@query
def infer_schema_nested(spark, sf):
    records = i.nested_records(spark, sf)
    row = c.decode_payload(col("after"), c.infer_schema(records, payload="after", nested=True))
    rows = records.select(row.alias("row")).select("row.*")
    return rows.select(
        "id",
        rows["inner"]["k"].alias("k"),
        rows["inner"]["deep"]["flag"].alias("flag"),
        F.get("numbers", F.lit(1)).alias("second"),
        F.size("objects").cast("bigint").alias("objects"),
        F.get("objects", F.lit(0))["a"].alias("a"),
        F.get("objects", F.lit(0))["b"].alias("b"),
        "mixed",
    )


@query
def avro_schema_nested(spark, sf):
    records = i.avro_nested_records(spark, sf)
    schema = c.infer_schema(records, avro_key="avro.schema", nested=True)
    rows = records.select(c.decode_payload(col("after"), schema).alias("row")).select("row.*")
    return rows.select(
        "id",
        "maybe",
        rows["list"][0].alias("first"),
        rows["lookup"]["a"].alias("a"),
        rows["inner"]["x"].alias("x"),
        rows["inner"]["deep"][0]["y"].alias("y"),
        "kind",
        F.unix_micros("maybe_at").alias("maybe_at"),
    )


@query
def avro_field_types(spark, sf):
    return c.avro_fields(i.event_records(spark, sf))


@query
def bookkeeping_layout(spark, sf):
    return i.shown_target(c.with_bookkeeping(i.table(spark, sf, "part")))


def _shown_batch(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", col("_seq").alias("seq"), col("_operation").alias("operation"), col("_read_at").alias("read_at"), "value", "props"
    )


@query
def compact_latest(spark, sf):
    return _shown_batch(c.compact(i.event_batch(spark, sf), "id"))


@query
def compact_carry_created(spark, sf):
    rows = c.compact(i.event_batch(spark, sf), "id", carry_created=True)
    return _shown_batch(rows).join(rows.select("id", col("_created_at").alias("created_at")), "id")


@query
def compact_dropped_updates(spark, sf):
    return _shown_batch(c.late_updates(i.event_batch(spark, sf), "id"))


def _rendered_events(spark, sf):
    return c.render(c.compact(i.event_batch(spark, sf), "id"), "id")


@query
def render_rows(spark, sf):
    return i.shown_target(_rendered_events(spark, sf))


@query
def route_inserts(spark, sf):
    return i.shown_target(c.route_inserts(_rendered_events(spark, sf)))


@query
def route_updates(spark, sf):
    return i.shown_target(c.route_updates(_rendered_events(spark, sf)))


@query
def encode_text(spark, sf):
    target = i.order_target(spark, sf)
    return c.encode_text(target.withColumn("o_day", micros_ntz(F.unix_micros("cdc_created_at")).cast("date")))


# Staging


def _document_rows(spark, sf):
    documents = i.table(spark, sf, "documents")
    operation = F.when(col("lang") == "en", "create").when(col("lang") == "fr", "snapshot").otherwise("update")
    batch = documents.select(
        col("doc_id").alias("_seq"), operation.alias("_operation"), (col("doc_id") * 1_000_003).alias("_read_at"), *documents.columns
    )
    return c.render(batch, "doc_id")


@query
def stage_roundtrip_csv(spark, sf):
    rows, path = _document_rows(spark, sf), work_folder(spark, "stage")
    c.stage_write(rows, path, "csv", "gzip")
    return i.shown_target(c.stage_read(spark, path, rows.schema, "csv"))


@query
def stage_roundtrip_parquet(spark, sf):
    pages = i.table(spark, sf, "pages")
    batch = pages.select(
        col("page_id").alias("_seq"), F.lit("create").alias("_operation"), (col("page_id") * 1_000_003).alias("_read_at"), *pages.columns
    )
    rows, path = c.render(batch, "page_id"), work_folder(spark, "stage")
    c.stage_write(rows, path, "parquet", "zstd")
    return i.shown_target(c.stage_read(spark, path, rows.schema, "parquet"))


# A target that has one column under another case, one of another type, one more and one less.
_OTHER_ORDERS = (
    "o_orderkey bigint, o_custkey int, O_ORDERSTATUS string, o_totalprice double, o_orderdate timestamp_ntz, o_comment string"
)


@query
def schema_check_report(spark, sf):
    orders = i.table(spark, sf, "orders")
    types = c.field_types(orders.select(c.payload_json(orders).alias("after")))
    return c.schema_report(types, T.StructType.fromDDL(_OTHER_ORDERS), "o_orderkey", "create")


# Merging

KNOWN = {"1-URGENT": "create", "2-HIGH": "update", "5-LOW": "delete"}
UNKNOWN = {"2-HIGH": "snapshot", "3-MEDIUM": "update", "4-NOT SPECIFIED": "delete"}


def _merge_orders(spark, sf, known, unknown):
    changes = i.order_changes(spark, sf, {p: KNOWN[p] for p in known}, {p: UNKNOWN[p] for p in unknown})
    return i.shown_target(c.merge(i.order_target(spark, sf), changes, "o_orderkey"))


@query
def merge_inserts(spark, sf):
    return _merge_orders(spark, sf, ["1-URGENT"], ["2-HIGH"])


@query
def merge_updates(spark, sf):
    return _merge_orders(spark, sf, ["2-HIGH"], ["3-MEDIUM"])


@query
def merge_soft_delete(spark, sf):
    return _merge_orders(spark, sf, ["5-LOW"], [])


@query
def merge_tombstones(spark, sf):
    return _merge_orders(spark, sf, [], ["4-NOT SPECIFIED"])


@query
def merge_stats(spark, sf):
    return c.merge_stats(i.order_target(spark, sf), i.order_changes(spark, sf, KNOWN, UNKNOWN), "o_orderkey")


# Whole destinations


@query
def apply_change_log(spark, sf):
    return i.shown_target(c.apply_batch(None, i.event_batch(spark, sf), "id"))


def _event_table(spark, batch, name, late="take"):
    payload = T.StructType([field for field in batch.schema if not field.name.startswith("_")])
    return c.TargetTable.create(spark, work_folder(spark, name), payload, "id", late=late)


def _cuts(batch: DataFrame, parts: int) -> list[DataFrame]:
    """The batch cut into so many ranges of its sequence."""
    end = c.high_watermark_value(batch, "_seq") + 1
    edges = [end * n // parts for n in range(parts + 1)]
    return [batch.filter((col("_seq") >= low) & (col("_seq") < high)) for low, high in zip(edges, edges[1:])]


@query
def apply_two_batches(spark, sf):
    batch = i.event_batch(spark, sf)
    table = _event_table(spark, batch, "two")
    for batch_id, part in enumerate(_cuts(batch, 2)):
        c.apply_to_table(table, part, batch_id)
    return i.shown_target(table.read())


@query
def apply_late_ignore(spark, sf):
    batch = i.event_batch(spark, sf)
    table = _event_table(spark, batch, "late", "ignore")
    for batch_id, part in enumerate(_cuts(batch, 2)):
        c.apply_to_table(table, part, batch_id)
    return i.shown_target(table.read())


@query
def apply_affected(spark, sf):
    batch = i.event_batch(spark, sf)
    table = _event_table(spark, batch, "affected")
    rows = []
    for batch_id, part in enumerate(_cuts(batch, 2)):
        affected = c.apply_to_table(table, part, batch_id).commit.affected
        rows += [(batch_id, operation, matched, count) for (operation, matched), count in affected.items()]
    return spark.createDataFrame(rows, "batch int, operation string, matched boolean, rows_affected bigint")


@query
def apply_json_records(spark, sf):
    records = i.event_records(spark, sf)
    path = f"{work_folder(spark, 'json')}/target"
    is_delete = col("operation") == "delete"
    for batch_id, part in enumerate([~is_delete, is_delete]):
        table = c.apply_records(path, records.filter(part), "id", batch_id)
    rows = table.read()
    return i.shown_target(rows.select(*[name for name in rows.columns if name.startswith("cdc_")], "id", "value", "props"))


@query
def stream_apply(spark, sf):
    batch = i.event_batch(spark, sf)
    table, folder = _event_table(spark, batch, "target"), work_folder(spark, "stream")
    stream = c.stream_changes(spark, f"{folder}/in/*", batch.schema)
    # Each range of the log arrives as new files, and the stream is asked again.
    for n, part in enumerate(_cuts(batch, 3)):
        part.write.parquet(f"{folder}/in/{n}")
        c.run_to_end(c.stream_apply(stream, table, f"{folder}/checkpoint"))
    return i.shown_target(table.read())


@query
def stream_apply_by_count(spark, sf):
    batch = i.event_batch(spark, sf)
    table, folder = _event_table(spark, batch, "counted"), work_folder(spark, "stream")
    stream = c.stream_changes(spark, f"{folder}/in/*", batch.schema)
    # The files that one write makes have no order among themselves, so each range is a micro-batch, whatever its files.
    for n, part in enumerate(_cuts(batch, 3)):
        part.write.parquet(f"{folder}/in/{n}")
        c.run_to_end(c.stream_apply(stream, table, f"{folder}/checkpoint", records=PAGE))
    c.close_stream(table, f"{folder}/checkpoint", PAGE)
    return i.shown_target(table.read())


@query
def stream_handover(spark, sf):
    old, new = i.order_versions(spark, sf)
    folder = work_folder(spark, "handover")
    c.consume(c.net_changes(old, new, "o_orderkey"), f"{folder}/log", 0, i.FIRST_CONSUME)

    def source():  # changes while it is being read
        c.consume(c.net_changes(new, old, "o_orderkey"), f"{folder}/log", 1, i.SECOND_CONSUME)
        return new

    table, position = c.backfill(source, "o_orderkey", "o_orderkey", "orders", f"{folder}/target", f"{folder}/log", i.SNAPSHOT_AT)

    def flat(log):
        return c.flatten_records(c.change_records(c.number_batches(log, PAGE), "o_orderkey", "orders", as_json=False), "o_orderkey")

    stream = c.stream_log(spark, f"{folder}/log", position)
    c.run_to_end(c.stream_apply(stream, table, f"{folder}/checkpoint", flat))
    rows = i.shown_target(table.read())
    return rows.withColumn("o_orderdate", micros_of(col("o_orderdate"), table.schema["o_orderdate"].dataType))


def _replicated(spark, versions, nulls="error", ordering="o_orderkey"):
    folder = work_folder(spark, "replica")
    for (old, new), at in zip(versions, (i.FIRST_CONSUME, i.SECOND_CONSUME)):
        table = c.replicate(
            old, new, "o_orderkey", ordering, "orders", f"{folder}/target", f"{folder}/log", i.SNAPSHOT_AT, at, nulls=nulls,
        )
    rows = i.shown_target(table.read())
    return rows.withColumn("o_orderdate", micros_of(col("o_orderdate"), table.schema["o_orderdate"].dataType))


@query
def replicate_table(spark, sf):
    return _replicated(spark, [i.order_versions(spark, sf)])


@query
def replicate_twice(spark, sf):
    old, new = i.order_versions(spark, sf)
    return _replicated(spark, [(old, new), (new, old)])


@query
def replicate_null_ordering(spark, sf):
    urgent, dearer = col("o_orderpriority") == "1-URGENT", col("o_orderstatus") == "P"
    old = i.table(spark, sf, "orders").withColumn("o_custkey", F.when(~urgent, col("o_custkey")))
    new = old.withColumn("o_totalprice", F.when(dearer, col("o_totalprice") + 1).otherwise(col("o_totalprice")))
    return _replicated(spark, [(old, new)], "keep", "o_custkey")
