"""Applying a batch of change records to a target."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.files import Files
from cdcframe.functions.columns import MissingColumn, col, column_list
from cdcframe.functions.ranges import ROWS_PER_RANGE, number_rows
from cdcframe.functions.types import logical_type, spark_type
from cdcframe.operators.check import SchemaMismatch, check_schema
from cdcframe.operators.compact import compact
from cdcframe.operators.infer import collect_types, field_types, infer_schema
from cdcframe.operators.merge import condense, merge
from cdcframe.operators.render import Bookkeeping, render
from cdcframe.operators.shape import ENVELOPE, OPERATION, READ_AT, REMOVE, SEQ, flatten_records
from cdcframe.sinks.stage import ROUTE, stage_read, stage_write
from cdcframe.sinks.table import STEP, Commit, TargetTable


def apply_batch(
    target: DataFrame | None,
    batch: DataFrame,
    keys: str | Iterable[str],
    prefix: str = "cdc",
    late: str = "take",
    carry_created: bool = False,
) -> DataFrame:
    """The target after a flat batch, as one plan: compact, render, merge. No target means an empty one."""
    changes = render(compact(batch, keys, carry_created), keys, prefix)
    return changes if target is None else merge(target, changes, keys, prefix, late=late)


def _payload_schema(batch: DataFrame) -> T.StructType:
    return T.StructType([field for field in batch.schema if field.name not in ENVELOPE])


def record_schema(
    records: DataFrame, mode: str = "batch", avro_key: str | None = None, nested: bool = False
) -> T.StructType:
    """The payload schema of change records; that of JSON payloads is inferred, see `infer_schema`."""
    after = records.schema["after"].dataType
    return infer_schema(records, mode, avro_key=avro_key, nested=nested) if isinstance(after, T.StringType) else after


def _fitted(inferred: T.StructType, table: TargetTable | None, records: DataFrame, keys: list[str]) -> T.StructType:
    """An inferred schema made to fit: what is NULL throughout has the type that the table gives it, and keys that no
    payload shows have that of the table, or else what their own JSON has."""
    known = {field.name.lower(): field for field in (table.schema if table else [])}
    fields = {field.name.lower(): field for field in inferred}
    for name, field in fields.items():
        if name in known and logical_type(field.dataType) in ("variant", logical_type(known[name].dataType)):
            fields[name] = T.StructField(field.name, known[name].dataType)
    missing = [key for key in keys if key.lower() not in fields]
    if missing and not all(key.lower() in known for key in missing):
        found = collect_types(field_types(records, "key"))
        known |= {name.lower(): T.StructField(name, spark_type(logical)) for name, logical in found.items()}
    for key in missing:
        if key.lower() not in known:
            raise MissingColumn(f"key column not found: {key}")
        fields[key.lower()] = T.StructField(key, known[key.lower()].dataType)
    return T.StructType(list(fields.values()))


@dataclass(frozen=True)
class Applied:
    """The outcome of a batch: the commit and how many records were taken in."""

    commit: Commit
    records: int = 0


def _check(table: TargetTable, batch: DataFrame) -> None:
    """Refuse a batch that does not fit the table, unless it starts with a delete that needs only its key."""
    schema = Bookkeeping(table.prefix).schema(_payload_schema(batch))
    try:
        check_schema(schema, table.schema, table.keys)
    except SchemaMismatch:
        first = batch.agg(F.min_by(col(OPERATION), col(SEQ))).first()[0]
        if first != REMOVE:
            raise
        check_schema(schema, table.schema, table.keys, first)


def _fit(batch: DataFrame, table: TargetTable) -> DataFrame:
    """The batch with the table's payload columns under the table's names; those it lacks are NULL."""
    mine = {name.lower(): name for name in batch.columns if name not in ENVELOPE}
    book = Bookkeeping(table.prefix).columns
    fields = [field for field in table.schema if field.name not in book]
    extra = set(mine) - {field.name.lower() for field in fields}
    if extra:
        raise SchemaMismatch(f"the target table has no column {', '.join(sorted(extra))}")
    return batch.select(
        *ENVELOPE,
        *[
            (col(mine[f.name.lower()]) if f.name.lower() in mine else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ],
    )


def apply_to_table(
    table: TargetTable,
    batch: DataFrame,
    batch_id: int | None = None,
    writer: str = "default",
    fmt: str = "parquet",
    codec: str | None = None,
    cleanup: bool = True,
    carry_created: bool = False,
) -> Applied:
    """Apply a flat batch to a stored table: check, compact, render, stage, merge, clean up.

    The stage is where the batch is cut off from what it was computed from: it is computed once, and its
    size is known before the merge chooses how to join. It is kept when the merge fails.
    """
    table.refresh()
    if table.is_done(batch_id, writer):
        return Applied(Commit(table.version, skipped=True))
    _check(table, batch)
    taken = Observation()
    counted = _fit(batch, table).observe(taken, F.count(F.lit(1)).alias("records"))
    changes = render(compact(counted, table.keys, carry_created), table.keys, table.prefix)
    stage = table.stage_path()
    stage_write(changes, stage, fmt, codec, table.prefix)
    files = Files(table.spark, stage)
    if not any(name.startswith(f"{ROUTE}=") for name in files.names(stage)):
        commit = table.merge(table.spark.createDataFrame([], table.schema), batch_id, writer)
    else:
        commit = table.merge(stage_read(table.spark, stage, table.schema, fmt), batch_id, writer)
    if cleanup:
        files.delete(stage)
    return Applied(commit, taken.get["records"])


def apply_by_count(
    table: TargetTable,
    batch: DataFrame,
    size: int,
    batch_id: int | None = None,
    writer: str = "default",
    close: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Commit:
    """Apply a flat batch as batches of `size` records each, in order of sequence, and commit them at once.

    The records that do not fill a batch wait in files beside the table for the next call of the same writer, which they
    come before; with `close` they are a batch of their own. So where batches end depends on the records alone and not on
    how calls cut them, as long as calls follow the sequence, and a call that is repeated cuts the same ones. Within each batch the rules of `compact` hold; from
    batch to batch those of `merge`, whose outcome is found without going through the batches one by one.
    """
    if size < 1:
        raise ValueError("a batch needs a record")
    table.refresh()
    if table.is_done(batch_id, writer):
        return Commit(table.version, skipped=True)
    spark, keys, waiting = table.spark, table.keys, table.state_of(writer)
    files, stage, attempt = Files(spark, table.path), table.stage_path(), uuid.uuid4().hex
    _check(table, batch)
    records = _fit(batch, table)
    schema = records.schema
    if waiting.get("pending"):
        records = spark.read.schema(schema).parquet(waiting["pending"]).unionByName(records)
    records.write.mode("overwrite").parquet(f"{stage}/records")
    numbered, count = number_rows(spark.read.schema(schema).parquet(f"{stage}/records"), [SEQ, *keys], "_number", rows_per_range=rows_per_range)
    whole = count if close else count - count % size
    steps = numbered.filter(col("_number") < whole).withColumn(STEP, F.floor(col("_number") / size).cast("bigint")).drop("_number")
    changes = render(compact(steps, [*keys, STEP]), [*keys, STEP], table.prefix)
    if table.late == "take":
        changes = condense(changes, keys, STEP, table.prefix)
    changes.write.mode("overwrite").parquet(f"{stage}/changes")
    pending = None
    if whole < count:
        pending = f"{table.path}/pending/{attempt}"
        numbered.filter(col("_number") >= whole).drop("_number").write.parquet(pending)
    state = {"pending": pending, "since": time.time() if pending else None}
    staged = spark.read.schema(changes.schema).parquet(f"{stage}/changes")
    commit = table.merge(staged, batch_id, writer, steps=True, state=state)
    files.delete(stage)
    if waiting.get("pending"):
        files.delete(waiting["pending"])
    return commit


def close_pending(table: TargetTable, size: int, writer: str = "default") -> Commit | None:
    """Apply the records that wait for their batch to fill as a batch of their own."""
    table.refresh()
    if not table.state_of(writer).get("pending"):
        return None
    book = Bookkeeping(table.prefix).columns
    payload = [field for field in table.schema if field.name not in book]
    envelope = T.StructType().add(SEQ, T.LongType()).add(OPERATION, T.StringType()).add(READ_AT, T.LongType())
    none = table.spark.createDataFrame([], T.StructType([*envelope, *payload]))
    return apply_by_count(table, none, size, None, writer, close=True)


def apply_records(
    table_path: str,
    records: DataFrame,
    keys: str | Iterable[str],
    batch_id: int | None = None,
    schema: T.StructType | None = None,
    mode: str = "batch",
    avro_key: str | None = None,
    nested: bool = False,
    buckets: int | None = None,
    prefix: str = "cdc",
    late: str = "take",
    **options,
) -> TargetTable:
    """Apply change records to the table at a path, which is created by the first batch.

    The schema of JSON payloads is inferred unless given; a column of NULLs, and the keys of a batch of deletes, have the
    types of the table. `options` go to `apply_to_table`.
    """
    spark, keys = records.sparkSession, column_list(keys)
    table = TargetTable.open(spark, table_path) if TargetTable.exists(spark, table_path) else None
    if schema is None:
        schema = record_schema(records, mode, avro_key, nested)
        if isinstance(records.schema["after"].dataType, T.StringType):
            schema = _fitted(schema, table, records, keys)
    batch = flatten_records(records, keys, schema)
    if table is None:
        table = TargetTable.create(spark, table_path, _payload_schema(batch), keys, buckets, prefix, late)
    apply_to_table(table, batch, batch_id, **options)
    return table
