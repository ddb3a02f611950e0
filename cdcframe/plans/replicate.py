"""From a source table to change records, and on to a target table."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe.files import Files
from cdcframe.functions.columns import col, column_list, literal, require
from cdcframe.functions.payload import (
    CHANGE_POSITION,
    SNAPSHOT_POSITION,
    Position,
    json_value,
    parse_position,
    position_json,
)
from cdcframe.operators.shape import SNAPSHOT, classify, collapse_pairs, to_records
from cdcframe.plans.apply import apply_records
from cdcframe.sinks.table import TargetTable
from cdcframe.sources.feed import CONSUMED_AT, net_changes
from cdcframe.sources.log import (
    BATCH_ID,
    INDEX_IN_BATCH,
    ROW_NUMBER,
    consume,
    log_end,
    next_consume,
    number_batches,
    payload_columns,
    read_log,
)
from cdcframe.sources.scan import high_watermark_value, key_columns, snapshot

_WRITER = "replicate"


def micros(at: datetime) -> int:
    """Microseconds since 1970-01-01 UTC of a time with a zone."""
    if at.tzinfo is None:
        raise ValueError("the time needs a time zone")
    return round(at.timestamp() * 1_000_000)


def snapshot_records(
    df: DataFrame,
    ordering: str,
    keys: str | Iterable[str] | None,
    table: str,
    read_at: datetime,
    columns: Iterable[str] | None = None,
    as_json: bool = True,
    position: Position | None = None,
    nulls: str = "error",
    primary_keys: Iterable[str] = (),
) -> DataFrame:
    """A bounded snapshot as records, whole or from a saved position on.

    With a position, the maximum is the one it holds and the records after it are those that were not done. Without
    keys, the primary keys, or else the ordering column, key the records. A NULL ordering value fails the query;
    `nulls` can also be `keep`, for which such rows belong to a snapshot from its start, or `drop`. All records have
    the sequence 0: a key occurs once, see `require_unique`.
    """
    if position is not None and position.kind != SNAPSHOT_POSITION:
        raise ValueError("the saved position is not one of a snapshot")
    keys = key_columns(column_list(keys or []), primary_keys, ordering)
    kind = df.schema[ordering].dataType
    maximum = high_watermark_value(df, ordering) if position is None else position.maximum
    at = F.lit(micros(read_at)).cast("bigint")
    last, top = json_value(col(ordering), kind), json_value(literal(maximum, kind), kind)
    saved = position_json(SNAPSHOT_POSITION, last, top, time=F.timestamp_micros(at))
    rows = snapshot(df, ordering, maximum, None if position is None else position.last, nulls=nulls)
    return to_records(rows, SNAPSHOT, keys, table, at, saved, F.lit(0).cast("bigint"), columns, as_json)


def require_unique(df: DataFrame, keys: str | Iterable[str]) -> None:
    """Raise if a key occurs twice: the snapshot of such a table has no one row for it. Only keys are shuffled."""
    keys = require(df, keys, "key column")
    twice = df.groupBy(*[col(key) for key in keys]).count().filter(F.col("count") > 1).first()
    if twice is not None:
        raise ValueError(f"the key ({', '.join(keys)}) = {tuple(twice)[:-1]} occurs {twice[-1]} times")


def change_records(batches: DataFrame, keys: str | Iterable[str], table: str, as_json: bool = True) -> DataFrame:
    """Batched change-log rows as records, one per change, in the order of their row numbers."""
    rows = classify(collapse_pairs(batches), "_operation")
    columns = payload_columns(batches)
    position = position_json(CHANGE_POSITION, index=col(INDEX_IN_BATCH), batch=col(BATCH_ID), time=col(CONSUMED_AT))
    read_at = F.unix_micros(col(CONSUMED_AT))
    return to_records(rows, col("_operation"), keys, table, read_at, position, col(ROW_NUMBER), columns, as_json)


def snapshot_then_changes(snapshots: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot records followed by change records.

    `phase` is 0 for the snapshot and 1 for the changes; records go in order of (phase, seq). The
    changes are recorded from before the snapshot's maximum is taken, so a row may come in both; the
    merge by key heals that.
    """
    return snapshots.withColumn("phase", F.lit(0)).unionByName(changes.withColumn("phase", F.lit(1)))


def _has_snapshot(spark: SparkSession, table_path: str) -> bool:
    """Whether the snapshot was committed. A call that failed before that may have left an empty table."""
    return TargetTable.exists(spark, table_path) and TargetTable.open(spark, table_path).is_done(0, _WRITER)


def backfill(
    read: Callable[[], DataFrame],
    keys: str | Iterable[str] | None,
    ordering: str,
    name: str,
    table_path: str,
    log_path: str,
    snapshot_at: datetime,
    nulls: str = "error",
    primary_keys: Iterable[str] = (),
    **options,
) -> tuple[TargetTable, Position | None]:
    """Bring a whole source table into a target, and tell from where on in its change log a stream has to go on.

    The position is that of the end of the log before `read` is called, and is kept beside the table: whatever changes
    while the source is being read is recorded after it, so nothing is missed, and what is in both is merged by key. A call
    that is repeated after a failure keeps the first position, and takes the snapshot again if it was not committed.
    No position means the start of the log.
    """
    spark = SparkSession.getActiveSession()
    keys = key_columns(column_list(keys or []), primary_keys, ordering)
    saved = f"{table_path.rstrip('/')}/backfill/{name}.json"
    files = Files(spark, table_path)
    if not files.exists(saved):
        end = log_end(spark, log_path)
        row = {"IteratorType": CHANGE_POSITION, "IndexInBatch": 0, "BatchID": end - 1}
        files.write_text(saved, json.dumps(row if end else None))
    text = files.read_text(saved)
    position = None if text == "null" else parse_position(text)
    if not _has_snapshot(spark, table_path):
        source = read()
        require_unique(source, keys)
        records = snapshot_records(source, ordering, keys, name, snapshot_at, as_json=False, nulls=nulls)
        apply_records(table_path, records, keys, batch_id=0, writer=_WRITER, **options)
    return TargetTable.open(spark, table_path), position


def replicate(
    old: DataFrame,
    new: DataFrame,
    keys: str | Iterable[str] | None,
    ordering: str,
    name: str,
    table_path: str,
    log_path: str,
    snapshot_at: datetime,
    consumed_at: datetime,
    batch_size: int = 1000,
    with_snapshot: bool = True,
    nulls: str = "error",
    primary_keys: Iterable[str] = (),
    consume_id: int | None = None,
    **options,
) -> TargetTable:
    """Bring a target table from version `old` of a source table to version `new`, by way of the change log.

    The first time, and unless it is left out, a snapshot of the old version comes before the changes. Later calls
    over the same table and log carry on: from `new` to a still later version and so on; after a call that failed
    before its snapshot was committed, the snapshot is taken again. Each call adds a consume to the log and applies
    what that consume holds. To repeat a call that failed after its consume, give the `consume_id` it had
    (`next_consume` tells before a call), so that its changes are not added twice.
    """
    spark = old.sparkSession
    keys = key_columns(column_list(keys or []), primary_keys, ordering)
    consume_id = next_consume(spark, log_path) if consume_id is None else consume_id
    if with_snapshot and not _has_snapshot(spark, table_path):
        require_unique(old, keys)
        records = snapshot_records(old, ordering, keys, name, snapshot_at, as_json=False, nulls=nulls)
        apply_records(table_path, records, keys, batch_id=0, writer=_WRITER, **options)
    consume(net_changes(old, new, keys), log_path, consume_id, consumed_at)
    log = number_batches(read_log(spark, log_path, consume_id), batch_size)
    records = change_records(log, keys, name, as_json=False)
    return apply_records(table_path, records, keys, batch_id=consume_id + 1, writer=_WRITER, **options)
