"""The change log and the target as Structured Streaming source and sink."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdcframe.files import Files
from cdcframe.functions.columns import col
from cdcframe.functions.payload import Position
from cdcframe.plans.apply import apply_by_count, apply_to_table, close_pending
from cdcframe.sinks.table import TargetTable
from cdcframe.sources.log import INDEX_SCHEMA, LogFile, consume, index_folder, last_source, next_consume, read_files, rows_done

Flatten = Callable[[DataFrame], DataFrame]


def stream_changes(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The parquet files of a folder as a stream in the order they were written. For a change log, see `stream_log`.

    The files that one job writes have no order among themselves: where the order matters, `max_files` is for jobs of one file.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*[col(field.name) for field in schema])


@dataclass(frozen=True)
class LogStream:
    """A change log as a stream: what streams is its index, and the rows of a micro-batch are those the index names."""

    path: str
    index: DataFrame
    start: int = 0

    def rows(self, batch: DataFrame) -> DataFrame | None:
        """The numbered rows of a micro-batch of the index; None if it has none after the start."""
        files = sorted((LogFile(**line.asDict()) for line in batch.collect()), key=lambda file: file.first)
        files = [file for file in files if file.rows and file.end > self.start]
        return read_files(batch.sparkSession, self.path, files, self.start) if files else None


def stream_log(
    spark: SparkSession, path: str, position: Position | None = None, max_consumes: int | None = None
) -> LogStream:
    """The numbered rows of a change log as a stream, from its start or after a saved position of it.

    A consume is seen when it is in the index, so never in part and never twice. Files that lie wholly before the position
    are not opened. A position of a snapshot is refused.
    """
    start = rows_done(position)
    Files(spark, path).make(index_folder(path))
    reader = spark.readStream.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.json")
    if max_consumes is not None:
        reader = reader.option("maxFilesPerTrigger", max_consumes)
    return LogStream(path, reader.json(index_folder(path)), start)


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """The id of a started stream, which outlives restarts."""
    saved = Files(spark, checkpoint).read_text(f"{checkpoint.rstrip('/')}/metadata")
    return f"stream {json.loads(saved)['id']}"


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def stream_each(
    stream: DataFrame | LogStream,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to a function, with its number. After a failure the last one comes again under its number."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = stream.rows(batch) if isinstance(stream, LogStream) else batch
        if rows is not None:
            handle(rows, batch_id)

    source = stream.index if isinstance(stream, LogStream) else stream
    query = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return query.trigger(**_trigger(interval)).start()


def stream_append(
    stream: DataFrame | LogStream,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    change: Flatten | None = None,
) -> StreamingQuery:
    """Append a stream to parquet files, each micro-batch once. `change` is applied to each micro-batch of a log first: there
    every micro-batch has a folder of its own, which a repetition replaces."""
    if not isinstance(stream, LogStream):
        stream = stream if change is None else change(stream)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        return writer.trigger(**_trigger(interval)).start(path)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows if change is None else change(rows)
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_batch={batch_id}")

    return stream_each(stream, write, checkpoint, interval)


def stream_consume(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    at: Callable[[int], datetime] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Append a stream of changes, as `net_changes` has them, to the change log at `path`: one consume for each micro-batch.

    The index keeps which micro-batch of which stream a consume was, so one that comes again after a failure is in the log
    once: if its index file had been put in place it is skipped, otherwise written anew. `at` gives the consume time
    of a micro-batch; by itself it is the present. The log has one writer at a time.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark, writer = batch.sparkSession, _identity(batch.sparkSession, checkpoint)
        last = last_source(spark, path, f"{writer}:")
        if last is None or int(last.rsplit(":", 1)[1]) < batch_id:
            consume(batch, path, next_consume(spark, path), at(batch_id) if at else None, f"{writer}:{batch_id}")

    return stream_each(stream, take, checkpoint, interval)


def stream_apply(
    stream: DataFrame | LogStream,
    table: TargetTable,
    checkpoint: str,
    flatten: Flatten | None = None,
    writer: str | None = None,
    interval: str | None = None,
    records: int | None = None,
    delay: float | None = None,
    **options,
) -> StreamingQuery:
    """Apply each micro-batch of a stream to a table, in order.

    `flatten` turns a micro-batch into a flat batch. Without an interval the query takes what there is
    and ends. The table keeps the last batch of each `writer`, so a micro-batch that is replayed after a
    failure is skipped. Unless named, the writer is the stream itself, by the id that Spark keeps in its
    checkpoint: a stream with a new checkpoint is a new writer, and takes its source anew.

    Late updates are found within one batch, so the limits of batches are part of the result. By themselves they are those
    of the micro-batches, e.g. `max_files`. With `records` a batch is that many records, however they come: see
    `apply_by_count`. What does not fill a batch waits for the next micro-batch, but is a batch by itself if that
    comes more than `delay` seconds later; at the end `close_stream` makes it one.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        flat = batch if flatten is None else flatten(batch)
        name = writer or _identity(table.spark, checkpoint)
        if records is None:
            apply_to_table(table, flat, batch_id, name, **options)
            return
        table.refresh()
        since = table.state_of(name).get("since")
        if delay is not None and since is not None and time.time() - since > delay and not table.is_done(batch_id, name):
            close_pending(table, records, name)
        apply_by_count(table, flat, records, batch_id, name, **options)

    return stream_each(stream, merge_batch, checkpoint, interval)


def close_stream(table: TargetTable, checkpoint: str, records: int, writer: str | None = None) -> None:
    """Apply what a stream that has ended has left waiting for its batch to fill."""
    close_pending(table, records, writer or _identity(table.spark, checkpoint))


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query that ends by itself, and stop it whatever happens."""
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError("the stream did not end in time")
    finally:
        query.stop()
