"""The change log: append-only parquet files whose rows are numbered by an index.

Rows are numbered from 0 in the order (consume time, digest of the row id, row id, is-update, action). The digest is
taken here, so any row ids are spread evenly over tasks without a look at them first. Files are written once, in
that order; what makes the numbers is an index of one small file for each consume, with the first number of each data file.
A row's number is that of its file plus its place there. A consume counts from the moment its index file is put in place by
one rename: readers and streams know of no other files. A page, or the rest of the log after a position, opens only the
files that the index names for it; nothing is sorted or shuffled to read the log, however far into it.

Layout of a log folder:

    data/<consume>-<attempt>/part-*.parquet    the rows of a consume
    index/<consume>.json                       a line for each file: its name, first number, rows, and the consume time
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe.files import Files
from cdcframe.functions.columns import checked, col
from cdcframe.functions.payload import CHANGE_POSITION, Position
from cdcframe.sources.feed import ACTION, CONSUMED_AT, IS_UPDATE, METADATA, ROW_ID

ROW_NUMBER = "METADATA$ROW_NUMBER"
BATCH_ID = "batch_id"
INDEX_IN_BATCH = "index_in_batch"
_DIGEST = "_digest"
_DIGEST_RANGE = 16**8
#: Hex digits of a digest that make a positive bigint.
_LEADING = 15
#: The index is broadcast up to so many files; beyond, Spark joins it as it sees fit.
_BROADCAST_FILES = 100_000


@dataclass(frozen=True)
class LogFile:
    """A line of the index."""

    consume: int
    file: str  # under the folder of the log
    first: int
    rows: int
    at: int  # microseconds
    source: str | None = None  # what a stream calls the batch

    @property
    def end(self) -> int:
        return self.first + self.rows


#: The lines of the index, as a stream reads them.
INDEX_SCHEMA = "consume bigint, file string, first bigint, rows bigint, at bigint, source string"


def index_folder(path: str) -> str:
    return f"{path.rstrip('/')}/index"


def _consumes(files: Files, path: str) -> list[int]:
    names = files.names(index_folder(path))
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _entries(files: Files, path: str, consume_id: int) -> list[LogFile]:
    text = files.read_text(f"{index_folder(path)}/{consume_id}.json")
    return [LogFile(**json.loads(line)) for line in text.splitlines()]


def consume(
    changes: DataFrame, path: str, consume_id: int, at: datetime | None = None, source: str | None = None
) -> bool:
    """Append all pending changes to the log at `path`, stamped with one consume time. Whether they were appended.

    Consume ids go up with time. A consume that is in the log already is left as it is, so repeating one after a failure
    duplicates nothing; what a failed attempt wrote is in no index and counts for nothing.

    The changes are computed and written once, into files that follow the order of the digests, whose leading digits cut
    them into even ranges that need no sampling. A NULL row id fails the consume.
    """
    at = at or datetime.now(timezone.utc)
    if at.tzinfo is None:
        raise ValueError("the consume time needs a time zone")
    spark, consume_id = changes.sparkSession, int(consume_id)
    path = path.rstrip("/")
    files = Files(spark, path)
    done = _consumes(files, path)
    if consume_id in done:
        return False
    if done and done[-1] > consume_id:
        raise ValueError(f"the log has consumes after {consume_id}, whose rows are numbered already")
    first = _next_number(files, path, done)

    folder = f"data/{consume_id}-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    micros = round(at.timestamp() * 1_000_000)
    stamp = F.timestamp_micros(F.lit(micros).cast("bigint")).alias(CONSUMED_AT)
    rows = in_ranges(changes, parts).select(*[col(name) for name in changes.columns], stamp)
    # Digests as text take half the room with zstd; Snappy leaves them as they are.
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{folder}")

    # Counting takes the files' footers only. There are about as many files as shuffle partitions.
    written = spark.read.schema(rows.schema).parquet(f"{path}/{folder}").groupBy(F.col("_metadata.file_name").alias("name"))
    sizes = {r["name"]: r["count"] for r in written.count().collect()}
    names = [name for name in files.names(f"{path}/{folder}") if name.endswith(".parquet")]
    lines = []
    # Files are in order of their task numbers. One without rows keeps the columns of a consume without rows.
    for name in sorted(names if not sizes else sizes, key=lambda name: (int(name.split("-")[1]), name)):
        lines.append(LogFile(consume_id, f"{folder}/{name}", first, sizes.get(name, 0), micros, source))
        first += sizes.get(name, 0)
    text = "".join(json.dumps(asdict(line)) + "\n" for line in lines)
    files.write_text(f"{index_folder(path)}/{consume_id}.json", text)
    return True


def in_ranges(changes: DataFrame, parts: int) -> DataFrame:
    """The changes in `parts` ranges of the order of the log, sorted within each, with the digest of their row ids.

    The digest is made anew after the shuffle, and a row id in lower-case hex goes through it, and through the sort, as
    bytes, so that a change takes a row id's worth of room there and not three.
    """
    row_id = checked(col(ROW_ID).isNotNull(), col(ROW_ID), "a change has no row id")
    names = [col(name) for name in changes.columns if name != ROW_ID]
    code = F.unhex(col(ROW_ID))
    packed = F.when(F.lower(F.hex(code)) == col(ROW_ID), code)
    slim = changes.withColumn(ROW_ID, row_id).select(*names, packed.alias("_packed"), F.when(packed.isNull(), col(ROW_ID)).alias("_plain"))
    whole = F.coalesce(F.lower(F.hex("_packed")), col("_plain"))
    slot = F.conv(F.substring(F.md5(whole), 1, 8), 16, 10).cast("bigint")
    ranged = slim.repartitionById(parts, F.floor(slot * F.lit(parts) / F.lit(_DIGEST_RANGE)).cast("int"))
    # Nor does the sort hold the texts: it goes by the leading digits as a number, and makes the rest where those are equal.
    digest = F.md5(whole)
    leading = F.conv(F.substring(digest, 1, _LEADING), 16, 10).cast("bigint").alias("_leading")
    placed = ranged.select(*names, "_packed", "_plain", leading)
    ordered = placed.sortWithinPartitions("_leading", digest, whole, IS_UPDATE, ACTION)
    return ordered.select(*names, whole.alias(ROW_ID), digest.alias(_DIGEST))


def _next_number(files: Files, path: str, done: list[int]) -> int:
    """The number after the last row of the log. Only the last index file is looked at."""
    return max((entry.end for entry in _entries(files, path, done[-1])), default=0) if done else 0


def last_source(spark: SparkSession, path: str, beginning: str) -> str | None:
    """The source of the last consume whose source has this beginning."""
    files = Files(spark, path)
    for consume_id in reversed(_consumes(files, path)):
        for entry in _entries(files, path, consume_id)[:1]:
            if entry.source is not None and entry.source.startswith(beginning):
                return entry.source
    return None


def log_end(spark: SparkSession, path: str) -> int:
    """The number that the next row of the log at `path` will have."""
    files = Files(spark, path)
    return _next_number(files, path, _consumes(files, path))


def next_consume(spark: SparkSession, path: str) -> int:
    """The id after that of the last consume of a log, 0 for a log that does not exist."""
    return max(_consumes(Files(spark, path), path), default=-1) + 1


def read_log(
    spark: SparkSession, path: str, consume_id: int | None = None, first: int = 0, end: int | None = None
) -> DataFrame:
    """The change log at `path`, what one consume added, or the rows from number `first` up to `end`: the table columns, the
    four metadata columns and the row number. Files without such rows are not opened."""
    files = Files(spark, path)
    done = _consumes(files, path)
    if consume_id is not None:
        done = [n for n in done if n == consume_id]
    if not done:
        raise FileNotFoundError(f"no log at {path}" if consume_id is None else f"no consume {consume_id} in the log at {path}")
    entries = [entry for n in _needed(files, path, done, first) for entry in _entries(files, path, n)]
    return read_files(spark, path, entries, first, end)


def _needed(files: Files, path: str, done: list[int], first: int) -> list[int]:
    """The consumes that can have rows from a number on, the last one in any case. Consumes are in order of their numbers, so
    it is found by halving, which reads few index files of a long log."""
    low, high = 0, len(done) - 1
    while first and low < high:
        middle = (low + high) // 2
        if max(entry.end for entry in _entries(files, path, done[middle])) > first:
            high = middle
        else:
            low = middle + 1
    return done[low:]


def read_files(
    spark: SparkSession, path: str, entries: Iterable[LogFile], first: int = 0, end: int | None = None
) -> DataFrame:
    """The numbered rows of some files of a log, from number `first` up to `end`. Others are not opened."""
    entries = list(entries)
    if not entries:
        raise ValueError("no files of the log are given")
    wanted = [e for e in entries if e.rows and e.end > first and (end is None or e.first < end)] or entries[-1:]
    rows = spark.read.parquet(*[f"{path.rstrip('/')}/{entry.file}" for entry in wanted])
    names = rows.columns
    # A folder has no two files of a name, and each consume its own folder: both make the name of a file.
    file = F.substring_index(F.col("_metadata.file_path"), "/", -2).alias("_file")
    placed = rows.select(*[col(name) for name in names], file, F.col("_metadata.row_index").alias("_place"))
    # As an Arrow table, so that it is a local relation: no task has to make it.
    starts = pa.table({"_file": [entry.file.split("/", 1)[1] for entry in wanted], "_start": [entry.first for entry in wanted]})
    starts = spark.createDataFrame(starts)
    starts = F.broadcast(starts) if len(wanted) <= _BROADCAST_FILES else starts
    numbered = placed.join(starts, "_file").select(
        *[col(name) for name in names], (col("_start") + col("_place")).alias(ROW_NUMBER)
    )
    if first > min(entry.first for entry in wanted):
        numbered = numbered.filter(col(ROW_NUMBER) >= F.lit(first))
    if end is not None:
        numbered = numbered.filter(col(ROW_NUMBER) < F.lit(end))
    return numbered


def payload_columns(log: DataFrame) -> list[str]:
    """The columns of the table itself, without those of the log."""
    return [name for name in log.columns if name not in (*METADATA, ROW_NUMBER, BATCH_ID, INDEX_IN_BATCH)]


def number_batches(log: DataFrame, size: int) -> DataFrame:
    """The log with the batch of each row (the number of the batch's first row) and its index there."""
    index = col(ROW_NUMBER) % F.lit(size)
    return log.withColumn(BATCH_ID, col(ROW_NUMBER) - index).withColumn(INDEX_IN_BATCH, index)


def log_page(spark: SparkSession, path: str, offset: int, size: int) -> DataFrame:
    """The `size` rows of the log at `path` from row number `offset` on, in log order."""
    return read_log(spark, path, first=offset, end=offset + size).orderBy(col(ROW_NUMBER)).limit(size)


def log_after(spark: SparkSession, path: str, position: Position | None, size: int) -> DataFrame:
    """The batched rows of the log at `path` that come after a saved position; all of them, without one."""
    return number_batches(read_log(spark, path, first=rows_done(position)), size)


def rows_done(position: Position | None) -> int:
    """How many rows of a log are done at a saved position, which must be one of a log."""
    if position is not None and position.kind != CHANGE_POSITION:
        raise ValueError("the saved position is not one of a change log")
    return 0 if position is None else position.rows_done
