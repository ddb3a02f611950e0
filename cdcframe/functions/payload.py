"""Row payloads, keys and positions as columns."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import col, require
from cdcframe.functions.times import rfc3339

# The two kinds of position.
SNAPSHOT_POSITION = "s"
CHANGE_POSITION = "c"


def _unordered(dtype: T.DataType) -> bool:
    """Whether values of a type hold variants or maps, which cannot be grouped by."""
    if isinstance(dtype, T.StructType):
        return any(_unordered(field.dataType) for field in dtype)
    if isinstance(dtype, T.ArrayType):
        return _unordered(dtype.elementType)
    return isinstance(dtype, (T.VariantType, T.MapType))


def _plain(value: Column, dtype: T.DataType) -> Column:
    """The value with its maps as arrays of entries in order of their keys, and its variants as JSON text."""
    if not _unordered(dtype):
        return value
    if isinstance(dtype, T.VariantType):
        return F.to_json(value)
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[_plain(value[field.name], field.dataType).alias(field.name) for field in dtype])
        return F.when(value.isNotNull(), fields)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: _plain(item, dtype.elementType))
    pairs = F.transform(
        F.map_entries(value),
        lambda e: F.struct(_plain(e["key"], dtype.keyType).alias("key"), _plain(e["value"], dtype.valueType).alias("value")),
    )
    return F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))


def canonical(value: Column, dtype: T.DataType) -> Column | None:
    """A column that is equal for equal values of a type that cannot be grouped by, since it holds variants or maps at some
    depth; None for other types."""
    if not _unordered(dtype):
        return None
    # Arrays, structs and text group as they are.
    return _plain(value, dtype)


def json_value(column: Column, dtype: T.DataType) -> Column:
    """A value as it goes into JSON: times as UTC RFC 3339 text, the rest as it is."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return rfc3339(column, dtype)
    return column


def json_object(df: DataFrame, columns: Iterable[str]) -> Column:
    """The columns, in the given order, as a JSON object in which NULLs are kept."""
    fields = [json_value(col(name), df.schema[name].dataType).alias(name) for name in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def payload_json(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The whole row as a JSON object with its keys in order of name.

    Binary values become base64 and times become UTC RFC 3339 text.
    """
    return json_object(df, sorted(require(df, df.columns if columns is None else columns)))


def record_key(df: DataFrame, keys: str | Iterable[str]) -> Column:
    """The key columns as one struct; a column that the frame lacks is an error."""
    return F.struct(*[col(name) for name in require(df, keys, "key column")])


def position_json(
    kind: str,
    last: Column | None = None,
    maximum: Column | None = None,
    index: Column | None = None,
    batch: Column | None = None,
    time: Column | None = None,
) -> Column:
    """A resumable position as JSON text. `time` defaults to the start time of the query."""
    if kind not in (SNAPSHOT_POSITION, CHANGE_POSITION):
        raise ValueError(f"unknown position kind {kind!r}")
    nothing, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    return F.to_json(
        F.struct(
            F.lit(kind).alias("IteratorType"),
            (nothing if last is None else last).alias("SnapshotLastProcessedVal"),
            (nothing if maximum is None else maximum).alias("SnapshotMaxValue"),
            (zero if index is None else index).alias("IndexInBatch"),
            (zero if batch is None else batch).alias("BatchID"),
            rfc3339(F.current_timestamp() if time is None else time, T.TimestampType()).alias("Time"),
        ),
        {"ignoreNullFields": "false"},
    )


@dataclass(frozen=True)
class Position:
    """A parsed position: where a snapshot or a change log is to be resumed."""

    kind: str
    last: object = None
    maximum: object = None
    index: int = 0
    batch: int = 0

    @property
    def rows_done(self) -> int:
        """How many rows of the change log are done, the one at this position included."""
        return self.batch + self.index + 1


def parse_position(text: str | None) -> Position | None:
    """The position in a saved text; nothing saved means a fresh start."""
    if text is None:
        return None
    saved = json.loads(text, parse_float=Decimal)
    kind = saved.get("IteratorType")
    if kind not in (SNAPSHOT_POSITION, CHANGE_POSITION):
        raise ValueError(f"unknown position kind {kind!r}")
    return Position(
        kind,
        saved.get("SnapshotLastProcessedVal"),
        saved.get("SnapshotMaxValue"),
        int(saved.get("IndexInBatch") or 0),
        int(saved.get("BatchID") or 0),
    )
