"""Compacted records as rows of the target table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import checked, col, column_list
from cdcframe.operators.shape import CREATE, CREATED_AT, ENVELOPE, OPERATION, READ_AT, REMOVE, SNAPSHOT, UPDATE


@dataclass(frozen=True)
class Bookkeeping:
    """The four bookkeeping columns of a target table."""

    prefix: str = "cdc"

    @property
    def operation(self) -> str:
        return f"{self.prefix}_operation"

    @property
    def created_at(self) -> str:
        return f"{self.prefix}_created_at"

    @property
    def updated_at(self) -> str:
        return f"{self.prefix}_updated_at"

    @property
    def deleted_at(self) -> str:
        return f"{self.prefix}_deleted_at"

    @property
    def columns(self) -> list[str]:
        return [self.operation, self.created_at, self.updated_at, self.deleted_at]

    def layout(self, names: Iterable[str]) -> list[str]:
        """The columns of the table in order: bookkeeping first, the others by name."""
        return self.columns + sorted(name for name in names if name not in self.columns)

    def schema(self, payload: T.StructType) -> T.StructType:
        """The schema of the table for payload (and key) columns of the given types."""
        types = {field.name: field.dataType for field in payload}
        types |= dict.fromkeys(self.columns, T.TimestampType()) | {self.operation: T.StringType()}
        return T.StructType([T.StructField(name, types[name]) for name in self.layout(types)])


def with_bookkeeping(df: DataFrame, prefix: str = "cdc") -> DataFrame:
    """The frame in table order, with the bookkeeping columns it lacks added as NULL."""
    wanted = Bookkeeping(prefix).schema(df.schema)
    return df.select(
        *[
            col(field.name) if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name)
            for field in wanted
        ]
    )


def render(winners: DataFrame, keys: str | Iterable[str], prefix: str = "cdc") -> DataFrame:
    """The table row of each winning record.

    The read time goes to the one time column of the operation. A delete keeps its key and leaves every
    payload column NULL. A created time that `compact` has carried is kept.
    """
    keys, book = column_list(keys), Bookkeeping(prefix)
    carried = F.timestamp_micros(col(CREATED_AT)) if CREATED_AT in winners.columns else F.lit(None)
    operation, read_at = col(OPERATION), F.timestamp_micros(col(READ_AT))
    kept = {
        book.operation: operation,
        book.created_at: F.when(operation.isin(CREATE, SNAPSHOT), read_at).otherwise(carried).cast("timestamp"),
        book.updated_at: F.when(operation == UPDATE, read_at),
        book.deleted_at: F.when(operation == REMOVE, read_at),
        **{name: col(name) for name in keys},
    }
    names = [name for name in winners.columns if name not in (*ENVELOPE, CREATED_AT)]
    return winners.select(
        *[kept.get(name, F.when(operation != REMOVE, col(name))).alias(name) for name in book.layout(names)]
    )


def route(rows: DataFrame, prefix: str = "cdc") -> Column:
    """Where a row goes: `inserts` (create, snapshot) or `updates` (update, delete)."""
    operation = col(Bookkeeping(prefix).operation)
    inserts = operation.isin(CREATE, SNAPSHOT)
    target = F.when(inserts, "inserts").otherwise("updates")
    return checked(inserts | operation.isin(UPDATE, REMOVE), target, "a row has an unknown operation")


def route_inserts(rows: DataFrame, prefix: str = "cdc") -> DataFrame:
    """The rows that go in as new."""
    return rows.filter(route(rows, prefix) == "inserts")


def route_updates(rows: DataFrame, prefix: str = "cdc") -> DataFrame:
    """The rows that change or delete."""
    return rows.filter(route(rows, prefix) == "updates")
