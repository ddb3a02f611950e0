"""Bounded, resumable scans of a table in the order of one column.

The maximum of the ordering column is taken once, when a snapshot starts, and kept in its positions.
The bounds are plain literals, so they reach the parquet or JDBC scan; nothing is paged, the whole
range is one parallel scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcframe.functions.columns import checked, col, literal, require
from cdcframe.functions.payload import SNAPSHOT_POSITION, Position


def key_columns(keys: Iterable[str], primary_keys: Iterable[str], ordering: str) -> list[str]:
    """The columns that key the records of a table: the named ones, else its primary key, else the ordering column."""
    return list(keys) or list(primary_keys) or [ordering]


def high_watermark(df: DataFrame, ordering: str) -> DataFrame:
    """One row with the largest value of the ordering column, NULL for an empty table."""
    require(df, ordering, "ordering column")
    return df.agg(F.max(col(ordering)).alias("high_watermark"))


def high_watermark_value(df: DataFrame, ordering: str) -> Any:
    """The high watermark as a value, to be fixed at the start of a snapshot."""
    return high_watermark(df, ordering).first()[0]


def snapshot(
    df: DataFrame,
    ordering: str,
    maximum: Any = None,
    after: Any = None,
    columns: Iterable[str] | None = None,
    nulls: str = "drop",
) -> DataFrame:
    """The rows with `after < ordering <= maximum`; a bound that is None does not apply.

    As with any comparison, a row whose ordering value is NULL falls out as soon as there is a bound;
    `nulls="error"` fails instead, and `nulls="keep"` takes such rows into a scan without a lower bound.
    """
    require(df, ordering, "ordering column")
    order, kind = col(ordering), df.schema[ordering].dataType
    if nulls not in ("drop", "error", "keep"):
        raise ValueError(f"nulls must be 'drop', 'error' or 'keep', not {nulls!r}")
    if nulls == "error":
        order = checked(order.isNotNull(), order, f"NULL in ordering column {ordering}")
    if after is not None:
        df = df.filter(order > literal(after, kind))
    if maximum is not None:
        below = order <= literal(maximum, kind)
        df = df.filter(below | order.isNull() if nulls == "keep" and after is None else below)
    if after is None and maximum is None and nulls == "error":
        df = df.filter(order.isNotNull())
    return df if columns is None else df.select(*[col(name) for name in require(df, columns)])


def resume_snapshot(
    df: DataFrame, ordering: str, position: Position, columns: Iterable[str] | None = None
) -> DataFrame:
    """The rest of a snapshot. Its maximum comes from the position, it is not taken again."""
    if position.kind != SNAPSHOT_POSITION:
        raise ValueError("the saved position is not one of a snapshot")
    return snapshot(df, ordering, position.maximum, position.last, columns)


def snapshot_page(
    df: DataFrame,
    ordering: str,
    size: int,
    maximum: Any = None,
    after: Any = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """The next `size` rows in order.

    The next page starts strictly after the last value of this one, so an ordering column with
    repeated values loses rows between pages; `snapshot` reads such a table whole.
    """
    page = snapshot(df, ordering, maximum, after).orderBy(col(ordering)).limit(size)
    return page if columns is None else page.select(*[col(name) for name in require(df, columns)])
