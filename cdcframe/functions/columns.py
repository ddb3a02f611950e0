"""Small helpers on column lists, shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumn(ValueError):
    """A named column is not in the frame."""


def column_list(names: str | Iterable[str]) -> list[str]:
    """One name or several, as a list."""
    return [names] if isinstance(names, str) else list(names)


def require(df: DataFrame, names: str | Iterable[str], role: str = "column") -> list[str]:
    """The names as a list, after checking that the frame has each of them."""
    names = column_list(names)
    missing = [name for name in names if name not in df.columns]
    if missing or not names:
        raise MissingColumn(f"{role} not found: {', '.join(missing) or '(none given)'}")
    return names


def col(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def checked(ok: Column, value: Column, message: str | Column) -> Column:
    """The value where `ok` is true; the query fails with the message elsewhere."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, value).otherwise(F.raise_error(text))


def literal(value: Any, dtype: T.DataType) -> Column:
    """A collected or parsed value as a literal of a column's type.

    A datetime of a zone-less column goes by its text: as such it would count as an instant, and shift
    with the session time zone.
    """
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    if isinstance(value, Decimal) and isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = float(value)  # the nearest double, as it was written
    if isinstance(value, Decimal):
        return F.lit(format(value, "f")).cast(dtype)  # as text, so that no digit is lost
    return F.lit(value).cast(dtype)
