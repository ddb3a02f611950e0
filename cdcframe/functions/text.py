"""Values as the text fields of a staged row, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import col
from cdcframe.functions.times import micros_ntz, micros_of

_NESTED = (T.StructType, T.MapType, T.ArrayType, T.VariantType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def field_text(column: Column, dtype: T.DataType) -> Column:
    """One value as text: times as UTC microseconds, nested values as JSON, NULL as nothing."""
    if isinstance(dtype, _TIMES):
        column = micros_of(column, dtype)
    elif isinstance(dtype, T.BinaryType):
        column = F.base64(column)
    elif isinstance(dtype, _NESTED):
        column = F.to_json(column)
    return F.coalesce(column.cast("string"), F.lit(""))


def text_field(text: Column, dtype: T.DataType) -> Column:
    """The value of a text field in the given type. An empty field is NULL."""
    text = F.nullif(text, F.lit(""))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if isinstance(dtype, T.TimestampNTZType):
        return micros_ntz(text.cast("bigint"))
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(text)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(text)
    if isinstance(dtype, _NESTED):
        return F.from_json(text, dtype, {"mode": "FAILFAST"})
    return text.cast(dtype)


def encode_text(df: DataFrame) -> DataFrame:
    """Every column as its text field."""
    return df.select(*[field_text(col(f.name), f.dataType).alias(f.name) for f in df.schema])


def decode_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text fields in the order of `schema`, as typed columns."""
    return df.select(
        *[
            text_field(col(name), field.dataType).alias(field.name)
            for name, field in zip(df.columns, schema, strict=True)
        ]
    )
