"""Logical column types: the vocabulary in which batches and tables are compared."""

from __future__ import annotations

from pyspark.sql import types as T

# The logical type names and the Spark type each one is stored as.
SPARK_TYPE = {
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "varchar": T.StringType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp_tz": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
    "object": T.MapType(T.StringType(), T.StringType()),
    "array": T.ArrayType(T.StringType()),
    "vector": T.ArrayType(T.FloatType()),
}


class UnsupportedType(ValueError):
    """A column type that has no logical counterpart."""


def logical_type(dtype: T.DataType) -> str:
    """The logical name of a Spark type; a type without one is refused."""
    if isinstance(dtype, T.DecimalType):
        return "float" if dtype.scale > 0 else "integer"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.FractionalType):
        return "float"
    if isinstance(dtype, T.ArrayType):
        return "vector" if isinstance(dtype.elementType, T.FloatType) else "array"
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "object"
    for name, spark_type in SPARK_TYPE.items():
        if type(dtype) is type(spark_type):
            return name
    raise UnsupportedType(f"no logical type for {dtype.simpleString()}")


def spark_type(name: str) -> T.DataType:
    """The Spark type a logical type is stored as."""
    try:
        return SPARK_TYPE[name]
    except KeyError:
        raise UnsupportedType(f"unknown logical type {name!r}") from None
