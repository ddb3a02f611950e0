"""Logical column types found in a batch: in its JSON payloads, or in Avro schemas it carries."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import checked, col
from cdcframe.functions.types import spark_type
from cdcframe.operators.shape import payload_side

# Logical types by Avro logical type, and by Avro type where there is none.
AVRO_LOGICAL_TYPES = {
    "decimal": "float",
    "uuid": "varchar",
    "date": "date",
    "time-millis": "timestamp_tz",
    "time-micros": "timestamp_tz",
    "timestamp-millis": "timestamp_tz",
    "timestamp-micros": "timestamp_tz",
}
AVRO_TYPES = {
    "boolean": "boolean",
    "int": "integer",
    "long": "integer",
    "float": "float",
    "double": "float",
    "bytes": "varchar",
    "string": "varchar",
    "enum": "varchar",
    "record": "object",
    "array": "array",
    "map": "object",
}


def first_record(batch: DataFrame, payload: str = "after", seq: str = "seq") -> DataFrame:
    """The payload of the record with the smallest sequence, as one row."""
    return batch.agg(F.min_by(col(payload), col(seq)).alias(payload))


def field_types(batch: DataFrame, payload: str = "after") -> DataFrame:
    """The fields of JSON payloads and the logical type of each over the whole batch.

    Whole numbers are `integer`, other numbers `float`, and a field with both is `float`. A field that
    is NULL throughout is `variant`; NULLs beside values do not count. Text, nested values and fields
    whose values disagree are `varchar`.
    """
    parsed = batch.select(F.parse_json(col(payload)).alias("_json"))
    fields = parsed.lateralJoin(batch.sparkSession.tvf.variant_explode(col("_json").outer()))
    found = F.schema_of_variant(col("value"))
    kind = (
        F.when(found == "VOID", F.lit(None).cast("string"))
        .when(found == "BIGINT", "integer")
        .when(found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT"), "float")
        .when(found == "BOOLEAN", "boolean")
        .otherwise("varchar")
    )
    # One row per field and kind first: the rest works on as many rows as there are columns.
    kinds = fields.select(col("key").alias("field"), kind.alias("_kind")).groupBy("field", "_kind").count()
    low, high = F.min("_kind"), F.max("_kind")
    merged = (
        F.when(low.isNull(), "variant")
        .when(low == high, low)
        .when((low == "float") & (high == "integer"), "float")
        .otherwise("varchar")
    )
    return kinds.groupBy("field").agg(merged.alias("logical_type"))


def _settled(kind: T.DataType) -> T.DataType:
    """The type to decode as: whole numbers are bigint, others double; values that disagree, and objects without any field,
    are text; what is NULL throughout is variant."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind]) if kind.fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.LongType()
    if isinstance(kind, T.FractionalType):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return T.VariantType()
    return T.StringType() if isinstance(kind, T.VariantType) else kind


def nested_schema(batch: DataFrame, payload: str = "after") -> T.StructType:
    """The schema of JSON payloads over the whole batch, with objects as structs and arrays as arrays at any depth.

    One aggregate merges the types of all payloads, combined where they are read; what comes to the driver is the schema
    itself. Fields that are missing or NULL in some payloads do not count there.
    """
    found = batch.agg(F.schema_of_variant_agg(F.parse_json(col(payload)))).first()[0]
    # An object is a struct to Spark. Names that are quoted may hold anything.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    ddl = "".join(part if n % 2 else part.replace("OBJECT<", "STRUCT<") for n, part in enumerate(parts))
    kind = _settled(T.DataType.fromDDL(ddl))
    if not isinstance(kind, T.StructType):
        raise ValueError(f"the payloads are not objects with fields but {found}")
    return T.StructType(sorted(kind.fields, key=lambda f: f.name))


def avro_type(schema: object, named: dict[str, object] | None = None, inside: tuple[str, ...] = ()) -> T.DataType:
    """The Spark type of an Avro schema (parsed from its JSON), at any depth.

    Records are structs, arrays and maps what they are called, and a union of null and one other branch is that one; any
    other union is refused, and so is a record within itself. Simple types are those of the logical types.
    """
    named = {} if named is None else named
    if isinstance(schema, list):
        branches = [branch for branch in schema if branch != "null"]
        if len(branches) != 1:
            raise ValueError(f"no type for the Avro union {json.dumps(schema)}")
        return avro_type(branches[0], named, inside)
    if isinstance(schema, str):
        if schema in inside:
            raise ValueError(f"the Avro record {schema} holds itself")
        if schema in named:
            return avro_type(named[schema], named, inside)
        if schema not in AVRO_TYPES or schema in ("record", "enum", "array", "map"):
            raise ValueError(f"no type for Avro {schema!r}")
        return spark_type(AVRO_TYPES[schema])
    kind, name = schema["type"], schema.get("name")
    if isinstance(kind, (dict, list)):
        return avro_type(kind, named, inside)
    if name is not None and kind in ("record", "enum", "fixed"):
        named[name] = schema
    if kind == "record":
        inside = (*inside, name)
        return T.StructType([T.StructField(f["name"], avro_type(f["type"], named, inside)) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(avro_type(schema["items"], named, inside))
    if kind == "map":
        return T.MapType(T.StringType(), avro_type(schema["values"], named, inside))
    if schema.get("logicalType") in AVRO_LOGICAL_TYPES:
        return spark_type(AVRO_LOGICAL_TYPES[schema["logicalType"]])
    if kind in ("enum", "fixed"):
        return T.StringType()
    return avro_type(kind, named, inside)


def avro_schema(batch: DataFrame, metadata_key: str = "avro.schema") -> T.StructType:
    """The schema that the Avro schemas in the metadata of a batch give its payloads, nested types and all.

    A batch has few distinct schemas; they come to the driver. Fields of all of them are taken, and a field of two types is
    refused.
    """
    texts = batch.select(col("metadata")[metadata_key].alias("text")).filter(col("text").isNotNull()).distinct()
    fields: dict[str, T.DataType] = {}
    for row in sorted(texts.collect()):
        for field in avro_type(json.loads(row["text"])):
            if fields.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"field {field.name} is both {fields[field.name].simpleString()} and {field.dataType.simpleString()}")
    return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])


def _lookup(table: dict[str, str], name: Column) -> Column:
    return F.create_map(*[F.lit(item) for pair in table.items() for item in pair])[name]


def _avro_logical_type(field: Column) -> Column:
    """The logical type of one field of an Avro record schema."""
    declared = F.variant_get(field, "$.type", "variant")
    branches = F.try_variant_get(declared, "$", "array<variant>")
    concrete = F.filter(branches, lambda b: ~F.coalesce(F.try_variant_get(b, "$", "string") == "null", F.lit(False)))
    # A union stands for its one branch beside "null"; any other union has no logical type.
    declared = F.when(branches.isNull(), declared).when(F.size(concrete) == 1, concrete[0])
    named = F.schema_of_variant(declared) == "STRING"
    base = F.when(named, F.try_variant_get(declared, "$", "string")).otherwise(
        F.try_variant_get(declared, "$.type", "string")
    )
    logical = F.when(~named, F.try_variant_get(declared, "$.logicalType", "string"))
    fixed = F.when((base == "fixed") & (logical == "decimal"), "float")
    nested = base.isin("record", "array", "map", "enum", "fixed")
    by_logical = F.when(~nested, _lookup(AVRO_LOGICAL_TYPES, logical))
    return F.coalesce(by_logical, fixed, _lookup(AVRO_TYPES, base))


def avro_fields(batch: DataFrame, metadata_key: str = "avro.schema") -> DataFrame:
    """The fields of every Avro record schema in the metadata of a batch.

    One row per distinct schema and field, with the schema's digest and the number of records that
    carry it, so that a batch whose schema changes midway shows it. A field without a logical type
    fails the query.
    """
    texts = batch.select(col("metadata")[metadata_key].alias("_schema")).filter(col("_schema").isNotNull())
    schemas = texts.groupBy("_schema").agg(F.count(F.lit(1)).alias("records"))
    parsed = F.variant_get(F.parse_json(col("_schema")), "$.fields", "array<variant>")
    fields = schemas.select(F.sha2(col("_schema"), 256).alias("schema_id"), "records", F.explode(parsed).alias("_field"))
    name = F.variant_get(col("_field"), "$.name", "string")
    logical = _avro_logical_type(col("_field"))
    unmapped = F.concat(F.lit("no logical type for Avro field "), name)
    return fields.select(
        "schema_id", "records", name.alias("field"), checked(logical.isNotNull(), logical, unmapped).alias("logical_type")
    )


def collect_types(types: DataFrame) -> dict[str, str]:
    """The logical type of each field, on the driver: it is to become a schema, which is there anyway."""
    rows = types.select("field", "logical_type").distinct().collect()
    found: dict[str, str] = {}
    for field, logical in sorted(rows):
        if found.setdefault(field, logical) != logical:
            raise ValueError(f"field {field} is both {found[field]} and {logical}")
    return found


def infer_schema(
    batch: DataFrame,
    mode: str = "batch",
    payload: str | None = None,
    seq: str = "seq",
    avro_key: str | None = None,
    nested: bool = False,
) -> T.StructType:
    """The payload schema of a batch of JSON records, with its fields in order of name.

    A record's payload is the side that goes by its operation (`before` for a delete), unless a column is
    named. `first` looks at the first record only, `batch` at all of them. With `avro_key`, the types come from
    the Avro schemas under that key of the metadata instead of from the payloads. Objects and arrays are text, or by
    their name in an Avro schema; with `nested` they are structs and arrays with types of their own.
    """
    if mode not in ("first", "batch"):
        raise ValueError(f"mode must be 'first' or 'batch', not {mode!r}")
    if payload is None and not avro_key:
        payload = "_payload"
        side = payload_side(batch) if {"operation", "before"} <= set(batch.columns) else col("after")
        batch = batch.withColumn(payload, side)
    source = "metadata" if avro_key else payload
    if mode == "first":
        batch = first_record(batch, source, seq)
    if nested:
        return avro_schema(batch, avro_key) if avro_key else nested_schema(batch, payload)
    types = collect_types(avro_fields(batch, avro_key) if avro_key else field_types(batch, payload))
    return T.StructType([T.StructField(name, spark_type(logical)) for name, logical in types.items()])
