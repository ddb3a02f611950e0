"""Change-log rows as change records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import col, checked, require
from cdcframe.functions.payload import payload_json, record_key
from cdcframe.sources.feed import ACTION, DELETE, INSERT, IS_UPDATE

# The four operations of a record.
CREATE = "create"
UPDATE = "update"
REMOVE = "delete"
SNAPSHOT = "snapshot"
OPERATIONS = [CREATE, UPDATE, REMOVE, SNAPSHOT]

# The columns of a flat batch, beside its key and payload columns.
SEQ = "_seq"
OPERATION = "_operation"
READ_AT = "_read_at"
ENVELOPE = [SEQ, OPERATION, READ_AT]
#: What `compact` can add: the created time that the winner's batch has seen.
CREATED_AT = "_created_at"


def collapse_pairs(log: DataFrame) -> DataFrame:
    """The log without the old-image half of update pairs."""
    return log.filter(~F.coalesce((col(ACTION) == DELETE) & col(IS_UPDATE), F.lit(False)))


def classify(log: DataFrame, name: str = "operation") -> DataFrame:
    """The log with the operation of each row; a row that is none of the three fails the query."""
    action, is_update = col(ACTION), col(IS_UPDATE)
    operation = (
        F.when((action == INSERT) & ~is_update, CREATE)
        .when((action == INSERT) & is_update, UPDATE)
        .when((action == DELETE) & ~is_update, REMOVE)
        .otherwise(F.raise_error(F.concat(F.lit("no operation for change action "), F.coalesce(action, F.lit("NULL")))))
    )
    return log.withColumn(name, operation)


def to_records(
    df: DataFrame,
    operation: Column | str,
    keys: str | Iterable[str],
    table: str,
    read_at: Column,
    position: Column,
    seq: Column,
    columns: Iterable[str] | None = None,
    as_json: bool = True,
) -> DataFrame:
    """Rows as change records.

    A record has a `seq`, `position`, `operation`, `metadata` (the table name and the read time in
    microseconds), a `key` struct, and its row in `after`: as JSON text for consumers elsewhere, or as a
    struct for those in the same job. `before` is always NULL, and a delete has no `after` either: its
    key says it all.
    """
    operation = F.lit(operation) if isinstance(operation, str) else operation
    metadata = F.create_map(F.lit("table"), F.lit(table), F.lit("readAt"), read_at.cast("string"))
    row = payload_json(df, columns) if as_json else record_key(df, df.columns if columns is None else columns)
    after = F.when(operation != REMOVE, row)
    return df.select(
        seq.alias("seq"),
        position.alias("position"),
        operation.alias("operation"),
        metadata.alias("metadata"),
        record_key(df, keys).alias("key"),
        F.when(F.lit(False), row).alias("before"),
        after.alias("after"),
    )


def payload_side(records: DataFrame) -> Column:
    """The side of the payload an operation goes by: `before` for a delete, else `after`."""
    return F.when(col("operation") == REMOVE, col("before")).otherwise(col("after"))


def decode_payload(payload: Column, schema: T.StructType) -> Column:
    """JSON text as a struct. Text that is not JSON, or a value of another type, fails the query.

    Times are read in any of the forms that a cast takes, RFC 3339 among them.
    """
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    stored = T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, times) else f.dataType) for f in schema]
    )
    row = F.from_json(payload, stored, {"mode": "FAILFAST"})

    def value(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.VariantType):
            return F.when(~F.is_variant_null(row[field.name]), row[field.name])
        return row[field.name].cast(field.dataType)

    return F.struct(*[value(field).alias(field.name) for field in schema])


def flatten_records(records: DataFrame, keys: str | Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    """Change records as a flat batch: sequence, operation, read time, keys, payload columns.

    Key and payload may be structs or JSON text; text needs `schema`. The key columns come from the
    record key, so that a delete needs no payload. The read time is the metadata entry `readAt`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = payload_side(records)
    after_type = records.schema["after"].dataType
    if isinstance(after_type, T.StringType):
        if schema is None:
            raise ValueError("JSON payloads need a schema")
        payload = decode_payload(payload, schema)
    else:
        schema = after_type
    key = col("key")
    if isinstance(records.schema["key"].dataType, T.StringType):
        key = decode_payload(key, T.StructType([schema[name] for name in keys]))
    rows = records.select(
        col("seq").alias(SEQ),
        col("operation").alias(OPERATION),
        col("metadata")["readAt"].cast("bigint").alias(READ_AT),
        key.alias("_key"),
        payload.alias("_payload"),
    )
    return rows.select(
        *ENVELOPE,
        *[col("_key")[name].alias(name) for name in keys],
        *[col("_payload")[field.name].alias(field.name) for field in schema if field.name not in keys],
    )


def checked_batch(batch: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """A flat batch in which each row has a known operation, a read time, a sequence and a key."""
    keys = require(batch, keys, "key column")
    require(batch, ENVELOPE)
    must = {
        OPERATION: col(OPERATION).isin(OPERATIONS),
        READ_AT: col(READ_AT).isNotNull(),
        SEQ: col(SEQ).isNotNull(),
        **{name: col(name).isNotNull() for name in keys},
    }
    checks = {name: checked(ok, col(name), f"a record has no valid {name}").alias(name) for name, ok in must.items()}
    return batch.select(*[checks.get(name, col(name)) for name in batch.columns])
