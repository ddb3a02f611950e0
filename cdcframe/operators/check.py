"""Whether the columns of a batch fit an existing target table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import col, column_list
from cdcframe.functions.types import logical_type
from cdcframe.operators.shape import REMOVE

OK = "ok"


class SchemaMismatch(ValueError):
    """The batch does not fit the target table."""


def _verdicts(
    batch: dict[str, str], target: T.StructType, keys: Iterable[str], first_operation: str | None
) -> list[tuple[str, str | None, str | None, str]]:
    """One row per column: name, type in the batch, type in the target, verdict."""
    ours = {name.lower(): logical for name, logical in batch.items()}
    theirs = {field.name.lower(): logical_type(field.dataType) for field in target}
    starts_with_delete = first_operation == REMOVE
    waived = not theirs or (starts_with_delete and {key.lower() for key in keys} <= theirs.keys())

    def verdict(name: str) -> str:
        if waived:
            return OK
        if name not in theirs:
            return "missing in target"
        if name not in ours:
            return OK if starts_with_delete else "missing in batch"
        return OK if ours[name] == theirs[name] else "type differs"

    return [(name, ours.get(name), theirs.get(name), verdict(name)) for name in sorted(ours.keys() | theirs.keys())]


def schema_report(
    batch_types: DataFrame, target: T.StructType, keys: str | Iterable[str], first_operation: str | None = None
) -> DataFrame:
    """One row per column: its type in the batch, in the target, and the verdict.

    `batch_types` is what `field_types` or `avro_fields` found. Verdicts are `ok`, `missing in target`,
    `missing in batch` and `type differs`. Names are compared without regard to case. A target without
    columns accepts anything. A batch that starts with a delete needs only its keys in the target; if
    they are not there, its columns must be, but the target may have more.
    """
    spark, keys = batch_types.sparkSession, column_list(keys)
    fields = [(field.name.lower(), logical_type(field.dataType)) for field in target]
    theirs = spark.createDataFrame(fields, "column string, target_type string")
    ours = batch_types.select(F.lower("field").alias("column"), col("logical_type").alias("batch_type"))
    starts_with_delete = first_operation == REMOVE
    waived = not fields or (starts_with_delete and {key.lower() for key in keys} <= {name for name, _ in fields})
    verdict = (
        F.when(F.lit(waived), OK)
        .when(col("target_type").isNull(), "missing in target")
        .when(col("batch_type").isNull(), OK if starts_with_delete else "missing in batch")
        .when(col("batch_type") == col("target_type"), OK)
        .otherwise("type differs")
    )
    return ours.join(theirs, "column", "full").select("column", "batch_type", "target_type", verdict.alias("verdict"))


def check_schema(
    batch: T.StructType, target: T.StructType, keys: str | Iterable[str], first_operation: str | None = None
) -> None:
    """Raise, naming each column that is wrong, if a batch of the given schema does not fit the target."""
    types = {field.name: logical_type(field.dataType) for field in batch}
    rows = _verdicts(types, target, column_list(keys), first_operation)
    bad = [f"{name}: {verdict} ({ours}, {theirs})" for name, ours, theirs, verdict in rows if verdict != OK]
    if bad:
        raise SchemaMismatch("the batch does not fit the target table: " + "; ".join(bad))
