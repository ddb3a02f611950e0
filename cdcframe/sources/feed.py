"""The net changes between two versions of a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcframe.functions.columns import col, require
from cdcframe.functions.payload import canonical, json_object

# The change columns and the two actions.
ACTION = "METADATA$ACTION"
IS_UPDATE = "METADATA$ISUPDATE"
ROW_ID = "METADATA$ROW_ID"
CONSUMED_AT = "METADATA$TS"
METADATA = [ACTION, IS_UPDATE, ROW_ID, CONSUMED_AT]
INSERT = "INSERT"
DELETE = "DELETE"
#: Rows of the two versions for each task, at most about.
ROWS_PER_TASK = 250_000


def net_changes(
    old: DataFrame, new: DataFrame, keys: str | Iterable[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """What has to happen to `old` to get `new`.

    A new row is an INSERT and a row that is gone is a DELETE. Where a key has both, the row was changed:
    `METADATA$ISUPDATE` is true for the DELETE with the old image and for the INSERT with the new one.
    What came and went in between does not show.

    The row id is a digest of the key. Where a key has several rows on one side, so that it does not
    identify them, it is a digest of the row and the number of the copy.

    The versions are taken as bags of rows, shuffled once, by key, and cancelled against each other by a
    grouped sum over whole rows; copies of a row, and keys with many rows, are therefore never paired with
    one another. A window over the rows left over of each key tells which of them were changed. The versions are
    counted at the call, for the number of tasks to follow from their rows.
    """
    keys = require(old, keys, "key column")
    names = list(old.columns) if columns is None else require(old, columns)
    names = keys + [name for name in names if name not in keys]
    require(new, names)

    def version(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[col(name) for name in names], F.lit(sign).cast("bigint").alias("_net"))

    both = version(old, -1).unionByName(version(new, 1))
    # What holds a variant or a map goes by its JSON text, with keys in order; one of the equal values is carried.
    texts = {name: canonical(col(name), old.schema[name].dataType) for name in names}
    texts = {name: text for name, text in texts.items() if text is not None}
    whole = [texts[name].alias(f"_json {name}") if name in texts else col(name) for name in names]
    sums = [F.sum("_net").alias("_net"), *[F.first(col(name)).alias(name) for name in texts]]
    # All rows of a key go to one task: the sum over whole rows and the look at the rows left over of each key then need no
    # shuffle of their own. A task holds its rows in memory, so there are more tasks than the session's where it has few.
    parts = int(old.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-(old.count() + new.count()) // ROWS_PER_TASK))
    both = both.repartition(parts, *[col(key) for key in keys])
    left = both.groupBy(*whole).agg(*sums).filter(col("_net") != 0).select(*[col(name) for name in names], "_net")

    of_one = Window.partitionBy(*[col(key) for key in keys])
    gone = F.sum(F.greatest(-col("_net"), F.lit(0))).over(of_one)
    come = F.sum(F.greatest(col("_net"), F.lit(0))).over(of_one)
    sides = left.select(*left.columns, gone.alias("_gone"), come.alias("_come"))
    pair, many = (col("_gone") > 0) & (col("_come") > 0), (col("_gone") > 1) | (col("_come") > 1)
    marked = sides.select(*left.columns, pair.alias("_pair"), many.alias("_many"))
    rows = _repeat(marked, F.abs(col("_net")))
    of_key, of_row = json_object(rows, keys), json_object(rows, [*names, "_step", "_copy"])
    return rows.select(
        *[col(name) for name in names],
        F.when(col("_net") > 0, INSERT).otherwise(DELETE).alias(ACTION),
        col("_pair").alias(IS_UPDATE),
        F.sha2(F.when(col("_many"), of_row).otherwise(of_key), 256).alias(ROW_ID),
    )


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row so many times over. Copies are put out in steps, so none needs an array of them all."""
    step = 65_536
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / F.lit(step)).cast("bigint"))
    df = df.withColumn("_copies", times).withColumn("_step", F.explode(steps))
    rest = F.least(F.lit(step).cast("bigint"), col("_copies") - col("_step") * F.lit(step))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), rest)))
