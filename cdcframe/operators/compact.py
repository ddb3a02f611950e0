"""The latest record of each key of a batch."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdcframe.functions.columns import col, column_list
from cdcframe.functions.ranges import range_of_number
from cdcframe.operators.shape import CREATE, CREATED_AT, OPERATION, READ_AT, SEQ, SNAPSHOT, UPDATE, checked_batch

_ROWS_PER_STRETCH = 1_000_000


def compact(batch: DataFrame, keys: str | Iterable[str], carry_created: bool = False) -> DataFrame:
    """One winning record per key.

    In order of sequence, a create, snapshot or delete always takes over from what came before; an
    update only if its read time is later than that of every earlier update of the key. Sequences are
    distinct within a key.

    The update that takes over last is the first one to reach the greatest read time, so the winner is
    the later, by sequence, of two extremes: the last record that is not an update, and the update with
    the greatest read time (of equals, the first). Both are partial aggregates. A key is folded wherever
    its rows are read and one row per key and task is shuffled, however many records a key has.

    By itself the winner forgets what came before it in the batch. With `carry_created` it has a column `_created_at`: the
    read time of the last create or snapshot up to it, which `render` makes its created time. That is a third extreme of
    the same aggregate: no such record comes after the winner.
    """
    keys = column_list(keys)
    batch = checked_batch(batch, keys)
    rest = [name for name in batch.columns if name not in keys]
    record = F.struct(*[col(name) for name in rest])
    is_update = col(OPERATION) == UPDATE
    latest = F.struct(col(READ_AT), (-col(SEQ)).alias("_first"))
    created = F.when(col(OPERATION).isin(CREATE, SNAPSHOT), col(SEQ))
    carried = [CREATED_AT] if carry_created else []
    sides = batch.groupBy(*[col(name) for name in keys]).agg(
        F.max_by(record, F.when(~is_update, col(SEQ))).alias("_taken"),
        F.max_by(record, F.when(is_update, latest)).alias("_updated"),
        *[F.max_by(col(READ_AT), created).alias(name) for name in carried],
    )
    by_update = col("_taken").isNull() | (col("_updated")[SEQ] > col("_taken")[SEQ])
    winner = F.when(by_update, col("_updated")).otherwise(col("_taken"))
    return sides.select(*[col(name) for name in keys], *carried, winner.alias("_winner")).select(
        *[col(name) for name in keys], *[col("_winner")[name].alias(name) for name in rest], *carried
    )


def late_updates(
    batch: DataFrame, keys: str | Iterable[str], rows_per_stretch: int = _ROWS_PER_STRETCH
) -> DataFrame:
    """The updates `compact` passes over: not read later than every earlier update of their key.

    Needs the running maximum of the read time per key. The sequence is cut at its quantiles into stretches of
    about `rows_per_stretch` records, the maximum runs within (key, stretch), and the maxima of the earlier
    stretches of a key are carried in, so that no key is sorted by one task.
    """
    keys = column_list(keys)
    updates = checked_batch(batch, keys).filter(col(OPERATION) == UPDATE)
    # Cut by counts, not by width: the edges are quantiles of the sequence, a few numbers for each stretch.
    count = updates.count()
    shares = [n * rows_per_stretch / count for n in range(1, math.ceil(count / rows_per_stretch))]
    edges = updates.approxQuantile(SEQ, shares, min(0.01, rows_per_stretch / (8 * max(count, 1)))) if shares else []
    edges = sorted({int(edge) for edge in edges})
    updates = updates.withColumn("_stretch", range_of_number(col(SEQ), edges))

    by = [*keys, "_stretch"]
    peaks = updates.groupBy(*by).agg(F.max(READ_AT).alias("_peak"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = peaks.withColumn("_carried", F.max("_peak").over(earlier)).drop("_peak")
    running = Window.partitionBy(*by).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)
    seen = updates.withColumn("_running", F.max(READ_AT).over(running)).join(carried, by)
    late = seen.filter(col(READ_AT) <= F.greatest("_running", "_carried"))
    return late.select(*[col(name) for name in batch.columns])
