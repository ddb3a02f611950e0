"""Cutting rows into ranges of an order, and numbering them along it."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcframe.functions.columns import col, literal, require

#: Rows of a range, about, and ranges at most: what is known of a range is held by the driver.
ROWS_PER_RANGE, RANGES = 1_000_000, 2_000
#: Rows looked at for each range, to find where to cut.
_SAMPLE = 20
#: Slots of the table that numbers are looked up in.
_SLOTS_PER_EDGE, _SLOTS = 32, 1 << 20


def whole_numbers(numbers: Iterable[int]) -> Column:
    """An array of bigints as one literal, however many there are."""
    text = ",".join(str(int(n)) for n in numbers)
    return F.split(F.lit(text), ",").cast("array<bigint>") if text else F.array().cast("array<bigint>")


def range_of(value: Column, edges: Column, count: int) -> Column:
    """How many of the `count` sorted edges lie below the value, by bisection."""
    if not count:
        return F.lit(0)

    def halve(bounds: Column, _: Column) -> Column:
        middle = F.floor((bounds["low"] + bounds["high"]) / 2).cast("int")
        below = F.get(edges, middle) < value
        low = F.when(below, middle + 1).otherwise(bounds["low"])
        high = F.when(below, bounds["high"]).otherwise(middle)
        still = bounds["low"] < bounds["high"]
        return F.struct(F.when(still, low).otherwise(bounds["low"]).alias("low"), F.when(still, high).otherwise(bounds["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(count).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(count.bit_length())), start, halve)["low"]


def range_of_number(value: Column, edges: list[int]) -> Column:
    """`range_of` for whole numbers: looked up in a table of even slots, and by bisection only where an edge cuts a slot."""
    if not edges:
        return F.lit(0)
    slots = min(_SLOTS_PER_EDGE * len(edges), _SLOTS)
    width = (edges[-1] - edges[0]) // slots + 1
    starts = [edges[0] + n * width for n in range(slots + 1)]
    below = [bisect_left(edges, start) for start in starts]  # edges below the first value of each slot
    last = [bisect_left(edges, start - 1) for start in starts[1:]]  # and below its last value
    sure = whole_numbers(low if low == high else -1 for low, high in zip(below, last))
    # A difference that does not fit the bigint is NULL, and the value is searched for.
    at = F.try_subtract(value.cast("bigint"), F.lit(edges[0]).cast("bigint"))
    found = F.get(sure, F.call_function("div", at, F.lit(width)).cast("int"))
    searched = range_of(value, whole_numbers(edges), len(edges))
    return (
        F.when(value <= edges[0], 0)
        .when(value > edges[-1], len(edges))
        .when(found >= 0, found.cast("int"))
        .otherwise(searched)
    )


def number_rows(
    df: DataFrame, order: str | Iterable[str], name: str, first: int = 0, rows_per_range: int = ROWS_PER_RANGE
) -> tuple[DataFrame, int]:
    """The rows with their number, from `first`, in order of some columns, and how many there are.

    The rows are cut into ranges at values of a small sample, which a hash draws, so that any range is about as large; the
    counts of the ranges add up to the number each one starts at, and a window numbers the rows within it. NULL comes
    first. Which of several rows that are equal in all columns comes first is left open. The frame is read three times.
    """
    order = require(df, order)
    place = F.struct(*[col(n) for n in order])
    total = df.count()
    ranges = max(1, min(RANGES, -(-total // rows_per_range)))
    edges: list = []
    if ranges > 1:
        drawn = df.select(place.alias("_place")).filter(F.pmod(F.xxhash64("_place"), F.lit(max(1, total // (ranges * _SAMPLE)))) == 0)
        sample = [r["_place"] for r in drawn.distinct().orderBy("_place").limit(2 * ranges * _SAMPLE).collect()]
        edges = [sample[n * len(sample) // ranges] for n in range(1, ranges)] if sample else []
        edges = [edge for n, edge in enumerate(edges) if n == 0 or edge != edges[n - 1]]
    kinds = [df.schema[n].dataType for n in order]
    cuts = F.array(*[F.struct(*[literal(v, t).alias(n) for v, t, n in zip(edge, kinds, order)]) for edge in edges])
    cut = df.withColumn("_range", range_of(place, cuts, len(edges)).cast("int"))
    sizes = dict.fromkeys(range(len(edges) + 1), 0) | {r["_range"]: r["count"] for r in cut.groupBy("_range").count().collect()}
    starts = [first]
    for n in range(len(edges)):
        starts.append(starts[-1] + sizes[n])
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*[col(n) for n in order]))
    number = F.get(whole_numbers(starts), col("_range")) + within - 1
    return cut.withColumn(name, number.cast("bigint")).drop("_range"), total
