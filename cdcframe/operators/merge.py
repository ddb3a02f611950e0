"""Merging compacted rows into a target table, with soft deletes."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.functions.columns import col, column_list, require
from cdcframe.operators.render import Bookkeeping
from cdcframe.operators.shape import CREATE, OPERATIONS, REMOVE, SNAPSHOT, UPDATE

_OLD = "_old"
_NEW = "_new"

#: What becomes of an update of a stored row that was updated at the same time or later: it is taken all the same, since
#: the later batch wins, or ignored.
LATE = ("take", "ignore")


def _new(name: str) -> Column:
    return col(_NEW + name)


def _rules(
    old: Callable[[str], Column],
    new: Callable[[str], Column],
    matched: Column,
    untouched: Column,
    keys: list[str],
    names: Iterable[str],
    book: Bookkeeping,
    late: str,
) -> list[Column]:
    """The merged value of each column, from the stored row (`matched`: there is one) and the change (`untouched`: none)."""
    if late not in LATE:
        raise ValueError(f"late must be one of {', '.join(LATE)}")
    operation = new(book.operation)
    if late == "ignore":
        is_late = matched & (operation == UPDATE) & (new(book.updated_at) <= old(book.updated_at))
        untouched = untouched | F.coalesce(is_late, F.lit(False))
    keeps_created = untouched | (matched & operation.isin(UPDATE, REMOVE) & new(book.created_at).isNull())
    keeps_payload = untouched | (matched & (operation == REMOVE))

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(old(name), new(name))
        if name in (book.operation, book.deleted_at):
            keep = untouched
        elif name == book.created_at:
            keep = keeps_created
        else:
            keep = keeps_payload
        return F.when(keep, old(name)).otherwise(new(name))

    return [value(name).alias(name) for name in names]


def merge(
    target: DataFrame,
    changes: DataFrame,
    keys: str | Iterable[str],
    prefix: str = "cdc",
    affected: Observation | None = None,
    late: str = "take",
) -> DataFrame:
    """The target after the changes, which hold at most one row per key.

    create, snapshot  overwrite the whole row, or insert it
    update            overwrites all but the created time, or inserts the row; a deleted row comes back. One with a created
                      time of its own (see `compact`) overwrites that too. With late="ignore", an update that is not later
                      than the stored updated time, be it that of a deleted row, changes nothing
    delete            sets only the operation and the deleted time; an unknown key gets a tombstone

    A NULL key matches nothing. `affected` takes the counts of `affected_counts` when the result is computed. Both sides
    are shuffled by key, unless they lie that way already, as the rows of a `TargetTable` do.
    """
    keys, book = require(target, keys, "key column"), Bookkeeping(prefix)
    names = target.columns
    require(changes, names)
    rest = [name for name in names if name not in keys]
    matched, untouched = col(_OLD), col(_NEW).isNull()
    new = lambda name: col(name) if name in keys else _new(name)
    rules = _rules(col, new, matched, untouched, keys, names, book, late)
    old = target.withColumn(_OLD, F.lit(True))
    fresh = changes.select(
        *[col(key) for key in keys], *[col(name).alias(_NEW + name) for name in rest], F.lit(True).alias(_NEW)
    )
    joined = old.join(fresh, keys, "full")
    if affected is not None:
        joined = joined.observe(affected, *affected_counts(_new(book.operation), col(_OLD).isNotNull()))
    return joined.select(*rules)


def fold(
    target: DataFrame | None,
    changes: DataFrame,
    keys: str | Iterable[str],
    order: Iterable[str],
    schema: T.StructType,
    prefix: str = "cdc",
    late: str = "take",
) -> DataFrame:
    """The target after changes of several batches, merged one after the other as `merge` does, in one plan.

    A key has at most one change for each value of the `order` columns; all changes of a key are brought together in one
    row, so there should be few (see `condense`). A target that lies by key already is neither shuffled nor sorted. No
    target means an empty one.
    """
    keys, order, book = column_list(keys), list(order), Bookkeeping(prefix)
    names = schema.names
    place = F.struct(*[col(name) for name in order]).alias("place")
    entry = F.struct(place, F.struct(*[col(name) for name in names]).alias("row"))
    in_order = lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)
    grouped = changes.groupBy(*[col(key) for key in keys]).agg(F.array_sort(F.collect_list(entry), in_order).alias(_NEW))

    def step(row: Column, change: Column) -> Column:
        old, new = (lambda name: row[name]), (lambda name: change["row"][name])
        merged = F.struct(*_rules(old, new, F.lit(True), F.lit(False), keys, names, book, late))
        return F.when(row.isNull(), change["row"]).otherwise(merged).cast(schema)

    start = F.lit(None).cast(schema)
    if target is None:
        folded = grouped.select(F.aggregate(col(_NEW), start, step).alias("row"))
        return folded.select(*[col("row")[name].alias(name) for name in names])
    old = target.withColumn(_OLD, F.lit(True))
    joined = old.join(grouped.hint("shuffle_hash"), keys, "full")
    stored = F.when(col(_OLD), F.struct(*[col(name) for name in names])).otherwise(start).cast(schema)
    folded = F.when(col(_NEW).isNotNull(), F.aggregate(col(_NEW), stored, step)).alias("_row")
    rows = joined.select(*[col(name) for name in names], folded)
    changed = col("_row").isNotNull()
    return rows.select(*[F.when(changed, col("_row")[name]).otherwise(col(name)).alias(name) for name in names])


def condense(changes: DataFrame, keys: str | Iterable[str], order: str, prefix: str = "cdc") -> DataFrame:
    """The rendered changes of several batches, less those that later ones make good: at most three are left of a key.

    These are the last create or snapshot, the last update after it, and the last delete after both. For late="take" only.
    Partial aggregates, so that a key with many changes is combined where they are read.
    """
    keys, operation = column_list(keys), col(Bookkeeping(prefix).operation)
    row = F.struct(*[col(name) for name in changes.columns])
    kinds = {"_taken": operation.isin(CREATE, SNAPSHOT), "_updated": operation == UPDATE, "_removed": operation == REMOVE}
    sides = changes.groupBy(*[col(key).alias(f"_key{n}") for n, key in enumerate(keys)]).agg(
        *[F.max_by(row, F.when(kind, col(order))).alias(name) for name, kind in kinds.items()]
    )
    taken, updated, removed = (col(name) for name in kinds)
    after = lambda a, b: a.isNotNull() & (b.isNull() | (a[order] > b[order]))
    left = F.array(
        taken, F.when(after(updated, taken), updated), F.when(after(removed, taken) & after(removed, updated), removed)
    )
    rows = sides.select(F.explode(F.filter(left, lambda x: x.isNotNull())).alias("_row"))
    return rows.select(*[col("_row")[name].alias(name) for name in changes.columns])


def affected_counts(operation: Column, matched: Column) -> list[Column]:
    """A count of changes for each operation, with and without a row of the same key: see `affected_rows`."""
    return [
        F.count_if((operation == name) & (matched if found else ~matched)).alias(f"{name}_{found}".lower())
        for name in OPERATIONS
        for found in (True, False)
    ]


def affected_rows(counts: dict[str, int]) -> dict[tuple[str, bool], int]:
    """Rows affected by operation and whether the key was there before, without zeros."""
    named = {(name, found): counts.get(f"{name}_{found}".lower(), 0) for name in OPERATIONS for found in (True, False)}
    return {key: count for key, count in named.items() if count}


def merge_into(changes: DataFrame, table: str, keys: str | Iterable[str], prefix: str = "cdc") -> None:
    """The same merge on a catalog table, done by the table itself.

    For catalogs whose tables take row-level operations. Spark's own session catalog does not; there,
    and for plain files, use `TargetTable`.
    """
    keys, book = require(changes, keys, "key column"), Bookkeeping(prefix)
    names = changes.columns

    def change(name: str) -> Column:
        return F.col(f"_changes.`{name}`")

    same_key = reduce(and_, [change(key) == F.col(f"{table}.`{key}`") for key in keys])
    operation = change(book.operation)
    (
        changes.alias("_changes")
        .mergeInto(table, same_key)
        .whenMatched(operation.isin(CREATE, SNAPSHOT))
        .update({name: change(name) for name in names})
        .whenMatched(operation == UPDATE)
        .update({name: change(name) for name in names if name != book.created_at})
        .whenMatched(operation == REMOVE)
        .update({name: change(name) for name in (book.operation, book.deleted_at)})
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def merge_stats(target: DataFrame, changes: DataFrame, keys: str | Iterable[str], prefix: str = "cdc") -> DataFrame:
    """How many rows the merge affects: by operation, and whether the key was there before."""
    keys, book = require(target, keys, "key column"), Bookkeeping(prefix)
    known = target.select(*keys).withColumn("_known", F.lit(True))
    found = changes.select(*keys, col(book.operation).alias("operation")).join(known, keys, "left")
    matched = F.coalesce(col("_known"), F.lit(False)).alias("matched")
    return found.groupBy("operation", matched).agg(F.count(F.lit(1)).alias("rows_affected"))
