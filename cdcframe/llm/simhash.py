"""Near-duplicates by SimHash, found with covering locality-sensitive hashing.

Each of the 64 bits of a fingerprint gets a non-zero vector of r + 1 bits. For each non-zero vector v there is a table that
keeps those bits of a fingerprint whose vector has an odd inner product with v. Fewer than r + 1 vectors leave some v
orthogonal to all of them, so two fingerprints that differ in at most r bits agree in at least one of the 2^(r+1) - 1 tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut, row_key
from cdcframe.llm.components import connected

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit number; 0 if it has no word."""
    words = (text or b"").lower().split()  # on bytes, both know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends[: max(0, len(words) - shingle)]]
    ends = ends[shingle - 1 :] or ends[-1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 65536):
        pairs = zip(starts[at : at + 65536], ends[at : at + 65536])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, keyed: bool = False
) -> DataFrame:
    """`id`, `key` (of id and text if `keyed`, else empty) and `fingerprint` (bigint) of every row. A NULL or empty text has the fingerprint 0."""

    def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([fingerprint(value, shingle) for value in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], values], names=["id", "key", "fingerprint"])

    kind = docs.schema[id].dataType.simpleString()
    key = row_key(id, text) if keyed else F.lit("")
    plain = docs.select(F.col(id).alias("id"), key.alias("key"), F.col(text).cast("binary").alias("text"))
    return plain.mapInArrow(hash_batches, f"id {kind}, key string, fingerprint bigint")


def covering_masks(radius: int, free: int = (1 << BITS) - 1) -> list[int]:
    """Bit masks, as unsigned numbers, within the bits `free`. Pairs that differ in `radius` of these bits or fewer agree in one."""
    tables = (1 << (radius + 1)) - 1
    places = [bit for bit in range(BITS) if free >> bit & 1]
    vectors = [place % tables + 1 for place in range(len(places))]
    return [
        sum(1 << bit for bit, vector in zip(places, vectors) if (vector & v).bit_count() % 2) for v in range(1, tables + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _trees(members: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Within one bucket: (member, root) for all that are connected by steps of at most `radius` bits."""
    left = np.unique(members)
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= radius
            if near.any():
                found = left[near]
                frontier.extend(found)
                left = left[~near]
                yield from ((int(x), int(root)) for x in found)


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (`a`, `b`) that connect what is connected within each row of `members`."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy().view(np.uint64)
            found: list[tuple[int, int]] = []
            for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
                found += _trees(values[start:end], radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return buckets.select("members").mapInArrow(link, "a bigint, b bigint")


def near_links(distinct: DataFrame, radius: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """Links (`a`, `b`) over distinct `fingerprint` values, connecting exactly what pairs within `radius` bits connect.

    A bucket of more than `bucket_rows` fingerprints is dealt out again by the covering masks of the bits that its table
    leaves free, which loses no pair. Of 64 bits each step keeps half, so a bucket of the second step has at most 2^16.
    Each step shuffles its rows once, for the counts and for what is done with them.
    """
    masks = covering_masks(radius)
    fp = F.col("fingerprint")

    def deal(rows: DataFrame, key: F.Column, *more: F.Column) -> DataFrame:
        return rows.select("fingerprint", *more, F.posexplode(key).alias("table", "key"))

    def counted(rows: DataFrame) -> DataFrame:
        """Members of buckets that have several, with their number in `members`."""
        rows = rows.repartition("table", "key")
        ends = [F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most")]
        buckets = rows.groupBy("table", "key").agg(*ends, F.count("*").alias("members")).filter("least < most")
        return rows.join(buckets.select("table", "key", "members"), ["table", "key"])

    def gathered(rows: DataFrame) -> DataFrame:
        return _bucket_links(rows.groupBy("table", "key").agg(F.collect_list("fingerprint").alias("members")), radius)

    dealt = counted(deal(distinct, F.array(*(fp.bitwiseAND(F.lit(_signed(mask))) for mask in masks))))
    small = gathered(dealt.filter(F.col("members") <= bucket_rows))

    fine = [
        F.array(*(F.lit(_signed(mask | more)) for more in covering_masks(radius, ~mask & ((1 << BITS) - 1))))
        for mask in masks
    ]
    crowded = dealt.filter(F.col("members") > bucket_rows).select("fingerprint", F.col("table").alias("outer"))
    inner = F.transform(F.array(*fine)[F.col("outer")], lambda mask: fp.bitwiseAND(mask))
    again = deal(crowded, inner, F.col("outer"))
    again = again.select("fingerprint", (F.col("outer") * len(masks) + F.col("table")).alias("table"), "key")
    return small.union(gathered(counted(again))).distinct()


def _firsts(rows: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """For each `fingerprint` the `first` row (id, NULL last, then key) of its component."""
    own = F.min(F.struct(F.col("id").isNull().alias("lost"), "id", "key"))
    distinct = cut(rows.groupBy("fingerprint").agg(own.alias("own")))
    roots = connected(near_links(distinct.select("fingerprint"), radius, bucket_rows))
    members = roots.union(roots.select("root", "root").distinct())
    firsts = members.join(distinct, F.col("node") == F.col("fingerprint")).groupBy("root").agg(F.min("own").alias("first"))
    linked = members.join(firsts, "root").select(F.col("node").alias("fingerprint"), "first")
    return distinct.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("first", "own").alias("first"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, bucket_rows: int = 4096
) -> DataFrame:
    """The id, `fingerprint` (16 hex digits) and `component_id` of every row.

    Rows link if their fingerprints differ in at most `radius` bits; the component id is the smallest id that links reach,
    NULL if all ids of a component are. Rows without words have the fingerprint zero and link like any other. Repeated
    rows are each reported. Copies share a fingerprint and are one node of the graph, so they are never paired. Columns
    other than the id and the text are not carried.
    """
    rows = cut(fingerprints(docs, id, text, shingle))
    return rows.join(_firsts(rows, radius, bucket_rows), "fingerprint").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, bucket_rows: int = 4096
) -> DataFrame:
    """One row of each component, that with the smallest id, with all its columns. Of rows that repeat id and text, one."""
    rows = cut(fingerprints(docs, id, text, shingle, keyed=True))
    chosen = _firsts(rows, radius, bucket_rows).select(F.col("first.key").alias("_simhash_key")).distinct()
    keyed = docs.withColumn("_simhash_key", row_key(id, text))
    return keyed.join(chosen, "_simhash_key", "left_semi").dropDuplicates(["_simhash_key"]).select(*docs.columns)
