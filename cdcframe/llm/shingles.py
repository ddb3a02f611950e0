"""Near-duplicates by the Jaccard similarity of their sets of word shingles.

The first candidates come from covering SimHash: what fingerprints of 64 bits connect that differ in 4 bits or fewer. Pairs at
the threshold differ in about 10 bits, and the number of tables doubles with each bit, so it cannot find them all. What it
leaves comes from minwise hashing: a set has 64 bands of 6 minima, and a pair of similarity s has a band in common with the
probability 1 - (1 - s^6)^64, which at 0.8 is all but 4 in 10^9. Each candidate of either kind is checked against the sets
themselves, so no pair below the threshold links; members that have a component by then are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut, row_key
from cdcframe.llm.components import connected
from cdcframe.llm.simhash import BITS, near_links

SEED = 42
BANDS, ROWS = 64, 6
MARKS = 1 << 24
_RANDOM = np.random.default_rng(SEED)
_TURNS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 63, BANDS, np.uint64)


def shingle_set(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a UTF-8 text. One with fewer words is one shingle, one without has none."""
    words = (text or b"").lower().split()  # on bytes, both know ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends[: max(0, len(words) - shingle)]]
    ends = ends[shingle - 1 :] or ends[-1:]
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends)], np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A number for each band of a set that is not empty."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 256):
        np.minimum(least, (hashes[at : at + 256, None] * _TURNS).min(axis=0), out=least)
    return ((least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def set_fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of a set of shingles as a signed 64-bit number; 0 if it is empty."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")[0])


def _sketches(docs: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """`id`, `key` (of id and text), `node` (a hash of the shingle set), `size`, `fingerprint` and `bands` of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, prints, bands = [], [], [], []
            for value in batch.column(2).to_pylist():
                hashes = shingle_set(value, shingle)
                nodes.append(np.int64(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64)))
                sizes.append(len(hashes))
                prints.append(set_fingerprint(hashes))
                bands.append(band_keys(hashes) if len(hashes) else [])
            arrays = [pa.array(values, pa.int64()) for values in (nodes, sizes, prints)] + [pa.array(bands, pa.list_(pa.int64()))]
            names = ["id", "key", "node", "size", "fingerprint", "bands"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=names)

    kind = docs.schema[id].dataType.simpleString()
    plain = docs.select(F.col(id).alias("id"), row_key(id, text).alias("key"), F.col(text).cast("binary").alias("text"))
    return plain.mapInArrow(sketch, f"id {kind}, key string, node bigint, size bigint, fingerprint bigint, bands array<bigint>")


def _marked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """`docs` with `marked`: true where `key` is one of `keys`, and for few others.

    Each key has one of `MARKS` bits, so what is broadcast has 2 MB at most. It keeps texts that nothing asks for out of a shuffle.
    """
    mark = F.pmod(F.xxhash64("key"), F.lit(MARKS)) + 1
    bits = keys.select(F.bitmap_bucket_number(mark).alias("part"), F.bitmap_bit_position(mark).alias("bit"))
    bits = bits.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    rows = docs.withColumns({"part": F.bitmap_bucket_number(mark), "bit": F.bitmap_bit_position(mark)})
    byte = F.expr("cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
    marked = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0, F.lit(False))
    return rows.join(F.broadcast(bits), "part", "left").withColumn("marked", marked).drop("part", "bit", "bits")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """`node` and `hashes` (eight bytes each) of rows with `node` and `text`."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([shingle_set(value, shingle).tobytes() for value in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["node", "hashes"])

    return texts.select("node", F.col("text").cast("binary")).mapInArrow(sets, "node bigint, hashes binary")


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of `pairs` (`a`, `b`) whose sets have the similarity `threshold` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                shared = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
                keep.append(shared / (len(a) + len(b) - shared) >= threshold)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint")


def _cells(placed: DataFrame, cell: int) -> DataFrame:
    """`node` and `root` in cells (`bucket`, `p`, `q`), so that any two members of a bucket meet in one. A bucket of more than
    `cell` shingles is cut into parts, and each two of its parts are a cell."""
    parts = F.ceil(F.col("total") / cell)
    part = F.pmod(F.xxhash64("node"), parts)
    dealt = placed.select("bucket", "node", "root", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    return dealt.select("bucket", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "node", "root")


def _cell_links(cells: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between roots that connect what is similar within each cell and not in one component yet."""

    def link(members: pa.Table) -> pa.Table:
        root = members["root"].to_numpy()
        _, label, count = np.unique(root, return_inverse=True, return_counts=True)
        order = np.argsort(count[label], kind="stable")  # members of the largest component last: they need no look at each other
        label, root = label[order], root[order]
        hashes = members["hashes"].combine_chunks()
        hashes = [np.frombuffer(hashes[i].as_buffer(), np.uint64) for i in order.tolist()]
        sizes = np.array([len(x) for x in hashes])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        values, ids = np.unique(np.concatenate(hashes), return_inverse=True)
        seen, found = np.zeros(len(values), np.bool_), []
        for i in range(len(root) - 1):
            other = label[i + 1 :] != label[i]
            if not other.any():
                continue
            own = ids[starts[i] : ends[i]]
            seen[own] = True
            shared = np.add.reduceat(seen[ids[ends[i] :]], starts[i + 1 :] - ends[i], dtype=np.int64)
            seen[own] = False
            near = other & (shared / (sizes[i + 1 :] + sizes[i] - shared) >= threshold)
            for j in (np.flatnonzero(near) + i + 1).tolist():
                if label[j] != label[i]:
                    found.append((root[i], root[j]))
                    label[label == label[j]] = label[i]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return cells.join(sets, "node").groupBy("bucket", "p", "q").applyInArrow(link, "a bigint, b bigint")


def _possible(size: Column, other: Column, threshold: float) -> Column:
    """Whether sets of these sizes can have the similarity `threshold`."""
    return F.least(size, other) >= F.lit(threshold) * F.greatest(size, other) - 1e-6


def simhash_pairs(distinct: DataFrame, radius: int = 4, threshold: float = 0.0) -> DataFrame:
    """Pairs (`a` < `b`) of nodes that connect what `fingerprint`s connect that differ in at most `radius` bits.

    Those of them that are too different in `size` for the similarity `threshold` are left out.
    """
    prints = distinct.filter("size > 0").select("node", "size", "fingerprint")
    own = [F.min("node").alias("first"), F.min_by("size", "node").alias("first_size")]
    firsts = cut(prints.groupBy("fingerprint").agg(*own))
    same = prints.join(firsts, "fingerprint").filter(F.col("first") < F.col("node"))
    same = same.select(F.col("first").alias("p"), "node", "first_size", "size")
    links = near_links(firsts.select("fingerprint"), radius)
    for end, node, size in (("a", "p", "p_size"), ("b", "q", "q_size")):
        named = firsts.select(F.col("fingerprint").alias(end), F.col("first").alias(node), F.col("first_size").alias(size))
        links = links.join(named, end)
    pairs = same.union(links.select("p", "q", "p_size", "q_size")).toDF("p", "q", "p_size", "q_size")
    pairs = pairs.filter(_possible(F.col("p_size"), F.col("q_size"), threshold))
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def _shared(distinct: DataFrame) -> DataFrame:
    """`bucket`, `node` and `size` of the members of each bucket that has several, with its smallest and its largest node
    (`least`, `most`) and their sizes. Of buckets with the same members one stays, so near copies are in few.

    The bands are shuffled once, for the aggregate and for the join.
    """
    dealt = distinct.select("node", "size", F.explode("bands").alias("bucket")).filter("bucket is not null").repartition("bucket")
    ends = [F.min("node").alias("least"), F.max("node").alias("most")]
    ends += [F.min_by("size", "node").alias("least_size"), F.max_by("size", "node").alias("most_size")]
    members = [F.count("*").alias("members"), F.bit_xor("node").alias("mixed"), F.sum("size").alias("total")]
    buckets = dealt.groupBy("bucket").agg(*ends, *members).filter("least < most")
    ends = ["least", "most", "least_size", "most_size"]
    chosen = buckets.groupBy(*ends, "members", "mixed", "total").agg(F.min("bucket").alias("bucket"))
    return dealt.join(chosen.select("bucket", *ends), "bucket")


def _roots(
    docs: DataFrame, distinct: DataFrame, id: str, text: str, shingle: int, threshold: float, cell: int
) -> DataFrame:
    """`node` and `root` of the components that the candidates of the similarity `threshold` or more make, without the roots.

    The candidates of SimHash are checked together with those of each bucket against its smallest and its largest node.
    Buckets whose members are then still in different components are gone through member by member, without pairs as rows.
    What they connect are components, so only links between roots are left to follow then.
    """
    shared = cut(_shared(distinct))
    node, end = F.col("node"), F.col("end.node")
    ends = [F.struct(F.col(x).alias("node"), F.col(f"{x}_size").alias("size")) for x in ("least", "most")]
    pairs = shared.select("node", "size", F.explode(F.array(*ends)).alias("end"))
    pairs = pairs.filter((node != end) & _possible(F.col("size"), F.col("end.size"), threshold))
    pairs = pairs.select(F.least(node, end).alias("a"), F.greatest(node, end).alias("b"))
    tried = cut(pairs.union(simhash_pairs(distinct, threshold=threshold)).distinct())

    members = shared.select("node").union(tried.select(F.explode(F.array("a", "b")))).distinct()
    members = cut(members.join(distinct.select("node", "own.key"), "node"))
    texts = _marked(docs.select(row_key(id, text).alias("key"), F.col(text).alias("text")), members).filter("marked")
    sets = cut(_sets(texts.join(members, "key").dropDuplicates(["node"]), shingle))
    roots = connected(_similar(tried, sets, threshold))
    placed = shared.select("bucket", "node", "size").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum("size").alias("total"))
    placed = placed.join(mixed.filter("low < high").select("bucket", "total"), "bucket")
    later = connected(_cell_links(_cells(placed, cell), sets, threshold))
    above = later.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(later)


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, threshold: float = 0.8, cell: int = 1 << 18
) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id (NULL last), with all its columns.

    Rows link if the Jaccard similarity of their shingle sets is `threshold` or more. Rows without words are one group. Rows
    with the same set are one node of the graph. Of rows that repeat id and text, one stays.
    """
    rows = _sketches(docs, id, text, shingle)
    own = F.min(F.struct(F.col("id").isNull().alias("lost"), "id", "key"))
    sketch = [F.first(name).alias(name) for name in ("size", "fingerprint", "bands")]
    distinct = cut(rows.groupBy("node").agg(own.alias("own"), *sketch))
    roots = _roots(docs, distinct, id, text, shingle, threshold, cell)
    placed = distinct.select("node", "own").join(roots, "node", "left")
    firsts = placed.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("own").alias("first"))
    chosen = firsts.select(F.col("first.key").alias("key"), F.lit(True).alias("chosen"))
    keys = docs.select(row_key(id, text).alias("key")).groupBy("key").agg(F.count("*").alias("rows")).join(chosen, "key", "left")
    keys = cut(keys.filter("rows > 1 or chosen is null"))  # rows of all others stay as they are
    rows = _marked(docs.select(row_key(id, text).alias("key"), F.struct(*docs.columns).alias("row")), keys)
    again = rows.filter("marked").join(keys, "key", "left").filter("rows is null or chosen")
    return rows.filter("not marked").select("row.*").union(again.dropDuplicates(["key"]).select("row.*"))
