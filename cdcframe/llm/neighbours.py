"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Distinct vectors are dealt at random into cells of bounded size. Each starts with neighbours from a few random groups.
Then, again and again, the neighbours of a node (those it names, and the nearest that name it) are joined with their
vectors and compared among one another, and each keeps the best it has met: a neighbour's neighbour is likely a
neighbour. A query walks the graph of every cell from its entries to ever nearer nodes, and the best of all cells are its
result, scored exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cdcframe.llm.common import cut

#: Nodes of a cell, and queries that walk it in one group.
CELL, QUERIES = 8192, 1024
#: Neighbours that a node keeps, and that may name it in a round.
NEIGHBOURS, REVERSE = 24, 24
#: Random groups at the start, and their size.
STARTS, START_SIZE = 4, 64
ROUNDS = 6
#: Nodes that a walk remembers; it goes on from this many at a time until it has gone on from all. Nodes it starts from.
BEAM, STEP, ENTRIES = 128, 8, 64


def _runs(batches: Iterator[pa.RecordBatch], key: str, rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of about so many rows in which every run of equal keys is whole. The input is sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table[key].to_numpy()
        end = int(np.searchsorted(keys, keys[-1]))  # where the last run begins
        if end:
            yield table.slice(0, end)
        held = table.slice(end).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: the number of each one's run, and its place there."""
    first = np.r_[True, keys[1:] != keys[:-1]]
    starts = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    return run, np.arange(len(keys)) - starts[run]


def _best(a: np.ndarray, b: np.ndarray, sim: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without repeats, the `keep` most similar `b` of each `a`."""
    if not len(a):
        return a, b, sim
    order = np.lexsort((b, a))
    a, b, sim = a[order], b[order], sim[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    a, b, sim = a[new], b[new], sim[new]
    order = np.lexsort((b, -sim, a))
    a, b, sim = a[order], b[order], sim[order]
    top = _places(a)[1] < keep
    return a[top], b[top], sim[top]


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Rows from vectors in sixteen bits; shorter ones with zeros at their end. Their products are the measure itself, so a
    longer vector is nearer to all: the graph leads to what a search by inner product looks for."""
    codes = column.to_pylist()
    size = max(map(len, codes))
    values = np.frombuffer(b"".join(code.ljust(size, b"\0") for code in codes), np.float16)
    return values.reshape(len(codes), size // 2).astype(np.float32)


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float32())]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "sim"])


_EDGES = "a bigint, b bigint, sim float"


def _sorted(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key)


def _start(nodes: DataFrame, groups: Column, keep: int) -> DataFrame:
    """Edges within random groups of the same cell."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "group"):
            run, _ = _places(table["group"].to_numpy())
            node, found = table["node"].to_numpy(), []
            for start, end in zip(np.searchsorted(run, range(run[-1] + 1)), np.searchsorted(run, range(run[-1] + 1), "right")):
                code = _codes(table["code"].slice(start, end - start))
                sim = code @ code.T
                np.fill_diagonal(sim, -np.inf)
                near = np.argsort(-sim, axis=1, kind="stable")[:, : min(keep, end - start - 1)]
                own = node[start:end]
                found.append((np.repeat(own, near.shape[1]), own[near].ravel(), np.take_along_axis(sim, near, 1).ravel()))
            yield _edges(*(np.concatenate(part) for part in zip(*found)))

    dealt = nodes.select("cell", "node", "code", F.explode(F.sequence(F.lit(1), F.lit(STARTS))).alias("start"))
    group = F.xxhash64("cell", "start", F.pmod(F.xxhash64("start", "node"), groups))
    return _sorted(dealt.select(group.alias("group"), "node", "code"), "group").mapInArrow(compare, _EDGES)


def _merge(edges: DataFrame, keep: int) -> DataFrame:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "a"):
            yield _edges(*_best(*(table[c].to_numpy() for c in ("a", "b", "sim")), keep))

    return _sorted(edges, "a").mapInArrow(best, _EDGES)


def _compared(members: DataFrame, keep: int) -> DataFrame:
    """Edges between members (`u`, `v`, `code`, `worst`) of the same `u` that beat what `v` has."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "u", 1 << 14):
            u, v = table["u"].to_numpy(), table["v"].to_numpy()
            order = np.lexsort((v, u))
            order = order[np.r_[True, (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])]]
            u, v = u[order], v[order]
            run, place = _places(u)
            code, worst = _codes(table["code"])[order], table["worst"].to_numpy()[order]
            shape = (int(run[-1]) + 1, int(place.max()) + 1)
            ids, bar = np.full(shape, -1, np.int64), np.full(shape, np.inf, np.float32)
            vectors = np.zeros((*shape, code.shape[1]), np.float32)
            ids[run, place], bar[run, place], vectors[run, place] = v, worst, code
            sim = vectors @ vectors.transpose(0, 2, 1)
            better = (sim > bar[:, :, None]) & (ids >= 0)[:, None, :] & (ids[:, :, None] != ids[:, None, :])
            g, i, j = np.nonzero(better)
            yield _edges(*_best(ids[g, i], ids[g, j], sim[g, i, j], keep))

    return _sorted(members, "u").mapInArrow(compare, _EDGES)


def neighbour_graph(nodes: DataFrame, cell_rows: int, rounds: int = ROUNDS, keep: int = NEIGHBOURS) -> DataFrame:
    """Edges (`a`, `b`, `sim`) to about the `keep` nearest of the same cell, for `nodes` (`cell`, `node`, `code`)."""
    groups = F.lit(max(1, cell_rows // START_SIZE))
    edges = cut(_merge(_start(nodes, groups, max(1, keep // STARTS)), keep))
    for _ in range(rounds):
        nearest = W.partitionBy("b").orderBy(F.col("sim").desc(), "a")
        naming = edges.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= REVERSE)
        members = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        members = members.union(naming.select("b", "a"))
        worst = edges.groupBy("a").agg(F.when(F.count("*") == keep, F.min("sim")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
        known = nodes.join(worst, F.col("node") == F.col("a"), "left").select(
            "node", "code", F.coalesce("worst", F.lit(float("-inf"))).cast("float").alias("worst")
        )
        met = members.join(known, F.col("v") == F.col("node")).select("u", "v", "code", "worst")
        edges = cut(_merge(edges.union(_compared(met, keep)), keep))
    return edges


def walk(
    queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, links: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and similarities of the nearest `keep` nodes of a cell that greedy walks find, -1 where there are no more.

    `links` has the places of each node's neighbours, -1 for none. `own` is the query's place in the cell or -1.
    """
    n, q = len(vectors), len(queries)
    longest = np.argsort(-np.einsum("nd,nd->n", vectors, vectors), kind="stable")[: ENTRIES // 2]
    entries = np.unique(np.r_[np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64), longest])
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # stands for no node
    beam = np.concatenate([np.broadcast_to(entries, (q, len(entries))), np.where(own >= 0, own, n)[:, None]], axis=1)
    beam[:, -1] = np.where(np.isin(beam[:, -1], entries), n, beam[:, -1])
    rows = np.arange(q)[:, None]
    padded = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
    sims = np.einsum("qbd,qd->qb", padded[beam], queries)
    sims[beam == n] = -np.inf
    seen[rows, beam] = True
    gone = beam == n
    links = np.where(links < 0, n, links)
    links = np.concatenate([links, np.full((1, links.shape[1]), n)])
    while not gone.all():
        waiting = np.where(gone, -np.inf, sims)
        width = min(STEP, beam.shape[1])
        ahead = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
        nodes = np.where(np.take_along_axis(gone, ahead, 1), n, np.take_along_axis(beam, ahead, 1))
        np.put_along_axis(gone, ahead, True, 1)
        found = np.sort(links[nodes].reshape(q, -1), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = n
        found[seen[rows, found]] = n
        found = np.sort(found, axis=1)
        found = found[:, : max(1, int((found < n).sum(axis=1).max()))]
        seen[rows, found] = True
        new = np.einsum("qbd,qd->qb", padded[found], queries)
        new[found == n] = -np.inf
        beam, sims = np.concatenate([beam, found], 1), np.concatenate([sims, new], 1)
        gone = np.concatenate([gone, found == n], 1)
        if beam.shape[1] > BEAM:
            top = np.argpartition(-sims, BEAM - 1, axis=1)[:, :BEAM]
            beam, sims, gone = (np.take_along_axis(x, top, 1) for x in (beam, sims, gone))
    order = np.argsort(-sims, axis=1, kind="stable")[:, :keep]
    beam, sims = np.take_along_axis(beam, order, 1), np.take_along_axis(sims, order, 1)
    return np.where(beam < n, beam, -1), sims


def _links(places: dict[int, int], a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> np.ndarray:
    """The neighbours of each node in both directions, the nearest that name it up to `REVERSE`, as places."""
    at = np.array([places[x] for x in a.tolist()], np.int64)
    to = np.array([places[x] for x in b.tolist()], np.int64)
    back = _best(to, at, sim, REVERSE)
    both = _best(np.r_[at, back[0]], np.r_[to, back[1]], np.r_[sim, back[2]], NEIGHBOURS + REVERSE)
    links = np.full((len(places), max(1, NEIGHBOURS + REVERSE)), -1, np.int64)
    if len(both[0]):
        links[both[0], _places(both[0])[1]] = both[1]
    return links


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    cell: int = CELL,
    queries: int = QUERIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """`query_id`, `rank` (from 1), the id and `score` (inner product, double) of about the `k` nearest of each query row.

    Rows with a NULL id, or a vector that is NULL, zero, empty or holds NULL, NaN or infinity take no part. Only vectors of
    equal length are compared. Ties go to the smaller id. Rows that repeat id and vector count once. Copies of a vector are
    one node, with as many of their smallest ids as a result can hold, so a large group of them is neither paired nor
    gathered. Scores are exact; which rows are found is approximate. Other columns are not carried.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(vector, lambda x: x == 0)
    fit = F.col(id).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False)) & ~F.coalesce(zero, F.lit(False))
    kind = vectors.schema[vector].dataType.simpleString()
    rows = vectors.filter(fit).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = rows.groupBy("id", "vector").agg(F.max("asks").alias("asks"))
    few = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    copies = rows.withColumn("copy", few).filter(F.col("copy") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.filter("asks").select("vector").distinct().withColumn("asks", F.lit(True))
    nodes = copies.join(asked, "vector", "left").withColumn("node", F.monotonically_increasing_id())
    nodes = cut(nodes)  # with this, the numbers of the nodes stay as they are
    greatest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    count = nodes.agg(F.count("*"), F.count("asks"), greatest).first()
    unit = count[2] or 1.0  # with all components within one, no product leaves the float
    cells, lines = max(1, math.ceil(count[0] / cell)), max(1, math.ceil(count[1] / queries))
    part = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(cells))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for value in batch.column(2).to_pylist():
                codes.append((np.array(value, np.float64) / unit).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(codes, pa.binary())], names=["cell", "node", "code"])

    celled = nodes.withColumn("cell", (F.size("vector") * F.lit(cells) + part).cast("long"))
    coded = cut(celled.select("cell", "node", "vector").mapInArrow(encode, "cell bigint, node bigint, code binary"))
    edges = neighbour_graph(coded, -(-count[0] // cells), rounds)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lists = edges.groupBy("a").agg(F.collect_list("b").alias("to"), F.collect_list("sim").alias("sims"))
    graph = celled.join(lists, F.col("node") == F.col("a"), "left").select("cell", "node", "vector", "to", "sims", every(lines).alias("line"))
    line = F.pmod(F.xxhash64(F.lit(4), "node"), F.lit(lines)).cast("int")
    sizes = F.size("vector") * F.lit(cells)
    askers = celled.filter("asks").select("node", "vector", line.alias("line"), every(cells).alias("part"), sizes.alias("base"))
    askers = askers.select(F.col("node").alias("asker"), F.col("vector").alias("wanted"), "line", (F.col("base") + F.col("part")).cast("long").alias("cell"))

    def search(asking: pa.Table, given: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if asking.num_rows and given.num_rows:
            given = given.sort_by("node").combine_chunks()
            asking = asking.sort_by("asker").combine_chunks()
            matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            exact, wanted = matrix(given, "vector"), matrix(asking, "wanted")
            node, asker = given["node"].to_numpy(), asking["asker"].to_numpy()
            places = {x: i for i, x in enumerate(node.tolist())}
            counts = np.array([len(x or []) for x in given["to"].to_pylist()])
            a = np.repeat(node, counts)
            b = given["to"].combine_chunks().flatten().to_numpy()
            sim = given["sims"].combine_chunks().flatten().to_numpy()
            links = _links(places, a, b, sim)
            own = np.array([places.get(x, -1) for x in asker.tolist()])
            plain = (exact.astype(np.float64) / unit).astype(np.float32)
            for at in range(0, len(asker), 256):
                some = slice(at, at + 256)
                asked_ = wanted[some].astype(np.float64)
                asked_ = (asked_ / np.abs(asked_).max(axis=1, keepdims=True)).astype(np.float32)
                near, _ = walk(asked_, own[some], plain, links, k + 1)
                for i, places_ in enumerate(near):
                    places_ = places_[places_ >= 0]
                    scores = exact[places_].astype(np.float64) @ wanted[at + i].astype(np.float64)
                    found.append((np.full(len(places_), asker[at + i]), node[places_], scores))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0)] * 3
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, t, from_pandas=False) if len(x) else pa.array([], t) for x, t in zip(parts, kinds)], names=["asker", "node", "score"])

    keys = ["cell", "line"]
    met = askers.groupBy(*keys).cogroup(graph.groupBy(*keys)).applyInArrow(search, "asker bigint, node bigint, score double")
    # A query's own row may be among them, so one more than asked for.
    one = W.partitionBy("asker").orderBy(F.col("score").desc(), "id")
    ids = nodes.select("node", F.explode("ids").alias("id"))
    top = met.join(ids, "node").withColumn("place", F.row_number().over(one)).filter(F.col("place") <= k + 1)
    asking_rows = rows.filter("asks").select(F.col("id").alias("query_id"), "vector")
    named = asking_rows.join(nodes.select("vector", F.col("node").alias("asker")), "vector").select("query_id", "asker")
    last = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    result = named.join(top, "asker").filter(F.col("id") != F.col("query_id")).withColumn("rank", F.row_number().over(last))
    return result.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")
