"""Exact top-k search by inner product, columnar branch-and-bound.

Vectors are scaled to integers. Candidates and queries meet in the cells of a grid of bounded blocks; each cell is one
group. There the candidates lie dimension by dimension. The inner product of a query with all of them grows block by block
of dimensions. What is left of it is at most the product of the lengths of the two remainders, so a candidate whose sum
and bound stay below the query's k-th best cannot come in, and the others are compacted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

SCALE = 256
#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 8192, 1024
#: Dimensions added before each compaction.
STEP = 8
#: Scaled components beyond this have sums that might leave the long.
WIDE = 1 << 24


def usable(vector: Column) -> Column:
    """Not NULL, and no component NULL, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _floor(x: Column) -> Column:
    """The floor of a double as a double, however large."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def _order(dots: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -dots))[:k]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and scores of the `k` best of one block, ties to the smaller id, itself left out."""
    n, dimensions = vectors.shape
    columns = np.ascontiguousarray(vectors.T)
    ends = list(range(STEP, dimensions, STEP)) + [dimensions]

    def remainders(rows: np.ndarray) -> np.ndarray:
        """Upper bounds of the lengths of what is left after each step."""
        squares = rows.astype(np.float64) ** 2
        return np.stack([np.sqrt(squares[:, end:].sum(axis=1)) * (1 + 1e-9) for end in ends])

    left_vectors, left_queries = remainders(vectors), remainders(queries)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for row, (query, query_id) in enumerate(zip(queries, query_ids)):
        alive = np.flatnonzero(ids != query_id)
        sums, begin = np.zeros(len(alive), np.int64), 0
        for step, end in enumerate(ends):
            if len(alive) == n:
                sums += query[begin:end] @ columns[begin:end]
            else:
                sums += query[begin:end] @ columns[begin:end, alive]
            begin = end
            if end == dimensions or len(alive) <= k:
                continue
            bound = left_vectors[step, alive] * left_queries[step, row]
            # At least k of them reach this.
            floor = np.partition(sums - bound, len(alive) - k)[len(alive) - k]
            keep = sums + bound >= floor
            if not keep.all():
                alive, sums = alive[keep], sums[keep]
        best = _order(sums, ids[alive], k)
        found.append((np.full(len(best), query_id), ids[alive][best], sums[best]))
    return tuple(np.concatenate(part) for part in zip(*found))


def search_wide(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for components whose sums can leave the long, with Python's integers; what leaves it counts as its end."""
    whole = np.array([[int(x) for x in row] for row in vectors.tolist()], object).reshape(vectors.shape)
    low, high = -(1 << 63), (1 << 63) - 1
    found = []
    for query, query_id in zip(queries.tolist(), query_ids):
        sums = whole @ np.array([int(x) for x in query], object) if whole.shape[1] else np.zeros(len(whole), object)
        alive = np.flatnonzero(ids != query_id)
        scores = [min(max(int(score), low), high) for score in sums[alive]]
        best = sorted(range(len(alive)), key=lambda at: (-scores[at], ids[alive[at]]))[:k]
        found.append((np.full(len(best), query_id), ids[alive[best]], np.array([scores[at] for at in best], np.int64)))
    return tuple(np.concatenate(part) for part in zip(*found))


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id: str = "vec_id",
    vector: str = "embedding",
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """`query_id`, `rank` (from 1), the id and `score` (long) of the `k` best candidates of each query row.

    A component x counts as floor(256 x). Rows with a NULL vector, or one that holds NULL, NaN or infinity, or a NULL id
    take no part. Only vectors of equal length are compared. Ties go to the smaller id; a row that repeats is a candidate
    for each time, but never for a query of the same id. Vectors with scaled components over 2^24 are compared in cells of
    their own, with integers of any size; a score beyond the long counts as its end. Other columns are not carried.
    """
    whole = F.transform(vector, lambda x: _floor(x.cast("double") * SCALE))
    rows = vectors.filter(F.col(id).isNotNull() & usable(F.col(vector))).select(
        F.col(id).cast("long").alias("id"), is_query.alias("asks"), whole.alias("whole")
    )
    wide = F.exists("whole", lambda x: F.abs(x) > WIDE)
    rows = rows.withColumn("size", F.size("whole")).withColumn("wide", wide)
    count = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long")), F.max("wide")).first()
    columns, lines = max(1, math.ceil(count[0] / candidates)), max(1, math.ceil((count[1] or 0) / queries))
    # Wide vectors have columns and lines of their own: the odd numbers.
    block = lambda n, seed: (2 * F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)) + F.col("wide").cast("int")).cast("int")
    every = lambda n, any_wide: F.explode(F.sequence(F.lit(0), F.lit(2 * n - 1), F.lit(1 if any_wide else 2)))
    odd = bool(count[2])
    given = rows.select("id", "whole", "size", block(columns, 1).alias("column"), every(lines, odd).alias("line"))
    asked = rows.filter("asks").select("id", "whole", "size", block(lines, 2).alias("line"), every(columns, odd).alias("column"))

    def cell(some: pa.Table, all_: pa.Table) -> pa.Table:
        parts = []
        if some.num_rows and all_.num_rows:
            size = some["size"][0].as_py()
            matrix = lambda t: t["whole"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, size)
            asking, vectors_ = matrix(some), matrix(all_)
            if max(np.abs(asking).max(initial=0), np.abs(vectors_).max(initial=0)) > WIDE:
                found = search_wide(asking, some["id"].to_numpy(), vectors_, all_["id"].to_numpy(), k)
            else:
                found = search_block(asking.astype(np.int64), some["id"].to_numpy(), vectors_.astype(np.int64), all_["id"].to_numpy(), k)
            parts = [pa.array(part, pa.int64()) for part in found]
        return pa.table(parts or [pa.array([], pa.int64())] * 3, names=["query_id", "id", "score"])

    keys = ["size", "line", "column"]
    met = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(cell, "query_id long, id long, score long")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id), "score")


SQL = f"""
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::hugeint) as v from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
  from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
