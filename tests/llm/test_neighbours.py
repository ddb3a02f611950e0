"""Approximate neighbours: recall against brute force, exact scores, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcframe.llm import neighbours
from cdcframe.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"
ASKS = "vec_id % 20 = 0"


def truth(ids, vectors, query, k):
    scores = vectors.astype(np.float64) @ vectors[query].astype(np.float64)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return ids[order], scores[order]


def recall(got, ids, vectors, k=20):
    """Of a result with the right form; scores must be those of the rows named."""
    hits = total = 0
    place = {id: i for i, id in enumerate(ids.tolist())}
    for query, group in got.groupby("query_id"):
        group = group.sort_values("rank")
        assert group["rank"].tolist() == list(range(1, len(group) + 1)) and query not in set(group.vec_id)
        scores = vectors[[place[i] for i in group.vec_id]].astype(np.float64) @ vectors[place[query]].astype(np.float64)
        assert np.allclose(group.score, scores, atol=1e-12)
        assert list(zip(-group.score, group.vec_id)) == sorted(zip(-group.score, group.vec_id))
        best, _ = truth(ids, vectors, place[query], k)
        assert len(group) == len(best)
        hits, total = hits + len(set(best) & set(group.vec_id)), total + len(best)
    return hits / total


def test_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op10_nn_descent"](spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy())
    assert got.query_id.nunique() == (ids % 20 == 0).sum()
    assert recall(got, ids, vectors) >= 0.9


def test_many_cells_and_copies(spark):
    """Random vectors of different lengths of arrow, in small cells, a third of them copies of one."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1200, 16)).astype(np.float32)
    vectors[::3] = vectors[0]
    ids = rng.permutation(1200) * 5
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.expr(ASKS), cell=200, queries=50).toPandas()
    assert got.query_id.nunique() == 300
    assert recall(got, ids, vectors) >= 0.95


def worst(got, ids, vectors):
    return min(recall(group, ids, vectors) for _, group in got.groupby("query_id"))


@pytest.mark.parametrize("shape", ["lengths", "clusters", "equal"])
def test_recall_for_inner_products_of_any_lengths(spark, shape):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(4000, 32))
    if shape == "clusters":
        vectors = rng.normal(size=(40, 32))[rng.integers(0, 40, 4000)] + 0.3 * vectors
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if shape != "equal":
        vectors *= rng.lognormal(0, 1.0 if shape == "lengths" else 0.5, (4000, 1))
    vectors, ids = vectors.astype(np.float32), np.arange(4000)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.expr(ASKS)).toPandas()
    assert got.query_id.nunique() == 200
    assert recall(got, ids, vectors) >= 0.95 and worst(got, ids, vectors) >= 0.5


def test_a_score_beyond_the_float_loses_no_candidate(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 0.0], 0), (20, [1.0, 1.0], 0), (2, [-3e38, 3e38], 0)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.expr(ASKS)).toPandas()
    assert got[got.query_id == 0].vec_id.tolist() == [1, 20, 2]
    assert got[got.query_id == 20].vec_id.tolist() == [0, 1, 2]


def test_odd_rows(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.expr(ASKS)).collect() == []
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (20, [1.0, 0.0], 0), (20, [1.0, 0.0], 1), (40, [0.0, 0.0], 0)]
    rows += [(2, None, 0), (60, [1.0, None], 0), (80, [math.nan, 1.0], 0), (3, [math.inf, 1.0], 0), (4, [], 0)]
    rows += [(None, [1.0, 1.0], 0), (100, [1.0, 2.0, 3.0], 0), (101, [-1.0, 0.0, 0.0], 0), (120, [5.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as node", "3 as cell")
    got = sorted(map(tuple, neighbours.nearest(df, F.expr(ASKS)).collect()))
    want = [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5), (100, 1, 101, -1.0)]
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 300])
def test_small_cells_are_walked_whole(n):
    rng = np.random.default_rng(n)
    vectors = rng.normal(size=(n, 8)).astype(np.float32)
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -9)
    links = np.argsort(-sims, axis=1)[:, : min(10, n - 1)] if n > 1 else np.full((1, 1), -1)
    own = np.arange(n)
    found, scores = neighbours.walk(vectors, own, vectors, links.astype(np.int64), 5)
    for i, (row, score) in enumerate(zip(found, scores)):
        row = row[row >= 0]
        assert len(set(row.tolist())) == len(row) == min(5, n)
        assert np.allclose(score[: len(row)], (vectors @ vectors[i])[row], atol=1e-5)
        if n <= 64:
            assert set(row.tolist()) == set(np.argsort(-(vectors @ vectors[i]), kind="stable")[:5].tolist())
