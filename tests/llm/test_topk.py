"""Exact top-k against SQL over all pairs, and its bounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcframe.llm import topk
from cdcframe.llm.queries import ORACLES
from tests.llm import duck

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def rows_of(seed, n=400, size=20):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.0, 0.25]) for _ in range(size)], 0) for i in range(n)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]  # copies: ties
    rows += [(2000, None, 0), (2050, [1.0, None], 0), (2100, [math.nan] * size, 0), (2150, [math.inf] * size, 0)]
    rows += [(3000, [1.0, 2.0], 0), (3001, [2.0, 1.0], 0), (3050, [-1.0, 1.0], 0), (5000, [], 0), (None, rows[1][1], 0)]
    return rows


@pytest.mark.parametrize("candidates, queries", [(8192, 1024), (30, 3)])
def test_query_equals_sql(spark, candidates, queries):
    df = spark.createDataFrame(rows_of(1), SCHEMA).selectExpr("*", "1 as id", "2 as size", "3 as whole")
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, candidates=candidates, queries=queries)
    duck.agree(got, duck.over_rows(embeddings=df), ORACLES["op9_exact_top_k"])


def test_bounds_lose_nothing():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-300, 300, (3000, 64)) * (rng.random((3000, 1)) < 0.5) + rng.integers(-3, 3, (3000, 64))
    ids = rng.permutation(3000)
    got = topk.search_block(vectors[:40], ids[:40], vectors, ids, 5)
    at = 0
    for query, id in zip(vectors[:40], ids[:40]):
        scores = vectors @ query
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != id][:5]
        assert got[1][at : at + 5].tolist() == ids[order].tolist() and got[2][at : at + 5].tolist() == scores[order].tolist()
        at += 5


def test_few_and_no_rows(spark):
    asks = F.col("vec_id") % 50 == 0
    assert topk.exact_top_k(spark.createDataFrame([], SCHEMA), asks).collect() == []
    two = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], SCHEMA)
    assert list(map(tuple, topk.exact_top_k(two, asks).collect())) == [(0, 1, 1, 256 * 512)]
    empty = spark.createDataFrame([(0, []), (1, []), (2, [1.0])], "vec_id bigint, embedding array<float>")
    assert list(map(tuple, topk.exact_top_k(empty, asks).collect())) == [(0, 1, 1, 0)]


@pytest.mark.parametrize("scale", [1e5, 1e9, 1e30])
def test_large_components_take_part(spark, scale):
    rng = random.Random(int(scale) % 97)
    draw = lambda: float(np.float32(rng.gauss(0, 1) * (scale if rng.random() < 0.1 else 1)))
    rows = [(i, [draw() for _ in range(6)], 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, candidates=60, queries=2).collect()
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    for query in (0, 50, 100, 150):
        scores = {i: sum(x * y for x, y in zip(whole[query], v)) for i, v in whole.items() if i != query}
        scores = {i: max(min(score, (1 << 63) - 1), -(1 << 63)) for i, score in scores.items()}
        want = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert mine == [(n + 1, i, scores[i]) for n, i in enumerate(want)]


def test_repeated_ids(spark):
    rows = [(0, [1.0], 0), (0, [3.0], 0), (1, [2.0], 0), (1, [2.0], 0)]
    got = topk.exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert {r["vec_id"] for r in got} == {1} and all(r["query_id"] == 0 for r in got)
