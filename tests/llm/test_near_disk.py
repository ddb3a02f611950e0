"""What the near-duplicate stage writes on its way: links settle without needless rounds, and near copies are not dealt again and again."""

import random

import pytest
from pyspark.sql import functions as F

from cdcframe.llm import components, shingles, simhash
from tests.inspect_plan import plan
from tests.llm.test_shingles import brute_kept, planted


def components_of(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent if find(x) != x}


@pytest.fixture
def cuts(monkeypatch):
    """The numbers of rows that are kept on the way."""
    rows = []
    for module in (components, shingles, simhash):

        def counted(df, cut=module.cut):
            df = cut(df)
            rows.append(df.count())
            return df

        monkeypatch.setattr(module, "cut", counted)
    return rows


def linked(spark, links):
    found = components.connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len({r["node"] for r in found}) == len(found)
    return {r["node"]: r["root"] for r in found}


def test_stars_take_no_round(spark, cuts):
    links = [(x, 7 * (x // 7)) for x in range(70)] + [(14, 15), (3, 0)]
    assert linked(spark, links) == {x: 7 * (x // 7) for x in range(70) if x % 7}
    assert cuts == [60]


def test_no_links(spark, cuts):
    assert linked(spark, [(5, 5)]) == {} and cuts == [0]


@pytest.mark.parametrize("seed", range(4))
def test_components_of_random_links(spark, cuts, seed):
    """Sparse and dense, in both directions, repeated; a path and a hub. No round makes more links than there are."""
    random.seed(seed)
    links = [(random.randrange(-200, 200), random.randrange(-200, 200)) for _ in range(90 + 60 * seed)]
    links += links[:20] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000 - i, 1999) for i in range(100)]
    assert linked(spark, links) == components_of(links)
    assert cuts == sorted(cuts, reverse=True)


def near_copies(spark):
    rows = list(enumerate(text for pair in planted(0.9, 0.97, 40, 8) for text in pair))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string")


def test_near_copies_are_kept_in_few_buckets(spark, cuts):
    """Each two share some fifty bands, all with the same two members."""
    rows, docs = near_copies(spark)
    assert sorted(r["doc_id"] for r in shingles.keep_one(docs).collect()) == brute_kept(rows)
    assert max(cuts) <= 2 * len(rows)


def exchanges(df, of):
    df.collect()
    final = plan(df).split("== Initial Plan")[0].splitlines()
    return sum(of in line and "Reused" not in line for line in final)


def test_buckets_are_shuffled_once(spark):
    _, docs = near_copies(spark)
    rows = shingles._sketches(docs, "doc_id", "text", 5)
    distinct = components.cut(rows.groupBy("node").agg(F.first("size").alias("size"), F.first("bands").alias("bands")))
    assert exchanges(shingles._shared(distinct), "Exchange hashpartitioning(bucket") == 1
    prints = components.cut(rows.select("fingerprint").distinct())
    assert exchanges(simhash.near_links(prints), "Exchange hashpartitioning(table") == 1


def test_marks_are_those_of_the_keys_and_few_others(spark):
    docs = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("key"), "id")
    found = shingles._marked(docs, docs.filter("id % 10 = 3").select("key")).collect()
    marked = {r["id"] for r in found if r["marked"]}
    assert len(found) == 4000 and marked >= set(range(3, 4000, 10)) and len(marked) < 420
    assert not any(r["marked"] for r in shingles._marked(docs, docs.filter("id < 0")).collect())


@pytest.mark.parametrize("marks", [1, 1 << 24])
def test_rows_are_right_however_many_are_marked(spark, monkeypatch, marks):
    monkeypatch.setattr(shingles, "MARKS", marks)
    rows, _ = near_copies(spark)
    rows += [(1000 + i, f"own text number {i} of many") for i in range(300)]
    docs = spark.createDataFrame([*rows, rows[0], rows[-1], rows[-1]], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in shingles.keep_one(docs).collect()) == brute_kept(rows)
