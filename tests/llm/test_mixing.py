"""The mix against SQL that ranks every quotient, and its promises."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cdcframe.llm import mixing
from cdcframe.llm.queries import ORACLES
from tests.llm import duck

SCHEMA = "doc_id bigint, text string, source string"


def docs_of(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "a", "é", "Z", "tiny", None])
        words = 3 if source == "tiny" else rng.choice([0, 1, 40, 500])
        rows.append((i, " ".join(f"w{rng.randrange(99)}\n" for _ in range(words)), source))
    rows += [(5000, None, "a"), (5000, None, "a"), (None, "x y z", "a"), (5001, "same text", "b"), (5001, "same text", "b")]
    rows += [(5002, "", "only empty"), (5003, "u v w", "nbsp")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_query_equals_sql(spark):
    rows, df = docs_of(spark)
    got = mixing.taken(mixing.mix(df))
    result = duck.agree(got, duck.over_rows(documents=df), ORACLES["op5_sainte_lague_mix"])
    assert len(result) == len(rows)


def test_many_shards_equal_sql(spark):
    _, df = docs_of(spark, 2)
    sql = ORACLES["op5_sainte_lague_mix"].replace(f"/ {mixing.SHARD_WORDS}", "/ 700").replace(f"least({mixing.BLOCK_WORDS},", "least(16,")
    duck.agree(mixing.taken(mixing.mix(df, shard_words=700, block_words=16)), duck.over_rows(documents=df), sql)


def test_promises(spark):
    rows, df = docs_of(spark, 3, 600)
    out = mixing.taken(mixing.mix(df)).collect()
    again = mixing.taken(mixing.mix(df.repartition(7))).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert all(0 <= row["taken"] <= 3 * row["size"] for row in out)
    total = sum(row["size"] for row in out)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(mixing.WORD, text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {source: i % 3 + 1 for i, source in enumerate(order)}
    target, capped = {}, set()
    while True:  # reshare until none is above
        open_weight = sum(w for s, w in weights.items() if s not in capped)
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weights[s] / open_weight for s in order}
        above = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    source_of = {id: source for id, _, source in rows}
    took = defaultdict(int)
    for row in out:
        source = source_of[row["doc_id"]]
        assert (row["source_size"], row["target"]) == (sizes[source], pytest.approx(target[source]))
        took[source] += row["taken"]
    block = {s: max(1, min(mixing.BLOCK_WORDS, sizes[s] // mixing.LEAST_BLOCKS)) for s in order}
    assert all(abs(took[s] - target[s]) <= 2 * block[s] for s in order)


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 1, "b": 5, "c": 20, "d": 33, "e": 100, "f": 700, "g": 40_000, "h": 2, "i": 64, "j": 65}
    rows = [(n, " ".join(["w"] * size), name) for n, (name, size) in enumerate(sizes.items())]
    rows += [(100 + n, "one", "many") for n in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.taken(mixing.mix(df)).collect()
    took, target = Counter(), {}
    for r in out:
        name = "many" if r["doc_id"] >= 100 else list(sizes)[r["doc_id"]]
        took[name] += r["taken"]
        target[name] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    for name, size in (sizes | {"many": 50}).items():
        assert abs(took[name] - target[name]) <= max(1, min(64, size // 64)) + 0.5, name
    duck.agree(mixing.taken(mixing.mix(df)), duck.over_rows(documents=df), ORACLES["op5_sainte_lague_mix"])


def test_apportionment_equals_dealing_seats_one_by_one(spark):
    rng = random.Random(7)
    for seats in (0, 1, 17, 400):
        votes = [rng.choice([0, 1, 5, 5, 100, 10**6]) for _ in range(25)] + [3]
        dealt = [0] * len(votes)
        for _ in range(seats):
            best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * dealt[i] + 1), -i))
            dealt[best] += 1
        df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "party int, votes long, seats long")
        got = mixing.sainte_lague(df, [], "party", "votes", "seats").collect()
        assert sorted((r["party"], r["quota"]) for r in got) == list(enumerate(dealt))


def test_texts_hold_the_words_taken(spark):
    rows, df = docs_of(spark, 4, 80)
    df = df.selectExpr("*", "1 as start", "'own' as _key", "2 as _spans", "3 as _whole", "4 as _words")
    pieces = mixing.mix(df)
    want = Counter()
    for row in mixing.taken(pieces).collect():
        want[row["doc_id"]] += row["taken"]
    got = Counter()
    mixed = mixing.mixed_texts(df, pieces)
    assert mixed.columns == df.columns
    texts = {(id, text) for id, text, _ in rows}
    for row in mixed.collect():
        got[row["doc_id"]] += len(re.findall(mixing.WORD, row["text"]))
        assert any(id == row["doc_id"] and row["text"].split()[0] in text for id, text in texts if text)
    assert got == +want


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.taken(mixing.mix(empty)).collect() == []
    none = spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)
    assert sorted(map(tuple, mixing.taken(mixing.mix(none)).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
