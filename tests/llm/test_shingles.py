"""Near-duplicates by shingle sets against all pairs, with planted copies."""

import random

import pytest

import corpus_pipeline as cp
from cdcframe.llm import shingles, simhash


def brute_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_kept(rows):
    """The ids that stay, by all pairs. Ids are distinct."""
    sets, parent = [brute_set(text) for _, text in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    groups = {}
    for i, (id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(id)
    return sorted(min(ids) for ids in groups.values())


def planted(low, high, n, seed):
    """Pairs of texts whose similarity lies in [low, high)."""
    random.seed(seed)
    pairs = []
    while len(pairs) < n:
        words = [f"w{random.randrange(5000)}" for _ in range(random.choice((60, 200, 500)))]
        copy = list(words)
        for _ in range(random.randrange(1, 14)):
            copy[random.randrange(len(copy))] = f"x{random.randrange(999)}"
        if low <= similarity(brute_set(" ".join(words)), brute_set(" ".join(copy))) < high:
            pairs.append((" ".join(words), " ".join(copy)))
    return pairs


@pytest.mark.parametrize("low", [0.8, 0.85, 0.9])
def test_planted_copies_go(spark, low):
    pairs = planted(low, low + 0.05, 40, 3) + [(f"own text number {i}", f"quite other words {i}") for i in range(9)]
    rows = [(2 * i + k, pair[k], "en", "a", 0) for i, pair in enumerate(pairs) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = sorted(r["doc_id"] for r in cp.drop_near_duplicates(spark, docs, "").collect())
    assert kept == [2 * i for i in range(40)] + list(range(80, 98))


@pytest.mark.parametrize("cell", [1 << 18, 300])
def test_kept_equal_all_pairs(spark, cell):
    """Below and above the threshold, chains, case, spaces, short and empty texts."""
    pairs = planted(0.7, 0.8, 20, 5) + planted(0.8, 0.9, 20, 6)
    texts = [text for pair in pairs for text in pair]
    words = [f"c{i}" for i in range(100)]
    for step in range(12):  # each is near the next one only
        texts.append(" ".join(f"s{i}" if i < 5 * step else word for i, word in enumerate(words)))
    for _ in range(60):  # a group around the threshold
        texts.append(" ".join(f"g{random.randrange(999)}" if random.random() < 0.02 else word for word in words))
    texts += [None, "", " \n", "one two", "One\ttwo", "one two three", texts[0].upper()]
    random.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in shingles.keep_one(docs, cell=cell).collect()) == brute_kept(rows)


def test_exactly_the_threshold_links():
    words = [f"w{i}" for i in range(12)]
    assert similarity(brute_set(" ".join(words)), brute_set(" ".join([*words, "x", "y"]))) == 0.8
    a, b = shingles.shingle_set(" ".join(words).encode()), shingles.shingle_set(" ".join([*words, "x", "y"]).encode())
    assert (len(a), len(b), len(set(a.tolist()) & set(b.tolist()))) == (8, 10, 8)


def test_the_simhash_of_a_set():
    words = [f"w{i}" for i in range(90)]
    text = " ".join(words).encode()
    assert shingles.set_fingerprint(shingles.shingle_set(text)) == simhash.fingerprint(text, 5)
    assert shingles.set_fingerprint(shingles.shingle_set(b"")) == 0


def test_simhash_finds_the_first_candidates(spark):
    """Copies share a fingerprint, others are a few bits away: all are connected, and no others."""
    random.seed(4)
    prints = [random.getrandbits(63) for _ in range(40)]
    for value in prints[:20]:
        prints += [value, value ^ 0b1011, value ^ (1 << 40) ^ (1 << 3)]
    rows = [(node * 7 - 300, 5, value) for node, value in enumerate(prints)]
    pairs = shingles.simhash_pairs(spark.createDataFrame([*rows, (9999, 0, 0)], "node bigint, size bigint, fingerprint bigint"))
    parent = {row[0]: row[0] for row in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs.collect():
        assert a < b
        parent[find(a)] = find(b)
    found = {a[0]: find(a[0]) for a in rows}
    parent = {row[0]: row[0] for row in rows}
    for a in rows:
        for b in rows:
            if (a[2] ^ b[2]).bit_count() <= 4:
                parent[find(a[0])] = find(b[0])
    assert all((found[a[0]] == found[b[0]]) == (find(a[0]) == find(b[0])) for a in rows for b in rows)
