"""SimHash near-duplicates against all pairs."""

import random

import pytest
import xxhash

from cdcframe.llm import simhash


def brute_fingerprint(text, shingle=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    prints = [brute_fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            least[find(i)] = min(id, least.get(find(i), id))
    return sorted(((id, f"{prints[i]:016x}", least.get(find(i))) for i, (id, _) in enumerate(rows)), key=repr)


def near_texts(seed, groups=12):
    random.seed(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{random.randrange(5000)}" for _ in range(random.choice((3, 6, 40, 200)))]
        for _ in range(random.randrange(1, 6)):
            copy = list(words)
            for _ in range(random.randrange(3)):
                copy[random.randrange(len(copy))] = f"x{random.randrange(99)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_components_equal_all_pairs(spark, bucket_rows):
    rows = near_texts(5) + [(900, None), (901, ""), (902, " \n"), (903, "ÀB c"), (None, "lost id"), (7, "w1 w2"), (7, "w1 w2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.near_duplicates(df, bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_spark_hashes_alike(spark):
    df = spark.createDataFrame([(1, "Äb c\td")], "doc_id bigint, text string")
    assert df.selectExpr("xxhash64('Äb c d') as h").first()[0] % 2**64 == xxhash.xxh64_intdigest("Äb c d".encode(), 42)
    assert simhash.fingerprints(df).first()["fingerprint"] % 2**64 == xxhash.xxh64_intdigest("Äb c d".encode(), 42)


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(4)
    random.seed(1)
    for _ in range(3000):
        difference = sum(1 << bit for bit in random.sample(range(64), 4))
        outer = [mask for mask in masks if mask & difference == 0]
        assert outer
        free = ~outer[0] & (1 << 64) - 1
        assert any((mask | outer[0]) & difference == 0 for mask in simhash.covering_masks(4, free))
    assert all(30 <= mask.bit_count() <= 34 for mask in masks)


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).collect() == []
    clash = spark.createDataFrame([(3, "a b", 1, 2, "x")], "doc_id bigint, text string, fingerprint int, component_id int, node string")
    assert [row["component_id"] for row in simhash.near_duplicates(clash).collect()] == [3]


def test_one_of_each_group_stays(spark):
    rows = near_texts(6) + [(900, None), (901, ""), (7, "w1 w2"), (7, "w1 w2"), (7, "other words"), (None, "lost id"), (None, "lost id")]
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "doc_id bigint, text string, fingerprint int")
    kept = simhash.keep_one(df, bucket_rows=3)
    assert kept.columns == df.columns
    parent = brute_components([(i, text) for i, (_, text) in enumerate(rows)])
    groups = {}
    for i, _, component in parent:
        groups.setdefault(component, []).append(i)
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    least = sorted((order(min(group, key=order)) for group in groups.values()))
    assert sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in kept.collect()) == least
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_dense_bucket_is_not_paired(spark):
    """A chain of fingerprints one bit apart in one bucket: links grow with the members."""
    values = [(i ^ (i >> 1),) for i in range(3000)]  # neighbours differ in one bit
    df = spark.createDataFrame(values, "fingerprint bigint")
    links = simhash.near_links(df, bucket_rows=500).count()
    assert links < 31 * 31 * 3000
    from cdcframe.llm.components import connected

    assert {row["root"] for row in connected(simhash.near_links(df, bucket_rows=500)).collect()} == {0}
