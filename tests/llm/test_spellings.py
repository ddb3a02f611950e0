"""Spelling variants against SQL, and near words against all pairs."""

import random
import zlib

import numpy as np
import pytest

from cdcframe.llm import spellings
from cdcframe.llm.queries import ORACLES
from tests.llm import duck

SCHEMA = "doc_id bigint, text string, lang string"
LETTERS = "abcdefghinorstÀßàé×ÿ"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(short == long[:i] + long[i + 1 :] for i in range(len(long)))


def edited(word, rng):
    at, letter = rng.randrange(len(word)), rng.choice(LETTERS)
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def vocabulary(n, seed, parts=("tion", "ing", "able", "en", "er", "st", "ou", "ié")):
    """Words of few syllables, so that many have equal letter counts, and words one edit off."""
    rng = random.Random(seed)
    made = {"".join(rng.choice(parts) for _ in range(rng.randrange(3, 6))) for _ in range(n)}
    made |= {edited(word, rng) for word in sorted(made)[: n // 2]}
    return {word: rng.choice([2, 3, 25, 26, 300]) for word in sorted(made) if word}


def brute_near(counts):
    out = {}
    for word, n in counts.items():
        others = [other for other in counts if other != word and near(word, other)]
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        out[word] = (n, len(others), best and (counts[best], best))
    return out


@pytest.mark.parametrize("cell, sample", [(40_000, 20_000), (60, 500), (9, 200)])
def test_near_words_equal_all_pairs(spark, cell, sample):
    counts = vocabulary(400, cell)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["n"], r["n_near"], r["best"] and tuple(r["best"])) for r in spellings.near_words(df, cell, sample).collect()}
    assert got == brute_near(counts)


def test_pairs_of_a_cell_are_met_once():
    words = sorted(vocabulary(300, 7))
    home, visitors = words[::2], words[1::2]
    got = sorted(tuple(sorted(map(int, pair))) for a, b in spellings.near_pairs(home, visitors) for pair in zip(a, b))
    both = home + visitors
    want = [(i, j) for i in range(len(both)) for j in range(i + 1, len(both)) if i < len(home) and near(both[i], both[j])]
    assert got == want


def test_every_near_word_is_visited():
    words = sorted(vocabulary(500, 11))
    lengths, counts = spellings._measured(words)
    tree = spellings.cell_tree(np.concatenate([lengths[:, None], counts], axis=1), 40)
    home, later = spellings.deal(tree, lengths, counts)
    visits = {(int(row), int(cell)) for rows, cells in later for row, cell in zip(rows, cells)}
    assert len(set(home)) > 20
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if near(a, b) and home[i] < home[j]:
                assert (i, home[j]) in visits
    assert len(visits) < len(words) * len(set(home)) / 3


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [word for word in vocabulary(60, seed) if len(word) > 4]
    shown = lambda word: rng.choice([word, word, word, word.title(), edited(word, rng)])
    rows = [(i, " ".join(shown(rng.choice(words[: 2 + i])) + rng.choice(["", ".", "1", "_"]) for _ in range(150)), "en") for i in range(n)]
    long = "Überaus" * 9000
    odd = [(None, f"{long} {long} nothing nothing", None), (70, None, "en"), (71, "", "en"), (72, "ÀÀÀÀÀÀÀ×÷×÷×÷×÷ ÀÀÀÀÀÀÀ " * 3, None)]
    return rows + odd + [(73, f"{long}x", "de")] * 2 + [(74, "absolute absolute absolute Ωabsolute absolutıon", "en")]


def brute_words(rows):
    counts = {}
    for id, text, _ in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "\u00c0" <= c <= "\u00ff":
                run += c.lower() if c < "\x80" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
                counts[word] = counts.get(word, 0) + 1
            run = ""
    return {word: n for word, n in counts.items() if n >= 2 and len(word) >= 7}


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_sql_and_plain_python(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as word", "2 as n", "3 as run").repartition(3)
    counted = spellings.words(df)
    assert {r["word"]: r["n"] for r in counted.collect()} == brute_words(rows)
    got = spellings.variants(counted, cell=50, sample=100)
    short = df.filter("length(text) < 50000 or text is null")  # the SQL spells words out letter by letter
    duck.agree(spellings.variants(spellings.words(short), cell=50), duck.over_rows(documents=short), ORACLES["op12_kd_tree_spellings"])
    counts = brute_words(rows)
    forms = {w: best[1] if best and best[0] >= 10 * n else None for w, (n, _, best) in brute_near(counts).items()}

    def root(word):
        return root(forms[word]) if forms[word] else word

    assert {r["word"]: (r["form"], r["root"]) for r in got.collect()} == {w: (forms[w], root(w)) for w in counts}
    assert sum(form is not None for form in forms.values()) > 5


def test_long_ways_to_the_root(spark):
    """Each word's form has ten times its n, and is one edit off."""
    chain = ["aaaaaaa"[:i] + "bbbbbbb"[i:] for i in range(8)]
    df = spark.createDataFrame([(word, 2 * 10**i) for i, word in enumerate(chain)], "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["form_n"]) for r in spellings.variants(df).collect()}
    assert got[chain[0]] == (chain[1], chain[-1], 20) and got[chain[-1]] == (None, chain[-1], None)


def test_no_words(spark):
    none = spark.createDataFrame([(1, "short words only", "en")], SCHEMA)
    assert spellings.variants(spellings.words(none)).collect() == []
    assert spellings.variants(spellings.words(none.limit(0))).collect() == []
