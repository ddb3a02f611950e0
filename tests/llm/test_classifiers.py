"""Quality, toxicity and language: held-out accuracy on the given tables, and edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cdcframe.llm import fitting, language, quality, toxicity
from cdcframe.llm.common import remainder
from cdcframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"
EDGES = [(1, None), (2, ""), (3, "123 !!"), (4, "word " * 200_000), (4, "word " * 200_000), (None, "no id")]


@pytest.mark.parametrize(
    "name, label, accuracy",
    [("op2_quality_compression", "quality", 0.97), ("op4_toxicity_lexicon", "toxic", 0.96)],
)
def test_held_out_labels(spark, name, label, accuracy):
    got = QUERIES[name](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(got) == docs.count()
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    joined = got[got.held_out].merge(labels, on="doc_id")
    assert (joined.predicted == joined[label]).mean() > accuracy


def test_held_out_languages(spark):
    got = QUERIES["op8_language_backoff"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    joined = got[got.held_out].merge(docs, on="doc_id")
    assert len(got) == len(docs) and (joined.lang_pred == joined.lang).mean() > 0.97


def test_held_out_rows_are_not_learnt_from(spark):
    learn = remainder("doc_id", 4) != 2
    rows = [(i, "the quick brown fox jumps " * 20, i % 2, i % 2) for i in range(200)]
    out = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    changed = df.withColumn("text", F.when(F.col("doc_id").isin(out), "zap zap").otherwise(F.col("text")))
    one = quality.fit_quality(df.select("doc_id", "text"), df, learn)
    two = quality.fit_quality(changed.select("doc_id", "text"), df, learn)
    assert (one.good, one.bad, one.coefficients.tolist()) == (two.good, two.bad, two.coefficients.tolist())


def test_scores_without_labels_and_odd_texts(spark):
    docs, none = spark.createDataFrame(EDGES, DOCS), spark.createDataFrame([], LABELS)
    learn = F.lit(True)
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        assert {row["score"] for row in score(docs, fit(docs, none, learn)).collect()} == {0.5}
        for value in (0, 1):
            labels = spark.createDataFrame([(1, value, value), (4, value, value), (None, value, value), (9, None, None)], LABELS)
            scores = [row["score"] for row in score(docs, fit(docs, labels, learn)).collect()]
            assert len(scores) == len(EDGES) and all((s > 0.5) == bool(value) for s in scores)
        empty = docs.limit(0)
        assert score(empty, fit(empty, none, learn)).collect() == []
    wide = docs.selectExpr("*", "1 as score", "2 as label", "3 as slot")
    assert quality.score_quality(wide, quality.fit_quality(wide, none, learn)).columns == ["doc_id", "score"]
    model = quality.fit_quality(docs, none, learn)
    assert quality.keep_good(wide, model, threshold=0.5).columns == wide.columns
    assert quality.keep_good(docs, model, threshold=0.6).count() == 0


def test_whole_texts_count(spark):
    """What stands at the end of a very long text decides."""
    matcher = toxicity.Matcher({"scum": 5.0, "veq*": 3.0})
    assert matcher.find("fine " * 300_000 + "scum") == [(1_500_000, 1_500_004, 5.0)]
    assert matcher.features(["a " * 1000 + "scum"])[0, 1] < matcher.features(["a scum"])[0, 1]


def test_lexicon_matching():
    matcher = toxicity.Matcher({"idiot": 6.0, "trash": 6.0, "vequ*": 4.0}, exceptions=("trash can",))
    found = lambda text: [text[a:b] for a, b, _ in matcher.find(text)]
    assert found("You IDIOT!!") == ["IDIOT"]
    assert found("1d10t, іdiоt tr@$h") == ["1d10t", "іdiоt", "tr@$h"]
    assert found("idiotic trashy Vequai vequ unvequ") == ["Vequ", "vequ"]
    assert found("a trash can, the Trash cans, trash") == ["Trash", "trash"]
    assert toxicity.Matcher({}).find("idiot") == []


def test_lexicon_prefers_what_says_most():
    found = {"idiot": (100, 6.0), "idio*": (100, 6.0), "vequ*": (90, 5.0), "vequa": (20, 4.0), "veque*": (30, 4.0)}
    assert toxicity._lexicon(found) == {"idiot": 6.0, "vequ*": 5.0}


def test_language_backs_off(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house there", "en"), ("das haus dort", "de"), ("x y", None)] * 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit_language(docs, F.lit(True))
    assert model.languages == ["de", "en"]
    scorer = language.Scorer(model)
    assert scorer.predict("the")[0] == "en" and scorer.predict("hausen")[0] == "de" and scorer.predict("thereby")[0] == "en"
    assert scorer.predict("ж") == ("de", 0.5) and scorer.predict("12 !") == ("und", 0.0) and scorer.predict(None) == ("und", 0.0)
    odd = spark.createDataFrame(EDGES, DOCS).selectExpr("*", "1 as lang_pred")
    got = [tuple(row) for row in language.predict_language(odd, model).collect()]
    assert [row[0] for row in got] == [id for id, _ in EDGES] and [row[1] for row in got[:3]] == ["und"] * 3
    nothing = language.fit_language(docs.limit(0), F.lit(True))
    assert {row["lang_pred"] for row in language.predict_language(odd, nothing).collect()} == {"und"}
    assert language.predict_language(odd.limit(0), model).collect() == []


SMALL = "/root/testdata/sf0.001"


def sigmoid(coefficients, *features):
    return 1 / (1 + math.exp(-sum(c * x for c, x in zip(coefficients, (1, *features)))))


def test_quality_equals_plain_compression(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit_quality(docs, labels, F.lit(True))
    texts = {row["doc_id"]: (row["text"] or "").encode() for row in docs.collect()}

    def size(piece, dictionary):
        given = zstandard.ZstdCompressionDict(dictionary)
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=3, dict_data=given, **options).compress(piece))

    got = {row["doc_id"]: row["score"] for row in quality.score_quality(docs, model).collect()}
    assert got.keys() == texts.keys()
    for id, text in texts.items():
        pieces = [text[at : at + 1024] for at in range(0, len(text), 1024)]
        saved = sum(size(piece, model.bad) - size(piece, model.good) for piece in pieces)
        assert got[id] == pytest.approx(sigmoid(model.coefficients, saved / (len(text) + 32), math.log1p(len(text))), abs=1e-9)


def test_quality_learns_from_whole_texts(spark):
    """What tells the classes apart stands between 40 and 90 percent of long texts, each time somewhere else."""
    def made(i, word):
        body = [f"w{(i * 7919 + j * 104729) % 99991}" for j in range(3000)]
        for j in range(40):
            body[1200 + (i * 37 + j * 41) % 1500] = f"{word} phrase of {word} kind with {word} words"
        return " ".join(body)

    rows = [(i, made(i, ("wretched", "splendid")[i % 2]), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.fit_quality(df.select("doc_id", "text"), df, F.lit(True))
    assert b"splendid words" in model.good and b"wretched" not in model.good
    assert b"wretched words" in model.bad and b"splendid" not in model.bad
    assert max(len(model.good), len(model.bad)) <= quality.DICTIONARY_BYTES


def test_dictionary_of_little_or_one_kind_of_text():
    assert quality._dictionary([], 100) == b"" and quality._dictionary([b"ab", b"c"], 3) == b"abc"
    assert b"word word" in quality._dictionary([b"word " * 200] * 500, 16384)


def test_draw_is_the_first_by_hash(spark):
    """Also of a group with nearly all rows, and of groups smaller than the draw."""
    rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 1000 == 0, "few").otherwise("most").alias("kind"))
    hashed = rows.withColumn("h", F.xxhash64(F.lit(1), "id")).collect()
    for n in (5, 700):
        want = {}
        for kind in ("few", "most"):
            ids = [row["id"] for row in sorted(hashed, key=lambda row: row["h"]) if row["kind"] == kind][:n]
            want |= {(kind, slot): id for slot, id in enumerate(ids)}
        assert {(r["kind"], r["slot"]): r["id"] for r in fitting.draw(rows, "kind", "id", n).collect()} == want


def plain_weights(text, lexicon, exceptions):
    """The weight of each entry at each place where it stands, outside exceptions."""
    plain = [c for c in text.lower()]
    folded = "".join(toxicity.HOMOGLYPHS.get(c, c) for c in plain)
    found, harmless = set(), set()
    for line in (folded, "".join(toxicity.DIGITS.get(c, c) for c in folded)):
        for entry in [*lexicon, *exceptions]:
            word = entry.removesuffix("*")
            after = "" if word != entry else r"(?![^\W_])"
            for match in re.finditer(rf"(?<![^\W_])(?={re.escape(word)}{after})", line):
                (found if entry in lexicon else harmless).add((match.start(), match.start() + len(word), lexicon.get(entry)))
    return [w for a, b, w in found if not any(x <= a and b <= y for x, y, _ in harmless)]


def test_toxicity_equals_plain_search(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels, F.lit(True))
    model.lexicon = model.lexicon | {"idiot": 6.0, "stupid": 5.0, "trash": 4.5, "scum*": 4.0}
    odd = ["1d10t", "a trash can; tr@sh, trashcan", "SCUMMY pond scum scums", "іdiоt stupid question stupid", "st0p1d stup1d!", "", None]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(-i, t) for i, t in enumerate(odd, 1)], DOCS))
    texts = {row["doc_id"]: row["text"] or "" for row in docs.collect()}
    got = {row["doc_id"]: row["score"] for row in toxicity.score_toxicity(docs, model).collect()}
    assert got.keys() == texts.keys()
    hits = 0
    for id, text in texts.items():
        total = sum(plain_weights(text, model.lexicon, model.exceptions))
        hits += total > 0
        features = (math.log1p(total), math.log1p(100 * total / max(1, len(text.split())))) if total else (0, 0)
        assert got[id] == pytest.approx(sigmoid(model.coefficients, *features), abs=1e-9)
    assert hits > 10


def test_language_equals_plain_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    learnt = [row for row in rows if zlib.crc32(str(row["doc_id"]).encode()) % 3 != 1 and row["lang"]]
    counts = {n: defaultdict(Counter) for n in range(6)}  # whole words at 0
    for row in learnt:
        for word in re.findall(r"[^\W\d_]+", (row["text"] or "").lower()):
            counts[0][word][row["lang"]] += 1
            for n in range(1, 6):
                line = f" {word} " if n > 1 else word
                for at in range(len(line) - n + 1):
                    counts[n][line[at : at + n]][row["lang"]] += 1
    languages = sorted({row["lang"] for row in learnt if re.search(r"[^\W\d_]", row["text"] or "")})
    totals = {n: {l: sum(by[l] + 0.5 for by in entries.values()) for l in languages} for n, entries in counts.items()}

    def scores(n, entry):
        shares = [(counts[n][entry][l] + 0.5) / totals[n][l] for l in languages]
        return np.log(np.array(shares) / sum(shares))

    def unseen(word):
        for n in range(5, 0, -1):
            line = f" {word} " if n > 1 else word
            known = [line[at : at + n] for at in range(len(line) - n + 1) if line[at : at + n] in counts[n]]
            if known:
                return np.mean([scores(n, gram) for gram in known], axis=0)
        return np.zeros(len(languages))

    model = language.fit_language(docs, remainder("doc_id", 3) != 1)
    assert model.languages == languages and len(model.words) == len(counts[0])
    assert {n: len(known) for n, known in model.grams.items()} == {n: len(counts[n]) for n in range(1, 6)}
    got = {row["doc_id"]: row for row in language.predict_language(docs, model).collect()}
    backed_off = 0
    for row in rows:
        words = Counter(re.findall(r"[^\W\d_]+", (row["text"] or "").lower()))
        if not words:
            assert got[row["doc_id"]]["lang_pred"] == "und"
            continue
        backed_off += any(word not in counts[0] for word in words)
        total = sum(n * (scores(0, word) if word in counts[0] else unseen(word)) for word, n in words.items())
        posterior = np.exp(total - total.max())
        best = int(total.argmax())
        score = 1 / posterior.sum()
        assert got[row["doc_id"]]["score"] == pytest.approx(score, abs=1e-3)
        if score > 0.51:
            assert got[row["doc_id"]]["lang_pred"] == languages[best]
    assert backed_off > 10


def test_a_repeated_id_counts_once(spark):
    """One id on a third of all rows is drawn once, with its smallest text, and takes no other's place."""
    rows = [(0, f"veq {i}", "xx") for i in range(50)] + [(i, f"haus {i}", "xx") for i in range(1, 20)] + [(20, None, "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.select("doc_id").distinct().withColumn("quality", F.lit(1))
    sample, counts = fitting.labelled_sample(docs.select("doc_id", "text"), labels, "quality", F.lit(True), 21)
    texts = {row["doc_id"]: row["text"] for row in sample.collect()}
    assert counts == {1: 21} and sample.count() == 21 and texts[0] == "veq 0" and texts[20] is None
    model = language.fit_language(docs, F.lit(True), per_language=21)
    assert model.words.keys() == {"veq", "haus"}
    one = language.fit_language(docs.dropDuplicates(["doc_id"]).replace({f"veq {i}": "veq 0" for i in range(50)}, subset="text"), F.lit(True))
    assert model.words == one.words and np.array_equal(model.word_scores, one.word_scores)


def test_logistic_regression_finds_known_coefficients():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20000, 2))
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(int)
    assert np.allclose(fitting.logistic(x, y, np.ones(len(y))), [0.5, 2, -1], atol=0.1)
