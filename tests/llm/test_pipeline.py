"""The pipeline against plain Python, stage by stage on the smallest tables, and on odd rows."""

import pytest

import corpus_pipeline as cp
from cdcframe.llm import mixing, quality, secrets
from cdcframe.llm.common import remainder, stored, table
from tests.llm.test_packing import check
from tests.llm.test_shingles import brute_kept

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["documents"] = docs
    for name, stage in cp.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), "stage")
    return out


def test_quality_stage(spark, stages):
    docs = stages["documents"]
    model = quality.fit_quality(docs, table(spark, SF, "labels"), remainder("doc_id", 4) != 2)
    good = {r["doc_id"] for r in quality.score_quality(docs, model).collect() if r["score"] >= 0.7}
    want = [r for r in docs.select(*cp.COLUMNS).collect() if r["doc_id"] in good]
    assert rows_of(stages["quality classifier"]) == sorted(map(tuple, want), key=repr)
    assert 0 < len(want) < docs.count()


def test_near_duplicate_stage(stages):
    before = stages["quality classifier"].collect()
    keep = set(brute_kept([(r["doc_id"], r["text"]) for r in before]))
    want = [tuple(r) for r in before if r["doc_id"] in keep]
    assert rows_of(stages["SimHash near-dedup"]) == sorted(want, key=repr)


def test_secret_stage(stages):
    want = []
    for r in stages["SimHash near-dedup"].collect():
        text = secrets.mask(r["text"])
        want.append((r["doc_id"], text, r["lang"], r["source"], None if text is None else len(text)))
    assert rows_of(stages["secret scans"]) == sorted(want, key=repr)


def test_mixing_stage(stages):
    docs = stages["secret scans"]
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(mixing.mix(docs)).collect()}
    got = dict.fromkeys(taken, 0)
    texts = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    for r in stages["mixing sources to target weights"].collect():
        words = r["text"].split()
        got[r["doc_id"]] += len(words)
        assert set(words) <= set(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert got == taken


def test_packing_stage(stages):
    pieces = stages["packing"].collect()
    _, padding = check([(r["doc_id"], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in pieces], 2048)
    assert padding == 0 and all(len(r["ids"]) == 4 * r["length"] for r in pieces)
    mixed = stages["mixing sources to target weights"]
    assert len({r["doc_id"] for r in pieces}) == mixed.select("doc_id").distinct().count()


def test_all_but_the_last_return_documents(stages):
    for name, _ in cp.STAGES[:-1]:
        assert stages[name].columns == cp.COLUMNS and stages[name].dtypes == stages["documents"].dtypes


def test_run(spark, stages):
    # Groups of the last stage are drawn by row number, so its sequences may differ; the ids they hold may not.
    total = lambda df: sum(r["length"] for r in df.select("length").collect())
    assert total(cp.run(spark, SF)) == total(stages["packing"])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, tmp_path, empty):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, label int, _key string, spans int"
    text = "secret: abcdefg " * 3000
    rows = [(1, None, None, None, None, 1, "k", 2), (2, "", "en", "a", 0, 1, "k", 2), (None, "x y z", None, "a", 5, 1, "k", 2)]
    rows += [(3, text, "en", "a", len(text), 0, "k", 0)] * 2 + [(4, text, None, "b", None, None, None, None)]
    spark.createDataFrame([] if empty else rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [] if empty else [(3, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES:  # each on the odd rows themselves
        out = stage(spark, docs, str(tmp_path)).count()
        assert out == 0 or not empty
    kept = cp.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == ([] if empty else ["1", "3", "None"])
    cp.run(spark, str(tmp_path)).count()

