"""License scan against SQL that compares every block with every template."""

import random

from cdcframe.llm import licenses
from cdcframe.llm.queries import ORACLES
from tests.llm import duck


def noisy(rng, sentence):
    words = sentence.split()
    for _ in range(rng.randrange(5)):
        words[rng.randrange(len(words))] = rng.choice(["x", "the", "License", "ünder"])
    return " ".join(words)


def texts(seed):
    rng = random.Random(seed)
    fill = ["the", "of", "software", "license", "cc", "by", "BY", "mit", "work", "copy", "é", "İ", "Kind", "public", "free", "use"]
    out = [None, "", "MIT License", "mit-license MIT\nLICENSE", "GNU General Public License apache license cc by", "cc by by cc by"]
    for _ in range(150):
        parts = [rng.choice(fill) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), noisy(rng, rng.choice(licenses.TEMPLATES)[1]))
        out.append(rng.choice([" ", "\n", ", "]).join(parts))
    return out


def test_query_equals_sql(spark):
    rows = [(i, text) for i, text in enumerate(texts(3))] + [(0, "MIT License"), (0, "MIT License"), (None, "cc by")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = licenses.digest(licenses.scan_licenses(df))
    result = duck.agree(got, duck.over_rows(documents=df), ORACLES["op3_license_scan"])
    assert len(result) == len(rows)
    assert {row[-1] for row in result} > {0.0, 1.0}  # and templates without a phrase
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_template_across_block_ends(spark):
    _, sentence = next(t for t in licenses.TEMPLATES if t[0] == "bsd")
    rows = [(n, "word " * n + sentence) for n in range(70)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(row["labels"] == ["bsd"] and row["score"] == 1.0 for row in licenses.scan_licenses(df).collect())


def labels(spark, *texts, templates=licenses.TEMPLATES):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [row["labels"] for row in licenses.scan_licenses(df, templates=templates).orderBy("doc_id").collect()]


def test_licenses_of_a_family_are_told_apart(spark):
    under = "under the terms of the GNU {} Public License as published by the Free Software Foundation"
    by = "This work is licensed under a Creative Commons {} 4.0 International License"
    got = labels(
        spark,
        "you can redistribute it and/or modify it " + under.format("General"),
        "you can redistribute it and/or modify it " + under.format("Lesser General"),
        "you can redistribute it and/or modify it " + under.format("Affero General"),
        "Released under the Apache License",
        by.format("Attribution"),
        by.format("Attribution-ShareAlike"),
        f"{by.format('Attribution')}. {by.format('Attribution-ShareAlike')}.",
        f"{under.format('Lesser General')} or {under.format('Affero General')}",
    )
    assert got == [["gpl"], ["lgpl"], ["agpl"], ["apache"], ["cc-by"], ["cc-by-sa"], ["cc-by", "cc-by-sa"], ["agpl", "lgpl"]]


def test_whole_license_texts_are_templates(spark):
    """Of 33, 100 and 700 words, copied with a twentieth of the words changed, beginning anywhere; and SQL agrees."""
    rng = random.Random(5)
    templates = licenses.TEMPLATES + tuple((f"own-{n}", " ".join(f"W{rng.randrange(n)}é" for _ in range(n))) for n in (33, 100, 700))
    assert [licenses.stride_of(t) for _, t in templates[-3:]] == [64, 128, 1024]
    rows, expected = [], []
    for label, sentence in templates[-3:]:
        words = sentence.split()
        for before in (0, 1, 31, 63, 64, 500, 1023, 1500):
            copy = [w if rng.random() > 0.05 else "other" for w in words]
            rows.append((len(rows), " ".join(["fill"] * before + copy + ["fill"] * rng.randrange(90))))
            expected.append(label)
        rows.append((len(rows), " ".join(words[: len(words) // 2])))
        expected.append("")
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = licenses.digest(licenses.scan_licenses(df, templates=templates))
    duck.agree(got, duck.over_rows(documents=df), licenses.sql(templates))
    assert [row["labels"] for row in got.orderBy("doc_id").collect()] == expected
    assert labels(spark, "MIT License", "none", templates=(("x", " ;"),)) == [["mit"], []]


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert licenses.scan_licenses(empty).collect() == []
    clash = spark.createDataFrame([("k", "MIT license", 1, 2, 3)], "doc_id string, text string, row int, words int, label int")
    row = licenses.digest(licenses.scan_licenses(clash)).first()
    assert (row["doc_id"], row["n_words"], row["first_word"], row["labels"]) == ("k", 2, 0, "mit")
