"""Row numbers, pages and resuming of the change log against sorting all rows."""

import hashlib
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cdcframe import consume, log_after, log_page, number_batches, number_rows, parse_position, read_log
from cdcframe.files import Files
from cdcframe.sources import log as log_module
from cdcframe.sources.feed import ACTION, CONSUMED_AT, IS_UPDATE, ROW_ID
from cdcframe.sources.log import ROW_NUMBER, in_ranges
from tests.inspect_plan import plan

AT = datetime(2024, 5, 1, 23, 59, 59, tzinfo=timezone.utc)


def feed(spark, low, high):
    half = "id k, case when id % 3 = 0 then 'DELETE' else 'INSERT' end `METADATA$ACTION`, id % 2 = 0 `METADATA$ISUPDATE`"
    return spark.range(low, high).selectExpr(*half.split(", "), "sha2(cast(id div 2 as string), 256) `METADATA$ROW_ID`")


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    for n, (low, high) in enumerate([(0, 500), (500, 503), (503, 503), (503, 1200)]):
        assert consume(feed(spark, low, high), path, n, AT + timedelta(hours=n))
    return path


@pytest.fixture(scope="module")
def log(spark, path):
    return read_log(spark, path)


def in_order(log):
    rows = [(r[CONSUMED_AT], digest(r[ROW_ID]), r[ROW_ID], r[IS_UPDATE], r[ACTION], r["k"]) for r in log.collect()]
    return [row[-1] for row in sorted(rows)]


def digest(row_id):
    return hashlib.md5(row_id.encode()).hexdigest()


def test_numbers(log):
    rows = {r[ROW_NUMBER]: r["k"] for r in log.collect()}
    assert [rows[n] for n in range(1200)] == in_order(log)


def test_batches(log):
    for row in number_batches(log, 100).collect():
        assert row["batch_id"] + row["index_in_batch"] == row[ROW_NUMBER] and row["batch_id"] % 100 == 0
        assert 0 <= row["index_in_batch"] < 100


def test_pages(spark, path, log):
    order = in_order(log)
    for offset in (0, 450, 499, 502, 1100, 1200, 5000):
        assert [r["k"] for r in log_page(spark, path, offset, 130).collect()] == order[offset : offset + 130]


def test_a_page_opens_only_its_files(spark, path):
    """Files without rows of the page may as well not be there."""
    whole, page = read_log(spark, path).inputFiles(), log_page(spark, path, 490, 20)
    assert 0 < len(page.inputFiles()) < len(whole)
    assert len(read_log(spark, path, first=1199).inputFiles()) == 1
    assert len(read_log(spark, path, consume_id=1).inputFiles()) <= 3


def test_the_index_is_found_by_halving(spark, folder, monkeypatch):
    for n in range(16):
        consume(feed(spark, 10 * n, 10 * n + 10), folder, n, AT + timedelta(hours=n))
    opened, entries = [], log_module._entries
    monkeypatch.setattr(log_module, "_entries", lambda files, path, n: opened.append(n) or entries(files, path, n))
    assert [r[ROW_NUMBER] for r in read_log(spark, folder, first=153, end=155).orderBy(ROW_NUMBER).collect()] == [153, 154]
    assert len(opened) <= 6


def test_many_files_are_numbered_in_order(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, parts in enumerate([37, 1, 200]):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            consume(feed(spark, n * 2000, n * 2000 + 2000), folder, n, AT + timedelta(days=n))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    log = read_log(spark, folder)
    rows = {r[ROW_NUMBER]: r["k"] for r in log.collect()}
    assert [rows[n] for n in range(6000)] == in_order(log)


@pytest.mark.parametrize("index,batch", [(0, 0), (99, 400), (2, 500), (99, 1100)])
def test_resume(spark, path, log, index, batch):
    position = parse_position(f'{{"IteratorType":"c","IndexInBatch":{index},"BatchID":{batch}}}')
    rest = log_after(spark, path, position, 100).orderBy(ROW_NUMBER).collect()
    assert [r["k"] for r in rest] == in_order(log)[batch + index + 1 :]
    assert log_after(spark, path, None, 100).count() == 1200


def test_resume_needs_a_log_position(spark, path):
    with pytest.raises(ValueError):
        log_after(spark, path, parse_position('{"IteratorType":"s","SnapshotLastProcessedVal":3}'), 100)


def test_any_row_ids_are_numbered_in_order_and_spread(spark, folder):
    """Ids from elsewhere: short, of mixed case, with one beginning."""
    ids = ["zz00", "8000", "FFFF", "0001", "", "é", "Zz00"] + [f"same-beginning-{n}" for n in range(500)]
    rows = [(n, "INSERT", False, row_id) for n, row_id in enumerate(ids)]
    changes = spark.createDataFrame(rows, f"k bigint, `{ACTION}` string, `{IS_UPDATE}` boolean, `{ROW_ID}` string")
    consume(changes, folder, 0, AT)
    log = read_log(spark, folder)
    numbered = {r[ROW_NUMBER]: r["k"] for r in log.collect()}
    assert [numbered[n] for n in range(len(ids))] == in_order(log) == sorted(range(len(ids)), key=lambda n: digest(ids[n]))
    sizes = [entry.rows for entry in log_module._entries(Files(spark, folder), folder, 0)]
    assert len(sizes) > 1 and max(sizes) < 2 * len(ids) / len(sizes)


def test_a_change_without_a_row_id_is_refused(spark, folder):
    changes = feed(spark, 0, 5).selectExpr("k", f"`{ACTION}`", f"`{IS_UPDATE}`", f"cast(null as string) `{ROW_ID}`")
    with pytest.raises(Exception, match="no row id"):
        consume(changes, folder, 0, AT)


def test_a_page_is_a_top_k(spark, path):
    assert "TakeOrderedAndProject" in plan(log_page(spark, path, 100, 50))


def test_repeating_a_consume_duplicates_nothing(spark, folder):
    assert [consume(feed(spark, 0, 50), folder, 7, AT) for _ in range(2)] == [True, False]
    assert read_log(spark, folder).count() == 50


def test_a_consume_that_failed_before_its_index_counts_for_nothing(spark, folder, monkeypatch):
    consume(feed(spark, 0, 20), folder, 0, AT)
    with monkeypatch.context() as broken:
        broken.setattr(Files, "write_text", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            consume(feed(spark, 20, 50), folder, 1, AT)
    assert len(os.listdir(f"{folder}/data")) == 2 and read_log(spark, folder).count() == 20
    assert consume(feed(spark, 20, 50), folder, 1, AT)
    numbers = sorted(r[ROW_NUMBER] for r in read_log(spark, folder).collect())
    assert numbers == list(range(50))


@pytest.mark.parametrize("rows_per_range", [10**6, 40, 3])
def test_any_rows_are_numbered_in_order(spark, rows_per_range):
    rows = [(None if n % 50 == 0 else f"k{n * n % 7}", n * 7919 % 1000, n) for n in range(1000)]
    df = spark.createDataFrame(rows, "a string, b int, c long").repartition(5)
    numbered, count = number_rows(df, ["a", "b", "c"], "n", first=10, rows_per_range=rows_per_range)
    got = {r["n"]: r["c"] for r in numbered.collect()}
    want = [c for *_, c in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))]
    assert count == 1000 and [got[n + 10] for n in range(1000)] == want
    if rows_per_range < 1000:  # not in one task, and no range holds much more than its share
        tasks = numbered.groupBy(F.spark_partition_id()).count().count()
        assert "SinglePartition" not in plan(numbered) and tasks > 1


def test_numbering_ties_and_no_rows(spark):
    same = spark.createDataFrame([(1,)] * 200, "a int")
    numbered, count = number_rows(same, "a", "n", rows_per_range=10)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(200)) and count == 200
    numbered, count = number_rows(same.limit(0), "a", "n")
    assert numbered.collect() == [] and count == 0


def test_an_earlier_consume_cannot_be_replaced(spark, folder):
    consume(feed(spark, 0, 5), folder, 2, AT)
    with pytest.raises(ValueError):
        consume(feed(spark, 0, 5), folder, 1, AT)


def test_empty_log(spark, folder):
    consume(feed(spark, 0, 0), folder, 0, AT)
    log = read_log(spark, folder)
    assert log.count() == 0 and log_page(spark, folder, 0, 10).count() == 0
    assert set(log.columns) == {"k", ACTION, IS_UPDATE, ROW_ID, CONSUMED_AT, ROW_NUMBER}
    with pytest.raises(FileNotFoundError):
        read_log(spark, f"{folder}/none")


def test_consume_needs_a_zone(spark, folder):
    with pytest.raises(ValueError):
        consume(feed(spark, 0, 1), folder, 0, datetime(2024, 1, 1))


def test_a_change_takes_one_row_id_of_room_in_the_shuffle(spark):
    """Neither its digest nor the text of its hex digits goes through; any text comes out as it was."""
    ids = ["ABCD", "abcd", "abc", "", "00", "zz", "0aBc", "ünï"] + [digest(str(n)) for n in range(50)]
    rows = [(n, "INSERT", False, name) for n, name in enumerate(ids)]
    changes = spark.createDataFrame(rows, f"k bigint, `{ACTION}` string, `{IS_UPDATE}` boolean, `{ROW_ID}` string")
    ranged = in_ranges(changes, 4)
    before = plan(ranged).split("Exchange", 1)[1]
    assert "_packed" in before and "_digest" not in before
    got = [(r["k"], r[ROW_ID], r["_digest"]) for r in ranged.collect()]
    assert got == sorted(((n, name, digest(name)) for n, name in enumerate(ids)), key=lambda row: (row[2], row[1]))


def test_the_sort_of_a_consume_holds_no_texts_of_row_ids(spark):
    text = plan(in_ranges(feed(spark, 0, 100), 4))
    below = text[text.index("Sort [") :].splitlines()[1]
    assert "Sort [_leading" in text and "_leading" in below and "_digest" not in below and ROW_ID not in below


def test_equal_leading_digits_are_told_apart_by_the_rest(spark, monkeypatch):
    monkeypatch.setattr(log_module, "_LEADING", 1)
    rows = [(n, "INSERT" if n % 2 else "DELETE", True, digest(str(n // 2)) if n % 3 else f"zz{n}") for n in range(400)]
    changes = spark.createDataFrame(rows, f"k bigint, `{ACTION}` string, `{IS_UPDATE}` boolean, `{ROW_ID}` string")
    got = [(r["_digest"], r[ROW_ID], r[ACTION], r["k"]) for r in in_ranges(changes, 3).collect()]
    assert got == sorted((digest(row_id), row_id, action, n) for n, action, _, row_id in rows)
