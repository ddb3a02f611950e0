"""The stream gives what the same batches give, and survives being stopped and repeated."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import cdcframe as c
from cdcframe import TargetTable, apply_batch, run_to_end, stream_append, stream_apply, stream_changes
from cdcframe.files import Files
from cdcframe.sources.log import ROW_NUMBER
from cdcframe.streaming import stream as stream_module
from tests.test_merge import random_batch
from tests.test_table import PAYLOAD, rows


def test_stream_equals_batches(spark, folder):
    table, expected = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4), None
    for n in range(3):
        batch = random_batch(spark, n, 120, 60)
        batch.write.parquet(f"{folder}/in/{n}")
        stream = stream_changes(spark, f"{folder}/in/*", batch.schema)
        run_to_end(stream_apply(stream, table, f"{folder}/cp"))
        expected = apply_batch(expected, batch, "id")
        assert rows(table.read()) == rows(expected)
    run_to_end(stream_apply(stream, table, f"{folder}/cp"))
    assert rows(table.read()) == rows(expected)


def test_files_go_in_the_order_they_were_written(spark, folder):
    table, expected = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4), None
    for n in range(3):
        batch = random_batch(spark, n, 60, 40)
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        expected = apply_batch(expected, batch, "id")
    stream = stream_changes(spark, f"{folder}/in", batch.schema, max_files=1)
    run_to_end(stream_apply(stream, table, f"{folder}/cp"))
    assert table.version == 3 and rows(table.read()) == rows(expected)


def test_a_failed_batch_is_taken_again(spark, folder, monkeypatch):
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4)
    batch = random_batch(spark, 1, 60, 40)
    batch.write.parquet(f"{folder}/in")
    stream = stream_changes(spark, f"{folder}/in", batch.schema)

    apply_to_table = stream_module.apply_to_table

    def merged_then_lost(*args, **options):
        raise RuntimeError(f"lost after {apply_to_table(*args, **options)}")

    with monkeypatch.context() as broken:
        broken.setattr(stream_module, "apply_to_table", merged_then_lost)
        with pytest.raises(Exception, match="lost after"):
            run_to_end(stream_apply(stream, table, f"{folder}/cp"))
    run_to_end(stream_apply(stream, table, f"{folder}/cp"))
    assert table.version == 1 and rows(table.read()) == rows(apply_batch(None, batch, "id"))


def test_flatten_and_append(spark, folder):
    batch = random_batch(spark, 1, 60, 40)
    batch.withColumnRenamed("_seq", "n").write.parquet(f"{folder}/in")
    schema = batch.withColumnRenamed("_seq", "n").schema
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4)
    stream = stream_changes(spark, f"{folder}/in", schema)
    run_to_end(stream_apply(stream, table, f"{folder}/cp", lambda df: df.withColumnRenamed("n", "_seq")))
    assert rows(table.read()) == rows(apply_batch(None, batch, "id"))
    run_to_end(stream_append(stream, f"{folder}/out", f"{folder}/cp2"))
    assert spark.read.parquet(f"{folder}/out").count() == 60


def test_from_the_log_to_the_table(spark, folder):
    versions = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")], [(2, "c"), (3, "e")]]
    frames = [spark.createDataFrame(rows, "id bigint, name string") for rows in versions]
    payload = frames[0].schema
    table = c.TargetTable.create(spark, f"{folder}/t", payload, "id", 4)
    at = datetime(2024, 5, 1, tzinfo=timezone.utc)
    before = frames[0].limit(0)
    for n, after in enumerate(frames):
        c.consume(c.net_changes(before, after, "id"), f"{folder}/log", n, at + timedelta(minutes=n))
        before = after
        records = lambda df: c.change_records(c.number_batches(df, 10), "id", "people")
        stream = c.stream_log(spark, f"{folder}/log")
        run_to_end(stream_apply(stream, table, f"{folder}/cp", lambda df: c.flatten_records(records(df), "id", payload)))
    found = {r["id"]: (r["cdc_operation"], r["name"]) for r in table.read().collect()}
    assert found == {1: ("delete", "a"), 2: ("update", "c"), 3: ("update", "e")}
    assert table.version == 3


def test_two_checkpoints_are_two_writers(spark, folder):
    table, expected = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4), None
    for n in range(2):
        batch = random_batch(spark, n, 60, 40)
        batch.write.parquet(f"{folder}/in{n}")
        stream = stream_changes(spark, f"{folder}/in{n}", batch.schema)
        run_to_end(stream_apply(stream, table, f"{folder}/cp{n}"))
        expected = apply_batch(expected, batch, "id")
    assert table.version == 2 and rows(table.read()) == rows(expected)


def test_a_stream_that_does_not_end(spark, folder):
    batch = random_batch(spark, 1, 10, 10)
    batch.write.parquet(f"{folder}/in")
    stream = stream_changes(spark, f"{folder}/in", batch.schema)
    with pytest.raises(TimeoutError):
        run_to_end(stream_append(stream, f"{folder}/out", f"{folder}/cp", "1 second"), timeout=2)


def events(spark, n, seed=3):
    """A batch of distinct sequences, so that its records have one order."""
    return random_batch(spark, seed, n, 25).withColumn("_seq", F.row_number().over(Window.orderBy("_seq", "id")).cast("long"))


def by_count(spark, records, size, late="take"):
    """The batches one after the other."""
    expected = None
    for low in range(0, records.count(), size):
        part = records.filter((F.col("_seq") > low) & (F.col("_seq") <= low + size))
        expected = apply_batch(expected, part, "id", late=late)
    return rows(expected)


@pytest.mark.parametrize("late", ["take", "ignore"])
@pytest.mark.parametrize("files", [1, 3, 10])
def test_batches_of_so_many_records_however_they_come(spark, folder, files, late):
    records = events(spark, 130)
    records.write.parquet(f"{folder}/all")
    records = spark.read.parquet(f"{folder}/all")
    for n in range(10):  # ten files, in order
        records.filter((F.col("_seq") > 13 * n) & (F.col("_seq") <= 13 * n + 13)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4, late=late)
    stream = stream_changes(spark, f"{folder}/in", records.schema, max_files=files)
    run_to_end(stream_apply(stream, table, f"{folder}/cp", records=20))
    assert rows(table.read()) == by_count(spark, records.filter("_seq <= 120"), 20, late)
    c.close_stream(table, f"{folder}/cp", 20)
    assert rows(table.read()) == by_count(spark, records, 20, late)
    c.close_stream(table, f"{folder}/cp", 20)  # nothing waits any more
    assert rows(table.read()) == by_count(spark, records, 20, late) and not os.listdir(f"{table.path}/pending")


def test_a_counted_micro_batch_that_comes_again_cuts_the_same_batches(spark, folder, monkeypatch):
    records = events(spark, 90)
    records.write.parquet(f"{folder}/all")
    records = spark.read.parquet(f"{folder}/all")
    for n in range(3):
        records.filter((F.col("_seq") > 30 * n) & (F.col("_seq") <= 30 * n + 30)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4)
    stream = stream_changes(spark, f"{folder}/in", records.schema, max_files=1)
    publish, apply = TargetTable._publish, stream_module.apply_by_count

    def lost_before(self, manifest):
        if manifest["commit"] == 2:
            raise RuntimeError("lost before")
        publish(self, manifest)

    def lost_after(table, flat, size, batch_id, *args):
        done = apply(table, flat, size, batch_id, *args)
        if batch_id == 2:
            raise RuntimeError("lost after")
        return done

    for name, place, broken in (("_publish", TargetTable, lost_before), ("apply_by_count", stream_module, lost_after)):
        with monkeypatch.context() as patch:
            patch.setattr(place, name, broken)
            with pytest.raises(Exception, match="lost"):
                run_to_end(stream_apply(stream, table, f"{folder}/cp", records=20))
    run_to_end(stream_apply(stream, table, f"{folder}/cp", records=20))
    c.close_stream(table, f"{folder}/cp", 20)
    assert rows(table.read()) == by_count(spark, records, 20)


def test_a_batch_that_has_waited_too_long_is_closed(spark, folder):
    records = events(spark, 60)
    records.write.parquet(f"{folder}/all")
    records = spark.read.parquet(f"{folder}/all")
    table, expected = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4), None
    for low, high in ((0, 25), (25, 60)):
        part = records.filter((F.col("_seq") > low) & (F.col("_seq") <= high))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = stream_changes(spark, f"{folder}/in", records.schema)
        run_to_end(stream_apply(stream, table, f"{folder}/cp", records=20, delay=0.0))
    c.close_stream(table, f"{folder}/cp", 20)
    for low, high in ((0, 20), (20, 25), (25, 45), (45, 60)):
        expected = apply_batch(expected, records.filter((F.col("_seq") > low) & (F.col("_seq") <= high)), "id")
    assert rows(table.read()) == rows(expected)


def feed(spark, low, high):
    half = "id k, 'INSERT' `METADATA$ACTION`, id % 2 = 0 `METADATA$ISUPDATE`"
    return spark.range(low, high).selectExpr(*half.split(", "), "sha2(cast(id as string), 256) `METADATA$ROW_ID`")


AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


def test_a_stream_from_a_position_opens_no_file_before_it(spark, folder):
    for n in range(3):
        c.consume(feed(spark, 100 * n, 100 * n + 100), f"{folder}/log", n, AT + timedelta(hours=n))
    want = {r["k"] for r in c.read_log(spark, f"{folder}/log", first=150).collect()}
    files = [json.loads(line) for n in range(3) for line in open(f"{folder}/log/index/{n}.json")]
    for file in files:
        if file["first"] + file["rows"] <= 150:
            os.remove(f"{folder}/log/{file['file']}")
    position = c.parse_position('{"IteratorType":"c","IndexInBatch":49,"BatchID":100}')
    stream = c.stream_log(spark, f"{folder}/log", position, max_consumes=1)
    run_to_end(stream_append(stream, f"{folder}/out", f"{folder}/cp"))
    assert {r["k"] for r in spark.read.parquet(f"{folder}/out").collect()} == want and len(want) == 150
    c.consume(feed(spark, 300, 320), f"{folder}/log", 3, AT + timedelta(hours=3))
    run_to_end(stream_append(stream, f"{folder}/out", f"{folder}/cp"))
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == 170 and got.agg(F.max(ROW_NUMBER)).first()[0] == 319
    with pytest.raises(ValueError, match="not one of a change log"):
        c.stream_log(spark, f"{folder}/log", c.parse_position('{"IteratorType":"s","SnapshotLastProcessedVal":3}'))


def test_consuming_as_a_stream_survives_a_crash_between_write_and_commit(spark, folder, monkeypatch):
    c.consume(feed(spark, 0, 10), f"{folder}/log", 0, AT)  # the log has other consumes already
    for n in range(3):
        feed(spark, 10 + 20 * n, 30 + 20 * n).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = stream_changes(spark, f"{folder}/in", feed(spark, 0, 1).schema, max_files=1)
    write, consume = Files.write_text, stream_module.consume

    def lost_before(self, path, text):
        if path.endswith("index/2.json"):
            raise RuntimeError("lost before the index")
        write(self, path, text)

    def lost_after(batch, path, consume_id, *args):
        consume(batch, path, consume_id, *args)
        if consume_id == 3:
            raise RuntimeError("lost after the index")

    for name, place, broken in (("write_text", Files, lost_before), ("consume", stream_module, lost_after)):
        with monkeypatch.context() as patch:
            patch.setattr(place, name, broken)
            with pytest.raises(Exception, match="lost"):
                run_to_end(c.stream_consume(stream, f"{folder}/log", f"{folder}/cp"))
    run_to_end(c.stream_consume(stream, f"{folder}/log", f"{folder}/cp"))
    log = c.read_log(spark, f"{folder}/log").collect()
    assert sorted(r["k"] for r in log) == list(range(70)) and sorted(r[ROW_NUMBER] for r in log) == list(range(70))
    assert c.next_consume(spark, f"{folder}/log") == 4 and len(os.listdir(f"{folder}/log/data")) == 5


def test_handover_loses_no_change(spark, folder, monkeypatch):
    """Rows that change while the table is being read, before and after their own row is read, arrive."""
    versions = [[(1, "a"), (2, "b"), (3, "c")], [(1, "a"), (2, "x"), (4, "d")], [(1, "y"), (4, "e"), (5, "f")]]
    one, two, three = (spark.createDataFrame(v, "id bigint, name string") for v in versions)
    log = f"{folder}/log"
    c.consume(c.net_changes(one.limit(0), one, "id"), log, 0, AT)

    def read():
        c.consume(c.net_changes(one, two, "id"), log, 1, AT + timedelta(minutes=1))
        return spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], one.schema)  # partly before, partly after

    args = ("id", "id", "people", f"{folder}/t", log, AT)
    with monkeypatch.context() as patch:  # fails before the snapshot is taken
        with pytest.raises(ZeroDivisionError):
            c.backfill(lambda: 1 / 0, *args)
    table, position = c.backfill(read, *args, buckets=4)
    assert position.rows_done == 3

    def flat(rows):
        return c.flatten_records(c.change_records(c.number_batches(rows, 10), "id", "people", as_json=False), "id")

    stream = c.stream_log(spark, log, position)
    run_to_end(stream_apply(stream, table, f"{folder}/cp", flat))
    c.consume(c.net_changes(two, three, "id"), log, 2, AT + timedelta(minutes=2))
    assert c.backfill(read, *args)[1] == position  # a second call changes nothing
    run_to_end(stream_apply(stream, table, f"{folder}/cp", flat))
    found = {r["id"]: (r["cdc_operation"], r["name"]) for r in table.read().collect()}
    assert found == {1: ("update", "y"), 2: ("delete", "x"), 3: ("delete", None), 4: ("update", "e"), 5: ("create", "f")}


def test_handover_from_an_empty_log(spark, folder):
    frame = spark.createDataFrame([(1, "a")], "id bigint, name string")
    table, position = c.backfill(lambda: frame, "id", "id", "people", f"{folder}/t", f"{folder}/log", AT)
    assert position is None and table.read().count() == 1
