"""The stored table: what a merge writes, replays, crashes, old readers, clean-up."""

import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe import SchemaMismatch, TargetTable, apply_batch, apply_records, apply_to_table, compact, merge, merge_stats, render
from cdcframe.operators.merge import condense, fold
from cdcframe.sinks import table as table_module
from tests.inspect_plan import plan
from tests.test_merge import random_batch

PAYLOAD = T.StructType().add("id", T.LongType()).add("v", T.StringType())


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def make(spark, folder, buckets=8):
    return TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", buckets)


def test_batches_one_after_the_other(spark, folder):
    table, expected = make(spark, folder), None
    for n in range(3):
        batch = random_batch(spark, n, 150, 80 * (n + 1))
        done = apply_to_table(table, batch, n)
        assert done.records == 150 and not done.commit.skipped
        expected = apply_batch(expected, batch, "id")
        assert rows(table.read()) == rows(expected)
        assert rows(TargetTable.open(spark, table.path).read()) == rows(expected)
    assert not os.listdir(f"{table.path}/stage")


def parquet_files(folder):
    return sorted(name for name in os.listdir(folder) if name.endswith(".parquet")) if os.path.exists(folder) else []


def test_a_small_merge_writes_its_changes_only_and_the_old_version_still_reads(spark, folder):
    table = make(spark, folder)
    apply_to_table(table, random_batch(spark, 1, 300, 200), 0)
    old = TargetTable.open(spark, table.path)
    before, written = rows(old.read()), parquet_files(table._folder("rows"))
    done = apply_to_table(table, random_batch(spark, 2, 2, 2), 1)
    assert 1 <= done.commit.buckets <= 2
    assert parquet_files(table._folder("rows")) == written and len(written) == 8
    assert len(parquet_files(table._folder("changes"))) == done.commit.buckets
    assert rows(old.read()) == before != rows(table.read())
    old.refresh()
    assert rows(old.read()) == rows(table.read())


def test_no_side_of_a_read_is_shuffled_and_the_rows_are_not_sorted(spark, folder):
    table = make(spark, folder)
    for n in range(3):
        apply_to_table(table, random_batch(spark, n, 20 if n else 300, 200), n)
    text = plan(table.read())
    assert text.count("Bucketed: true") == 2 and "Exchange" not in text and "Sort " not in text and "FullOuter" in text


def test_merging_a_frame_into_stored_rows_moves_the_frame_only(spark, folder):
    table = make(spark, folder)
    apply_to_table(table, random_batch(spark, 1, 300, 200), 0)
    changes = random_batch(spark, 9, 30, 200).filter("_operation = 'create'").dropDuplicates(["id"]).sortWithinPartitions("v")
    rendered = render(changes, "id").hint("merge")
    text = plan(merge(table.read(), rendered, "id"))
    assert text.count("Exchange hashpartitioning(id") == plan(rendered).count("Exchange hashpartitioning(id") == 1
    assert "hashpartitioning(id#" in text and ", 8)" in text


def tasks_of(spark, action):
    """The tasks that an action has run."""
    status, group = spark.sparkContext.statusTracker(), f"count {id(action)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("other", "")
    stages = {stage for job in status.getJobIdsForGroup(group) for stage in status.getJobInfo(job).stageIds}
    return sum(info.numCompletedTasks for info in map(status.getStageInfo, stages) if info)


def test_three_updates_cost_tasks_for_the_buckets_they_touch(spark, folder):
    table = make(spark, folder, 256)
    apply_to_table(table, random_batch(spark, 1, 3000, 2500), 0)
    assert len(parquet_files(table._folder("rows"))) > 200
    changes = render(random_batch(spark, 2, 3, 2500).filter("_operation <> 'create'"), "id").dropDuplicates(["id"])
    changes.write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    assert tasks_of(spark, lambda: table.merge(staged, 1)) < 40
    assert table.version == 2


def test_changes_are_brought_into_the_rows_when_they_are_many(spark, folder, monkeypatch):
    table, expected = make(spark, folder), None
    generations = set()
    for n in range(12):
        batch = random_batch(spark, n, 400 if n == 0 else 25, 300)
        apply_to_table(table, batch, n)
        expected = apply_batch(expected, batch, "id")
        generations.add(table._manifest["generation"])
        assert sum(c["rows"] for c in table._manifest["changes"]) < 0.25 * table._manifest["rows"]
        assert rows(table.read()) == rows(expected)
    assert 2 <= len(generations) < 8
    assert len(parquet_files(table._folder("rows"))) == 8
    monkeypatch.setattr(table_module, "BUCKET_BYTES", 500)  # the buckets are too large now
    apply_to_table(table, random_batch(spark, 20, 200, 300), 20)
    expected = apply_batch(expected, random_batch(spark, 20, 200, 300), "id")
    assert table.buckets > 8 and rows(table.read()) == rows(expected)
    apply_to_table(table, random_batch(spark, 21, 9, 300), 21)
    assert rows(TargetTable.open(spark, table.path).read()) == rows(apply_batch(expected, random_batch(spark, 21, 9, 300), "id"))


def test_buckets_by_the_size_of_the_first_batch(spark, folder):
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id")
    assert table.buckets is None and table.read().count() == 0
    apply_to_table(table, random_batch(spark, 1), 0)
    assert table.buckets == 8 and TargetTable.open(spark, table.path).buckets == 8


@pytest.mark.parametrize("late", ["take", "ignore"])
def test_fold_equals_one_merge_after_the_other(spark, late):
    merged, parts = None, []
    for n in range(6):
        changes = render(compact(random_batch(spark, n, 60, 25), "id"), "id")
        merged = changes if merged is None else merge(merged, changes, "id", late=late)
        parts.append(changes.withColumn("n", F.lit(n)))
    schema = merged.schema
    union = reduce(DataFrame.unionByName, parts)
    assert rows(fold(None, union, "id", ["n"], schema, late=late)) == rows(merged)
    first, later = parts[0].drop("n"), union.filter("n > 0")
    assert rows(fold(first, later, "id", ["n"], schema, late=late)) == rows(merged)
    if late == "take":
        few = condense(later, "id", "n")
        assert max(r["count"] for r in few.groupBy("id").count().collect()) <= 3
        assert rows(fold(first, few, "id", ["n"], schema)) == rows(merged)
        assert rows(fold(None, condense(union, "id", "n"), "id", ["n"], schema)) == rows(merged)


def test_late_updates_of_later_batches_are_ignored_on_request(spark, folder):
    schema = "_seq bigint, _operation string, _read_at bigint, id bigint, v string"
    batches = [
        [(0, "create", 5, 1, "a"), (0, "update", 9, 2, "b"), (0, "update", 9, 3, "c"), (0, "update", 9, 4, "d")],
        [(1, "update", 6, 1, "e"), (1, "update", 9, 2, "late"), (1, "delete", 3, 3, None), (1, "update", 10, 4, "f")],
        [(2, "update", 6, 1, "late"), (2, "create", 1, 2, "g"), (2, "update", 8, 3, "late"), (2, "delete", 20, 4, None)],
        [(3, "update", 7, 1, "h"), (3, "update", 2, 2, "i"), (3, "update", 10, 3, "j"), (3, "update", 10, 4, "late")],
    ]
    table = TargetTable.create(spark, f"{folder}/t", PAYLOAD, "id", 4, late="ignore")
    expected = None
    for n, batch in enumerate(batches):
        batch = spark.createDataFrame(batch, schema)
        apply_to_table(table, batch, n)
        expected = apply_batch(expected, batch, "id", late="ignore")
    assert rows(table.read()) == rows(expected)
    found = {r["id"]: (r["cdc_operation"], r["v"]) for r in table.read().collect()}
    assert found == {1: ("update", "h"), 2: ("update", "i"), 3: ("update", "j"), 4: ("delete", "f")}


def test_the_created_time_can_be_carried(spark, folder):
    schema = "_seq bigint, _operation string, _read_at bigint, id bigint, v string"
    data = [(0, "create", 5, 1, "a"), (1, "update", 6, 1, "b"), (0, "update", 7, 2, "c"), (0, "create", 8, 3, "d"), (1, "delete", 9, 3, None)]
    batch = spark.createDataFrame(data, schema)
    table = make(spark, folder)
    apply_to_table(table, spark.createDataFrame([(0, "create", 1, 1, "old")], schema), 0)
    apply_to_table(table, batch, 1, carry_created=True)
    created = {r["id"]: r["c"] for r in table.read().selectExpr("id", "unix_micros(cdc_created_at) c").collect()}
    assert created == {1: 5, 2: None, 3: 8}


def test_the_commit_counts_what_the_merge_affects(spark, folder):
    table, expected = make(spark, folder), None
    for n in range(3):
        batch = random_batch(spark, n, 150, 120)
        changes = render(compact(batch, "id"), "id")
        known = expected if expected is not None else changes.limit(0)
        stats = {(r["operation"], r["matched"]): r["rows_affected"] for r in merge_stats(known, changes, "id").collect()}
        commit = apply_to_table(table, batch, n).commit
        assert commit.affected == stats and sum(stats.values()) == commit.changes
        expected = apply_batch(expected, batch, "id")


def test_a_batch_is_merged_once(spark, folder):
    table = make(spark, folder)
    apply_to_table(table, random_batch(spark, 1), 0)
    before = rows(table.read())
    assert apply_to_table(table, random_batch(spark, 2), 0).commit.skipped
    assert rows(table.read()) == before
    assert not apply_to_table(table, random_batch(spark, 2), 0, writer="another").commit.skipped


def test_crash_before_the_manifest(spark, folder, monkeypatch):
    table = make(spark, folder)
    apply_to_table(table, random_batch(spark, 1), 0)
    before = rows(table.read())
    with monkeypatch.context() as broken:
        broken.setattr(TargetTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            apply_to_table(table, random_batch(spark, 2), 1)
    assert os.listdir(f"{table.path}/stage") == ["2"]
    table = TargetTable.open(spark, table.path)
    assert rows(table.read()) == before
    apply_to_table(table, random_batch(spark, 2), 1)
    expected = apply_batch(apply_batch(None, random_batch(spark, 1), "id"), random_batch(spark, 2), "id")
    assert rows(table.read()) == rows(expected)


def test_vacuum(spark, folder):
    table = make(spark, folder, 4)
    for n in range(4):
        apply_to_table(table, random_batch(spark, n, 3 if n else 200, 50), n)
    current, previous = rows(table.read()), None
    table.vacuum(keep=1)
    assert rows(TargetTable.open(spark, table.path).read()) == current
    assert len(os.listdir(f"{table.path}/manifest")) <= 2  # the manifest and its checksum
    apply_to_table(table, random_batch(spark, 9, 3, 50), 4)
    del previous


def test_empty_batch(spark, folder):
    table = make(spark, folder)
    done = apply_to_table(table, random_batch(spark, 1).limit(0), 0)
    assert done.records == 0 and table.read().count() == 0 and table.is_done(0)


def test_csv_stage(spark, folder):
    table = make(spark, folder)
    batch = random_batch(spark, 1)
    apply_to_table(table, batch, 0, fmt="csv", codec="gzip", cleanup=False)
    assert rows(table.read()) == rows(apply_batch(None, batch, "id"))
    assert sorted(d for d in os.listdir(f"{table.path}/stage/1") if d.startswith("_cdc_route")) == ["_cdc_route=inserts", "_cdc_route=updates"]


def test_a_batch_that_does_not_fit(spark, folder):
    table = make(spark, folder)
    batch = random_batch(spark, 1).filter("_operation <> 'delete'")
    with pytest.raises(SchemaMismatch, match="type differs"):
        apply_to_table(table, batch.withColumn("v", batch["_seq"]), 0)
    with pytest.raises(SchemaMismatch, match="missing in batch"):
        apply_to_table(table, batch.drop("v"), 0)
    with pytest.raises(SchemaMismatch, match="missing in target"):
        apply_to_table(table, batch.withColumn("w", batch["v"]), 0)
    assert table.version == 0


def test_a_batch_that_starts_with_a_delete_needs_only_its_key(spark, folder):
    table = make(spark, folder)
    apply_to_table(table, spark.createDataFrame([(0, "create", 5, 1, "a")], random_batch(spark, 1).schema), 0)
    apply_to_table(table, spark.createDataFrame([(0, "delete", 6, 1)], "_seq bigint, _operation string, _read_at bigint, id bigint"), 1)
    row = table.read().first()
    assert (row["cdc_operation"], row["v"]) == ("delete", "a")


def test_records_with_inferred_schema(spark, folder):
    first = [
        (0, "create", '{"id":1}', None, '{"id":1,"name":"a","n":1.5}', "10"),
        (1, "create", '{"id":2}', None, '{"id":2,"name":"b","n":2}', "11"),
    ]
    second = [(0, "delete", '{"id":1}', None, None, "12"), (1, "update", '{"id":2}', None, '{"id":2,"name":"c","n":3.5}', "13")]
    schema = "seq bigint, operation string, key string, before string, after string, at string"

    def records(data):
        return spark.createDataFrame(data, schema).selectExpr("*", "map('readAt', at) metadata").drop("at")

    apply_records(f"{folder}/t", records(first), "id", 0)
    table = apply_records(f"{folder}/t", records(second), "id", 1)
    assert table.schema["id"].dataType == T.LongType() and table.schema["n"].dataType == T.DoubleType()
    found = {r["id"]: (r["cdc_operation"], r["name"], r["n"]) for r in table.read().collect()}
    assert found == {1: ("delete", "a", 1.5), 2: ("update", "c", 3.5)}


def json_records(spark, data):
    schema = "seq bigint, operation string, key string, before string, after string, at string"
    return spark.createDataFrame(data, schema).selectExpr("*", "map('readAt', at) metadata").drop("at")


def test_json_batches_of_deletes_and_of_nulls(spark, folder):
    path = f"{folder}/t"
    apply_records(path, json_records(spark, [(0, "create", '{"id":1}', None, '{"id":1,"name":"a","n":1.5}', "1")]), "id", 0)
    apply_records(path, json_records(spark, [(0, "update", '{"id":1}', None, '{"id":1,"name":null,"n":2.5}', "2")]), "id", 1)
    table = apply_records(path, json_records(spark, [(0, "delete", '{"id":1}', None, None, "3"), (1, "delete", '{"id":2}', None, None, "3")]), "id", 2)
    found = {r["id"]: (r["cdc_operation"], r["name"], r["n"]) for r in table.read().collect()}
    assert found == {1: ("delete", None, 2.5), 2: ("delete", None, None)}
    first = [(0, "delete", '{"id":1}', '{"id":1,"name":"a"}', None, "1"), (1, "create", '{"id":2}', None, '{"id":2,"name":"b"}', "1")]
    table = apply_records(f"{folder}/u", json_records(spark, first), "id", 0, mode="first")
    assert {r["id"]: (r["cdc_operation"], r["name"]) for r in table.read().collect()} == {1: ("delete", None), 2: ("create", "b")}
    table = apply_records(f"{folder}/v", json_records(spark, [(0, "delete", '{"id":1}', None, None, "1")]), "id", 0)
    assert table.read().first()["id"] == 1


def test_fields_that_are_null_throughout_are_variant(spark, folder):
    data = [(0, "create", '{"id":1}', None, '{"id":1,"x":null}'), (1, "update", '{"id":2}', None, '{"id":2,"x":null}')]
    records = spark.createDataFrame(data, "seq bigint, operation string, key string, before string, after string")
    table = apply_records(f"{folder}/t", records.selectExpr("*", "map('readAt', '5') metadata"), "id", 0)
    assert table.schema["x"].dataType == T.VariantType()
    assert sorted(map(tuple, table.read().select("id", "x").collect())) == [(1, None), (2, None)]


def test_create_checks_its_arguments(spark, folder):
    with pytest.raises(ValueError):
        TargetTable.create(spark, f"{folder}/a", PAYLOAD, "id", buckets=6)
    with pytest.raises(ValueError):
        TargetTable.create(spark, f"{folder}/b", PAYLOAD, "key")
    TargetTable.create(spark, f"{folder}/c", PAYLOAD, "id")
    with pytest.raises(FileExistsError):
        TargetTable.create(spark, f"{folder}/c", PAYLOAD, "id")
    with pytest.raises(FileNotFoundError):
        TargetTable.open(spark, f"{folder}/d")
