"""The merge rules, column by column."""

import random

import pytest
from pyspark.sql import functions as F

from cdcframe import apply_batch, compact, merge, merge_into, merge_stats, render
from cdcframe.operators.render import Bookkeeping

SCHEMA = "cdc_operation string, cdc_created_at int, cdc_updated_at int, cdc_deleted_at int, id int, v string"
TARGET = [
    ("create", 1, None, None, 1, "a"),
    ("update", 1, 2, None, 2, "b"),
    ("delete", 1, 2, 3, 3, "c"),
    ("create", 1, None, None, 9, "i"),
]


def merged(spark, changes):
    target = spark.createDataFrame(TARGET, SCHEMA)
    rows = merge(target, spark.createDataFrame(changes, SCHEMA), "id")
    return {row[4]: tuple(row) for row in rows.collect()}


@pytest.mark.parametrize("operation", ["create", "snapshot"])
def test_create_overwrites_everything_or_inserts(spark, operation):
    changes = [(operation, 7, None, None, key, "new") for key in (1, 2, 3, 4)]
    rows = merged(spark, changes)
    assert [rows[key] for key in (1, 2, 3, 4)] == changes
    assert rows[9] == TARGET[3] and len(rows) == 5


def test_update_keeps_only_the_created_time_or_inserts(spark):
    rows = merged(spark, [("update", None, 7, None, key, "new") for key in (1, 2, 3, 4)])
    assert rows[1] == ("update", 1, 7, None, 1, "new")
    assert rows[2] == ("update", 1, 7, None, 2, "new")
    assert rows[3] == ("update", 1, 7, None, 3, "new")  # deleted before, and back again
    assert rows[4] == ("update", None, 7, None, 4, "new")
    assert rows[9] == TARGET[3] and len(rows) == 5


def test_delete_marks_or_leaves_a_tombstone(spark):
    rows = merged(spark, [("delete", None, None, 7, key, None) for key in (1, 2, 4)])
    assert rows[1] == ("delete", 1, None, 7, 1, "a")
    assert rows[2] == ("delete", 1, 2, 7, 2, "b")
    assert rows[4] == ("delete", None, None, 7, 4, None)
    assert rows[3] == TARGET[2] and rows[9] == TARGET[3] and len(rows) == 5


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([("create", 1, None, None, None, "a")], SCHEMA)
    changes = spark.createDataFrame([("update", None, 2, None, None, "b")], SCHEMA)
    rows = sorted(map(tuple, merge(target, changes, "id").collect()))
    assert [row[5] for row in rows] == ["a", "b"]


def random_batch(spark, seed, rows=400, keys=120):
    rng = random.Random(seed)
    records = [
        (n, rng.choice(["create", "snapshot", "update", "delete"]), rng.randrange(1000), rng.randrange(keys), f"{seed}-{n}")
        for n in range(rows)
    ]
    return spark.createDataFrame(records, "_seq bigint, _operation string, _read_at bigint, id bigint, v string")


@pytest.mark.parametrize("seed", [1, 2])
def test_replaying_changes_nothing(spark, seed):
    target = apply_batch(None, random_batch(spark, seed), "id")
    changes = render(compact(random_batch(spark, seed + 100, 100), "id"), "id")
    once = merge(target, changes, "id").collect()
    again = merge(merge(target, changes, "id"), changes, "id").collect()
    assert sorted(once, key=repr) == sorted(again, key=repr)


def test_stats(spark):
    changes = [("create", 7, None, None, 1, ""), ("update", None, 7, None, 2, ""), ("update", None, 7, None, 5, ""), ("delete", None, None, 7, 6, None)]
    rows = merge_stats(spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(changes, SCHEMA), "id").collect()
    assert {tuple(row) for row in rows} == {("create", True, 1), ("update", True, 1), ("update", False, 1), ("delete", False, 1)}


def test_merge_into_resolves_against_a_catalog_table(spark, folder):
    # The session catalog has no tables that take a MERGE: all but the last step can be seen here.
    target = spark.createDataFrame(TARGET, SCHEMA)
    spark.sql(f"create table if not exists merge_target ({SCHEMA}) using parquet location '{folder}/m'")
    try:
        with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
            merge_into(target, "merge_target", "id")
        with pytest.raises(Exception, match="cannot be resolved|UNRESOLVED"):
            merge_into(target.withColumnRenamed("v", "w"), "merge_target", "id")
    finally:
        spark.sql("drop table merge_target")


def test_prefix_and_composite_key(spark):
    schema = SCHEMA.replace("cdc_", "x_") + ", w int"
    target = spark.createDataFrame([("create", 1, None, None, 1, "a", 5)], schema)
    changes = spark.createDataFrame([("delete", None, None, 2, 1, "a", None), ("delete", None, None, 2, 1, "b", None)], schema)
    rows = {row["v"]: tuple(row) for row in merge(target, changes, ["id", "v"], "x").collect()}
    assert rows == {"a": ("delete", 1, None, 2, 1, "a", 5), "b": ("delete", None, None, 2, 1, "b", None)}


def test_layout():
    book = Bookkeeping("p")
    assert book.layout(["b", "a", "p_operation"]) == ["p_operation", "p_created_at", "p_updated_at", "p_deleted_at", "a", "b"]


def test_columns_may_have_odd_names(spark):
    target = spark.createDataFrame([("create", 1, None, None, 1, "a")], SCHEMA).withColumnRenamed("v", "odd.na`me")
    changes = target.withColumn("cdc_operation", F.lit("delete"))
    assert merge(target, changes, "id").first()["odd.na`me"] == "a"
