"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = rows(columns, result.fetchall())
    assert expected
    assert rows(df.columns, map(tuple, df.collect())) == expected


def test_counted_batches_of_a_range_in_many_files(spark, folder):
    """Files of one write have no order: the batches still follow the sequence."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.repartition(6, "user_id").write.parquet(f"{folder}/events.parquet")
    df = QUERIES["stream_apply_by_count"](spark, folder)
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    result = connection.execute(ORACLES["stream_apply_by_count"])
    columns = [d[0] for d in result.description]
    assert rows(df.columns, map(tuple, df.collect())) == rows(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
