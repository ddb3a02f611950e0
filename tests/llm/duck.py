"""SQL over the tables of a folder, or over rows of a test."""

import glob
import os

import duckdb


def over_folder(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def over_rows(**tables):
    connection = duckdb.connect()
    for name, frame in tables.items():
        connection.register(f"_{name}", frame.toArrow())
        connection.execute(f"create table {name} as select * from _{name}")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def agree(df, connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows(columns, result.fetchall())
    assert rows(df.columns, map(tuple, df.collect())) == expected
    return expected
