"""Run a query and its SQL on the same tables and compare them as unordered rows."""

import datetime as dt
import decimal
import glob
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimal in a result")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def assert_same(df, con, sql: str) -> int:
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    expected = rows(names, relation.fetchall())
    actual = rows(df.columns, df.collect())
    assert sorted(df.columns) == sorted(names)
    assert len(actual) == len(expected), f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        assert a == e, f"{a} != {e}"
        assert [type(x) for x in a] == [type(x) for x in e], f"types of {a} and {e}"
    return len(actual)
