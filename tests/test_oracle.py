"""Every registered query against its SQL, as the driver does it."""

import duckdb
import pytest

import __spark_entry__
from tidemark.plans.roles import TABLES

SQL = __spark_entry__.ORACLE_SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in [*TABLES, "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """Type and value: a null is no empty string, a decimal no float; floats to nine digits, since sums differ in order."""
    return (type(v).__name__, f"{v:.9g}" if isinstance(v, float) else repr(v))


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(__spark_entry__.QUERIES))
def test_same_rows(spark, sf_dir, duck, name):
    df = __spark_entry__.QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    want = rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert got == want
    assert got or name in ("keyset_past_end",)
