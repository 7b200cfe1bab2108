"""Queries of the subpackage that have SQL, row for row with nulls and types."""

import duckdb
import pytest

from tidemark.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    rows = want.fetchall()
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    key = lambda r: repr(r)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=key)
    assert len(got) == len(rows) > 0 and got == sorted(rows, key=key)
