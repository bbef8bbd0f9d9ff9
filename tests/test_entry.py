"""The driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from support import SF_SMALL
from fanline.sources.tables import TABLES

# the optional training-data queries have tests of their own (tests/llm)
OWN = {n: q for n, q in E.queries().items() if n not in E.LLM_QUERIES}
OWN_ORACLES = {n: q for n, q in E.oracle_sql().items() if n not in E.LLM_QUERIES}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "topic", "subscriber", "queue"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(OWN) == set(OWN_ORACLES)
    assert len(OWN) >= 58


@pytest.mark.parametrize("name", sorted(OWN_ORACLES))
def test_query_matches_oracle_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
