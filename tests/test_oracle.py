"""Every query with SQL gives the rows that DuckDB gives for it."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from shelfmark.plans.registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    return 0.0 if isinstance(v, float) and v == 0 else v


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _check_plan(df, name):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text
    # Fitted recommenders score all pairs of factor blocks; that is Spark's own top-n.
    if not name.startswith(("als_", "recommendations_")):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, folder, name):
    df = entry.queries()[name](spark, folder)
    _check_plan(df, name)
    found = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in found.description}
    wanted = found.fetchall()
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    names = sorted(types)
    at = [list(types).index(n) for n in names]
    got = _sorted(tuple(r[n] for n in names) for r in df.collect())
    assert got == _sorted(tuple(r[i] for i in at) for r in wanted)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    _check_plan(df, name)
    assert df.take(1)


def test_entry(spark):
    out = entry.entry(spark).collect()
    assert [c for c in out[0].asDict()] == ["category", "avg_rating", "n"]
    assert sum(r["n"] for r in out) == 197
    assert not any(math.isnan(r["avg_rating"]) for r in out)
