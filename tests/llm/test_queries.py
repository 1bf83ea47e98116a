"""Every query of the subpackage runs, and gives DuckDB's rows where SQL can say it."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfmark.llm.queries import ORACLES, QUERIES


def test_all_are_offered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, folder, name):
    found = duck.execute(ORACLES[name])
    names = sorted(d[0] for d in found.description)
    at = [[d[0] for d in found.description].index(n) for n in names]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == names
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op12_collocations", "op13_main_text"}))
def test_runs_over_all_documents(spark, folder, name):
    ids = {r.doc_id for r in QUERIES[name](spark, folder).select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
