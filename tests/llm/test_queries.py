"""Registered queries of the subpackage: SQL where there is some, and whole tables otherwise."""

import glob
import os

import duckdb
import pytest

from forumflow.llm.oracle import ORACLE
from forumflow.llm.queries import QUERIES

SF_DIR = os.environ.get("FORUMFLOW_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


# An index: its SQL is the exact answer, which it must reach with recall 0.9 at least.
APPROXIMATE = {"op11_nearest_neighbours"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - APPROXIMATE))
def test_sql(spark, duck, name):
    rows = QUERIES[name](spark, SF_DIR)
    columns = sorted(rows.columns)
    got = sorted(map(tuple, rows.select(*columns).collect()), key=repr)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert got


# Checked against brute force in their own tests: they return no row per document.
OWN_TESTS = {"op13_spelling_variants"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - OWN_TESTS))
def test_whole_table(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    table, key = ("pages", "page_id") if "page_id" in rows.columns else ("documents", "doc_id")
    given = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in rows.select(key).collect()} == given


def test_nearest_neighbours_recall(spark, duck):
    rows = QUERIES["op11_nearest_neighbours"](spark, SF_DIR).collect()
    exact = duck.execute(ORACLE["op11_nearest_neighbours"]).fetchall()
    assert {r["query_id"] for r in rows} == {r[0] for r in exact}
    want = {(r[0], r[2]): r[3] for r in exact}
    found = [(r["query_id"], r["vec_id"]) for r in rows if (r["query_id"], r["vec_id"]) in want]
    assert len(found) >= 0.9 * len(want)
    assert all(abs(r["score"] - want[(r["query_id"], r["vec_id"])]) < 1e-12 for r in rows
               if (r["query_id"], r["vec_id"]) in want)
