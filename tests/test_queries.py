"""Every registered query against its SQL. FORUMFLOW_SF_DIR picks another data set."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from forumflow.plans import inputs
from forumflow.plans.catalog import QUERIES

SF_DIR = os.environ.get("FORUMFLOW_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    rows = contract.queries()[name](spark, SF_DIR)
    columns = sorted(rows.columns)
    got = sorted((tuple(map(normal, r)) for r in rows.select(*columns).collect()), key=repr)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(normal(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
    assert got


def test_types_agree(spark, duck):
    """Integer widths and the like are the same on both sides."""
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
             "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
    for name in QUERIES:
        sql = contract.oracle_sql()[name]
        if name in ("stream_ingest", "stream_upsert", "sink_roundtrip"):
            continue
        spark_types = {f.name: kinds[f.dataType.simpleString()] for f in contract.queries()[name](spark, SF_DIR).schema}
        described = duck.execute(f"describe {sql}").fetchall()
        assert spark_types == {d[0]: d[1] for d in described}, name


PARTED = ["assemble_items", "union_communities", "project_post", "comment_count", "resolve_post_id",
          "flatten_comments", "conversation_posts", "conversation_comments"]


@pytest.mark.parametrize("name", PARTED)
def test_part_size_changes_nothing(spark, monkeypatch, name):
    results = []
    for size in (1, 3, 10_000):
        monkeypatch.setattr(inputs, "PART_SIZE", size)
        results.append(sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect()), key=repr))
    assert results[0] == results[1] == results[2]


def test_entry(spark):
    assert contract.entry(spark).count() > 0
