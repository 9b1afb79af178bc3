"""Scans, unions and seed lists."""

import datetime as dt

from pyspark.sql import functions as F

from forumflow.operators.merge import first_per_key, last_per_key
from forumflow.schemas import PAGE, POST_ITEM
from forumflow.sources.items import read_items, seed_conflicts, seed_list, union_communities
from forumflow.sources.pages import read_page_files, read_pages
from tests.test_batch import frame, item


def test_items_by_folder(spark, tmp_path):
    for name in ("stocks", "funds"):
        rows = frame(spark, [item(1), item(2)]).drop("community")
        rows.write.json(str(tmp_path / f"community={name}"))
    items = read_items(spark, str(tmp_path), "json")
    assert sorted(items.columns) == sorted(POST_ITEM.names)
    assert sorted((r.community, r.seq) for r in items.collect()) == [
        ("funds", 1), ("funds", 2), ("stocks", 1), ("stocks", 2),
    ]


def test_union_puts_the_name_in(spark):
    one = frame(spark, [item(1, community="x")])
    two = frame(spark, [item(2)]).drop("community", "comment_total")
    out = union_communities({"a": one, "b": two})
    assert out.schema.simpleString() == POST_ITEM.simpleString()
    assert sorted((r.seq, r.community) for r in out.collect()) == [(1, "a"), (2, "b")]


def test_seed_lists(spark):
    texts = ["['https://f/r/a/new', 'https://f/r/b']", "[]", "nonsense", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in rows.select(seed_list(F.col("t"))).collect()]
    assert out == [["https://f/r/a/new", "https://f/r/b"], [], None, None]


def test_seed_conflicts(spark):
    seeds = spark.createDataFrame(
        [
            ("a", "https://f/r/a/new", "['https://f/r/a/new/']"),
            ("b", "https://f/r/bAnalysis/new", "['https://f/r/b/new']"),
            ("c", "https://f/r/c", "['https://f/r/c', 'https://f/r/d']"),
            ("e", "https://f/r/e", "broken"),
        ],
        "community string, start_url string, start_url_list string",
    )
    out = {(r.community, r.listed_url) for r in seed_conflicts(seeds).collect()}
    assert out == {("b", "https://f/r/b/new"), ("c", "https://f/r/d"), ("e", None)}


def test_pages(spark, tmp_path):
    row = ("u", "c", "post", dt.datetime(2024, 1, 1), 1, "<h1>x\n</h1>")
    spark.createDataFrame([row], PAGE).write.parquet(str(tmp_path / "p"))
    assert [tuple(r) for r in read_pages(spark, str(tmp_path / "p")).collect()] == [row]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "1.html").write_text("<h1>a\nb</h1>")
    [page] = read_page_files(spark, str(tmp_path / "f")).collect()
    assert page.html == "<h1>a\nb</h1>" and page.path.endswith("1.html")


def test_first_and_last_per_key(spark):
    rows = spark.createDataFrame([("k", 2, None), ("k", 1, "a"), ("m", 3, "b")], "k string, n int, v string")
    assert sorted(tuple(r) for r in first_per_key(rows, ["k"], ["n"]).collect()) == [("k", 1, "a"), ("m", 3, "b")]
    # A NULL in the winning row stays.
    assert sorted(tuple(r) for r in last_per_key(rows, ["k"], ["n"]).collect()) == [("k", 2, None), ("m", 3, "b")]
