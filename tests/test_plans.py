"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from forumflow import functions as ff
from forumflow.operators import merge, quality
from forumflow.operators.extract import drop_promoted
from forumflow.operators.typed import flatten_comments, post_rows, type_comments, type_posts
from forumflow.plans.catalog import QUERIES
from forumflow.plans.inputs import event_items, table
from forumflow.schemas import POST_ITEM


@pytest.fixture(autouse=True)
def whole_plans(spark):
    """Plans as Spark makes them for large inputs, described in full."""
    settings = {
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_promoted_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cards")
    spark.createDataFrame([("a", "/1", "x")], "label string, href string, more string").write.parquet(path)
    text = plan(drop_promoted(spark.read.parquet(path)).select("href"))
    assert "Not(EqualTo(label,promoted))" in text
    assert "more" not in text


def test_post_typing_does_not_load_comment_texts(spark, sf_dir, tmp_path):
    path = str(tmp_path / "items")
    event_items(table(spark, sf_dir, "events")).write.parquet(path)
    text = plan(post_rows(type_posts(spark.read.schema(POST_ITEM).parquet(path))))
    assert "comments:array<struct<commentUserName:string>>" in text


@pytest.mark.parametrize(
    "name", ["votes_post", "relative_time", "combine_join", "upsert_posts", "filter_complete", "late_update"]
)
def test_typing_stays_in_the_jvm(spark, sf_dir, name):
    assert "Python" not in plan(QUERIES[name](spark, sf_dir))
    assert "InPandas" not in plan(QUERIES[name](spark, sf_dir))


def test_fold_combines_before_its_only_exchange(spark, sf_dir):
    rows = post_rows(type_posts(event_items(table(spark, sf_dir, "events"))))
    text = plan(merge.fold_posts(rows))
    assert text.count("Exchange") == 1
    assert "partial_min_by" in text and "partial_max_by" in text
    # Nothing is typed in a filter that a projection then types again.
    assert "Filter (" not in text.split("Exchange")[1]


def test_comments_are_typed_once(spark, sf_dir):
    typed = type_posts(event_items(table(spark, sf_dir, "events")))
    text = plan(type_comments(flatten_comments(typed, where=F.col("reason").isNull())))
    assert "Exchange" not in text
    assert all("regexp" not in line for line in text.split("\n") if "Filter" in line)


def test_orphans_are_counted_before_the_join(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    text = plan(quality.orphans(documents, labels, "doc_id"))
    assert text.index("Join") < text.index("HashAggregate")
    assert "text:string" not in text


def test_nothing_is_broadcast_unchecked(spark, sf_dir):
    """No query forces a broadcast; only sizes Spark knows lead to one."""
    for name in ("lookup_post", "lookup_comment", "resolve_post_id", "late_update"):
        logical = QUERIES[name](spark, sf_dir)._jdf.queryExecution().logical().toString()
        assert "broadcast" not in logical.lower()


def test_hot_lookup_key_is_split(spark):
    """A third of all rows look up one key; adaptive execution splits that partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("title"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        stored = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("title"), F.col("id").alias("upvotes"))
        stored = stored.union(spark.createDataFrame([("hot", 7)], "title string, upvotes long"))
        found = merge.lookup(rows, stored, ["title"], ["upvotes"])
        out = found.groupBy("known").agg(F.count("payload"), F.sum("stored_upvotes"))
        [row] = out.collect()
        assert (row[0], row[1]) == (True, 300_000)
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_age_is_parsed_once_per_row(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        ff.relative_time(F.col("event_type"), F.col("ts")).alias("t")
    )
    code = rows._jdf.queryExecution().debug().codegenToSeq().toString()
    # Once for each of the two words.
    assert code.count(".matcher(") == 2
