"""Per-community marks: the oldest post and comment time a run has touched."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.operators.merge import post_existed
from forumflow.operators.quality import fits
from forumflow.schemas import MARK, WIDTH


def batch_communities(post_rows: DataFrame) -> DataFrame:
    """Communities the batch has items of, usable or not."""
    return (
        post_rows.filter(F.col("community").isNotNull() & fits("community", WIDTH["community"]))
        .select("community")
        .distinct()
    )


def touched_posts(post_rows: DataFrame, posts: DataFrame, batch_id: int) -> DataFrame:
    """(community, datetime) of every post a community's accepted items touched.

    Sightings are first reduced to one row per title and community, then meet the posts as
    they are after the batch: a known post counts with its stored time.
    """
    order = F.struct("captured_at", "seq")
    seen = (
        post_rows.filter(F.col("reason").isNull() & (F.col("pos_offset") == 0))
        .groupBy("title", "community")
        .agg(F.max(order).alias("order"))
        .select("title", "community", "order.*")
    )
    stored = posts.select("title", "datetime", "first_captured_at", "first_seq", "inserted_in")
    return seen.join(stored, "title").filter(post_existed(batch_id)).select("community", "datetime")


def marks(communities: DataFrame, touched: DataFrame, run_started_at: datetime) -> DataFrame:
    """One mark per community: the oldest touched time, never later than the start of the run."""
    start = F.lit(run_started_at).cast("timestamp_ntz")
    oldest = touched.groupBy("community").agg(F.min("datetime").alias("oldest"))
    return (
        communities.filter(fits("community", WIDTH["mark_community"]))
        .join(oldest, "community", "left")
        .select(F.least(start, "oldest").alias("datetime"), "community")
    )


def oldest(times: DataFrame, run_started_at: datetime) -> DataFrame:
    """``marks`` of rows that are themselves what a run touched: one aggregation over them."""
    start = F.lit(run_started_at).cast("timestamp_ntz")
    width = min(WIDTH["community"], WIDTH["mark_community"])
    return (
        times.filter(F.col("community").isNotNull() & fits("community", width))
        .groupBy("community")
        .agg(F.min("datetime").alias("oldest"))
        .select(F.least(start, "oldest").alias("datetime"), "community")
    )


def merge_marks(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Marks after a run: a community's new mark replaces its old one; others stay."""
    old = stored.select("community", F.col("datetime").alias("old"))
    new = incoming.select("community", F.col("datetime").alias("new"))
    return new.join(old, "community", "full_outer").select(
        F.coalesce("new", "old").alias(MARK.names[0]), "community"
    )
