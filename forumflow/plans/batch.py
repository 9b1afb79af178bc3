"""One run: captured items and the stored state in, the changed state and rejects out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.operators import marks as mk
from forumflow.operators import merge
from forumflow.operators.quality import fits, reject_rows
from forumflow.operators.typed import flatten_comments, post_rows, type_comments, type_posts
from forumflow.schemas import REJECT, STATE, WIDTH
from forumflow.semantics import DEFAULT, Semantics
from forumflow.session import scratch_path


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    """The five state tables without rows."""
    return {name: spark.createDataFrame([], schema) for name, schema in STATE.items()}


@dataclass(frozen=True)
class Batch:
    """What a run of ``run_batch`` needs besides the data.

    stage   called with (name, rows, partition column or None) for an intermediate that
            several steps read; may write it down and return the written table.
    stored  called with (table name, rows carrying its keys); returns at least the stored
            rows that have one of these keys.
    emit    called with (table name, rows) for each result; may write it down likewise.
    """

    batch_id: int
    run_started_at: datetime
    semantics: Semantics = DEFAULT
    stage: Callable[[str, DataFrame, str | None], DataFrame] = lambda name, rows, by: rows
    emit: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows


def run_batch(
    items: DataFrame, stored: Callable[[str, DataFrame], DataFrame], batch: Batch
) -> dict[str, DataFrame]:
    """Type, check, fold and merge one batch.

    The source is read twice, once for posts without their comments and once for comments;
    every later step works on the staged results.
    """
    keys = list(batch.semantics.comment_key)
    typed = type_posts(items, batch.semantics)
    posts_in = batch.stage("post_rows", post_rows(typed), None)

    communities = batch.stage("communities", mk.batch_communities(posts_in), None)
    out = {
        "community": batch.emit(
            "community",
            merge.upsert_communities(communities, stored("community", communities)),
        )
    }

    post_fold = batch.stage("post_fold", merge.fold_posts(posts_in), None)
    posts = batch.emit(
        "post", merge.upsert_posts(post_fold, stored("post", post_fold), batch.batch_id)
    )
    out["post"] = posts

    flat = flatten_comments(typed, where=F.col("reason").isNull())
    comments_in = batch.stage("comment_rows", type_comments(flat, batch.semantics), "pending")
    settled = merge.settle_comments(comments_in, posts, batch.batch_id)
    comment_fold = batch.stage("comment_fold", merge.fold_comments(settled, keys), None)
    out["comment"] = batch.emit(
        "comment", merge.upsert_comments(comment_fold, stored("comment", comment_fold), keys)
    )

    touched = {
        "post_mark": mk.touched_posts(posts_in, posts, batch.batch_id),
        "comment_mark": settled.filter(F.col("reason").isNull()).select("community", "datetime"),
    }
    for name, times in touched.items():
        new = mk.marks(communities, times, batch.run_started_at)
        out[name] = batch.emit(name, mk.merge_marks(stored(name, new), new))

    unmarked = communities.filter(~fits("community", WIDTH["mark_community"])).select(
        F.lit("mark").alias("stage"),
        F.lit("community").alias("reason"),
        F.lit(None).cast("bigint").alias("seq"),
        F.lit(None).cast("bigint").alias("pos"),
        F.col("community").alias("raw"),
    )
    rejects = (
        reject_rows(merge.settle_posts(posts_in, posts, batch.batch_id), "post")
        .unionByName(reject_rows(settled, "comment", F.col("pos")))
        .unionByName(unmarked)
    )
    out["rejects"] = batch.emit("rejects", rejects.select(*REJECT.names))
    return out


def run_staged(
    items: DataFrame,
    state: Mapping[str, DataFrame],
    run_started_at: datetime,
    batch_id: int = 0,
    semantics: Semantics = DEFAULT,
) -> dict[str, DataFrame]:
    """``run_batch`` over whole state tables, with the intermediates written to scratch.

    The results other than posts stay lazy.
    """
    spark = items.sparkSession
    work = scratch_path(spark, "run")

    def stage(name: str, rows: DataFrame, by: str | None) -> DataFrame:
        writer = rows.write.partitionBy(by) if by else rows.write
        writer.parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    def emit(name: str, rows: DataFrame) -> DataFrame:
        # Posts are looked up by comments, marks and rejects; the other results are not read again.
        return stage(name, rows, None) if name == "post" else rows

    batch = Batch(batch_id, run_started_at, semantics, stage, emit)
    return run_batch(items, lambda name, rows: state[name], batch)


def run_in_memory(
    items: DataFrame,
    state: Mapping[str, DataFrame],
    run_started_at: datetime,
    batch_id: int = 0,
    semantics: Semantics = DEFAULT,
) -> dict[str, DataFrame]:
    """``run_batch`` as one lazy plan over whole state tables, writing nothing."""
    batch = Batch(batch_id, run_started_at, semantics)
    return run_batch(items, lambda name, rows: state[name], batch)
