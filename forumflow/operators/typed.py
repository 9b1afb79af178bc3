"""Captured items to typed post and comment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forumflow import functions as ff
from forumflow.operators.quality import first_violation, fits
from forumflow.schemas import POST_ITEM, WIDTH
from forumflow.semantics import DEFAULT, Semantics


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of the schema, in order; absent ones are NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def content_id(*keys: str):
    """Identifier derived from the key columns; the same key gives the same id everywhere."""
    text = F.col(keys[0]) if len(keys) == 1 else F.concat_ws("\x00", *keys)
    return F.sha2(text, 256)


def first_parts(items: DataFrame) -> DataFrame:
    """One row per item, however many parts its discussion came in."""
    return items.filter(F.coalesce("pos_offset", F.lit(0)) == 0)


def project_posts(items: DataFrame) -> DataFrame:
    """Item fields under the names of the post table, still as displayed."""
    return items.select(
        "seq",
        "captured_at",
        F.coalesce("pos_offset", F.lit(0)).cast("bigint").alias("pos_offset"),
        "community",
        F.col("postTitle").alias("title"),
        F.col("postUserName").alias("author"),
        F.col("postTimeSince").alias("age_text"),
        F.col("postUpVotes").alias("votes_text"),
        F.col("postPercentUpVotes").alias("percent_text"),
        F.col("postText").alias("paragraphs"),
        "comments",
        ff.comment_count(F.col("comments"), F.col("comment_total")).alias("comment_count"),
    )


def type_posts(items: DataFrame, semantics: Semantics = DEFAULT) -> DataFrame:
    """One typed row per item, still with its comments.

    ``reason`` says why an item can be used for nothing; ``insert_reason`` why it cannot
    create a post, though it may update one that exists.
    """
    shown = project_posts(conform(items, POST_ITEM))
    at = F.col("captured_at")
    typed = shown.withColumns(
        {
            "post_id": content_id("title"),
            "upvotes": ff.post_votes(F.col("votes_text"), semantics.k_suffix),
            "percent_upvotes": ff.percent_upvoted(F.col("percent_text")),
            "datetime": ff.relative_time(F.col("age_text"), at, semantics.months),
            "age_known": ff.age_known(F.col("age_text")),
            "text": ff.combine_paragraphs(F.col("paragraphs"), semantics.paragraphs),
        }
    )
    reason = first_violation(
        {
            "order": at.isNotNull() & F.col("seq").isNotNull(),
            "community": F.col("community").isNotNull() & fits("community", WIDTH["community"]),
            "paragraphs": F.col("paragraphs").isNotNull(),
            "age": F.col("age_text").isNull() | F.col("datetime").isNotNull(),
            "votes": F.col("upvotes").isNotNull(),
            "percent": F.col("percent_upvotes").isNotNull(),
            "title": F.col("title").isNotNull() & fits("title", WIDTH["title"]),
        }
    )
    insert_reason = first_violation(
        {
            "author": F.col("author").isNotNull() & fits("author", WIDTH["author"]),
            "text": fits("text", WIDTH["text"]),
            "datetime": F.col("datetime").isNotNull(),
        }
    )
    return typed.withColumns({"reason": reason, "insert_reason": insert_reason})


def post_rows(typed: DataFrame) -> DataFrame:
    """The post part of typed items, without comments; ``raw`` only where something is wrong."""
    raw = F.to_json(
        F.struct(
            "community",
            "captured_at",
            "title",
            "author",
            "age_text",
            "votes_text",
            "percent_text",
            "paragraphs",
        )
    )
    suspect = F.col("reason").isNotNull() | F.col("insert_reason").isNotNull()
    return typed.select(
        "seq",
        "captured_at",
        "pos_offset",
        "community",
        "title",
        "author",
        "upvotes",
        "percent_upvotes",
        "comment_count",
        "text",
        "datetime",
        "reason",
        "insert_reason",
        F.when(suspect, raw).alias("raw"),
    )


def flatten_comments(typed: DataFrame, where: Column | None = None) -> DataFrame:
    """One row per captured comment with its post's key columns; posts without any give none.

    ``where`` picks the items whose comments to take. It is applied inside the generator: as a
    filter it would be pushed below the typing of the items and work that out twice.
    """
    chosen = F.col("comments") if where is None else F.when(where, F.col("comments"))
    flat = typed.select(
        "seq",
        "captured_at",
        "community",
        "title",
        "post_id",
        "insert_reason",
        "pos_offset",
        F.posexplode_outer(chosen).alias("index", "comment"),
    )
    return flat.filter(F.col("index").isNotNull()).select(
        "seq",
        "captured_at",
        "pos_offset",
        (F.col("pos_offset") + F.col("index")).alias("pos"),
        "community",
        "title",
        "post_id",
        "insert_reason",
        F.col("comment.commentUserName").alias("author"),
        F.col("comment.commentUpVotes").alias("votes_text"),
        F.col("comment.commentTimeSince").alias("age_text"),
        F.col("comment.commentText").alias("paragraphs"),
    )


def type_comments(flat: DataFrame, semantics: Semantics = DEFAULT) -> DataFrame:
    """Typed comment rows; ``reason`` says why a row cannot be stored.

    ``pending`` marks comments whose post could not be created from their own row, be it that
    the item cannot or that this is a later part of it, so that it takes a look at the post table
    to tell whether they count.
    """
    at = F.col("captured_at")
    typed = flat.withColumns(
        {
            "upvotes": ff.comment_votes(F.col("votes_text"), semantics.k_suffix),
            "datetime": ff.relative_time(F.col("age_text"), at, semantics.months),
            "text": ff.combine_paragraphs(
                F.col("paragraphs"), semantics.paragraphs, semantics.null_literal
            ),
        }
    )
    reason = first_violation(
        {
            "votes": F.col("upvotes").isNotNull(),
            "age": F.col("age_text").isNull() | F.col("datetime").isNotNull(),
            "paragraphs": F.col("paragraphs").isNotNull(),
            "incomplete": F.col("author").isNotNull()
            & F.col("datetime").isNotNull()
            & F.col("text").isNotNull(),
            "author": fits("author", WIDTH["author"]),
            "text": fits("text", WIDTH["text"]),
        }
    )
    later = F.col("insert_reason").isNull() & (F.col("pos_offset") > 0)
    pending = F.col("insert_reason").isNotNull() | later
    raw = F.to_json(F.struct("author", "votes_text", "age_text", "paragraphs"))
    return typed.withColumns({"reason": reason, "pending": pending, "later": later}).select(
        "seq",
        "captured_at",
        "pos",
        "community",
        F.when(F.col("pending"), F.col("title")).alias("title"),
        "post_id",
        "author",
        "upvotes",
        "text",
        "datetime",
        "reason",
        "pending",
        "later",
        F.when(F.col("reason").isNotNull() | F.col("later"), raw).alias("raw"),
    )
