"""Keyed folds and upserts.

Sequential "insert the first time, update afterwards" becomes an aggregate over an order
key: ``min_by`` for what the first sighting fixes, ``max_by`` for what the last one sets.
Both combine before the shuffle, so a key that a third of all rows share still arrives as
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumflow.operators.typed import content_id
from forumflow.schemas import COMMENT, POST

_ORDER = ("captured_at", "seq")


def not_before(left: Sequence[str], right: Sequence[str]) -> Column:
    """Whether one order key is equal to or after another, column by column.

    NULL when a key is missing; comparing structs would call a struct of NULLs the smaller one.
    """
    result = F.col(left[-1]) >= F.col(right[-1])
    for a, b in zip(reversed(left[:-1]), reversed(right[:-1])):
        result = (F.col(a) > F.col(b)) | ((F.col(a) == F.col(b)) & result)
    return result


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, whatever order the input has."""
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
        .select(*keys, "row.*")
    )


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
        .select(*keys, "row.*")
    )


def lookup(rows: DataFrame, stored: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every row with the ``stored_`` columns found under its key, and ``known`` to tell if any.

    ``stored`` has at most one row per key, so rows are never multiplied. Adaptive execution
    splits a key that very many rows look up.
    """
    found = stored.select(
        *on, *[F.col(c).alias(f"stored_{c}") for c in columns], F.lit(True).alias("known")
    )
    return rows.join(found, list(on), "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def resolve_post_id(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments with the id of the stored post of their title; others are dropped."""
    return comments.join(posts.select("title", F.col("id").alias("post_id")), "title")


def new_communities(rows: DataFrame, communities: DataFrame) -> DataFrame:
    """Communities among the rows that are not stored yet."""
    return (
        rows.select("community")
        .distinct()
        .join(communities.select("community"), "community", "left_anti")
        .select(content_id("community").alias("id"), "community")
    )


def upsert_communities(rows: DataFrame, communities: DataFrame) -> DataFrame:
    """Stored communities and the new ones."""
    return communities.select("id", "community").unionByName(new_communities(rows, communities))


def fold_posts(rows: DataFrame) -> DataFrame:
    """One row per title of usable post rows: ``first`` able to create it, and ``last``.

    Unusable rows are told apart inside the aggregate. A filter would be pushed below the
    typing of the rows and work out every value a second time.
    """
    order = F.struct(*_ORDER)
    usable = F.col("reason").isNull() & (F.col("pos_offset") == 0)
    creates = usable & F.col("insert_reason").isNull()
    return (
        rows.groupBy(F.when(usable, F.col("title")).alias("title"))
        .agg(
            F.min_by(
                F.struct("author", "text", "datetime", *_ORDER), F.when(creates, order)
            ).alias("first"),
            F.max_by(
                F.struct("upvotes", "percent_upvotes", "comment_count", "community", *_ORDER),
                F.when(usable, order),
            ).alias("last"),
        )
        .filter(F.col("last").isNotNull())
    )


def upsert_posts(fold: DataFrame, posts: DataFrame, batch_id: int) -> DataFrame:
    """Stored posts after a batch.

    A new title is inserted whole. A known one keeps its author, text and time and takes the
    counters and community of the latest capture, be it stored or incoming.
    """
    stored = posts.select("title", F.struct(*[c for c in POST.names if c != "title"]).alias("old"))
    joined = fold.join(stored, "title", "full_outer").filter(
        F.col("old").isNotNull() | F.col("first").isNotNull()
    )
    known = F.col("old").isNotNull()
    newer = F.col("last").isNotNull() & (
        ~known
        | not_before(
            ("last.captured_at", "last.seq"), ("old.last_captured_at", "old.last_seq")
        )
    )

    def fixed(column: str, source: str | None = None) -> Column:
        return F.when(known, F.col(f"old.{column}")).otherwise(F.col(f"first.{source or column}"))

    def counter(column: str, source: str | None = None) -> Column:
        return F.when(newer, F.col(f"last.{source or column}")).otherwise(F.col(f"old.{column}"))

    columns = {
        "id": content_id("title"),
        "title": F.col("title"),
        "author": fixed("author"),
        "upvotes": counter("upvotes"),
        "percent_upvotes": counter("percent_upvotes"),
        "comment_count": counter("comment_count"),
        "text": fixed("text"),
        "datetime": fixed("datetime"),
        "community": counter("community"),
        "first_captured_at": fixed("first_captured_at", "captured_at"),
        "first_seq": fixed("first_seq", "seq"),
        "last_captured_at": counter("last_captured_at", "captured_at"),
        "last_seq": counter("last_seq", "seq"),
        "inserted_in": F.when(known, F.col("old.inserted_in")).otherwise(F.lit(batch_id)),
    }
    return joined.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in POST]
    )


def post_existed(batch_id: int) -> Column:
    """Whether a stored post had been created when the item with this order key came."""
    return (F.col("inserted_in") < batch_id) | not_before(
        _ORDER, ("first_captured_at", "first_seq")
    )


def _creation_keys(posts: DataFrame) -> DataFrame:
    return posts.select("title", "first_captured_at", "first_seq", "inserted_in")


def settle_posts(rows: DataFrame, posts: DataFrame, batch_id: int) -> DataFrame:
    """Post rows with their final ``reason``, NULL for accepted ones.

    ``posts`` is the table after the batch. Rows that can create their post need no lookup;
    only the others go through the join. Of a discussion in parts the first part speaks.
    """
    rows = rows.filter(F.col("pos_offset") == 0)
    plain = rows.filter(F.col("reason").isNotNull() | F.col("insert_reason").isNull())
    looked_up = (
        rows.filter(F.col("reason").isNull() & F.col("insert_reason").isNotNull())
        .join(_creation_keys(posts), "title", "left")
        .withColumn(
            "reason",
            F.when(~F.coalesce(post_existed(batch_id), F.lit(False)), F.col("insert_reason")),
        )
    )
    return plain.unionByName(looked_up.select(*plain.columns))


def settle_comments(rows: DataFrame, posts: DataFrame, batch_id: int) -> DataFrame:
    """Comment rows of accepted items; comments of other items fall with their item.

    Comments of a later part whose post never came are kept with the reason ``post``.
    """
    plain = rows.filter(~F.col("pending"))
    exists = F.coalesce(post_existed(batch_id), F.lit(False))
    looked_up = (
        rows.filter(F.col("pending"))
        .join(_creation_keys(posts), "title", "left")
        .withColumn("exists", exists)
        .filter(F.col("exists") | F.col("later"))
        .withColumn("reason", F.when(F.col("exists"), F.col("reason")).otherwise("post"))
    )
    return plain.unionByName(looked_up.select(*plain.columns))


def fold_comments(rows: DataFrame, keys: Sequence[str] = ("text",)) -> DataFrame:
    """The latest sighting per comment key among storable comment rows."""
    columns = ["author", "upvotes", "text", "datetime", "post_id", "community", *_ORDER, "pos"]
    return last_per_key(
        rows.filter(F.col("reason").isNull()).select(*columns), list(keys), [*_ORDER, "pos"]
    )


def upsert_comments(
    fold: DataFrame, comments: DataFrame, keys: Sequence[str] = ("text",)
) -> DataFrame:
    """Stored comments after a batch: the latest capture wins, be it stored or incoming."""
    keys = list(keys)
    new = fold.select(*keys, F.struct(*[c for c in fold.columns if c not in keys]).alias("new"))
    old = comments.select(*keys, F.struct(*[c for c in COMMENT.names if c not in keys]).alias("old"))
    joined = new.join(old, keys, "full_outer")
    newer = F.col("new").isNotNull() & (
        F.col("old").isNull()
        | not_before(
            ("new.captured_at", "new.seq", "new.pos"),
            ("old.last_captured_at", "old.last_seq", "old.last_pos"),
        )
    )
    source = {"last_captured_at": "captured_at", "last_seq": "seq", "last_pos": "pos"}

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name == "id":
            return content_id(*keys)
        return F.when(newer, F.col(f"new.{source.get(name, name)}")).otherwise(F.col(f"old.{name}"))

    return joined.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in COMMENT])
