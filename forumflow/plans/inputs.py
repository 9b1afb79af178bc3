"""The driver's tables in the shapes the operators take.

Display texts are made by expressions that Spark and an ANSI SQL engine read alike, so both
sides of a check start from the same input. Every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.operators.extract import assemble_items
from forumflow.operators.typed import conform
from forumflow.schemas import PAGE, POST_ITEM

# One observed post per event, with one comment; (name, expression) over the events table.
EVENT_TEXTS = {
    "seq": "event_id",
    "community": "event_type",
    "captured_at": "ts",
    "title": "concat('p', cast(user_id as string))",
    "author": "case when event_id % 11 = 0 then null else concat('u', cast(event_id % 1000 as string)) end",
    "age_text": """case when event_id % 23 = 0 then 'x hours ago' when event_id % 29 = 0 then '2 years ago'
        else case event_id % 6 when 0 then 'just now'
        when 1 then concat(cast(event_id % 23 + 1 as string), ' hours ago') when 2 then '1 minute ago'
        when 3 then concat(cast(event_id % 29 as string), ' days ago')
        when 4 then '2 months ago' else null end end""",
    "votes_text": """case when event_id % 7 = 0 then '•' when event_id % 13 = 0 then '1.2m'
        when event_id % 5 = 0 then concat(cast(event_id % 90 as string), '.', cast(event_id % 10 as string), 'k')
        when event_id % 3 = 0 then concat(cast(event_id % 900 as string), '.', cast(event_id % 97 % 10 as string), 'k')
        else cast(event_id % 500 as string) end""",
    "percent_text": """case when event_id % 17 = 0 then '7' else case event_id % 4 when 0 then null when 1 then ''
        when 2 then concat(cast(event_id % 101 as string), '% Upvoted')
        else concat(' ', cast(event_id % 101 as string), '% Upvoted') end end""",
    "first_paragraph": "case when event_id % 9 = 0 then null else props end",
    "second_paragraph": "event_type",
    "c_author": "case when event_id % 19 = 0 then null else concat('c', cast(user_id as string)) end",
    "c_votes": """case when event_id % 8 = 0 then null when event_id % 31 = 0 then '•'
        when event_id % 3 = 0 then 'Vote' when event_id % 5 = 0 then concat(cast(event_id % 90 as string), '.5k')
        else cast(event_id % 50 as string) end""",
    "c_age": """case when event_id % 21 = 0 then null when event_id % 37 = 0 then 'yesterday'
        else concat(cast(event_id % 40 as string), ' hours ago') end""",
    "c_text": "concat(event_type, ' ', cast(event_id % 400 as string))",
}

# One row per turn; turn 0 is the post, later turns are its comments.
TURN_TEXTS = {
    "seq": "conv_id",
    "pos": "turn - 1",
    "community": "concat('topic', cast(conv_id % 12 as string))",
    "title": "text",
    "author": "concat(role, cast(conv_id % 50 as string))",
    "age_text": "concat(cast(conv_id % 25 as string), ' hours ago')",
    "votes_text": "concat(cast(conv_id % 40 as string), '.', cast(turn % 10 as string), 'k')",
    "percent_text": "concat(cast(conv_id % 101 as string), '% Upvoted')",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_texts(rows: DataFrame, texts: dict[str, str], *names: str) -> DataFrame:
    return rows.selectExpr(*[f"{texts[n]} as {n}" for n in names or texts])


def event_texts(rows: DataFrame, *names: str) -> DataFrame:
    """The named display texts of events, all by default."""
    return _with_texts(rows, EVENT_TEXTS, *names)


def event_items(rows: DataFrame) -> DataFrame:
    """Events as captured items."""
    comment = F.struct(
        F.col("c_author").alias("commentUserName"),
        F.col("c_votes").alias("commentUpVotes"),
        F.col("c_age").alias("commentTimeSince"),
        F.array("c_text").alias("commentText"),
    )
    return conform(
        event_texts(rows).select(
            "seq",
            "community",
            "captured_at",
            F.col("title").alias("postTitle"),
            F.col("author").alias("postUserName"),
            F.col("age_text").alias("postTimeSince"),
            F.col("votes_text").alias("postUpVotes"),
            F.col("percent_text").alias("postPercentUpVotes"),
            F.array("first_paragraph", "second_paragraph").alias("postText"),
            F.array(comment).alias("comments"),
        ),
        POST_ITEM,
    )


PART_SIZE = 10_000  # comments nested in a row; a storage choice that no result depends on


def conversation_items(rows: DataFrame, part_size: int | None = None) -> DataFrame:
    """Conversations as captured items: the first turn with all later ones nested in it."""
    captured_at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("conv_id") % 100_000).cast("int")
    )
    turns = rows.select(
        "turn",
        F.split("text", "\n").alias("paragraphs"),
        captured_at.alias("captured_at"),
        *[F.expr(sql).alias(name) for name, sql in TURN_TEXTS.items()],
    )
    posts = turns.filter(F.col("turn") == 0).select(
        "seq",
        "community",
        "captured_at",
        F.col("title").alias("postTitle"),
        F.col("author").alias("postUserName"),
        F.col("age_text").alias("postTimeSince"),
        F.col("votes_text").alias("postUpVotes"),
        F.col("percent_text").alias("postPercentUpVotes"),
        F.col("paragraphs").alias("postText"),
    )
    comments = turns.filter(F.col("turn") > 0).select(
        "seq",
        "pos",
        F.struct(
            F.col("author").alias("commentUserName"),
            F.col("votes_text").alias("commentUpVotes"),
            F.col("age_text").alias("commentTimeSince"),
            F.col("paragraphs").alias("commentText"),
        ).alias("comment"),
    )
    size = part_size or PART_SIZE
    return conform(assemble_items(posts, comments, ["seq"], part_size=size), POST_ITEM)


def page_archive(rows: DataFrame) -> DataFrame:
    """Pages under the archive schema; the community is the language of the page."""
    return conform(
        rows.select(
            "url",
            F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("community"),
            F.lit("post").alias("kind"),
            F.col("page_id").alias("seq"),
            "html",
        ),
        PAGE,
    )
