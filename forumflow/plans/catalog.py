"""Registered queries: each operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow import functions as ff
from forumflow.operators import marks as mk
from forumflow.operators import merge, quality
from forumflow.operators.extract import (
    LINK,
    POST_LAYOUT,
    TITLE,
    First,
    ListingRules,
    PostRules,
    drop_promoted,
    extract_cards,
    extract_firsts,
    extract_posts,
    resolve_url,
)
from forumflow.operators.markup import Nodes
from forumflow.operators.typed import (
    content_id,
    first_parts,
    flatten_comments,
    post_rows,
    project_posts,
    type_comments,
    type_posts,
)
from forumflow.plans.batch import empty_state, run_staged
from forumflow.plans.inputs import (
    conversation_items,
    event_items,
    event_texts,
    page_archive,
    table,
)
from forumflow.schemas import WIDTH
from forumflow.session import scratch_path
from forumflow.sources.items import seed_conflicts, union_communities
from forumflow.sources.keyed import KeyedStore
from forumflow.streaming.ingest import latest, stream_fold, stream_to_files, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

BASE_URL = "https://forum.example"
RUN_STARTED = datetime(2024, 1, 15)
BATCH = 0
FIRST_SEGMENT = r"^[a-z]+://[^/]+/([^/?#]+)"

# The pages' own layout, as rules.
MENU = ListingRules(card=Nodes(".//li"), label=Nodes("./a"), link=Nodes("./a"))
ARTICLE = PostRules(
    **{
        **POST_LAYOUT.__dict__,
        "author": Nodes(".//nav//a"),
        "votes": Nodes(".//div[@class]", prefix=("class", "ad")),
        "percent": (Nodes(".//h2"), Nodes(".//title")),
        "box": Nodes(".//article"),
        "paragraph": Nodes(".//p"),
        "comment": Nodes(".//article"),
        "comment_author": Nodes("./h1"),
        "comment_paragraph": Nodes(".//p"),
    }
)


def _digest(column):
    return F.sha2(column, 256)


# Which events had arrived before: those of the communities early in the alphabet.
def _earlier(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") < "m")


def _later(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") >= "m")


def _posts(spark: SparkSession, items: DataFrame) -> DataFrame:
    fold = merge.fold_posts(post_rows(type_posts(items)))
    return merge.upsert_posts(fold, empty_state(spark)["post"], BATCH)


POST_COLUMNS = [
    "id",
    "title",
    "author",
    "upvotes",
    "percent_upvotes",
    "comment_count",
    "text",
    "datetime",
    "community",
]
COMMENT_COLUMNS = ["post_id", "id", "author", "upvotes", "text", "datetime", "community"]


# Sources and sinks


def scan_pages(spark, sf_dir):
    return page_archive(table(spark, sf_dir, "pages")).select(
        "seq",
        "url",
        "community",
        F.length("html").alias("n_chars"),
        _digest("html").alias("html_digest"),
    )


def assemble_items(spark, sf_dir):
    # One row per comment, and one for an item without any.
    items = conversation_items(table(spark, sf_dir, "conversations"))
    first = F.col("pos_offset") == 0
    return items.select(
        "seq",
        "community",
        "postTitle",
        "comment_total",
        "pos_offset",
        F.posexplode_outer("comments").alias("index", "comment"),
    ).filter(first | F.col("index").isNotNull()).select(
        "seq",
        "community",
        "postTitle",
        "comment_total",
        (F.col("pos_offset") + F.col("index")).alias("pos"),
        F.col("comment.commentUserName").alias("author"),
        _digest(F.array_join("comment.commentText", "\n")).alias("text_digest"),
    )


def union_of_communities(spark, sf_dir):
    items = union_communities(
        {
            "from_events": event_items(table(spark, sf_dir, "events")),
            "from_conversations": conversation_items(table(spark, sf_dir, "conversations")),
        }
    )
    return first_parts(items).select("community", "seq", "postTitle", "postUpVotes")


def seed_consistency(spark, sf_dir):
    archive = page_archive(table(spark, sf_dir, "pages")).select("community", "url", "html")
    pages = extract_firsts(archive, {"href": LINK}, ["community", "url"])
    link = resolve_url(BASE_URL, F.col("href"))
    seeds = pages.select(
        "community",
        F.col("url").alias("start_url"),
        F.concat(
            F.lit("['"), F.col("url"), F.lit("', '"), F.coalesce(link, F.lit("")), F.lit("']")
        ).alias("start_url_list"),
    )
    return seed_conflicts(seeds, FIRST_SEGMENT)


def sink_roundtrip(spark, sf_dir):
    store = KeyedStore(spark, scratch_path(spark, "store"), {"post": 8, "comment": 8})
    store.apply(event_items(table(spark, sf_dir, "events")), RUN_STARTED, BATCH)
    return store.table("post").select(*POST_COLUMNS)


def sink_two_batches(spark, sf_dir):
    """Two arrivals through the stored tables: the second reads and replaces touched buckets."""
    events = table(spark, sf_dir, "events")
    store = KeyedStore(spark, scratch_path(spark, "store"), {"post": 8, "comment": 8})
    store.apply(event_items(_earlier(events)), RUN_STARTED, BATCH)
    store.apply(event_items(_later(events)), RUN_STARTED, BATCH + 1)
    return store.table("post").select(*POST_COLUMNS, "last_seq", "inserted_in")


# Extraction


def extract_cards_query(spark, sf_dir):
    return extract_cards(table(spark, sf_dir, "pages"), MENU, ["page_id"])


def extract_title(spark, sf_dir):
    return extract_firsts(table(spark, sf_dir, "pages"), {"title": TITLE}, ["page_id"])


def extract_first_link(spark, sf_dir):
    return extract_firsts(table(spark, sf_dir, "pages"), {"href": LINK}, ["page_id"])


def extract_fallback(spark, sf_dir):
    text = First((Nodes(".//p"), *TITLE.rules))
    return extract_firsts(table(spark, sf_dir, "pages"), {"text": text}, ["page_id"])


def extract_paragraphs(spark, sf_dir):
    posts = extract_posts(table(spark, sf_dir, "pages"), ARTICLE, ["page_id"])
    return posts.select("page_id", F.posexplode("postText").alias("pos", "text"))


def extract_nested(spark, sf_dir):
    posts = extract_posts(table(spark, sf_dir, "pages"), ARTICLE, ["page_id"])
    return posts.select(
        "page_id",
        "postTitle",
        F.col("postUserName").alias("first_menu_text"),
        F.col("postUpVotes").alias("ad_text"),
        F.col("postPercentUpVotes").alias("h2_or_title"),
        F.posexplode("comments").alias("pos", "comment"),
    ).select(
        "page_id",
        "postTitle",
        "first_menu_text",
        "ad_text",
        "h2_or_title",
        "pos",
        F.col("comment.commentUserName").alias("author"),
        F.size("comment.commentText").alias("n_paragraphs"),
        _digest(F.array_join("comment.commentText", "\n")).alias("text_digest"),
    )


def paragraph_null_literal(spark, sf_dir):
    # The role stands for a first paragraph, an empty one for the user's turns.
    role = F.array(F.nullif("role", F.lit("user")))
    paragraphs = F.concat(role, F.split("text", "\n"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        ff.combine_paragraphs(paragraphs, null_literal=True).alias("text"),
        ff.combine_paragraphs(role, "last", null_literal=True).alias("role_text"),
        ff.combine_paragraphs(role, "last").alias("role_text_or_null"),
    )


# Filters and checks


def filter_promoted(spark, sf_dir):
    cards = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            "case event_id % 4 when 0 then 'promoted' when 1 then null else event_type end"
        ).alias("label"),
    )
    return drop_promoted(cards)


def resolve_url_query(spark, sf_dir):
    pages = extract_firsts(table(spark, sf_dir, "pages"), {"href": LINK}, ["page_id", "url"])
    return pages.select(
        "page_id",
        resolve_url(BASE_URL, F.col("href")).alias("post_url"),
        resolve_url(BASE_URL, F.col("url")).alias("page_url"),
    )


def project_post(spark, sf_dir):
    items = first_parts(conversation_items(table(spark, sf_dir, "conversations")))
    return project_posts(items).select(
        "seq", "community", "title", "author", "age_text", "votes_text", "percent_text", "comment_count"
    )


def filter_complete(spark, sf_dir):
    typed = type_comments(
        flatten_comments(type_posts(event_items(table(spark, sf_dir, "events"))))
    )
    columns = ["author", "upvotes", "datetime", "text", "post_id"]
    return quality.complete(typed, columns).select("seq", "pos", *columns)


def validate_rows(spark, sf_dir):
    rules = {
        "lang": F.col("lang").isNotNull() & quality.fits("lang", 255),
        "source": F.col("source").isNotNull() & quality.fits("source", 255),
        "text": F.col("text").isNotNull() & quality.fits("text", WIDTH["text"]),
    }
    return quality.validate(table(spark, sf_dir, "documents"), rules).select("doc_id", "reason")


def fk_orphans(spark, sf_dir):
    return quality.orphans(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


def unique_violations(spark, sf_dir):
    return quality.duplicates(
        table(spark, sf_dir, "documents"), F.sha2("text", 256), "text_digest"
    )


# Scalar functions


def votes_post(spark, sf_dir):
    shown = event_texts(table(spark, sf_dir, "events"), "seq", "votes_text")
    return shown.select(
        "seq",
        "votes_text",
        ff.post_votes(F.col("votes_text")).alias("upvotes"),
        ff.post_votes(F.col("votes_text"), "double").alias("upvotes_binary"),
    )


def votes_comment(spark, sf_dir):
    shown = event_texts(table(spark, sf_dir, "events"), "seq", "c_votes")
    return shown.select("seq", "c_votes", ff.comment_votes(F.col("c_votes")).alias("upvotes"))


def percent_upvoted(spark, sf_dir):
    shown = event_texts(table(spark, sf_dir, "events"), "seq", "percent_text")
    return shown.select(
        "seq", "percent_text", ff.percent_upvoted(F.col("percent_text")).alias("percent")
    )


def relative_time(spark, sf_dir):
    shown = event_texts(table(spark, sf_dir, "events"), "seq", "age_text", "captured_at")
    text, at = F.col("age_text"), F.col("captured_at")
    return shown.select(
        "seq",
        ff.relative_time(text, at).alias("datetime"),
        ff.age_ok(text, at).alias("age_ok"),
        ff.age_known(text).alias("age_known"),
    )


def combine_join(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", ff.combine_paragraphs(F.split("text", "\n")).alias("text")
    )


def combine_last(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", ff.combine_paragraphs(F.split("text", "\n"), "last").alias("text")
    )


def word_split(spark, sf_dir):
    split = table(spark, sf_dir, "documents").select("doc_id", ff.words(F.col("text")).alias("w"))
    return split.select(
        "doc_id",
        F.size("w").alias("n_words"),
        F.get("w", F.lit(0)).alias("first_word"),
        _digest(F.array_join("w", "\n")).alias("words_digest"),
    )


def comment_count(spark, sf_dir):
    items = first_parts(conversation_items(table(spark, sf_dir, "conversations")))
    count = ff.comment_count(F.col("comments"), F.col("comment_total"))
    return items.select("seq", count.alias("comment_count"))


# Lookups


def upsert_community(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = event_texts(events, "community")
    earlier = event_texts(_earlier(events), "community")
    stored = merge.upsert_communities(earlier, empty_state(spark)["community"])
    return merge.upsert_communities(rows, stored)


def lookup_post(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stored = _posts(spark, event_items(_earlier(events)))
    rows = event_texts(events, "seq", "title")
    return merge.lookup(rows, stored, ["title"], ["author", "upvotes", "datetime"])


def resolve_post_id(spark, sf_dir):
    typed = type_posts(conversation_items(table(spark, sf_dir, "conversations")))
    comments = flatten_comments(typed).select("seq", "pos", "title")
    return merge.resolve_post_id(
        comments, _posts(spark, conversation_items(table(spark, sf_dir, "conversations")))
    ).select("seq", "pos", "post_id")


def lookup_comment(spark, sf_dir):
    # Long texts are looked up by their content id, so that they need not be shuffled.
    documents = table(spark, sf_dir, "documents").select(
        content_id("text").alias("id"), "source", "doc_id"
    )
    stored = merge.last_per_key(documents.filter(F.col("source") < "src5"), ["id"], ["doc_id"])
    return merge.lookup(
        documents.select("doc_id", "id"), stored, ["id"], ["source", "doc_id"]
    ).drop("id")


def flatten_comments_query(spark, sf_dir):
    typed = type_posts(conversation_items(table(spark, sf_dir, "conversations")))
    return flatten_comments(typed).select(
        "seq",
        "pos",
        "community",
        "post_id",
        "author",
        "votes_text",
        F.array_join("paragraphs", "\n").alias("text"),
    )


# Folds, upserts and marks


def upsert_posts(spark, sf_dir):
    return _posts(spark, event_items(table(spark, sf_dir, "events"))).select(*POST_COLUMNS)


def _run(spark, items):
    return run_staged(items, empty_state(spark), RUN_STARTED, BATCH)


def upsert_comments(spark, sf_dir):
    return _run(spark, event_items(table(spark, sf_dir, "events")))["comment"].select(
        *COMMENT_COLUMNS
    )


def post_mark(spark, sf_dir):
    # Typed once and written, as the fold, the touched posts and the communities all read it.
    typed = post_rows(type_posts(event_items(table(spark, sf_dir, "events"))))
    path = scratch_path(spark, "post-rows")
    typed.write.parquet(path)
    rows = spark.read.schema(typed.schema).parquet(path)
    posts = merge.upsert_posts(merge.fold_posts(rows), empty_state(spark)["post"], BATCH)
    touched = mk.touched_posts(rows, posts, BATCH)
    return mk.marks(mk.batch_communities(rows), touched, RUN_STARTED)


def comment_mark(spark, sf_dir):
    return _run(spark, event_items(table(spark, sf_dir, "events")))["comment_mark"]


def merge_marks(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = event_texts(events, "community", "captured_at")

    def simple(rows):
        times = rows.select("community", F.col("captured_at").alias("datetime"))
        return mk.oldest(times, RUN_STARTED)

    stored = simple(event_texts(events, "title", "captured_at").withColumnRenamed("title", "community"))
    return mk.merge_marks(stored, simple(rows))


def fold_duplicates(spark, sf_dir):
    typed = post_rows(type_posts(event_items(table(spark, sf_dir, "events"))))
    return merge.fold_posts(typed).select(
        "title",
        F.col("first.author").alias("first_author"),
        F.col("first.seq").alias("first_seq"),
        F.col("last.upvotes").alias("last_upvotes"),
        F.col("last.seq").alias("last_seq"),
    )


def first_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return merge.first_per_key(rows, ["user_id"], ["event_id"])


def conversation_posts(spark, sf_dir):
    items = conversation_items(table(spark, sf_dir, "conversations"))
    return _run(spark, items)["post"].select(*POST_COLUMNS)


def conversation_comments(spark, sf_dir):
    items = conversation_items(table(spark, sf_dir, "conversations"))
    return _run(spark, items)["comment"].select(*COMMENT_COLUMNS)


# Incremental


def _event_stream(spark, sf_dir):
    # As a pattern the path may name one file as well as a folder of files.
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _fold_columns(folded: DataFrame) -> DataFrame:
    return folded.select(
        "title",
        F.col("first.author").alias("first_author"),
        F.col("first.seq").alias("first_seq"),
        F.col("last.upvotes").alias("last_upvotes"),
        F.col("last.seq").alias("last_seq"),
    )


def stream_fold_query(spark, sf_dir):
    """The fold of all events kept as streaming state, over files arriving in two runs.

    The events are dealt in two by a hash of their id; the first run finds one half of them, a
    restart on the same checkpoint the other, each in two epochs. An epoch's files are as many as
    the tasks that read the events, since a file of one row group is read by one task.
    """
    events = table(spark, sf_dir, "events")
    out = scratch_path(spark, "stream-fold")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    n_files = events.rdd.getNumPartitions()
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", n_files)

    def fold(rows):
        return merge.fold_posts(post_rows(type_posts(event_items(rows))))

    for part in (0, 1):
        arriving = events.where(half == part).repartition(2 * n_files)
        arriving.write.mode("append").parquet(f"{out}/inbox")
        stream = reader.parquet(f"{out}/inbox")
        query = stream_fold(stream, fold, f"{out}/updates", f"{out}/checkpoint", "stream_fold")
        query.awaitTermination()
    return _fold_columns(latest(spark, f"{out}/updates", "title"))


def stream_ingest(spark, sf_dir):
    stream = _event_stream(spark, sf_dir)
    rows = post_rows(type_posts(event_items(stream)))
    out = scratch_path(spark, "stream-ingest")
    query = stream_to_files(rows, f"{out}/rows", f"{out}/checkpoint", "stream_ingest")
    query.awaitTermination()
    return (
        spark.read.schema(rows.schema)
        .parquet(f"{out}/rows")
        .select("seq", "community", "title", "upvotes", "datetime", "reason", "insert_reason")
    )


def stream_upsert_query(spark, sf_dir):
    stream = _event_stream(spark, sf_dir)
    out = scratch_path(spark, "stream-upsert")
    store = KeyedStore(spark, f"{out}/state", {"post": 8, "comment": 8})
    query = stream_upsert(
        event_items(stream), store, f"{out}/checkpoint", "stream_upsert", clock=lambda: RUN_STARTED
    )
    query.awaitTermination()
    return store.table("post").select(*POST_COLUMNS)


def late_update(spark, sf_dir):
    """Two arrivals whose captures interleave in time: older counters must not win."""
    events = table(spark, sf_dir, "events")
    first = _posts(spark, event_items(_earlier(events)))
    fold = merge.fold_posts(post_rows(type_posts(event_items(_later(events)))))
    return merge.upsert_posts(fold, first, BATCH + 1).select(*POST_COLUMNS, "last_seq", "inserted_in")


def reject_report(spark, sf_dir):
    return _run(spark, event_items(table(spark, sf_dir, "events")))["rejects"].drop("raw")


QUERIES: dict[str, Query] = {
    "scan_pages": scan_pages,
    "assemble_items": assemble_items,
    "union_communities": union_of_communities,
    "seed_consistency": seed_consistency,
    "sink_roundtrip": sink_roundtrip,
    "sink_two_batches": sink_two_batches,
    "extract_cards": extract_cards_query,
    "extract_title": extract_title,
    "extract_first_link": extract_first_link,
    "extract_fallback": extract_fallback,
    "extract_paragraphs": extract_paragraphs,
    "extract_nested": extract_nested,
    "paragraph_null_literal": paragraph_null_literal,
    "filter_promoted": filter_promoted,
    "resolve_url": resolve_url_query,
    "project_post": project_post,
    "filter_complete": filter_complete,
    "validate_rows": validate_rows,
    "fk_orphans": fk_orphans,
    "unique_violations": unique_violations,
    "votes_post": votes_post,
    "votes_comment": votes_comment,
    "percent_upvoted": percent_upvoted,
    "relative_time": relative_time,
    "combine_join": combine_join,
    "combine_last": combine_last,
    "word_split": word_split,
    "comment_count": comment_count,
    "upsert_community": upsert_community,
    "lookup_post": lookup_post,
    "resolve_post_id": resolve_post_id,
    "lookup_comment": lookup_comment,
    "flatten_comments": flatten_comments_query,
    "upsert_posts": upsert_posts,
    "upsert_comments": upsert_comments,
    "post_mark": post_mark,
    "comment_mark": comment_mark,
    "merge_marks": merge_marks,
    "fold_duplicates": fold_duplicates,
    "first_per_key": first_per_key,
    "conversation_posts": conversation_posts,
    "conversation_comments": conversation_comments,
    "stream_ingest": stream_ingest,
    "stream_upsert": stream_upsert_query,
    "stream_fold": stream_fold_query,
    "late_update": late_update,
    "reject_report": reject_report,
}
