"""Archives of captured pages, and the way from pages to items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.operators.extract import (
    LISTING_LAYOUT,
    POST_LAYOUT,
    ListingRules,
    PostRules,
    drop_promoted,
    extract_cards,
    extract_posts,
    resolve_url,
)
from forumflow.operators.typed import conform
from forumflow.schemas import PAGE, POST_ITEM

_KEYS = ["url", "community", "captured_at", "seq"]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """An archive of pages under the declared schema."""
    return spark.read.schema(PAGE).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Single page files, whole, as (path, html)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")
    )


def post_links(pages: DataFrame, base_url: str, rules: ListingRules = LISTING_LAYOUT) -> DataFrame:
    """Distinct post URLs per community from the listing pages, paid cards left out."""
    listings = pages.filter(F.col("kind") == "listing")
    cards = drop_promoted(extract_cards(listings, rules, _KEYS))
    url = resolve_url(base_url, F.col("href"))
    return cards.select("community", url.alias("url")).filter(F.col("url").isNotNull()).distinct()


def linkless_cards(pages: DataFrame, rules: ListingRules = LISTING_LAYOUT) -> DataFrame:
    """Cards that should lead to a post but have no link, in the shape of rejects."""
    listings = pages.filter(F.col("kind") == "listing")
    cards = drop_promoted(extract_cards(listings, rules, _KEYS))
    return cards.filter(F.col("href").isNull()).select(
        F.lit("card").alias("stage"),
        F.lit("href").alias("reason"),
        "seq",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("url").alias("raw"),
    )


def items_from_pages(
    pages: DataFrame,
    base_url: str,
    listing: ListingRules = LISTING_LAYOUT,
    post: PostRules = POST_LAYOUT,
) -> DataFrame:
    """Items of all post pages that a listing of their community links to.

    Pages are reduced to items before they meet the links, so no HTML is shuffled. Reading
    HTML is the dearest step: write the items down before running a batch on them.
    """
    posts = extract_posts(pages.filter(F.col("kind") == "post"), post, _KEYS)
    linked = posts.join(post_links(pages, base_url, listing), ["community", "url"], "left_semi")
    return conform(linked, POST_ITEM)
