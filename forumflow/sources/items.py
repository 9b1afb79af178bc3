"""Captured items: scans, the union over communities, and seed lists."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.operators.typed import conform
from forumflow.schemas import POST_ITEM


def read_items(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Items under the declared schema, which is never inferred.

    A folder per community (``community=<name>/``) gives the community column by itself.
    """
    return spark.read.schema(POST_ITEM).format(fmt).load(path)


def union_communities(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Items of several communities as one table, each under its community's name."""
    named = [
        conform(rows.withColumn("community", F.lit(name)), POST_ITEM)
        for name, rows in frames.items()
    ]
    return reduce(DataFrame.unionByName, named)


def seed_list(text: Column) -> Column:
    """A list literal such as ``['https://a', 'https://b']`` as an array; NULL if it is none."""
    return F.from_json(text, "array<string>")


def community_of(url: Column, pattern: str = r"/r/([^/?#]+)") -> Column:
    """The community a listing URL is about, '' when it names none."""
    return F.regexp_extract(url, pattern, 1)


def seed_conflicts(seeds: DataFrame, pattern: str = r"/r/([^/?#]+)") -> DataFrame:
    """Seeds whose start URL, URL list and community name do not agree.

    Input ``(community, start_url, start_url_list)``; one row per conflicting list entry.
    """
    return (
        seeds.select(
            "community",
            "start_url",
            F.explode_outer(seed_list(F.col("start_url_list"))).alias("listed_url"),
        )
        .withColumn("start_community", community_of(F.col("start_url"), pattern))
        .withColumn("listed_community", community_of(F.col("listed_url"), pattern))
        .filter(
            F.col("listed_url").isNull()
            | (F.col("start_community") != F.col("community"))
            | (F.col("listed_community") != F.col("community"))
        )
    )
