"""Pages to records: listing cards, post items, and the nesting of flat records."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumflow.operators.markup import Nodes, first_of, parse
from forumflow.schemas import CARD, COMMENT_ITEM


@dataclass(frozen=True)
class ListingRules:
    """Where a listing page keeps its cards, and a card its label and link."""

    card: Nodes
    label: Nodes
    link: Nodes


@dataclass(frozen=True)
class PostRules:
    """Where a post page keeps the fields of the post and of its comments."""

    title: Nodes
    author: Nodes
    age: Nodes
    votes: Nodes
    percent: tuple[Nodes, ...]
    box: Nodes
    paragraph: Nodes
    comment: Nodes
    comment_author: Nodes
    comment_votes: Nodes
    comment_age: Nodes
    comment_paragraph: Nodes


# The page layout the records come from, and the label of paid cards.
LISTING_LAYOUT = ListingRules(
    card=Nodes(
        ".//*[@id='SHORTCUT_FOCUSABLE_DIV']/div[2]/div/div/div/div[2]/div[3]/div[1]/div[4]/div"
    ),
    label=Nodes(".//div[2]/div[1]/div/div[1]/span[1]"),
    link=Nodes(".//div/div/div[2]/div/a"),
)
POST_LAYOUT = PostRules(
    title=Nodes(".//h1"),
    author=Nodes(".//div/div[2]/div/div[1]/div/a"),
    age=Nodes(".//a[@data-click-id='timestamp']"),
    votes=Nodes(".//div[@id]", prefix=("id", "vote-arrows"), then="./div"),
    percent=(
        Nodes(".//div[@data-test-id='post-content']/div[6]/div[2]/span"),
        Nodes(".//div[@data-test-id='post-content']/div[5]/div[2]/span"),
    ),
    box=Nodes(".//div[@data-test-id='post-content']"),
    paragraph=Nodes(".//div/div/p"),
    comment=Nodes(
        ".//div[@style]", prefix=("style", "--commentswrapper-gradient"), then="./div/div"
    ),
    comment_author=Nodes(".//a[@href]", prefix=("href", "/user/")),
    comment_votes=Nodes(".//div[@id]", prefix=("id", "vote-arrows"), then="./div[1]"),
    comment_age=Nodes(".//a[@id]", prefix=("id", "CommentTopMeta--Created--")),
    comment_paragraph=Nodes(".//div/div/p"),
)
PROMOTED_LABEL = "promoted"

_POST_FIELDS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "postTitle",
            "postUserName",
            "postTimeSince",
            "postUpVotes",
            "postPercentUpVotes",
        )
    ]
    + [
        T.StructField("postText", T.ArrayType(T.StringType())),
        T.StructField("comments", T.ArrayType(COMMENT_ITEM)),
    ]
)


def _fields(schema: T.StructType, keys: Sequence[str], pages: DataFrame) -> T.StructType:
    return T.StructType([pages.schema[k] for k in keys] + list(schema.fields))


def extract_cards(
    pages: DataFrame, rules: ListingRules, keys: Sequence[str], html: str = "html"
) -> DataFrame:
    """One row per card of each page, numbered in document order, with label and link."""
    keys = list(keys)

    def cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.itertuples(index=False):
                *kept, source = record
                tree = parse(source or "")
                rows += [
                    (*kept, pos, rules.label.first_text(c), rules.link.first_attribute(c, "href"))
                    for pos, c in enumerate(rules.card.find(tree))
                ]
            yield pd.DataFrame(rows, columns=[*keys, "pos", "label", "href"])

    card = T.StructType([CARD[name] for name in ("pos", "label", "href")])
    return pages.select(*keys, html).mapInPandas(cards, _fields(card, keys, pages))


def _post(source: str | None, rules: PostRules) -> tuple:
    tree = parse(source or "")
    comments = [
        {
            "commentUserName": rules.comment_author.first_text(node),
            "commentUpVotes": rules.comment_votes.first_text(node),
            "commentTimeSince": rules.comment_age.first_text(node),
            "commentText": rules.comment_paragraph.paragraph_texts(node),
        }
        for node in rules.comment.find(tree)
    ]
    return (
        rules.title.first_text(tree),
        rules.author.first_text(tree),
        rules.age.first_text(tree),
        rules.votes.first_text(tree),
        first_of(rules.percent, tree),
        [t for box in rules.box.find(tree) for t in rules.paragraph.paragraph_texts(box)],
        comments,
    )


def extract_posts(
    pages: DataFrame, rules: PostRules, keys: Sequence[str], html: str = "html"
) -> DataFrame:
    """One nested record per post page: the fields of the post and its comments in order."""
    keys = list(keys)

    def posts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*kept, *_post(source, rules)) for *kept, source in batch.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[*keys, *_POST_FIELDS.names])

    return pages.select(*keys, html).mapInPandas(posts, _fields(_POST_FIELDS, keys, pages))


@dataclass(frozen=True)
class First:
    """What to take of a page: the first text of the first rule that finds any, or with
    ``attribute`` the first of those."""

    rules: tuple[Nodes, ...]
    attribute: str | None = None

    def take(self, tree) -> str | None:
        if self.attribute is None:
            return first_of(self.rules, tree)
        found = (r.first_attribute(tree, self.attribute) for r in self.rules)
        return next((v for v in found if v is not None), None)


def extract_firsts(
    pages: DataFrame, fields: Mapping[str, First], keys: Sequence[str], html: str = "html"
) -> DataFrame:
    """The named fields of each page next to its key columns; NULL where nothing is found."""
    keys = list(keys)

    def firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *kept, source in batch.itertuples(index=False):
                tree = parse(source or "")
                rows.append((*kept, *[f.take(tree) for f in fields.values()]))
            yield pd.DataFrame(rows, columns=[*keys, *fields])

    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    return pages.select(*keys, html).mapInPandas(firsts, _fields(schema, keys, pages))


TITLE = First((Nodes(".//h1"),))
LINK = First((Nodes(".//a"),), "href")


def drop_promoted(cards: DataFrame, label: str = "label") -> DataFrame:
    """Cards with a label other than the paid one; cards without a label go as well."""
    return cards.filter(F.col(label) != PROMOTED_LABEL)


def resolve_url(base: str | Column, href: Column) -> Column:
    """Link target as a full URL: absolute ones as they are, others behind the base."""
    base = F.lit(base) if isinstance(base, str) else base
    absolute = href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    return F.when(absolute, href).otherwise(F.concat(base, href))


def assemble_items(
    posts: DataFrame,
    comments: DataFrame,
    key: Sequence[str],
    pos: str = "pos",
    part_size: int = 10_000,
) -> DataFrame:
    """Posts with their comments nested in order.

    ``posts`` has one row per key, ``comments`` the key, a position from 0 that is unique
    within it, and a struct ``comment``. A post with very many comments becomes several rows
    of at most ``part_size`` comments each: ``pos_offset`` tells where a part begins, and
    ``comment_total`` the number of all comments. Every join is one row against one row.
    """
    key = list(key)
    part = (F.floor(F.col(pos) / part_size)).cast("bigint")
    parts = (
        comments.withColumn("part", part)
        .groupBy(*key, "part")
        .agg(F.sort_array(F.collect_list(F.struct(pos, "comment"))).alias("sorted"))
        .select(*key, "part", F.col("sorted.comment").alias("comments"))
    )
    totals = comments.groupBy(*key).agg(
        F.count(F.lit(1)).cast("int").alias("comment_total"), F.max(part).alias("last_part")
    )
    heads = (
        posts.join(totals, key, "left")
        .withColumn("comment_total", F.coalesce("comment_total", F.lit(0)))
        .withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("last_part", F.lit(0).cast("bigint"))))
        )
        .drop("last_part")
    )
    return (
        heads.join(parts, [*key, "part"], "left")
        .withColumn(
            "comments", F.coalesce("comments", F.array().cast(parts.schema["comments"].dataType))
        )
        .withColumn("pos_offset", F.col("part") * part_size)
        .drop("part")
    )
