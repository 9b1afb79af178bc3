"""The set-based run against the sequential model, on random and on chosen items."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from forumflow.plans.batch import empty_state, run_in_memory, run_staged
from forumflow.schemas import POST_ITEM
from forumflow.semantics import Semantics
from tests.model import Model

START = dt.datetime(2024, 5, 1)


def random_items(rng, n, first_seq=0):
    def pick(*values):
        return rng.choice(values)

    ages = ["just now", "3 hours ago", "2 days ago", "40 days ago", "5 years ago", None, "x hours ago", "soon"]
    items = []
    for i in range(n):
        comments = [
            dict(
                commentUserName=pick("a", "b", "c", None),
                commentUpVotes=pick("1", "2.5k", "Vote", None, "•", "7"),
                commentTimeSince=pick(*ages),
                commentText=pick(["x"], ["y", None, "z"], [], [f"t{rng.randrange(8)}"]),
            )
            for _ in range(rng.randrange(4))
        ]
        # One title takes a large share of all items.
        title = "hot" if rng.random() < 0.3 else pick(None, *[f"p{k}" for k in range(12)])
        items.append(
            dict(
                seq=first_seq + i,
                community=pick("c1", "c2", "c3", None) if rng.random() < 0.3 else pick("c1", "c2"),
                captured_at=START + dt.timedelta(minutes=(first_seq + i) // 3),
                postTitle=title,
                postUserName=pick("u1", "u2", None, None),
                postTimeSince=pick(*ages),
                postUpVotes=pick("•", "1", "2", "3", "1.2k", "", "9"),
                postPercentUpVotes=pick(None, "", "87%", "100%"),
                postText=pick(["a"], ["a", "b"], [], [None]),
                comments=comments,
                pos_offset=None,
                comment_total=None,
            )
        )
    return items


def frame(spark, items):
    return spark.createDataFrame([[i[f.name] for f in POST_ITEM] for i in items], POST_ITEM)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def compare(out, model, rejects=True):
    posts = {r.title: r for r in out["post"].collect()}
    assert set(posts) == set(model.posts)
    for title, want in model.posts.items():
        got = posts[title]
        assert got.id == sha(title)
        for column in ("author", "text", "datetime", "upvotes", "percent_upvotes", "comment_count", "community"):
            assert got[column] == want[column], (title, column)
        assert (got.last_captured_at, got.last_seq) == want["last"]
    comments = {(r.text, r.author, r.post_id) if len(model.key) > 1 else (r.text,): r for r in out["comment"].collect()}
    want_comments = {
        (c["text"], c["author"], sha(c["title"])) if len(model.key) > 1 else (c["text"],): c
        for c in model.comments.values()
    }
    assert set(comments) == set(want_comments)
    for key, want in want_comments.items():
        got = comments[key]
        assert got.post_id == sha(want["title"])
        for column in ("author", "upvotes", "datetime", "community"):
            assert got[column] == want[column]
    assert {r.community for r in out["community"].collect()} == model.communities
    assert {r.community: r.datetime for r in out["post_mark"].collect()} == model.post_marks
    assert {r.community: r.datetime for r in out["comment_mark"].collect()} == model.comment_marks
    if rejects:
        got = sorted(((r.stage, r.reason, r.seq, r.pos) for r in out["rejects"].collect()), key=str)
        assert got == sorted(model.rejects, key=str)
        assert all(r.raw for r in out["rejects"].collect())


@pytest.mark.parametrize("seed, key", [(1, ("text",)), (2, ("post_id", "author", "text"))])
def test_one_batch(spark, seed, key):
    items = random_items(random.Random(seed), 300)
    run = run_in_memory if seed == 1 else run_staged
    model = Model(key)
    model.run(items, START + dt.timedelta(days=1))
    random.Random(seed).shuffle(items)
    out = run(
        frame(spark, items).repartition(3),
        empty_state(spark),
        START + dt.timedelta(days=1),
        semantics=Semantics(comment_key=key),
    )
    compare(out, model)


def test_several_batches_with_late_items(spark):
    rng = random.Random(5)
    items = random_items(rng, 240)
    model, state = Model(), empty_state(spark)
    # The second part holds older captures than the first.
    for n, part in enumerate([items[80:160], items[:80], items[160:]]):
        started = START + dt.timedelta(days=n + 1)
        model.rejects.clear()
        model.run(part, started)
        out = run_staged(frame(spark, part), state, started, batch_id=n)
        compare(out, model)
        state = {
            name: spark.createDataFrame(out[name].collect(), out[name].schema) for name in state
        }


def test_batch_cut_does_not_matter(spark):
    """Items in capture order give the same posts and comments however they are cut."""
    items = random_items(random.Random(9), 200)
    whole = run_staged(frame(spark, items), empty_state(spark), START)
    state = empty_state(spark)
    for n, (a, b) in enumerate([(0, 37), (37, 150), (150, 200)]):
        out = run_staged(frame(spark, items[a:b]), state, START, batch_id=n)
        state = {
            name: spark.createDataFrame(out[name].collect(), out[name].schema) for name in state
        }
    for name in ("community", "post", "comment"):
        columns = [c for c in whole[name].columns if c != "inserted_in"]
        assert sorted(whole[name].select(columns).collect(), key=str) == sorted(
            state[name].select(columns).collect(), key=str
        )


def item(seq, **changes):
    base = dict(
        seq=seq,
        community="stocks",
        captured_at=START,
        postTitle="T",
        postUserName="u",
        postTimeSince="3 hours ago",
        postUpVotes="2",
        postPercentUpVotes=None,
        postText=["p"],
        comments=[],
        pos_offset=None,
        comment_total=None,
    )
    return {**base, **changes}


def test_lengths_and_missing_fields(spark):
    items = [
        item(1, postTitle="x" * 10000, community="c" * 31),
        item(2, postTitle="x" * 10001),
        item(3, postTitle="A", postUserName="u" * 256),
        item(4, postTitle="B", postText=["t" * 10001]),
        item(5, postTitle="C", community="c" * 256),
        item(6, postTitle="D", postText=None),
        item(7, postTitle="E", captured_at=None),
        item(8, postTitle="F", comments=None),
        item(9, postTitle="G", comments=[
            dict(commentUserName="u", commentUpVotes="1", commentTimeSince="just now", commentText=["t" * 10001]),
            dict(commentUserName="u" * 256, commentUpVotes="1", commentTimeSince="just now", commentText=["t"]),
            dict(commentUserName="u", commentUpVotes="1", commentTimeSince="just now", commentText=None),
        ]),
        # Too long a text does not hinder the update of a post that exists.
        item(10, postTitle="F", postText=["t" * 10001], postUpVotes="50"),
    ]
    out = run_staged(frame(spark, items), empty_state(spark), START)
    assert {r.title[:1]: r.upvotes for r in out["post"].collect()} == {"x": 2, "F": 50, "G": 2}
    got = {(r.stage, r.reason, r.seq, r.pos) for r in out["rejects"].collect()}
    assert got == {
        ("post", "title", 2, None),
        ("post", "author", 3, None),
        ("post", "text", 4, None),
        ("post", "community", 5, None),
        ("post", "paragraphs", 6, None),
        ("post", "order", 7, None),
        ("comment", "text", 9, 0),
        ("comment", "author", 9, 1),
        ("comment", "paragraphs", 9, 2),
        ("mark", "community", None, None),
    }
    assert {r.community for r in out["post_mark"].collect()} == {"stocks"}
    assert out["comment"].count() == 0


def test_item_with_drifted_fields(spark):
    """Items without a community are refused; a comment without votes counts 0."""
    rows = spark.createDataFrame(
        [("T", "u", "just now", "2", ["p"], [("a", "2 points", "just now", ["c"])])],
        "postTitle string, postUserName string, postTimeSince string, postUpVotes string,"
        " postText array<string>, comments array<struct<commentUserName:string, points:string,"
        " commentTimeSince:string, commentText:array<string>>>",
    )
    path_items = rows.selectExpr("*", "1L seq", "timestamp_ntz'2024-01-01 00:00:00' captured_at")
    text = path_items.selectExpr("to_json(struct(*)) j")
    parsed = text.select(F.from_json("j", POST_ITEM).alias("r")).select("r.*")
    out = run_in_memory(parsed, empty_state(spark), START)
    assert [r.reason for r in out["rejects"].collect()] == ["community"]
    named = parsed.withColumn("community", F.lit("stocks"))
    out = run_in_memory(named, empty_state(spark), START)
    assert [r.upvotes for r in out["comment"].collect()] == [0]
