"""Edge values of the display-text functions, in both readings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumflow import functions as ff

AT = dt.datetime(2024, 3, 31, 12, 0, 0)


def apply(spark, values, kind, expression):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).sort("i").collect()]


def test_post_votes(spark):
    shown = ["•", "None", "Vote", "17", "-3", "1.2k", "32.3k", "0.9999999k", "-1.2k"]
    assert apply(spark, shown, "string", ff.post_votes) == [0, 0, 0, 17, -3, 1200, 32300, 999, -1200]
    bad = [None, "", "k", "1.2m", "1,234", "17.5", "99999999999", "9999999k", "nank", "1.2dk"]
    assert apply(spark, bad, "string", ff.post_votes) == [None] * len(bad)


def test_thousands_as_binary_product(spark):
    shown = [f"{n / 10}k" for n in range(1, 9999)]
    binary = apply(spark, shown, "string", lambda v: ff.post_votes(v, "double"))
    assert binary == [int(float(s[:-1]) * 1000) for s in shown]
    exact = apply(spark, shown, "string", ff.post_votes)
    assert exact == [n * 100 for n in range(1, 9999)]
    assert sum(a != b for a, b in zip(binary, exact)) == 46
    bad = ["infk", "nank", "1.2dk"]
    assert apply(spark, bad, "string", lambda v: ff.post_votes(v, "double")) == [None] * 3


def test_comment_votes(spark):
    assert apply(spark, ["Vote", None, "2.5k", "8"], "string", ff.comment_votes) == [0, 0, 2500, 8]
    assert apply(spark, ["•", "None", ""], "string", ff.comment_votes) == [None] * 3


def test_percent(spark):
    shown = ["100% Upvoted", None, "", "0% Upvoted", "  87%\tUpvoted", "7", "  ", "x%", "1 00%"]
    assert apply(spark, shown, "string", ff.percent_upvoted) == [
        100, 0, 0, 0, 87, None, None, None, None,
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("just now", AT),
        ("just", AT),
        ("1 hour ago", AT - dt.timedelta(hours=1)),
        ("3 hours ago", AT - dt.timedelta(hours=3)),
        ("  15 minutes ago", AT - dt.timedelta(minutes=15)),
        ("2 days ago", AT - dt.timedelta(days=2)),
        ("-2 days ago", AT + dt.timedelta(days=2)),
        ("1 month ago", dt.datetime(2024, 2, 29, 12)),
        ("1 year ago", AT),
        ("5 seconds ago", AT),
        ("x years ago", AT),
        ("3 Hours ago", AT),
        ("", None),
        ("yesterday", None),
        ("x hours ago", None),
        ("900000 days ago", None),
        ("2147483647 days ago", None),
        ("2147483647 hours ago", None),
        ("2147483647 minutes ago", None),
        ("2147483647 months ago", None),
        ("99999999999 hours ago", None),
    ],
)
def test_relative_time(spark, text, expected):
    at = F.lit(AT).cast("timestamp_ntz")
    row = spark.createDataFrame([(text,)], "v string").select(
        ff.relative_time(F.col("v"), at).alias("time"),
        ff.age_ok(F.col("v"), at).alias("ok"),
        ff.age_known(F.col("v")).alias("known"),
    ).first()
    assert row.time == expected
    assert row.ok == (text is None or expected is not None)
    if text in ("1 year ago", "5 seconds ago", "3 Hours ago"):
        assert row.known is False
    if text in ("just now", "3 hours ago", "1 month ago"):
        assert row.known is True


def test_months_can_be_refused(spark):
    at = F.lit(AT).cast("timestamp_ntz")
    shown = ["2 months ago", "2 days ago"]
    out = apply(spark, shown, "string", lambda v: ff.age_ok(v, at, months="reject"))
    assert out == [False, True]


LISTS = [["a"], [None], [], ["a", "b"], ["a", None], [None, None], None]


def test_paragraphs(spark):
    joined = apply(spark, LISTS, "array<string>", ff.combine_paragraphs)
    assert joined == ["a", "", "", "a b", "a", "", None]
    last = apply(spark, LISTS, "array<string>", lambda v: ff.combine_paragraphs(v, "last"))
    assert last == ["a", None, "", " b", " a", "", None]
    literal = apply(
        spark, LISTS, "array<string>", lambda v: ff.combine_paragraphs(v, "last", True)
    )
    assert literal == ["a", "None", "", " b", " None", " None", None]


def test_words_split_like_unicode_whitespace(spark):
    texts = ["  a b\tc d\x1ce　", "", " \n", "one", None, "x​y"]
    out = apply(spark, texts, "string", ff.words)
    assert out == [t.split() if t is not None else None for t in texts]
    second = apply(spark, texts, "string", lambda v: ff.word(v, 2))
    assert second == ["b", "", "", "", None, ""]


def test_comment_count(spark):
    rows = spark.createDataFrame(
        [(1, [("u",), (None,)], None), (2, [], None), (3, None, None), (4, [("u",)], 9)],
        "i int, comments array<struct<commentUserName:string>>, total int",
    )
    out = rows.select("i", ff.comment_count(F.col("comments"), F.col("total")).alias("n"))
    assert [r.n for r in out.sort("i").collect()] == [2, 0, 0, 9]
