"""Display text to typed values. Column in, Column out; nothing here leaves the JVM.

A value that cannot be read gives NULL, never an exception, so one bad row cannot fail a
batch. Where NULL is also a legal result, a companion ``*_ok`` column tells the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the display text may say.
POST_ZERO_VOTES = ("•", "None", "Vote")
COMMENT_ZERO_VOTES = ("Vote",)
NOW_WORD = "just"
HOUR_WORDS = ("hour", "hours")
MINUTE_WORDS = ("minute", "minutes")
DAY_WORDS = ("day", "days")
MONTH_WORDS = ("month", "months")
THOUSAND_SUFFIX = "k"
NULL_TEXT = "None"

# Unicode white space, as a regex character class body (Java's \s is ASCII only).
SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Times that can be stored.
_FIRST_DAY, _LAST_DAY = "0001-01-01", "9999-12-31"


def words(text: Column) -> Column:
    """All words of a text, split on any white space."""
    return F.regexp_extract_all(text, F.lit(f"([^{SPACE}]+)"), F.lit(1))


def word(text: Column, n: int) -> Column:
    """The n-th word (from 1), '' when there are fewer, NULL for a NULL text."""
    skip = f"[^{SPACE}]+[{SPACE}]+" * (n - 1)
    return F.regexp_extract(text, f"^[{SPACE}]*{skip}([^{SPACE}]+)", 1)


def _without_last_char(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 1)


def _count(text: Column, k_suffix: str) -> Column:
    shown = _without_last_char(text)
    exact = shown.try_cast("decimal(30,15)")
    if k_suffix == "double":
        # The decimal reading also guards against NaN, Infinity and Java's "1.2d".
        thousands = F.when(exact.isNotNull(), shown.try_cast("double") * 1000)
    else:
        thousands = exact * 1000
    return F.when(text.endswith(THOUSAND_SUFFIX), thousands.try_cast("int")).otherwise(
        text.try_cast("int")
    )


def post_votes(text: Column, k_suffix: str = "decimal") -> Column:
    """Votes of a post: '1.2k' -> 1200, placeholders -> 0; NULL when unreadable."""
    return F.when(text.isin(*POST_ZERO_VOTES), F.lit(0)).otherwise(_count(text, k_suffix))


def comment_votes(text: Column, k_suffix: str = "decimal") -> Column:
    """Votes of a comment: like a post's, but a missing text counts 0."""
    return F.when(
        text.isNull() | text.isin(*COMMENT_ZERO_VOTES), F.lit(0)
    ).otherwise(_count(text, k_suffix))


def percent_upvoted(text: Column) -> Column:
    """'98% Upvoted' -> 98; NULL or '' -> 0; NULL when unreadable."""
    shown = F.regexp_extract(text, f"^[{SPACE}]*([^{SPACE}]*)[^{SPACE}]", 1)
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(shown.try_cast("int"))


def relative_time(text: Column, at: Column, months: str = "calendar") -> Column:
    """'3 hours ago', seen at ``at``, as a point in time.

    NULL text -> NULL. An unknown unit counts as just now (see ``age_known``). Unreadable
    text and results outside years 1..9999 -> NULL (see ``age_ok``).
    """
    first, unit = word(text, 1), word(text, 2)
    n = first.try_cast("int")
    none, zero = F.lit(None).cast("timestamp_ntz"), F.lit(0)
    # How far each unit can go before the calendar ends, so that no arithmetic overflows.
    days_back = F.datediff(at, F.lit(_FIRST_DAY).cast("date"))
    days_on = F.datediff(F.lit(_LAST_DAY).cast("date"), at)
    hours_back = days_back * 24 + F.hour(at)
    minutes_back = hours_back.cast("bigint") * 60 + F.minute(at)
    months_back = F.year(at) * 12 + F.month(at) - 13
    within_days = n.between(-days_on, days_back)
    within_hours = n.between(-days_on * 24, hours_back)
    within_minutes = n.between(-days_on.cast("bigint") * 1440, minutes_back)
    within_months = n.between(-days_on / 31, months_back)
    if months == "calendar":
        month_start = F.when(within_months, at - F.make_ym_interval(zero, n))
    else:
        month_start = none
    # The first condition, which every row meets, names both words twice: Spark then extracts
    # each of them once per row instead of once per use.
    found = first.isNotNull() & unit.isNotNull()
    return (
        F.when(found & (unit == "") & (first != NOW_WORD), none)
        .when(first == NOW_WORD, at)
        .when(
            unit.isin(*HOUR_WORDS), F.when(within_hours, at - F.make_dt_interval(zero, n))
        )
        .when(
            unit.isin(*MINUTE_WORDS),
            F.when(within_minutes, at - F.make_dt_interval(zero, zero, n)),
        )
        .when(unit.isin(*DAY_WORDS), F.when(within_days, at - F.make_dt_interval(n)))
        .when(unit.isin(*MONTH_WORDS), month_start)
        .when(text.isNotNull(), at)
    )


def age_ok(text: Column, at: Column, months: str = "calendar") -> Column:
    """False when an age text is there but cannot be read."""
    return text.isNull() | relative_time(text, at, months).isNotNull()


def age_known(text: Column) -> Column:
    """False when the unit of an age text is unknown, so its time is only a guess."""
    units = HOUR_WORDS + MINUTE_WORDS + DAY_WORDS + MONTH_WORDS
    return F.when(
        text.isNotNull(), (word(text, 1) == NOW_WORD) | word(text, 2).isin(*units)
    )


def combine_paragraphs(
    paragraphs: Column, mode: str = "join", null_literal: bool = False
) -> Column:
    """One text from a list of paragraphs; NULL for a NULL list.

    "join" puts all non-NULL paragraphs together. "last" gives a lone paragraph as it is, of
    several only the last non-NULL one, led by a blank, and '' when there is none.
    """
    if null_literal:
        paragraphs = F.transform(paragraphs, lambda p: F.coalesce(p, F.lit(NULL_TEXT)))
    if mode == "join":
        return F.when(paragraphs.isNotNull(), F.concat_ws(" ", paragraphs))
    last = F.try_element_at(F.array_compact(paragraphs), F.lit(-1))
    return F.when(F.array_size(paragraphs) == 1, F.get(paragraphs, F.lit(0))).when(
        paragraphs.isNotNull(), F.coalesce(F.concat(F.lit(" "), last), F.lit(""))
    )


def comment_count(comments: Column, total: Column | None = None) -> Column:
    """Number of captured comments, before any of them is dropped; 0 for none.

    Only one leaf of the comment structs is read, so a scan need not load their texts.
    """
    size = F.coalesce(F.array_size(comments.getField("commentUserName")), F.lit(0))
    return size if total is None else F.coalesce(total, size)
