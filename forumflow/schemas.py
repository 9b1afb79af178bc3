"""Declared schemas: the captured item, the archive page and the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


COMMENT_ITEM = _table(
    commentUserName=_S, commentUpVotes=_S, commentTimeSince=_S, commentText=T.ArrayType(_S)
)

# pos_offset and comment_total exist so that a very long discussion can arrive as several
# rows: each row carries a bounded slice of the comments, the first one (offset 0) the total.
POST_ITEM = _table(
    seq=_L,
    community=_S,
    captured_at=_TS,
    postTitle=_S,
    postUserName=_S,
    postTimeSince=_S,
    postUpVotes=_S,
    postPercentUpVotes=_S,
    postText=T.ArrayType(_S),
    comments=T.ArrayType(COMMENT_ITEM),
    pos_offset=_L,
    comment_total=_I,
)

PAGE = _table(url=_S, community=_S, kind=_S, captured_at=_TS, seq=_L, html=_S)

CARD = _table(
    page_url=_S, community=_S, captured_at=_TS, seq=_L, pos=_I, label=_S, href=_S
)

COMMUNITY = _table(id=_S, community=_S)

# inserted_in, first_* and last_* are bookkeeping: which batch created the row, and the order
# keys of the observation that created it and of the one its counters come from.
POST = _table(
    id=_S,
    title=_S,
    author=_S,
    upvotes=_I,
    percent_upvotes=_I,
    comment_count=_I,
    text=_S,
    datetime=_TS,
    community=_S,
    first_captured_at=_TS,
    first_seq=_L,
    last_captured_at=_TS,
    last_seq=_L,
    inserted_in=_L,
)

COMMENT = _table(
    post_id=_S,
    id=_S,
    author=_S,
    upvotes=_I,
    text=_S,
    datetime=_TS,
    community=_S,
    last_captured_at=_TS,
    last_seq=_L,
    last_pos=_L,
)

MARK = _table(datetime=_TS, community=_S)

REJECT = _table(stage=_S, reason=_S, seq=_L, pos=_L, raw=_S)

STATE = {
    "community": COMMUNITY,
    "post": POST,
    "comment": COMMENT,
    "post_mark": MARK,
    "comment_mark": MARK,
}

# Column widths the stored tables accept (fixed values).
WIDTH = {
    "community": 255,
    "title": 10000,
    "author": 255,
    "text": 10000,
    "mark_community": 30,
}
