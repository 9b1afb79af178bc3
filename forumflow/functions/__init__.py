from forumflow.functions.display import (
    age_known,
    age_ok,
    combine_paragraphs,
    comment_count,
    comment_votes,
    percent_upvoted,
    post_votes,
    relative_time,
    word,
    words,
)

__all__ = [
    "age_known",
    "age_ok",
    "combine_paragraphs",
    "comment_count",
    "comment_votes",
    "percent_upvoted",
    "post_votes",
    "relative_time",
    "word",
    "words",
]
