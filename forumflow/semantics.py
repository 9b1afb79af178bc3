"""Choices between the exact reading of a captured value and the behaviour first observed."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Semantics:
    """How ambiguous values are read.

    paragraphs   "join" keeps every paragraph; "last" keeps only the last one, led by a blank.
    k_suffix     "decimal" multiplies exactly; "double" truncates a binary product (32.3k -> 32299).
    null_literal True turns an empty comment paragraph into the text "None".
    months       "calendar" goes back whole months; "reject" refuses ages given in months.
    comment_key  columns that identify a comment, out of text, author and post_id.
    """

    paragraphs: str = "join"
    k_suffix: str = "decimal"
    null_literal: bool = False
    months: str = "calendar"
    comment_key: tuple[str, ...] = ("text",)

    def __post_init__(self) -> None:
        if self.paragraphs not in ("join", "last"):
            raise ValueError(f"paragraphs: {self.paragraphs!r}")
        if self.k_suffix not in ("decimal", "double"):
            raise ValueError(f"k_suffix: {self.k_suffix!r}")
        if self.months not in ("calendar", "reject"):
            raise ValueError(f"months: {self.months!r}")
        if "text" not in self.comment_key or set(self.comment_key) - {"text", "author", "post_id"}:
            raise ValueError(f"comment_key: {self.comment_key!r}")


DEFAULT = Semantics()
OBSERVED = Semantics(
    paragraphs="last", k_suffix="double", null_literal=True, months="reject"
)
