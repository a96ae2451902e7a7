"""Tests for fields that hold nothing but white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each rule counts as white space. ``trim`` covers every
# character up to the space; ``unicode`` covers Unicode spaces but not the
# no-break ones, nor control characters other than separators. They end in \z
# because $ would also pass a line separator that the class does not hold.
BLANK_PATTERNS = {
    "trim": r"^[\x00-\x20]*\z",
    "unicode": r"^\p{javaWhitespace}*\z",
}


def is_blank(column: str | Column, rule: str = "trim") -> Column:
    """True for null and for text that is empty under the rule."""
    c = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(c.rlike(BLANK_PATTERNS[rule]), F.lit(True))
