"""Words of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_array(column: str | Column) -> Column:
    """Lower-case words. Only ASCII letters, digits and ``_`` make up a word."""
    return F.regexp_extract_all(F.lower(column), F.lit(r"\w+"), F.lit(0))


def tokens(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per word of the text, in column ``word``."""
    return df.select(F.explode(word_array(column)).alias("word"))
