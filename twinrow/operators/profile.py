"""Blank fields: how many, and the rows without any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from twinrow.functions.blank import is_blank


def _counts(columns: Sequence[str], rule: str) -> list[Column]:
    return [
        F.coalesce(F.sum(is_blank(c, rule).cast("bigint")), F.lit(0)).alias(c)
        for c in columns
    ]


def blank_profile(df: DataFrame, columns: Sequence[str], rule: str = "trim") -> DataFrame:
    """One row: the number of blank fields in each column."""
    return df.agg(*_counts(columns, rule))


def drop_blank(
    df: DataFrame,
    columns: Sequence[str],
    rule: str = "trim",
    observe: Observation | None = None,
) -> DataFrame:
    """Rows without a blank field.

    With ``observe`` the blank fields of all rows, dropped ones too, are counted
    in the same pass; read ``observe.get`` once the result has been written. The
    counts hold when the rows go to the output without a shuffle: a lost executor
    can make tasks before a shuffle run, and count, twice. Use ``blank_profile``
    there.
    """
    seen = df.observe(observe, *_counts(columns, rule)) if observe is not None else df
    keep = ~is_blank(columns[0], rule)
    for c in columns[1:]:
        keep = keep & ~is_blank(c, rule)
    return seen.where(keep)
