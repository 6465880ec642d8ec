"""Joins and filters on key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null matches null, keeping the left side's key columns.

    The right keys are renamed first, so a side derived from the other joins cleanly.
    """
    renamed = right.select(
        *[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys],
        F.lit(True),
    )
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The ``k`` rows with the greatest ``by``; ``ties`` make the choice repeatable."""
    return df.orderBy(
        F.col(by).desc_nulls_last(), *[F.col(tie).asc_nulls_last() for tie in ties]
    ).limit(k)
