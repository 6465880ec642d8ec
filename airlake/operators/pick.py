"""One row per key, chosen by an order.

Each pick is an aggregate over a struct, so every map task sends at most one row per
key: a key with very many copies is reduced before the shuffle and never gathered. The
struct holds the remaining columns after the ordering ones, which makes the order total
and the choice repeatable (rows that still tie are identical).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _pick(df: DataFrame, keys: list[str], order: list[Column], choose) -> DataFrame:
    ranks = [column.alias(f"_rank{i}") for i, column in enumerate(order)]
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(choose(F.struct(*ranks, *rest)).alias("_row"))
    return picked.select(*[name if name in keys else f"_row.{name}" for name in df.columns])


def keep_latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` value for each key."""
    return _pick(df, keys, [F.col(order)], F.max)


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row that sorts first for each key; nulls sort first, as in any Spark struct."""
    return _pick(df, keys, list(order), F.min)


def most_frequent(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """The commonest non-null ``value`` per key; equal counts go to the smaller value.

    ``weight`` names a count column when ``df`` is already pre-aggregated.
    """
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(*keys, value).agg(size.alias("_n"))
    candidate = F.when(F.col(value).isNotNull(), F.struct((-F.col("_n")).alias("_neg"), F.col(value)))
    best = counts.groupBy(*keys).agg(F.min(candidate).alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(
        *keys, F.col("_best")[value].alias(value), (-F.col("_best")["_neg"]).alias("usage_count")
    )
