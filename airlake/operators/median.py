"""Exact median per group, in bounded memory.

The built-in exact percentile keeps a group's values in one buffer. Here equal values are
counted first, combined before the shuffle, so a group moves one row per distinct value
however many rows it has. Those are then read in order, which spills to disk when needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def grouped_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Continuous median of the non-null ``value`` for each combination of ``keys``."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    group = Window.partitionBy(*keys)
    # Zero-based ranks: a value covers [end - n, end), the middle is [low, high].
    end = F.sum("_n").over(group.orderBy("_v"))
    total = F.sum("_n").over(group)
    middle = counts.select(*keys, "_v", "_n", end.alias("_end"), total.alias("_total")).where(
        (F.col("_end") - F.col("_n") <= F.floor(F.col("_total") / 2))
        & (F.col("_end") > F.floor((F.col("_total") - 1) / 2))
    )
    return middle.groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias(name))
