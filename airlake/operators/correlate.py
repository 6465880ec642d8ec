"""Correlations at several levels of control, from group moments.

Removing a group's mean from two series and correlating the residuals only needs each
group's count, covariance and variances: the within-group sums add up. Those moments are
ordinary mergeable aggregates, so no window gathers a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airlake.functions.moments import correlation
from airlake.operators.keys import join_on


def _moments(x: str, y: str):
    return (
        F.count(F.lit(1)).alias("_n"),
        F.covar_pop(x, y).alias("_cxy"),
        F.var_pop(x).alias("_cxx"),
        F.var_pop(y).alias("_cyy"),
    )


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .withColumn(x, F.col(x).cast("double"))
        .withColumn(y, F.col(y).cast("double"))
    )


def correlation_levels(df: DataFrame, x: str, y: str, levels: dict[str, list[str]]) -> DataFrame:
    """One row: the pair count and one correlation per level.

    ``levels`` maps a result column to the keys whose group means are removed first; an
    empty list is the plain correlation. Rows with a null key take no part in that level.
    """
    keys = list(dict.fromkeys(key for level in levels.values() for key in level))
    sets = [[F.col(key) for key in level] for level in levels.values()]
    grouped = (
        _pairs(df, x, y)
        .groupingSets(sets, *[F.col(key) for key in keys])
        .agg(F.grouping_id().alias("_level"), *_moments(x, y))
    )
    results = []
    for name, level in levels.items():
        # grouping_id sets a bit for each key that a grouping set leaves out.
        bits = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in level)
        usable = F.col("_level") == bits
        for key in level:
            usable = usable & F.col(key).isNotNull()
        weight = F.when(usable, F.col("_n"))
        results.append(
            correlation(
                F.sum(weight * F.col("_cxy")),
                F.sum(weight * F.col("_cxx")),
                F.sum(weight * F.col("_cyy")),
            ).alias(name)
        )
        if not level:
            results.insert(0, F.coalesce(F.sum(weight), F.lit(0)).alias("n"))
    return grouped.agg(*results)


def correlation_by(df: DataFrame, x: str, y: str, keys: list[str], min_rows: int) -> DataFrame:
    """Correlation per group having at least ``min_rows`` complete pairs."""
    moments = _pairs(df, x, y).groupBy(*keys).agg(*_moments(x, y))
    return moments.where(F.col("_n") >= min_rows).select(
        *keys,
        F.col("_n").alias("n"),
        correlation(F.col("_cxy"), F.col("_cxx"), F.col("_cyy")).alias("r"),
    )


def demean(df: DataFrame, value: str, keys: list[str], name: str) -> DataFrame:
    """Add ``name`` = value minus its group mean.

    The means are aggregated and joined back rather than computed in a window, so one
    very large group does not land in one task.
    """
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    joined = join_on(df, means, keys, "left")
    return joined.select(*df.columns, (F.col(value) - F.col("_mean")).alias(name))
