"""Data checks whose results are small frames.

All checks of one table share one scan. Checks that need a grouping or another table
(uniqueness, references) count per key first.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ERROR = "error"
WARN = "warn"

REPORT_COLUMNS = ["table_name", "column_name", "check_name", "severity", "violations"]


@dataclass(frozen=True)
class Range:
    """Accepted interval of a column; a missing bound is open, nulls always pass."""

    column: str
    low: float | None = None
    high: float | None = None
    severity: str = ERROR
    inclusive: bool = True

    def outside(self) -> Column:
        value = F.col(self.column)
        misses = []
        if self.low is not None:
            misses.append(value < self.low if self.inclusive else value <= self.low)
        if self.high is not None:
            misses.append(value > self.high if self.inclusive else value >= self.high)
        return reduce(lambda a, b: a | b, misses, F.lit(False))


@dataclass(frozen=True)
class Contract:
    """What a table promises about its columns."""

    not_null: tuple[str, ...] = ()
    # At most one column.
    unique: tuple[str, ...] = ()
    ranges: tuple[Range, ...] = ()
    values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # column -> (parent table, parent column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    def row_checks(self) -> list[tuple[str, str, str, Column]]:
        """(column, check, severity, violation predicate) for every row-wise promise."""
        checks = [(c, "not_null", ERROR, F.col(c).isNull()) for c in self.not_null]
        checks += [(r.column, "accepted_range", r.severity, r.outside()) for r in self.ranges]
        checks += [
            (c, "accepted_values", ERROR, ~F.col(c).isin(*allowed))
            for c, allowed in self.values.items()
        ]
        return checks


def table_report(name: str, df: DataFrame, contract: Contract) -> DataFrame:
    """One row per row-wise and uniqueness check of a table, from a single scan.

    With a unique column the violations are first counted per value of it, which also shows
    the repeated values; nulls are not values.
    """
    checks = contract.row_checks()
    names = [f"c{i}" for i in range(len(checks))]
    bad = [F.count_if(violated).alias(c) for c, (*_, violated) in zip(names, checks)]
    labels = [(column, check, severity) for column, check, severity, _ in checks]
    if contract.unique:
        (key,) = contract.unique
        per_value = df.groupBy(F.col(key).alias("_value")).agg(*bad, F.count(F.lit(1)).alias("_n"))
        repeats = F.count_if((F.col("_n") > 1) & F.col("_value").isNotNull())
        totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
        counts = per_value.agg(*totals, repeats.alias("_repeats"))
        names, labels = [*names, "_repeats"], [*labels, (key, "unique", ERROR)]
    else:
        counts = df.agg(*bad)
    lines = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.col(c).alias("violations"),
        )
        for c, (column, check, severity) in zip(names, labels)
    ]
    return counts.select(F.inline(F.array(*lines)))


def _line(name: str, column: str, check: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.lit(ERROR).alias("severity"),
        "violations",
    )


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations occurring more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def unique_report(name: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are not values."""
    repeats = repeated(df.where(F.col(column).isNotNull()), [column])
    return _line(name, column, "unique", repeats.agg(F.count(F.lit(1)).alias("violations")))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their row count. Null children are not orphans.

    Children are counted per value before the anti join, so a very frequent value is one row.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    keys = parent.select(F.col(parent_column).alias("key_value"))
    return values.join(keys, "key_value", "left_anti")


def reference_report(
    name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    missing = orphans(child, column, parent, parent_column)
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    return _line(name, column, "relationships", missing.agg(total))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class QualityError(RuntimeError):
    """An error-level check failed; tables downstream must not be built."""


def failures(rows: list) -> str:
    """The error-level violations among report rows, as text; empty if there are none."""
    failed = [r for r in rows if r.severity == ERROR and r.violations > 0]
    return ", ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failed)


def gate(report: DataFrame) -> list:
    """Run a report (one row per check), raise on error-level violations, return its rows."""
    rows = report.collect()
    if failed := failures(rows):
        raise QualityError(failed)
    return rows
