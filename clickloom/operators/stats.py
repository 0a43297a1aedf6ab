"""Descriptive statistics as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .ranks import values_at_ranks

# Fences stand 1.5 inter-quartile ranges outside the quartiles.
QUARTILES = (0.25, 0.5, 0.75)
FENCE = 1.5


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, n)`` for each named frame."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def distinct_count(rows: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Rows, and distinct values of a column; ``approximate`` uses a fixed-size sketch."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return rows.agg(F.count(column).alias("n"), distinct.alias("n_distinct"))


def value_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` for several categorical columns in one pass; nulls are left out."""
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], list(columns), "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )


def class_balance(rows: DataFrame, column: str) -> DataFrame:
    """``(column, n, share)`` of each class among the rows that have one."""
    counts = (
        rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def histogram(rows: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``(bin, low, high, n)`` of equal-width bins over the column's range.

    Bins are closed below and open above, the last one is closed; empty bins are listed with 0.
    """
    value = F.col(column).cast("double")
    known = rows.filter(value.isNotNull()).select(value.alias("v"))
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s"))
    edges = span.select(
        F.col("s.lo").alias("lo"), ((F.col("s.hi") - F.col("s.lo")) / bins).alias("width")
    )
    step = F.floor(F.try_divide(F.col("v") - F.col("edge.lo"), F.col("edge.width")))
    place = F.least(F.coalesce(step, F.lit(0)), F.lit(bins - 1))
    held = known.withColumn("edge", edges.select(F.struct("lo", "width")).scalar())
    counts = held.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    all_bins = edges.select(
        "lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _numbers(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())


def quantiles(rows: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """``(share, value)``: exact quantiles with linear interpolation between ranks."""
    found = values_at_ranks(_numbers(rows, column), "v", shares)
    part = F.col("rank") - F.floor("rank")
    return found.select(
        "share", (F.col("low") + part * (F.col("high") - F.col("low"))).alias("value")
    )


def box_plot(rows: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers and outlier count of a numeric column.

    A whisker ends at the most extreme value inside its fence.
    """
    values = _numbers(rows, column)
    names = ("q1", "median", "q3")
    found = quantiles(values, "v", QUARTILES).agg(
        *[
            F.max(F.when(F.col("share") == s, F.col("value"))).alias(name)
            for s, name in zip(QUARTILES, names)
        ]
    )
    held = values.withColumn("q", found.select(F.struct(*names)).scalar())
    reach = FENCE * (F.col("q.q3") - F.col("q.q1"))
    inside = F.col("v").between(F.col("q.q1") - reach, F.col("q.q3") + reach)
    return held.agg(
        *[F.max(f"q.{name}").alias(name) for name in names],
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def weighted_mean(rows: DataFrame, metric: str, weight: str) -> DataFrame:
    """Mean of per-batch metrics, each weighted by its batch size."""
    return rows.agg(
        F.try_divide(F.sum(F.col(metric) * F.col(weight)), F.sum(weight)).alias(metric)
    )


def best_row(rows: DataFrame, metric: str, order: str) -> DataFrame:
    """The row with the greatest metric; among equal ones the first in ``order``."""
    best = F.max_by(F.struct(*rows.columns), F.struct(F.col(metric), -F.col(order)))
    return rows.agg(best.alias("best")).select("best.*")
