"""Dirty-value handling: coercion, imputation, null census, reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import TEXT_LAYOUTS, text_millis
from .ranks import hash_key


def to_number(text: Column | str) -> Column:
    """Text as double; text that is no number becomes null."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("double")


def coerce_numeric(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.withColumns({c: to_number(c) for c in columns})


def column_means(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of each column; nulls do not count."""
    return rows.agg(*[F.avg(c).alias(c) for c in columns])


def impute_mean(
    rows: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Replace nulls by the column mean of ``fit_on``, by default of ``rows`` itself.

    Pass the training rows when filling test rows.
    """
    means = column_means(fit_on if fit_on is not None else rows, columns)
    held = rows.withColumn("_mean", means.select(F.struct(*columns)).scalar())
    filled = {c: F.coalesce(F.col(c), F.col("_mean")[c]) for c in columns}
    return held.withColumns(filled).drop("_mean")


def null_census(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, ``(feature, nulls)``, from a single pass; add up for the total."""
    columns = list(columns or rows.columns)
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "nulls")


def sample_rows(rows: DataFrame, n: int, id_column: str, seed: int | str = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash; the same rows on every run and cluster."""
    return rows.orderBy(hash_key(seed, id_column)).limit(n)


def sample_share(
    rows: DataFrame, share: float, id_column: str, seed: int | str = 42
) -> DataFrame:
    """The rows whose seeded hash lies in the lowest ``share`` of all hash values.

    Each row is decided by itself: no shuffle, the same rows on every run and cluster, and a larger
    share holds all rows of a smaller one. The number of rows is near the share, not exact.
    """
    if not 0 <= share <= 1:
        raise ValueError("share lies between 0 and 1")
    limit = round(share * (1 << 32))
    if limit == 1 << 32:
        return rows
    return rows.filter(F.substring(hash_key(seed, id_column), 1, 8) < F.lit(f"{limit:08x}"))


def parse_times(
    rows: DataFrame,
    column: str,
    output: str = "millis",
    layouts: Sequence[str] = TEXT_LAYOUTS,
    zone: str = "UTC",
) -> DataFrame:
    """Add the epoch milliseconds of a text time and, where there are none, the ``reason``.

    Reasons are ``missing``, ``empty`` and ``no layout``; it is null for parsed rows, so no row is
    lost and `unparsed` keeps the others apart.
    """
    text = F.col(column)
    reason = (
        F.when(text.isNull(), "missing")
        .when(F.trim(text) == "", "empty")
        .when(F.col(output).isNull(), "no layout")
    )
    return rows.withColumn(output, text_millis(text, layouts, zone)).withColumn("reason", reason)


def unparsed(rows: DataFrame) -> DataFrame:
    """Rows of `parse_times` that have no time, with their reason."""
    return rows.filter(F.col("reason").isNotNull())
