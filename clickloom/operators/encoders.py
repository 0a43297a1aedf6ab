"""Label indexing, one-hot columns and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from .pivots import listed, quoted
from .ranks import hash_digits, row_key, running_sums


def label_indexer(
    rows: DataFrame, column: str, output: str = "label", order: str = "frequencyDesc"
) -> StringIndexerModel:
    """Fitted indexer: most frequent label 0, equal counts alphabetical.

    ``order="alphabetAsc"`` numbers the labels alphabetically.
    """
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType=order).fit(rows)


def label_vocabulary(rows: DataFrame, column: str) -> DataFrame:
    """``(idx, label)``: the distinct labels numbered alphabetically from 0.

    The window runs over the distinct labels only, which are one row per class.
    """
    labels = rows.select(F.col(column).cast("string").alias("label")).filter(
        F.col("label").isNotNull()
    )
    place = F.row_number().over(Window.orderBy("label")) - 1
    return labels.distinct().select(place.alias("idx"), "label")


def one_hot(rows: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each categorical column by one 0/1 column ``{column}_{level}`` per level.

    No level is dropped and a null gives zeros; a value outside the levels is an error.
    """
    rows = rows.withColumns({c: listed(c, values) for c, values in levels.items()})
    others = [c for c in rows.columns if c not in levels]
    flags = [
        F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in levels.items()
        for v in values
    ]
    return rows.select(*others, *flags)


def observed_levels(rows: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels of each categorical column, found in one pass.

    They become column names, so there must be few of them; more than ``spark.sql.pivotMaxValues``
    in all are refused.
    """
    limit = int(rows.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = (
        rows.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(found) > limit:
        raise ValueError(f"more than {limit} levels; drop the widest column or index it")
    levels = {c: [] for c in columns}
    for row in found:
        levels[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in levels.items()}


def standardize(
    rows: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Subtract the mean and divide by the population standard deviation of ``fit_on``.

    A constant column is only centred. Pass the training rows when scaling test rows.
    """
    source = fit_on if fit_on is not None else rows
    stats = source.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(quoted(c)).alias("mean"),
                    F.nullif(F.stddev_pop(quoted(c)), F.lit(0.0)).alias("std"),
                ).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    scaled = {
        c: (F.col(quoted(c)) - F.col("_stats")[c]["mean"])
        / F.coalesce(F.col("_stats")[c]["std"], F.lit(1.0))
        for c in columns
    }
    return rows.withColumn("_stats", stats).withColumns(scaled).drop("_stats")


def _smoothed(total: Column, n: Column, prior: Column, weight: float) -> Column:
    return (total + weight * prior) / (n + weight)


def target_prior(rows: DataFrame, target: str) -> float:
    """Mean of the target over all rows; 0 where there are none."""
    return rows.agg(F.coalesce(F.avg(F.col(target).cast("double")), F.lit(0.0))).first()[0]


def ordered_target(
    rows: DataFrame,
    columns: Sequence[str],
    target: str,
    id_column: str,
    seed: int = 0,
    weight: float = 1.0,
) -> DataFrame:
    """Add ``{column}_target``: the mean target of earlier rows of the same category.

    Earlier is meant in one shuffled order of all rows, so no row's own target is in its value, and
    a category of any width is one number. The mean of all rows counts as ``weight`` rows more; a
    null is a category, rows without a target add nothing. A category with a third of all rows is
    summed in buckets of the order, never in one task.
    """
    prior = F.lit(target_prior(rows, target))
    known = F.col(target).isNotNull()
    keyed = rows.withColumns(
        {
            "_hash": row_key(rows, seed, id_column),
            "_n": F.when(known, 1).otherwise(0),
            "_target": F.coalesce(F.col(target).cast("double"), F.lit(0.0)),
        }
    )
    bucket = F.substring("_hash", 1, hash_digits(rows))
    for column in columns:
        summed = running_sums(
            keyed.withColumn("_bucket", bucket), "_hash", ["_n", "_target"], [column]
        )
        value = _smoothed(F.col("before__target"), F.col("before__n"), prior, weight)
        keyed = summed.withColumn(f"{column}_target", value).drop("before__n", "before__target")
    return keyed.drop("_hash", "_n", "_target")


def target_table(rows: DataFrame, column: str, target: str, weight: float = 1.0) -> DataFrame:
    """``(column, column_target)`` of each category over all rows, for rows that were not fitted."""
    prior = F.lit(target_prior(rows, target))
    value = _smoothed(
        F.coalesce(F.sum(F.col(target).cast("double")), F.lit(0.0)), F.count(target), prior, weight
    )
    return rows.groupBy(column).agg(value.alias(f"{column}_target"))


def with_target(
    rows: DataFrame, table: DataFrame, column: str, prior: float
) -> DataFrame:
    """Add ``{column}_target`` of a `target_table`; categories it lacks get the prior."""
    value = F.coalesce(F.col(f"t.{column}_target"), F.lit(prior)).alias(f"{column}_target")
    same = F.col(f"r.{quoted(column)}").eqNullSafe(F.col(f"t.{quoted(column)}"))
    return rows.alias("r").join(table.alias("t"), same, "left").select("r.*", value)
