"""Counting pivots and the merge of count matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    """Column name that may hold dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def listed(column: str, values: Sequence[str]) -> Column:
    """The column, failing the job on a value that is neither null nor listed."""
    value = F.col(quoted(column))
    text = F.concat(F.lit(f"{column} outside its list: "), value.cast("string"))
    return F.when(value.isNull() | value.isin(list(values)), value).otherwise(F.raise_error(text))


def pivot_counts(
    rows: DataFrame,
    column: str,
    values: Sequence[str] | None = None,
    key: str = "uid",
    weight: str | None = None,
) -> DataFrame:
    """One row per key and one bigint column per value of ``column``; missing pairs are 0.

    With ``values`` the schema is fixed and no job is needed to find it. Without it Spark looks
    the distinct values up and refuses more than ``spark.sql.pivotMaxValues``; `long_counts` has
    no such limit. ``weight`` names a column of counts to add up instead of counting rows.
    Null keys and null values are left out; a value outside ``values`` is an error, as its rows
    would be lost.
    """
    known = rows.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
    if values is not None:
        known = known.withColumn(column, listed(column, values))
    pivot = known.groupBy(key).pivot(column, list(values) if values is not None else None)
    cell = F.sum(weight) if weight else F.count(F.lit(1))
    return pivot.agg(cell).na.fill(0)


def long_counts(
    rows: DataFrame, column: str, key: str = "uid", weight: str | None = None
) -> DataFrame:
    """The same counts in long form, ``(key, column, cnt)``, for any number of values."""
    known = rows.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
    cell = F.sum(weight) if weight else F.count("*")
    return known.groupBy(key, column).agg(cell.alias("cnt"))


def merge_matrices(new: DataFrame, old: DataFrame, key: str = "uid") -> DataFrame:
    """Cell-wise sum of two count matrices; users and columns may occur in only one of them."""
    both = new.unionByName(old, allowMissingColumns=True)
    cells = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(
        *[F.sum(F.coalesce(F.col(quoted(c)), F.lit(0))).alias(c) for c in cells]
    )


def fill_zero(rows: DataFrame) -> DataFrame:
    """Nulls of all numeric columns as 0; text and array columns keep their nulls."""
    return rows.na.fill(0)
