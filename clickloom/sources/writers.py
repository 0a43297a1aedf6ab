"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def load_digest(rows: DataFrame) -> str:
    """Name of a load made from its rows, whatever their order: the same rows, the same name."""
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(rows.columns)])
    found = rows.agg(
        F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("digest")
    ).first()
    return f"{found['n']}_{found['digest'] or 0}".replace("-", "m")


def write_days(rows: DataFrame, path: str, date: str = "date") -> None:
    """JSON partitioned by ``$date``, a copy of ``date``, replacing what was at ``path``.

    The rebalance gathers each day into files of the advisory size: small days share no task with
    many files, and a day with most rows is spread over several tasks.
    """
    (
        rows.withColumn("$date", F.col(date))
        .hint("rebalance", F.col("`$date`"))
        .write.mode("overwrite")
        .partitionBy("$date")
        .json(path)
    )


def write_table(rows: DataFrame, path: str) -> None:
    """Parquet, replacing what was there."""
    rows.write.mode("overwrite").parquet(path)


def write_predictions(rows: DataFrame, path: str, id_column: str, value: str, **names) -> None:
    """Prediction file: id and value as CSV with a header.

    ``id_name`` and ``value_name`` set the names in the header.
    """
    rows.select(
        F.col(id_column).alias(names.get("id_name", "Id")),
        F.col(value).alias(names.get("value_name", value)),
    ).write.mode("overwrite").option("header", True).csv(path)
