"""Reproducible splits and epoch batches in the order of a seeded hash.

The order depends on the seed and the rows only, never on partitions or retries. Null and repeated
ids are ordered by a digest of the whole row; rows that are equal throughout are not told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..storage import stage
from .pivots import quoted
from .ranks import hash_key, hash_ranks, hash_threshold, row_key


def hash_share(seed: int | str, id_column: str) -> Column:
    """The first 32 bits of the row's hash as a number in [0, 1)."""
    head = F.conv(F.substring(hash_key(seed, id_column), 1, 8), 16, 10)
    return head.cast("double") / float(2**32)


def train_test_split(
    rows: DataFrame,
    id_column: str,
    train_share: float = 0.8,
    seed: int | str = 42,
    exact: bool = True,
) -> DataFrame:
    """Add ``part``: ``train`` for ``floor(share * rows)`` rows, ``test`` for the others.

    The exact size comes from one threshold hash, so no row is shuffled. ``exact=False`` compares
    the hash with the share itself and needs no extra pass; sizes are then right on average.
    """
    if exact:
        take = F.floor(F.col("total") * F.lit(train_share))
        limit = hash_threshold(rows, id_column, seed, take).scalar()
        in_train = F.coalesce(row_key(rows, seed, id_column) <= limit, F.lit(False))
    else:
        in_train = hash_share(seed, id_column) < train_share
    return rows.withColumn("part", F.when(in_train, "train").otherwise("test"))


def stratified_split(
    rows: DataFrame,
    id_column: str,
    label: str,
    test_share: float = 0.25,
    seed: int | str = 42,
    exact: bool = True,
) -> DataFrame:
    """Add ``part``: per label ``test`` for ``ceil(share * rows of the label)`` rows.

    Each label has one threshold hash; a label holding most rows costs no more than others. Rows
    without a label are a stratum of their own.
    """
    if exact:
        take = F.ceil(F.col("total") * F.lit(test_share))
        limits = stage(
            hash_threshold(rows, id_column, seed, take, [label]), "split-thresholds"
        )
        limits = limits.select(F.col(quoted(label)).alias("_label"), "threshold")
        keyed = rows.withColumn("_key", row_key(rows, seed, id_column))
        joined = keyed.join(limits, F.col(quoted(label)).eqNullSafe(F.col("_label")), "left")
        in_test = F.coalesce(F.col("_key") <= F.col("threshold"), F.lit(False))
        part = F.when(in_test, "test").otherwise("train").alias("part")
        return joined.select(*map(quoted, rows.columns), part)
    in_test = hash_share(seed, id_column) < test_share
    return rows.withColumn("part", F.when(in_test, "test").otherwise("train"))


def epoch_batches(
    rows: DataFrame,
    id_column: str,
    batch_size: int,
    seed: int | str = 42,
    epoch: int = 0,
    keep_last: bool = False,
) -> DataFrame:
    """Add ``batch``: the shuffled rows of one epoch in batches of equal size.

    Each row occurs at most once per epoch; an incomplete last batch stays with ``keep_last``.
    """
    total = rows.agg(F.count("*")).scalar()
    ranked = hash_ranks(rows, id_column, f"{seed}-{epoch}")
    batch = F.floor((F.col("rank") - 1) / batch_size)
    return (
        ranked.withColumn("batch", batch)
        .filter(F.lit(keep_last) | ((F.col("batch") + 1) * batch_size <= total))
        .drop("rank")
    )
