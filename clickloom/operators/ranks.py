"""Exact global order without a one-task window.

Rows are put in buckets that follow the wanted order. Bucket totals are few and give each bucket
its start; the window then only runs inside a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import stage
from .pivots import quoted

# Least and most buckets of a value order, most hash digits that name a bucket.
VALUE_BUCKETS = (64, 1024)
HASH_DIGITS = 4


def _parallelism(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def value_buckets(rows: DataFrame) -> int:
    """As many buckets as the session shuffles into, as a power of two within the limits."""
    least, most = VALUE_BUCKETS
    return min(most, max(least, 1 << (_parallelism(rows) - 1).bit_length()))


def hash_digits(rows: DataFrame) -> int:
    """Hexadecimal digits that name at least as many buckets as the session shuffles into."""
    return min(HASH_DIGITS, max(2, len(f"{_parallelism(rows):x}")))


def hash_key(seed: int | str, id_column: str) -> Column:
    """Reproducible shuffle key of a row; null ids are a value of their own."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit("\u0000"))
    return F.md5(F.concat(F.lit(f"{seed}-"), text))


def row_key(rows: DataFrame, seed: int | str, id_column: str) -> Column:
    """`hash_key`, followed by a digest of the whole row that orders rows of the same id."""
    digest = F.xxhash64(*[F.to_json(F.struct(quoted(c))) for c in rows.columns])
    return F.concat(hash_key(seed, id_column), F.lpad(F.hex(digest), 16, "0"))


def _same(columns: Sequence[str]) -> Column:
    """Null-safe join condition between frames named ``a`` and ``b``."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"a.{quoted(c)}").eqNullSafe(F.col(f"b.{quoted(c)}"))
    return same


def _bucket_starts(rows: DataFrame, sums: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sum of each column over the earlier buckets; one row per bucket (and ``by`` group)."""
    totals = rows.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    earlier = (
        Window.partitionBy(*by)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_start_{s}") for s in sums],
        *[F.col(s).alias(f"_total_{s}") for s in sums],
    )


def running_sums(
    bucketed: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Replace ``_bucket`` by ``before_{s}`` for each summed column: its sum over the rows earlier
    in ``order``.

    ``_bucket`` must never fall when ``order`` rises and ``order`` must be unique within ``by``.
    """
    columns = [c for c in bucketed.columns if c != "_bucket"]
    starts = _bucket_starts(bucketed, sums, by)
    earlier = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = [
        (F.col(f"_start_{s}") + F.coalesce(F.sum(s).over(earlier), F.lit(0))).alias(f"before_{s}")
        for s in sums
    ]
    kept = [F.col(f"a.{quoted(c)}").alias(c) for c in columns]
    joined = bucketed.alias("a").join(starts.alias("b"), _same([*by, "_bucket"]))
    return joined.select(*kept, "a._bucket", *[f"b._start_{s}" for s in sums]).select(
        *[quoted(c) for c in columns], *before
    )


def value_bounds(rows: DataFrame, value: str) -> list[float]:
    """Approximate quantiles of the column that part its rows into about equal buckets.

    Found once, by sketches merged as a tree, and constants from then on: every use of the
    buckets sees the same bounds. They only balance the buckets; any bounds keep orders exact.
    """
    buckets = value_buckets(rows)
    shares = [i / buckets for i in range(1, buckets)]
    return rows.approxQuantile(value, shares, 1 / (4 * buckets))


def _constant(number: float) -> str:
    return f"double('{number!r}')"


def with_value_bucket(rows: DataFrame, value: str, bounds: Sequence[float]) -> DataFrame:
    """Add ``_bucket``, the number of bounds below each value; a binary search in generated code."""
    placed = rows.withColumn("_bucket", F.lit(0))
    if not bounds:
        return placed
    array = F.expr(f"array({', '.join(map(_constant, bounds))})")
    step = 1 << (len(bounds).bit_length() - 1)
    while step:
        bound = F.get(array, F.col("_bucket") + (step - 1))
        further = F.when(bound < F.col(value), step).otherwise(0)
        placed = placed.withColumn("_bucket", F.col("_bucket") + further)
        step //= 2
    return placed


def _within_bucket(value: str, bounds: Sequence[float], bucket: int) -> Column:
    """Whether a value lies in the bucket, as a range the scan can skip files by."""
    inside = F.lit(True)
    if bucket > 0:
        inside = F.col(value) > F.expr(_constant(bounds[bucket - 1]))
    if bucket < len(bounds):
        inside = inside & (F.col(value) <= F.expr(_constant(bounds[bucket])))
    return inside


def values_at_ranks(rows: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """``(share, rank, low, high)``: the values at the ranks next to each share of the rows.

    ``rank`` is ``share * (rows - 1)``; ``low`` and ``high`` stand at it rounded down and up. The
    driver sees one count per bucket. Only rows in the buckets that hold a wanted rank go on: they
    are counted per distinct value and ordered by finer buckets of their own.
    """
    values = rows.select(value)
    bounds = value_bounds(values, value)
    counted = with_value_bucket(values, value, bounds).groupBy("_bucket")
    totals = counted.agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in totals)
    wanted, start = [], 0
    for r in sorted(totals):
        for share in shares:
            rank = share * (total - 1)
            for place in {math.floor(rank), math.ceil(rank)}:
                if start <= place < start + r["n"]:
                    wanted.append((r["_bucket"], float(share), rank, place - start))
        start += r["n"]
    outer, inside = F.lit(None).cast("int"), F.lit(False)
    for bucket in sorted({w[0] for w in wanted}):
        here = _within_bucket(value, bounds, bucket)
        outer, inside = F.when(here, bucket).otherwise(outer), inside | here
    kept = values.filter(inside).withColumn("_outer", outer)
    counts = kept.groupBy("_outer", value).agg(F.count("*").alias("n"))
    fine = with_value_bucket(counts, value, value_bounds(kept, value))
    placed = running_sums(fine, value, ["n"], by=["_outer"])
    # At most two rows per share.
    places = rows.sparkSession.createDataFrame(
        wanted, "_outer int, share double, rank double, _place bigint"
    )
    hit = F.col("_place").between(F.col("before_n"), F.col("before_n") + F.col("n") - 1)
    return (
        placed.join(F.broadcast(places), "_outer")
        .filter(hit)
        .groupBy("share", "rank")
        .agg(F.min(value).alias("low"), F.max(value).alias("high"))
    )


def hash_ranks(
    rows: DataFrame,
    id_column: str,
    seed: int | str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``rank``, the 1-based place of each row in the shuffled order (within ``by``).

    Rows of the same or no id follow a digest of the whole row; equal rows follow each other.
    """
    keyed = rows.withColumn("_hash", row_key(rows, seed, id_column)).withColumn("_one", F.lit(1))
    bucketed = keyed.withColumn("_bucket", F.substring("_hash", 1, hash_digits(rows)))
    ranked = running_sums(bucketed, "_hash", ["_one"], by)
    return ranked.select(*map(quoted, rows.columns), (F.col("before__one") + 1).alias("rank"))


def hash_threshold(
    rows: DataFrame,
    id_column: str,
    seed: int | str,
    take: Column,
    by: Sequence[str] = (),
) -> DataFrame:
    """Greatest `row_key` among the first ``take`` rows of the shuffled order, per ``by`` group.

    ``take`` is an expression of ``total``, the group's row count. The bucket of the cut is found
    by counts, then the finer bucket in it, and only rows of that one are ranked, so the last
    step stays small however large a bucket is. Groups that take nothing have no row. With ``by``
    the cuts are stored first: their true size then decides whether the joins broadcast them, and
    rows outside the cut buckets are not shuffled.
    """
    digits = hash_digits(rows)
    keyed = rows.select(*map(quoted, by), row_key(rows, seed, id_column).alias("_hash"))
    left = take.cast("long")
    for level in range(2):
        keyed = keyed.withColumn("_bucket", F.substring("_hash", 1 + level * digits, digits))
        carried = ["_left"] if level else []
        totals = _bucket_starts(keyed.withColumn("n", F.lit(1)), ["n"], [*by, *carried])
        if not level:
            group = Window.partitionBy(*map(quoted, by))
            totals = totals.withColumn("total", F.sum("_total_n").over(group))
        placed = totals.withColumn("_after", left - F.col("_start_n"))
        cut = placed.filter((F.col("_after") > 0) & (F.col("_after") <= F.col("_total_n")))
        cut = cut.select(*map(quoted, by), "_bucket", F.col("_after").alias("_left"))
        cut = stage(cut, "cut-buckets") if by else F.broadcast(cut)
        inside = keyed.drop("_left").alias("a").join(cut.alias("b"), _same([*by, "_bucket"]))
        groups = [F.col(f"a.{quoted(c)}").alias(c) for c in by]
        keyed = inside.select(*groups, "a._hash", "a._bucket", "b._left")
        left = F.col("_left")
    place = Window.partitionBy(*map(quoted, by), "_bucket").orderBy("_hash")
    boundary = keyed.withColumn("_place", F.row_number().over(place))
    return boundary.filter("_place = _left").select(
        *map(quoted, by), F.col("_hash").alias("threshold")
    )
