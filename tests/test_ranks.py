from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import ranks, splits, stats


def digest(seed, i):
    return hashlib.md5(f"{seed}-{i}".encode()).hexdigest()


def test_buckets_follow_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, expected in [("1", (64, 2)), ("200", (256, 2)), ("20000", (1024, 4))]:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            frame = spark.range(1)
            assert (ranks.value_buckets(frame), ranks.hash_digits(frame)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hash_ranks_are_the_sorted_order(spark):
    found = ranks.hash_ranks(spark.range(500), "id", "s")
    order = [r.id for r in found.orderBy("rank").collect()]
    assert order == sorted(range(500), key=lambda i: digest("s", i))
    assert sorted(r.rank for r in found.collect()) == list(range(1, 501))


def hot_groups(spark, n=900):
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string"))
    return spark.range(n).withColumn("g", group)


def test_hash_ranks_by_group(spark):
    found = ranks.hash_ranks(hot_groups(spark), "id", 1, by=["g"]).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r.g].append((r.rank, r.id))
    for members in groups.values():
        ids = [i for _, i in sorted(members)]
        assert ids == sorted(ids, key=lambda i: digest(1, i))
        assert sorted(members)[-1][0] == len(members)


@pytest.mark.parametrize("n, share", [(100, 0.8), (101, 0.8), (1, 0.8), (10, 1.0), (10, 0.0)])
def test_split_sizes(spark, n, share):
    found = splits.train_test_split(spark.range(n), "id", share).groupBy("part").count().collect()
    sizes = {r.part: r["count"] for r in found}
    assert sizes.get("train", 0) == int(n * share)
    assert sum(sizes.values()) == n


def test_split_ignores_partitions(spark):
    one = splits.train_test_split(spark.range(0, 400, 1, 1), "id").collect()
    many = splits.train_test_split(spark.range(0, 400, 1, 13), "id").collect()
    assert sorted(one) == sorted(many)


def test_approximate_split_is_near_the_share(spark):
    rough = splits.train_test_split(spark.range(5000), "id", exact=False)
    assert abs(rough.filter("part = 'train'").count() / 5000 - 0.8) < 0.03
    by_label = splits.stratified_split(hot_groups(spark, 5000), "id", "g", exact=False)
    assert abs(by_label.filter("part = 'test'").count() / 5000 - 0.25) < 0.03


def test_stratified_split(spark):
    frame = hot_groups(spark).unionByName(
        spark.createDataFrame([(9001, None), (9002, "single")], "id bigint, g string")
    )
    found = splits.stratified_split(frame, "id", "g").collect()
    assert len(found) == 902
    sizes = defaultdict(lambda: [0, 0])
    for r in found:
        sizes[r.g][r.part == "test"] += 1
    for label, (train, test) in sizes.items():
        if label is not None:
            assert test == -(-(train + test) // 4)


@pytest.mark.parametrize("size, batches", [(10, 10), (7, 14)])
def test_epoch_batches(spark, size, batches):
    found = splits.epoch_batches(spark.range(100), "id", size, epoch=3).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r.batch].append(r.id)
    assert sorted(groups) == list(range(batches))
    assert all(len(ids) == size for ids in groups.values())
    assert len({r.id for r in found}) == batches * size
    other = splits.epoch_batches(spark.range(100), "id", size, epoch=4).collect()
    assert {(r.id, r.batch) for r in found} != {(r.id, r.batch) for r in other}


SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize(
    "data",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 50,
        np.random.default_rng(1).normal(size=2000).tolist(),
        [7.0] * 700 + np.random.default_rng(2).exponential(5, 1400).tolist(),
        [-1e9, 0.0, 1e9, None],
    ],
    ids=["one", "two", "constant", "normal", "hot value", "wide"],
)
def test_quantiles(rows, data):
    frame = rows([(v,) for v in data], "v double")
    found = {r.share: r.value for r in stats.quantiles(frame, "v", SHARES).collect()}
    known = [v for v in data if v is not None]
    assert found == pytest.approx(dict(zip(SHARES, np.quantile(known, SHARES))))


def test_quantiles_of_nothing(rows):
    assert stats.quantiles(rows([(None,)], "v double"), "v", [0.5]).count() == 0


def test_running_sums_with_hot_value(rows):
    rng = np.random.default_rng(3)
    frame = rows([(float(v), int(n)) for v, n in zip(rng.permutation(500), rng.integers(0, 9, 500))],
                 "v double, n int")
    bucketed = ranks.with_value_bucket(frame, "v", ranks.value_bounds(frame, "v"))
    assert bucketed.select("_bucket").distinct().count() > 50
    found = ranks.running_sums(bucketed, "v", ["n"]).collect()
    total = 0
    for r in sorted(found, key=lambda r: r.v):
        assert r.before_n == total
        total += r.n


def test_box_plot(rows):
    data = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -50.0, None]
    found = stats.box_plot(rows([(v,) for v in data], "v double"), "v").first()
    q1, median, q3 = np.quantile([v for v in data if v is not None], [0.25, 0.5, 0.75])
    assert tuple(found) == (q1, median, q3, 1.0, 8.0, 2)


def test_histogram(rows):
    frame = rows([(float(v),) for v in range(31)] + [(None,)], "v double")
    found = sorted(stats.histogram(frame, "v").collect())
    assert [r.n for r in found] == [1] * 29 + [2]
    assert (found[0].low, found[-1].high) == (0.0, 30.0)
    sparse = stats.histogram(rows([(0.0,), (30.0,)], "v double"), "v").collect()
    assert sum(r.n for r in sparse) == 2 and len(sparse) == 30
    constant = stats.histogram(rows([(4.0,), (4.0,)], "v double"), "v", 3).collect()
    assert sum(r.n for r in constant) == 2


def test_small_statistics(rows):
    frame = rows([("a", 1), ("a", None), (None, 1)], "x string, y int")
    found = {(r.feature, r.value): r.n for r in stats.value_counts(frame, ["x", "y"]).collect()}
    assert found == {("x", "a"): 2, ("y", "1"): 2}
    balance = {r.x: (r.n, r.share) for r in stats.class_balance(frame, "x").collect()}
    assert balance == {"a": (2, 1.0)}
    assert tuple(stats.distinct_count(frame, "x").first()) == (2, 1)
    assert stats.distinct_count(frame, "x", approximate=True).first().n_distinct == 1
    history = rows([(1, 0.5, 4), (2, 0.75, 4), (3, 0.75, 2)], "epoch int, acc double, n int")
    assert stats.best_row(history, "acc", "epoch").first().epoch == 2
    assert stats.weighted_mean(history, "acc", "n").first().acc == pytest.approx(0.65)


def with_nulls(rows):
    ids = [i if i % 20 else None for i in range(100)]
    data = [(i, n, "x" if n < 60 else "y" if n < 90 else None) for n, i in enumerate(ids)]
    return rows(data, "id long, n int, label string")


def test_null_ids_keep_exact_sizes(rows):
    frame = with_nulls(rows)
    assert sorted(r["rank"] for r in ranks.hash_ranks(frame, "id", 1).collect()) == list(range(1, 101))
    parts = splits.train_test_split(frame, "id").groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"train": 80, "test": 20}
    batches = splits.epoch_batches(frame, "id", 10).groupBy("batch").count().collect()
    assert [r["count"] for r in batches] == [10] * 10
    kept = splits.epoch_batches(frame, "id", 30, keep_last=True).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in kept) == [10, 30, 30, 30]


def test_null_labels_are_a_stratum(rows):
    found = splits.stratified_split(with_nulls(rows), "id", "label", test_share=0.5)
    sizes = {(r.label, r.part): r["count"] for r in found.groupBy("label", "part").count().collect()}
    assert sizes == {
        ("x", "test"): 30, ("x", "train"): 30, ("y", "test"): 15, ("y", "train"): 15,
        (None, "test"): 5, (None, "train"): 5,
    }


def test_repeated_ids_keep_exact_sizes(rows):
    frame = rows([(i % 10, i) for i in range(100)], "id long, n int")
    parts = splits.train_test_split(frame, "id", 0.37).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"train": 37, "test": 63}
