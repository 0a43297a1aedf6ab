"""Deliveries that were lost at any step, early reduction to members, models of one's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_recovery import Lost, steps  # noqa: F401

from clickloom.operators import cleaning, membership
from clickloom.plans import batch_inference, data_mart
from clickloom.storage import Workspace
from clickloom.streaming import delivery

LAYOUT = "key STRING, value STRING"


class Target:
    """A topic that may lose a run after any part of a send."""

    def __init__(self, spark):
        self.spark, self.held, self.fails_after, self.asked = spark, [], None, 0

    def send(self, rows):
        for n, row in enumerate(rows.orderBy("key").collect()):
            if n == self.fails_after:
                self.fails_after = None
                raise Lost
            self.held.append((row.key, row.value))
        if self.fails_after is not None:
            self.fails_after = None
            raise Lost

    def sent(self, batch_id, since):
        self.asked += 1
        prefix = delivery.key_prefix("run", batch_id)
        found = [x for x in self.held if x[0].startswith(prefix)]
        return self.spark.createDataFrame(found, LAYOUT)


@pytest.mark.parametrize("part", [0, 1, 2, 3])
def test_a_batch_lost_within_its_send_is_sent_once(spark, rows, tmp_path, part):
    target = Target(spark)
    outbox = delivery.Outbox(spark, str(tmp_path), "run", ("uid",), target.send, target.sent)
    first = rows([("a", 1), ("b", 2), (None, 3)], "uid string, n int")
    again = rows([("a", 9), ("b", 9), (None, 9)], "uid string, n int")
    target.fails_after = part
    with pytest.raises(Lost):
        outbox(first, 1)
    outbox(again, 1)
    outbox(again, 1)
    outbox(first, 11)
    assert sorted(k for k, _ in target.held) == sorted(
        f'["run","{batch}",{u}]' for batch in (1, 11) for u in ('"a"', '"b"', "null")
    )
    assert sorted(v for k, v in target.held if '"1"' in k) == [
        '{"n":3}', '{"uid":"a","n":1}', '{"uid":"b","n":2}',
    ]
    assert target.asked == 1


def test_a_batch_lost_at_any_step_is_sent_once(spark, rows, tmp_path, steps):  # noqa: F811
    batch = rows([("a", 1), ("b", 2)], "uid string, n int")
    number = 1
    while True:
        target = Target(spark)
        outbox = delivery.Outbox(
            spark, str(tmp_path / str(number)), "run", ("uid",), target.send, target.sent
        )
        lost = steps.lost_at(number, lambda: outbox(batch, 0))
        outbox(batch, 0)
        outbox(batch, 1)
        assert len(target.held) == len(set(target.held)) == 4
        if not lost:
            break
        number += 1
    assert number > 4


def test_scores_compact_and_replay(spark, rows, tmp_path, steps):  # noqa: F811
    batches = [
        rows([(u, f"{u}{n}") for u in "abc"[n % 3 :]], "uid string, gender_age string")
        for n in range(6)
    ]
    expected = {"a": "a3", "b": "b4", "c": "c5"}
    number = 1
    while True:
        path = str(tmp_path / str(number))
        table = delivery.ScoreTable(spark, path, compact_after=2)
        assert table.read().count() == 0
        for n in range(5):
            table(batches[n], n)
        lost = steps.lost_at(number, lambda: table(batches[5], 5))
        table(batches[5], 5)
        table(batches[0], 0)  # an old batch again
        assert {r.uid: r.gender_age for r in table.read().collect()} == expected
        assert len(table._batches(-1)) <= 4
        if not lost:
            break
        number += 1
    assert number > 3


def test_filter_lets_all_members_and_few_others_pass(spark):
    members = spark.range(0, 5000).selectExpr("CAST(id * 7 AS STRING) AS uid")
    log = spark.range(0, 35000).selectExpr("CAST(id AS STRING) AS uid").unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS uid")
    )
    with Workspace(spark) as work:
        own = membership.Members(members.union(members.limit(3)), "uid", work)
        passed = {r.uid for r in own.reduce(log).collect()}
        held = {str(7 * n) for n in range(5000)}
        assert held <= passed and None not in passed
        assert len(passed - held) < 0.03 * 30000
        exact = membership.Members(members, "uid", work, most_bits=64)
        assert {r.uid for r in exact.reduce(log).collect()} == held
        empty = membership.Members(members.limit(0), "uid", work)
        assert empty.reduce(log).count() == 0


def test_data_mart_reduces_before_its_first_exchange(spark, rows):
    clients = rows([(str(n), n) for n in range(50)], "uid string, age int")
    web = spark.range(0, 20000).selectExpr(
        "CAST(id % 10000 AS STRING) AS uid", "id AS timestamp", "'http://x.com/a' AS url"
    )
    shop = spark.range(0, 20000).selectExpr(
        "CAST(id % 10000 AS STRING) AS uid", "'view' AS event_type", "'Toys' AS category"
    )
    cats = rows([("x.com", "News")], "domain string, category string")
    mart = data_mart.data_mart(clients, shop, web, cats, ["shop_toys"], ["web_news"])
    plain = data_mart.data_mart(clients, shop, web, cats)
    assert sorted(mart.collect()) == sorted(plain.select(*mart.columns).collect())
    with Workspace(spark) as work:
        left = membership.Members(clients, "uid", work).reduce(web)
        assert left.select("uid").distinct().count() < 50 + 0.03 * 10000
    physical = mart._jdf.queryExecution().optimizedPlan().toString()
    assert physical.count("getbit") >= 2


@pytest.mark.parametrize("batch_rows", [1, 7, 1024])
def test_own_model_scores_each_batch_alike(spark, rows, batch_rows):
    rng = np.random.default_rng(1)
    own = [(i, f"c{i % 3}", rng.normal(i % 3, 1, 4).tolist(), "old") for i in range(40)]
    own += [(40, "c0", None, "old"), (41, None, [1.0, None, 0.0, 0.0], "old")]
    table = rows(own, "id int, label string, features array<double>, scores string")
    means = batch_inference.class_means(table)
    labels, size, load = batch_inference.broadcast_model(means)
    scored = batch_inference.nearest_class(
        batch_inference.score_batches(table, load, size, batch_rows=batch_rows), labels
    )
    plain = {c: np.mean([v for _, k, v, _ in own if k == c and v], axis=0) for c in labels}
    assert labels == ["c0", "c1", "c2"]
    for row in scored.collect():
        if row.id >= 40:
            assert row.scores is None and row.nearest is None
            continue
        gaps = [((np.array(row.features) - plain[c]) ** 2).sum() for c in labels]
        assert np.allclose(row.scores, gaps)
        assert row.nearest == labels[int(np.argmin(gaps))]


def test_own_model_is_loaded_once_in_a_worker(spark, rows, tmp_path):
    folder = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(dir=folder)
        return lambda values: values.sum(axis=1, keepdims=True)

    table = spark.range(0, 4000, 1, 32).selectExpr("id", "array(id, 1D) AS features")
    scored = batch_inference.score_batches(table, load, 2, batch_rows=10)
    assert scored.filter("scores[0] = id + 1").count() == 4000
    assert 1 <= len(list(tmp_path.iterdir())) <= 8
    with pytest.raises(ValueError):
        batch_inference.broadcast_model(
            rows([(i, [0.0]) for i in range(3)], "label int, mean array<double>"), most_classes=2
        )
    wrong = rows([([1.0],)], "features array<double>")
    with pytest.raises(Exception, match="1 values and not 2"):
        batch_inference.score_batches(wrong, load, 2).collect()


def test_share_is_decided_row_by_row(spark):
    ids = spark.range(0, 20000)
    tenth = {r.id for r in cleaning.sample_share(ids, 0.1, "id").collect()}
    fifth = {r.id for r in cleaning.sample_share(ids.repartition(3), 0.2, "id").collect()}
    assert tenth < fifth and abs(len(tenth) - 2000) < 200
    assert cleaning.sample_share(ids, 1, "id").count() == 20000
    assert cleaning.sample_share(ids, 0, "id").count() == 0
    with pytest.raises(ValueError):
        cleaning.sample_share(ids, 1.5, "id")
