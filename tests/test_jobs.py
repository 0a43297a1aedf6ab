from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from clickloom.plans import data_mart, event_split, gender_age, user_item_matrix, web_features
from clickloom.operators import visits
from clickloom.sources import kafka, readers, writers
from clickloom.sources.schemas import SHOP_VISITS, STORED_VISITS, WEBLOGS
from clickloom.streaming import scoring
from test_visits import LOG, hot_visits

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01


def test_starting_offsets():
    assert kafka.offsets("t") == "earliest"
    assert kafka.offsets("t", "latest") == "latest"
    assert kafka.offsets("t", "17") == '{"t":{"0":17}}'
    assert kafka.offsets("t", 17, 3) == '{"t":{"0":17,"1":17,"2":17}}'
    assert kafka.offsets("t", {1: 5, 0: "latest"}, 3) == '{"t":{"0":-1,"1":5,"2":-2}}'
    options = kafka.kafka_options(
        "h:1", "t", 3, until={0: 9}, maxOffsetsPerTrigger=10, kafka_security_protocol="SSL"
    )
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": '{"t":{"0":3}}',
        "endingOffsets": '{"t":{"0":9}}',
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "domain_cats", "d.Driver")
    assert plain == {"url": "jdbc:x", "dbtable": "domain_cats", "driver": "d.Driver"}
    split = readers.jdbc_options("jdbc:x", "t", "d", "me", "secret", ("id", 0, 100, 8))
    assert split["numPartitions"] == "8" and split["upperBound"] == "100"


def test_messages_leave_nulls_out(rows):
    frame = rows([("a", None), ("b", 1)], "uid string, n int")
    found = kafka.json_messages(frame, "out").collect()
    assert [(r.value, r.topic) for r in found] == [
        ('{"uid":"a"}', "out"),
        ('{"uid":"b","n":1}', "out"),
    ]


def test_manifest_of_images(spark, tmp_path):
    for label, names in {"bart": ["1.jpg", "2.jpg", "x.png"], "lisa": ["3.jpg"]}.items():
        (tmp_path / "train" / label).mkdir(parents=True)
        for name in names:
            (tmp_path / "train" / label / name).write_bytes(b"x" * 3)
    found = readers.file_manifest(spark, str(tmp_path)).collect()
    assert sorted((r.label, r.file, r.length) for r in found) == [
        ("bart", "1.jpg", 3), ("bart", "2.jpg", 3), ("lisa", "3.jpg", 3),
    ]


def shop(rows, *events):
    data = [(u, e, c, i, T0 + d * DAY) for u, e, c, i, d in events]
    return rows(data, SHOP_VISITS)


def store(rows, path, *events):
    messages = kafka.json_messages(shop(rows, *events))
    event_split.split_events(event_split.decode_events(messages), path)


def test_split_replaces_only_its_own_load(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    first = [("a", "view", "c", "i", 0), ("a", "view", "c", "i", 1),
             ("a", "buy", "c", "i", 0), ("a", "other", "c", "i", 0)]
    store(rows, path, *first)
    store(rows, path, ("b", "view", "c", "i", 1), ("c", "view", "c", "i", 2))
    store(rows, path, *first)
    assert sorted(n for n in os.listdir(path) if n[0] != "_") == ["buy", "view"]
    found = readers.read_days(spark, f"{path}/view", STORED_VISITS).collect()
    assert sorted((r.uid, r.date) for r in found) == [
        ("a", "20240101"), ("a", "20240102"), ("b", "20240102"), ("c", "20240103"),
    ]
    part = readers.read_days(spark, f"{path}/view", STORED_VISITS, "20240102", "20240102")
    assert sorted(r.uid for r in part.collect()) == ["a", "b"]


def test_a_named_load_is_replaced(spark, rows, tmp_path):
    for user in ("a", "b"):
        events = event_split.decode_events(
            kafka.json_messages(shop(rows, (user, "view", "c", "i", 0)))
        )
        event_split.split_events(events, str(tmp_path), load="0-17")
    found = readers.read_days(spark, f"{tmp_path}/view", STORED_VISITS).collect()
    assert [r.uid for r in found] == ["b"]


def cells(spark, path):
    rows = [r.asDict() for r in spark.read.parquet(path).collect()]
    return {r["uid"]: {k: v for k, v in r.items() if v} for r in rows}


def test_matrix_updates_equal_the_whole_matrix(spark, rows, tmp_path):
    """Default arguments: new days, repeated runs, a late day, a further load of a day."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    build = user_item_matrix.build_snapshot
    loads = [
        [("a", "view", "c", "Big-Item 1", 0), ("b", "buy", "c", "x", 0), (None, "buy", "c", "x", 0)],
        [("a", "view", "c", "Big-Item 1", 3), ("c", "buy", "c", None, 3)],
        [("a", "view", "c", "Big-Item 1", 2), ("d", "buy", "c", "y", 2)],
        [("a", "view", "c", "Big-Item 1", 3), ("e", "view", "c", "z", 3)],
    ]
    for n, load in enumerate(loads):
        store(rows, source, *load)
        for _ in range(2):
            path = build(spark, source, target, update=True)
        assert path.endswith("/20240101" if n == 0 else "/20240104")
        whole = build(spark, source, str(tmp_path / f"whole{n}"))
        assert cells(spark, path) == cells(spark, whole)
    assert cells(spark, path)["a"]["view_big_item_1"] == 4
    assert cells(spark, f"{target}/20240101")["a"]["view_big_item_1"] == 1


def test_late_days_reach_every_later_snapshot(spark, rows, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    build = user_item_matrix.build_snapshot
    for day in (1, 3, 5, 2):
        store(rows, source, ("a", "view", "c", "x", day), ("a", "buy", "c", "x", day))
        build(spark, source, target, update=True)
    seen = {d: cells(spark, f"{target}/{d}")["a"]["view_x"] for d in ("20240102", "20240104", "20240106")}
    assert seen == {"20240102": 1, "20240104": 3, "20240106": 4}


def test_matrix_of_a_range(spark, rows, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    store(rows, source, ("a", "view", "c", "x", 0), ("a", "buy", "c", "x", 1))
    build = user_item_matrix.build_snapshot
    first = build(spark, source, target, update=True, date_to="20240101")
    assert first.endswith("/20240101")
    assert cells(spark, first)["a"] == {"uid": "a", "view_x": 1}
    with pytest.raises(ValueError):
        build(spark, source, target, date_from="20250101")


def test_data_mart(rows):
    clients = rows([("a", 1), ("b", 2), ("z", 3)], "uid string, age int")
    shop_log = shop(rows, ("a", "view", "Home-and Garden", "i", 0), ("a", "buy", "X", "i", 0),
                    ("q", "view", "X", "i", 0), ("b", "view", None, "i", 0))
    web = rows(
        [("a", 1, "http://www.x.com"), ("a", 1, "http://x.com/2"), ("b", 1, "http://X.com"),
         ("q", 1, "http://x.com")],
        "uid string, timestamp bigint, url string",
    )
    cats = rows([("x.com", "News"), ("y.com", "Shop-ping")], "domain string, category string")
    mart = {r.uid: r.asDict() for r in data_mart.data_mart(clients, shop_log, web, cats).collect()}
    assert mart["a"] == {
        "uid": "a", "age": 1, "shop_home_and_garden": 1, "shop_x": 0, "web_news": 2,
    }
    assert mart["b"]["web_news"] == 1 and mart["b"]["shop_x"] is None
    assert mart["z"]["web_news"] is None and len(mart) == 3
    raw = data_mart.data_mart(clients, shop_log, web, cats, key="host").collect()
    assert {r.uid: r.web_news for r in raw} == {"a": 1, "b": None, "z": None}
    with pytest.raises(ValueError):
        data_mart.web_category_counts(web, cats, "url")


def test_feature_store_has_no_null_numbers(rows, spark):
    log = hot_visits(spark)
    matrix = rows([("hot", 3), ("nobody", 4)], "uid string, buy_cameras_0 bigint")
    found = web_features.feature_store(log, matrix, 10)
    assert len(found.columns) == 1 + 1 + 2 + 7 + 24 + 1
    data = found.collect()
    assert len(data) == 40 and all(v is not None for r in data for v in r)
    assert sum(r.buy_cameras_0 for r in data) == 3


@pytest.fixture(scope="module")
def labelled(spark):
    label = F.when(F.col("uid") == "hot", "F:25-34").when(
        F.crc32("uid") % 2 == 0, "M:18-24"
    ).otherwise("F:18-24")
    return hot_visits(spark).withColumn("gender_age", label)


@pytest.fixture(scope="module")
def model(labelled):
    return gender_age.train(labelled)


def test_bag_equals_the_count_vectorizer(labelled, model):
    lists = labelled.groupBy("uid").agg(
        F.collect_list(F.regexp_extract("url", "//(www.)?([^/]+)", 2)).alias("domain_features")
    )
    expected = {r.uid: r.features for r in model.stages[0].transform(lists).collect()}
    counts = visits.user_domain_counts(labelled)
    bags = gender_age.bag_of_domains(counts, model.stages[0].vocabulary, ["uid"])
    assert {r.uid: r.features for r in bags.collect()} == expected


def test_saved_model_scores_alike(labelled, model, tmp_path):
    gender_age.save(model, str(tmp_path / "model"))
    loaded = gender_age.load(str(tmp_path / "model"))
    counts = visits.user_domain_counts(labelled)
    one = sorted(gender_age.score_counts(model, counts).collect())
    assert one == sorted(gender_age.score_counts(loaded, counts).collect())
    truth = {r.uid: r.gender_age for r in labelled.select("uid", "gender_age").distinct().collect()}
    assert sum(truth[r.uid] == r.gender_age for r in one) > 20


def messages(spark, rows, path, logs):
    kafka.json_messages(rows(logs, LOG)).coalesce(1).write.mode("append").text(path)


LOGS_1 = [("a", [(T0, "http://www.hot.com/1"), (T0, "bad")]), ("b", [(T0, "http://d1.org")]),
          ("none", []), (None, [(T0, "http://d2.org")])]
LOGS_2 = [("a", [(T0 + DAY, "http://hot.com/2"), (T0, "http://d4.org")])]


def test_stream_scores_equal_batch_scores(spark, rows, model, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    whole = LOGS_1 + LOGS_2
    for logs in (LOGS_1, LOGS_2):  # the second run restarts from the checkpoint
        messages(spark, rows, source, logs)
        scored = scoring.score_messages(model, spark.readStream.text(source))
        scoring.run_available(scoring.append_to_table(scored, out, checkpoint))
    found = spark.read.parquet(out).collect()
    batch = gender_age.score_logs(model, rows(whole, LOG)).collect()
    key = lambda r: (str(r.uid), r.gender_age)
    assert sorted(found, key=key) == sorted(batch, key=key) and len(found) == 4


def test_message_scores_equal_user_scores(rows, model):
    logs = rows(LOGS_1[:2], LOG)
    counts = visits.user_domain_counts(visits.explode_visits(logs))
    assert sorted(gender_age.score_logs(model, logs).collect()) == sorted(
        gender_age.score_counts(model, counts).collect()
    )


def test_running_counts_over_batches(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for logs in (LOGS_1, LOGS_2, LOGS_1):
        messages(spark, rows, source, logs)
        counts = scoring.running_counts(spark.readStream.text(source))
        store_ = scoring.CountStore(spark, out, "run", buckets=2)
        scoring.run_available(scoring.store_counts(counts, store_, checkpoint))
    found = {(r.uid, r.domain): r.cnt for r in store_.read().collect()}
    assert found == {
        ("a", "hot.com"): 3, ("a", None): 2, ("a", "d4.org"): 1, ("b", "d1.org"): 2,
    }


def test_running_counts_per_period(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    messages(spark, rows, source, LOGS_1 + LOGS_2)
    counts = scoring.running_counts(spark.readStream.text(source), period="1 day")
    store_ = scoring.CountStore(spark, out, "run")
    scoring.run_available(scoring.store_counts(counts, store_, checkpoint))
    found = store_.read().filter("domain = 'hot.com'").collect()
    assert sorted((str(r.period), r.cnt) for r in found) == [
        ("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 1),
    ]


def test_broken_messages_score_nothing(spark, rows, model):
    frame = rows([("{broken",), (None,)], "value string")
    assert scoring.score_messages(model, frame).count() == 0


def test_prediction_file(spark, rows, tmp_path):
    frame = rows([("1.jpg", "bart")], "file string, predicted string")
    path = str(tmp_path / "out")
    writers.write_predictions(frame, path, "file", "predicted", value_name="Expected")
    found = readers.read_csv(spark, path)
    assert found.columns == ["Id", "Expected"] and found.first().Expected == "bart"


def test_json_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "logs")
    rows(LOGS_1, LOG).write.json(path)
    assert readers.read_json(spark, path, WEBLOGS).count() == 4
    assert "visits" in readers.read_json(spark, path).columns
