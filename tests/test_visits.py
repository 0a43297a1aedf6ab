from __future__ import annotations

import pytest

from collections import Counter

from pyspark.sql import functions as F

from clickloom.functions.urls import url_domain
from clickloom.operators import domains, pivots, time_features, visits

LOG = "uid string, visits array<struct<timestamp:bigint,url:string>>"


def hot_visits(spark, n=3000):
    """Visits of 40 users to many domains; one user and one domain hold a third of all rows each."""
    i = F.col("id")
    j = F.floor(i / 3)
    user = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (j % 39).cast("string")))
    site = F.when(i % 3 == 1, "www.hot.com").otherwise(
        F.concat(F.lit("d"), (j * j % 101 % 24).cast("string"), F.lit(".org"))
    )
    return spark.range(n).select(
        user.alias("uid"),
        (i * 1_234_567).alias("timestamp"),
        F.concat(F.lit("http://"), site, F.lit("/p")).alias("url"),
    )


def brute(frame):
    out = Counter()
    for r in frame.collect():
        out[r.uid, r.url.split("/")[2].removeprefix("www.")] += 1
    return out


def test_explode_drops_null_and_empty(rows):
    logs = rows([("a", [(1, "u"), (2, None)]), ("b", []), ("c", None)], LOG)
    found = visits.explode_visits(logs).collect()
    assert [(r.uid, r.timestamp, r.url) for r in found] == [("a", 1, "u"), ("a", 2, None)]


def test_tokens_keep_order_and_skip_bad_urls(rows):
    logs = rows(
        [("a", [(2, "http://www.x.com"), (1, "bad"), (3, "http://y.org/1")]), ("b", None)], LOG
    )
    assert [r.domain_features for r in visits.domain_tokens(logs).collect()] == [
        ["x.com", "y.org"]
    ]


def test_restrict_to_repeats_nothing(rows):
    logs = rows([("a", 1), ("a", 2), ("b", 3), (None, 4)], "uid string, v int")
    members = rows([("a",), ("a",), (None,)], "uid string")
    assert sorted(r.v for r in visits.restrict_to(logs, members).collect()) == [1, 2]


def test_union_matches_names(rows):
    one = rows([("a", 1)], "uid string, v int")
    two = rows([(2, "b")], "v int, uid string")
    found = visits.union_logs(one, two).collect()
    assert sorted((r.uid, r.v) for r in found) == [("a", 1), ("b", 2)]


def test_counts_with_hot_keys(spark):
    log = hot_visits(spark)
    found = {(r.uid, r.domain): r.cnt for r in visits.user_domain_counts(log).collect()}
    assert found == brute(log)


def test_top_domains_cut_ties_alphabetically(rows):
    totals = rows([("c", 2), ("b", 2), ("a", 1), (None, 9)], "domain string, count bigint")
    found = [r.domain for r in domains.top_domains(totals, 2).collect()]
    assert found in (["b"], ["b", "c"]) and found == ["b", "c"]


def test_unknown_domain_takes_no_place(rows):
    totals = rows([("b", 1), (None, 9)], "domain string, count bigint")
    assert [r.domain for r in domains.top_domains(totals, 2).collect()] == ["b"]


def test_vector_equals_the_grid(spark):
    log = hot_visits(spark)
    counted = visits.user_domain_counts(log)
    top = domains.top_domains(domains.domain_counts(log), 10)
    assert top.collect() == domains.top_domains(domains.domain_totals(counted), 10).collect()
    grid = domains.user_domain_grid(counted, top).collect()
    vectors = {r.uid: r.domain_features for r in domains.domain_vector(log, 10).collect()}
    assert all(len(v) == 10 for v in vectors.values()) and len(vectors) == 40
    assert len(grid) == sum(n > 0 for v in vectors.values() for n in v)
    for r in grid:
        assert vectors[r.uid][r.position - 1] == r.cnt


def test_vector_of_users_without_top_domain_or_visit(rows):
    log = rows(
        [("a", 1, "http://x.com"), ("a", 1, "http://x.com"), ("b", 1, "http://y.com"),
         ("c", 1, "bad"), (None, 1, "http://x.com")],
        "uid string, timestamp bigint, url string",
    )
    users = rows([("a",), ("a",), ("z",), (None,)], "uid string")
    assert {r.uid: r.domain_features for r in domains.domain_vector(log, 1).collect()} == {
        "a": [2], "b": [0], "c": [0],
    }
    found = domains.domain_vector(log, 1, users=users).collect()
    assert {r.uid: r.domain_features for r in found} == {"a": [2], "z": [0]} and len(found) == 2


def test_time_features_agree(spark):
    log = hot_visits(spark)
    full = {r.uid: r.asDict() for r in time_features.time_features(log).collect()}
    for r in time_features.work_evening(log).collect():
        hours = [full[r.uid][f"web_hour_{h}"] for h in range(24)]
        assert sum(hours) == r.all_visit == sum(
            v for k, v in full[r.uid].items() if k.startswith("web_day_")
        )
        assert sum(hours[9:18]) == r.visit_work and sum(hours[18:]) == r.visit_evening
        assert full[r.uid]["web_fraction_work_hours"] == r.visit_work / r.all_visit
    assert time_features.hour_counts(log).count() == time_features.weekday_counts(log).count()


def test_pivot_drops_nulls_and_fills(rows):
    data = rows(
        [("a", "x"), ("a", "x"), ("b", "y"), ("b", None), (None, "x")], "uid string, c string"
    )
    expected = {"a": (2, 0), "b": (0, 1)}
    for values in (None, ["x", "y"]):
        found = pivots.pivot_counts(data, "c", values)
        assert found.columns == ["uid", "x", "y"]
        assert {r.uid: (r.x, r.y) for r in found.collect()} == expected
    fixed = pivots.pivot_counts(data, "c", ["x", "y", "z"])
    assert {r.uid: (r.y, r.z) for r in fixed.collect()} == {"a": (0, 0), "b": (1, 0)}
    with pytest.raises(Exception, match="outside its list: x"):
        pivots.pivot_counts(data, "c", ["y", "z"]).collect()


def test_long_counts_equal_pivot(spark):
    log = hot_visits(spark).withColumn("d", url_domain("url"))
    wide = pivots.pivot_counts(log, "d")
    cells = {
        (r["uid"], c): r[c] for r in wide.collect() for c in wide.columns[1:] if r[c]
    }
    long = {(r.uid, r.d): r.cnt for r in pivots.long_counts(log, "d").collect()}
    assert cells == long == brute(log)


def test_merge_matrices(rows):
    new = rows([("a", 1, 2), ("c", 1, 1)], "uid string, `buy_a.b` bigint, y bigint")
    old = rows([("a", 10, 5), ("b", 7, 7)], "uid string, `buy_a.b` bigint, z bigint")
    found = {r[0]: tuple(r[1:]) for r in pivots.merge_matrices(new, old).collect()}
    assert found == {"a": (11, 2, 5), "b": (7, 0, 7), "c": (1, 1, 0)}


def test_fill_zero_leaves_text(rows):
    data = rows([(None, None, None)], "n int, s string, a array<int>")
    assert tuple(pivots.fill_zero(data).first()) == (0, None, None)
