"""Domain dictionary, its classifier, and times written as text."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.functions import times
from clickloom.operators import cleaning
from clickloom.plans import domain_dictionary, gender_age
from clickloom.storage import Workspace


def counts(rows):
    data = []
    for u in range(60):
        label = ("F:18-24", "M:18-24", "F:25-34")[u % 3]
        data += [(f"u{u}", label, f"own{u % 3}.com", 3 + u % 4), (f"u{u}", label, "hot.com", 9)]
        data += [(f"u{u}", label, f"rare{u}.org", 1), (f"u{u}", label, None, 2)]
    return rows(data, "uid string, gender_age string, domain string, cnt long")


def test_terms_are_global_ranks(rows, spark):
    with Workspace(spark) as work:
        found = domain_dictionary.dictionary(counts(rows), work).collect()
        empty = domain_dictionary.dictionary(counts(rows).limit(0), work).collect()
    totals = sorted(((-r["count"], r.domain) for r in found))
    assert [(r.term, r.domain) for r in sorted(found)] == [(i, d) for i, (_, d) in enumerate(totals)]
    assert len(found) == 64 and empty == []


def test_cut_says_what_it_leaves_out(rows, spark):
    with Workspace(spark) as work:
        terms, report = domain_dictionary.cut(domain_dictionary.dictionary(counts(rows), work), 4)
        assert {r.domain for r in terms.collect()} == {"hot.com", "own0.com", "own1.com", "own2.com"}
        visits = 60 * 9 + sum(3 + u % 4 for u in range(60)) + 60
        assert tuple(report.first()) == (64, visits, 60, 60)


def test_dictionary_model_equals_the_listed_one(rows, spark, tmp_path):
    labelled = counts(rows)
    known = labelled.filter("domain IS NOT NULL")
    plain = labelled.drop("gender_age")
    listed = gender_age.score_counts(gender_age.train_counts(known), plain)
    with Workspace(spark) as work:
        model, _ = domain_dictionary.train(labelled, work)
        assert model.size == 64
        model.save(str(tmp_path / "model"))
        small, report = domain_dictionary.train(labelled, work, size=4)
        truth = {r.uid: r.gender_age for r in labelled.collect()}
        assert {r.uid: r.gender_age for r in small.score(plain).collect()} == truth
        assert report.first()["terms_left_out"] == 60
    loaded = domain_dictionary.DomainModel.load(spark, str(tmp_path / "model"))
    assert sorted(loaded.score(plain).collect()) == sorted(listed.collect())
    unknown = rows([("x", "never.seen", 1), ("y", None, 2)], "uid string, domain string, cnt long")
    assert loaded.score(unknown).count() == 2


def millis(*at):
    return int(datetime(*at, tzinfo=timezone.utc).timestamp() * 1000)


TEXTS = [
    ("2024-02-29 23:59:58", millis(2024, 2, 29, 23, 59, 58)),
    (" 2024-02-29 ", millis(2024, 2, 29)),
    ("20240229", millis(2024, 2, 29)),
    ("29.02.2024 07:08", millis(2024, 2, 29, 7, 8)),
    ("2024-02-29T01:00:00+02:00", millis(2024, 2, 28, 23)),
    ("2024-02-29T01:00:00.250Z", millis(2024, 2, 29, 1) + 250),
    ("2023-02-29", None),
    ("29.02.2024", None),
    ("yesterday", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_text_times(rows, spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        frame = rows([(i, t) for i, (t, _) in enumerate(TEXTS)], "i int, text string")
        found = cleaning.parse_times(frame, "text").orderBy("i").collect()
        assert [r.millis for r in found] == [m for _, m in TEXTS]
        assert [r.reason for r in found] == [None] * 6 + ["no layout"] * 3 + ["empty", "missing"]
        days = frame.select("i", times.text_date("text").cast("string").alias("d")).orderBy("i")
        assert [r.d for r in days.collect()][3:6] == ["2024-02-29", "2024-02-28", "2024-02-29"]
        bad = cleaning.unparsed(cleaning.parse_times(frame, "text"))
        assert bad.count() == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_times_of_a_zone_and_order_of_layouts(rows):
    frame = rows([("2024-07-01 12:00:00",), ("01/02/2024",)], "text string")
    summer = frame.select(times.text_millis("text", zone="Europe/Berlin")).collect()
    assert [r[0] for r in summer] == [millis(2024, 7, 1, 10), None]
    for layouts, day in (("dd/MM/yyyy", "MM/dd/yyyy"), (2024, 2, 1)), (("MM/dd/yyyy", "dd/MM/yyyy"), (2024, 1, 2)):
        found = frame.select(times.text_millis("text", layouts), times.text_layout("text", layouts))
        assert tuple(found.collect()[1]) == (millis(*day), layouts[0])
