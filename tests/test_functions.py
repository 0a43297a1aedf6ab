from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions import names, times, urls, vectors


def values(frame, column):
    return [r[0] for r in frame.select(column).collect()]


@pytest.mark.parametrize(
    "url, domain",
    [
        ("http://www.a.com/x", "a.com"),
        ("HTTP://WWW.A.com:8080/x?y=1", "a.com"),
        ("https://awwwb.com", "awwwb.com"),
        ("https://m.www2.org/", "m.www2.org"),
        ("a.com/no-scheme", None),
        ("http://bad host.com/", None),
        (None, None),
    ],
)
def test_domain(rows, url, domain):
    frame = rows([(url,)], "url string")
    assert values(frame, urls.url_domain("url")) == [domain]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("prefix", ["awwwb.com", "m.www2.org", "a.www.b"]),
        ("legacy", ["a.com", "m..org", "a.b"]),
        ("literal", ["awwwb.com", "m.www2.org", "a.b"]),
        ("none", ["awwwb.com", "m.www2.org", "www.a.www.b"]),
    ],
)
def test_strip_modes(rows, mode, expected):
    frame = rows([("awwwb.com",), ("m.www2.org",), ("www.a.www.b",)], "h string")
    assert values(frame, urls.strip_www(F.col("h"), mode)) == expected


def test_unknown_strip_mode():
    with pytest.raises(ValueError):
        urls.strip_www(F.col("h"), "other")


def test_names(rows):
    frame = rows([("Home-and Garden", "BUY"), (None, "view")], "c string, e string")
    assert values(frame, names.normalize_name("web_", "c")) == ["web_home_and_garden", None]
    assert values(frame, names.item_key("e", "c")) == ["BUY_home_and_garden", None]


def test_display_name_and_paths(rows):
    frame = rows([("abraham_grampa_SIMPSON", "/t/bart/01.jpg")], "l string, p string")
    assert values(frame, names.display_name("l")) == ["Abraham Grampa Simpson"]
    assert values(frame, names.file_name("p")) == ["01.jpg"]
    assert values(frame, names.parent_folder("p")) == ["bart"]
    bare = rows([("x.jpg",)], "p string")
    assert values(bare, names.parent_folder("p")) == [None]


def test_working_hours_truth_table(spark):
    frame = spark.range(24).select((F.col("id") * 3_600_000).alias("t"))
    hour = times.utc_hour("t")
    flags = frame.select(
        hour.alias("h"), times.is_work_hour(hour).alias("w"), times.is_evening_hour(hour).alias("e")
    ).collect()
    assert {r.h for r in flags if r.w} == set(range(9, 18))
    assert {r.h for r in flags if r.e} == set(range(18, 24))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_ignore_the_session_zone(spark, rows, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist as a New York wall-clock time on this day.
        frame = rows([("2024-03-10 02:30:59.9995",)], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("ts")
        )
        millis = times.epoch_millis("ts")
        found = frame.select(
            millis,
            times.utc_time_text(millis),
            times.utc_date_compact(millis),
            times.utc_weekday(millis),
            times.utc_hour(millis),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(found) == (1710037859999, "2024-03-10 02:30:59", "20240310", "sun", 2)


def test_dense_and_sparse_vectors(rows):
    frame = rows(
        [([(0, 5), (3, 7)],), ([(4, 1)],), ([],)],
        "e array<struct<pos:int,cnt:bigint>>",
    )
    size = F.lit(5)
    dense = values(frame, vectors.dense_counts(F.col("e"), size))
    assert dense == [[5, 0, 0, 7, 0], [0, 0, 0, 0, 1], [0, 0, 0, 0, 0]]
    sparse = values(frame, vectors.sparse_vector(size, F.col("e")))
    assert [list(v.toArray()) for v in sparse] == dense


def test_scores(rows):
    frame = rows([([1.0, 3.0, 3.0],), ([1000.0, 0.0, 0.0],)], "s array<double>")
    soft = values(frame, vectors.softmax("s"))
    assert soft[0] == pytest.approx([0.063379, 0.468311, 0.468311], abs=1e-6)
    assert soft[1] == [1.0, 0.0, 0.0]
    assert values(frame, vectors.argmax("s")) == [1, 0]
    assert values(frame, vectors.log_softmax_at("s", F.lit(1)))[0] == pytest.approx(
        math.log(soft[0][1])
    )
    names_ = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert values(frame, vectors.class_name(vectors.argmax("s"), names_)) == ["b", "a"]
    assert values(frame, vectors.element_at_position("s", 2)) == [3.0, 0.0]
    assert values(frame, vectors.element_at_position("s", 9)) == [None, None]


def test_channel_scaling_is_reversible(rows):
    frame = rows([([0.0, 127.5, 255.0, 64.0],)], "p array<double>")
    scaled = frame.select(vectors.scale_channels("p").alias("s"))
    assert scaled.first().s[1] == pytest.approx((0.5 - 0.456) / 0.224)
    back = values(scaled, vectors.unscale_channels("s"))[0]
    assert back == pytest.approx([0, 0.5, 1, 64 / 255])
    outside = rows([([99.0, -99.0, 0.0],)], "s array<double>")
    assert values(outside, vectors.unscale_channels("s"))[0] == pytest.approx([1, 0, 0.406])
