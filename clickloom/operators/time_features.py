"""Weekday, hour and working-time features of visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import (
    HOURS,
    WEEKDAYS,
    is_evening_hour,
    is_work_hour,
    utc_hour,
    utc_weekday,
)


def _parts(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("uid").isNotNull()).select(
        "uid", utc_weekday("timestamp").alias("day"), utc_hour("timestamp").alias("hour")
    )


def _day_counts() -> list:
    return [F.count_if(F.col("day") == d).alias(f"web_day_{d}") for d in WEEKDAYS]


def _hour_counts() -> list:
    return [F.count_if(F.col("hour") == h).alias(f"web_hour_{h}") for h in HOURS]


def _work_counts() -> list:
    hour = F.col("hour")
    return [
        F.count("*").alias("all_visit"),
        F.count_if(is_work_hour(hour)).alias("visit_work"),
        F.count_if(is_evening_hour(hour)).alias("visit_evening"),
    ]


def _fractions() -> list:
    return [
        F.try_divide("visit_work", "all_visit").alias("web_fraction_work_hours"),
        F.try_divide("visit_evening", "all_visit").alias("web_fraction_evening_hours"),
    ]


def weekday_counts(visits: DataFrame) -> DataFrame:
    """``uid`` and ``web_day_mon`` to ``web_day_sun``; a day without visits is 0."""
    return _parts(visits).groupBy("uid").agg(*_day_counts())


def hour_counts(visits: DataFrame) -> DataFrame:
    """``uid`` and ``web_hour_0`` to ``web_hour_23``."""
    return _parts(visits).groupBy("uid").agg(*_hour_counts())


def work_evening(visits: DataFrame) -> DataFrame:
    """Visits in all, in working and in evening hours, and the two shares."""
    counts = _parts(visits).groupBy("uid").agg(*_work_counts())
    return counts.select("*", *_fractions())


def time_features(visits: DataFrame) -> DataFrame:
    """The two shares, the seven weekday and the 24 hour counts of each user.

    One aggregate over the log: the sums run map-side, so a hot user arrives as one row per task.
    """
    counts = (
        _parts(visits).groupBy("uid").agg(*_work_counts(), *_day_counts(), *_hour_counts())
    )
    return counts.select(
        "uid",
        *_fractions(),
        *[f"web_day_{d}" for d in WEEKDAYS],
        *[f"web_hour_{h}" for h in HOURS],
    )
