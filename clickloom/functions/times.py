"""UTC calendar parts of epoch milliseconds.

All of them count from a zone-less epoch, so the session time zone cannot shift a result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Weekday abbreviations, Monday first, as `weekday()` counts.
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
HOURS = tuple(range(24))
# Working hours are [9, 18), evening hours are [18, 24).
WORK_HOURS = (9, 18)
EVENING_HOURS = (18, 24)

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_millis(ts: Column | str) -> Column:
    """Zone-less timestamp to epoch milliseconds, rounded down."""
    since = _as_column(ts).cast("timestamp_ntz") - F.expr(_EPOCH)

    def part(name: str) -> Column:
        return F.extract(F.lit(name), since)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000 + F.floor(part("SECOND") * 1000).cast("long")


def utc_seconds(millis: Column | str) -> Column:
    """Zone-less UTC timestamp of epoch milliseconds, cut to whole seconds."""
    seconds = F.floor(_as_column(millis) / 1000)
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def utc_date(millis: Column | str) -> Column:
    return utc_seconds(millis).cast("date")


def utc_date_text(millis: Column | str) -> Column:
    """``yyyy-MM-dd``."""
    return utc_date(millis).cast("string")


def utc_date_compact(millis: Column | str) -> Column:
    """``yyyyMMdd``."""
    return F.replace(utc_date_text(millis), F.lit("-"), F.lit(""))


def utc_time_text(millis: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return utc_seconds(millis).cast("string")


def utc_hour(millis: Column | str) -> Column:
    """Hour of the day, 0 to 23."""
    return F.pmod(F.floor(_as_column(millis) / 3_600_000), F.lit(24)).cast("int")


def utc_weekday(millis: Column | str) -> Column:
    """``mon`` to ``sun``."""
    return F.get(F.array(*map(F.lit, WEEKDAYS)), F.weekday(utc_date(millis)))


def _within(hour: Column, span: tuple[int, int]) -> Column:
    return (hour >= span[0]) & (hour < span[1])


def is_work_hour(hour: Column) -> Column:
    return _within(hour, WORK_HOURS)


def is_evening_hour(hour: Column) -> Column:
    return _within(hour, EVENING_HOURS)


# Layouts of text times that are tried in this order; a log may have others.
TEXT_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "dd.MM.yyyy HH:mm",
    "yyyy-MM-dd",
    "yyyyMMdd",
)
# Letters of a layout that name a zone or an offset.
_ZONE = re.compile("[VzOXxZ]")


def _parsed(text: Column, layout: str, zone: str) -> Column:
    if _ZONE.search(re.sub("'[^']*'", "", layout)):
        found = F.try_to_timestamp(text, F.lit(layout))
    else:
        # The zone is named in the text, so that the session's zone has no part in it.
        found = F.try_to_timestamp(F.concat(text, F.lit(f" {zone}")), F.lit(f"{layout} VV"))
    return F.unix_millis(found)


def text_millis(
    text: Column | str, layouts: Sequence[str] = TEXT_LAYOUTS, zone: str = "UTC"
) -> Column:
    """Epoch milliseconds of a text time by the first layout that fits; null where none does.

    A text without a zone of its own is in ``zone``. Blanks around a text do not count.
    """
    trimmed = F.trim(_as_column(text))
    return F.coalesce(*[_parsed(trimmed, layout, zone) for layout in layouts])


def text_date(
    text: Column | str, layouts: Sequence[str] = TEXT_LAYOUTS, zone: str = "UTC"
) -> Column:
    """UTC day of a text time."""
    return utc_date(text_millis(text, layouts, zone))


def text_layout(
    text: Column | str, layouts: Sequence[str] = TEXT_LAYOUTS, zone: str = "UTC"
) -> Column:
    """The layout that fits first; null where none does."""
    trimmed = F.trim(_as_column(text))
    found = [F.when(_parsed(trimmed, p, zone).isNotNull(), F.lit(p)) for p in layouts]
    return F.coalesce(*found)
