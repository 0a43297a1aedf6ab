"""User by item matrix of view and buy counts, kept as dated snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import item_key
from ..functions.times import utc_date
from ..operators.pivots import pivot_counts
from ..operators.visits import union_logs
from ..sources.readers import file_manifest, read_days
from ..sources.schemas import STORED_VISITS
from ..sources.writers import write_table
from ..storage import Files, Ledger
from .event_split import EVENT_TYPES

# Folders next to the snapshots: what each is made of, and its counts as rows.
LEDGER = "_snapshots"
TOTALS = "_totals"
STAGING = "_staging-"


def user_item_matrix(logs: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """One row per user, one column ``{event_type}_{item}`` per pair that occurs."""
    keyed = logs.select("uid", item_key("event_type", "item_id").alias("item"))
    return pivot_counts(keyed, "item", values)


def snapshot_date(logs: DataFrame) -> DataFrame:
    """One row: the last UTC day in the logs as ``yyyyMMdd``."""
    last = F.max(utc_date("timestamp")).cast("string")
    return logs.agg(F.replace(last, F.lit("-"), F.lit("")).alias("snapshot_date"))


def _read_events(spark: SparkSession, input_dir: str, **days) -> DataFrame:
    trees = [read_days(spark, f"{input_dir}/{t}", STORED_VISITS, **days) for t in EVENT_TYPES]
    return union_logs(*trees)


def build_snapshot(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    update: bool = False,
    values: Sequence[str] | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> str:
    """Write the matrix of the stored events to ``{output_dir}/{last day}``; return that path.

    With ``update`` a snapshot is the newest one before that still holds, and the events of the days
    after it: a normal day reads one snapshot and one day. A ledger says of which files of which
    days each snapshot is made. A snapshot counts when its entry stands, and one whose days (within
    the range) have new or changed files since is made again, as is one that a lost run left
    without an entry. So repeated runs, late days, further loads of a day and runs lost at any
    step all give the matrix of the events as they are stored.
    """
    if update:
        return _update(spark, input_dir, output_dir.rstrip("/"), values, date_from, date_to)
    logs = _read_events(spark, input_dir, date_from=date_from, date_to=date_to)
    day = snapshot_date(logs).first()["snapshot_date"]
    if day is None:
        raise ValueError("no events in range")
    path = f"{output_dir.rstrip('/')}/{day}"
    write_table(user_item_matrix(logs, values), path)
    return path


def _day_marks(spark: SparkSession, input_dir: str) -> DataFrame:
    """``(day, mark)``: a digest of the names, sizes and times of each day's event files."""
    files = [
        file_manifest(spark, f"{input_dir}/{t}", "*.json", keep=("modificationTime",))
        for t in EVENT_TYPES
    ]
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return (
        union_logs(*files)
        .filter(F.startswith("label", F.lit("$date=")))
        .groupBy(F.substring_index("label", "=", -1).alias("day"))
        .agg(F.sum(one).cast("string").alias("mark"))
    )


def _counts(events: DataFrame) -> DataFrame:
    keyed = events.select("uid", item_key("event_type", "item_id").alias("item")).dropna()
    return keyed.groupBy("uid", "item").agg(F.count("*").alias("cnt"))


class _Snapshots:
    """Snapshots of one folder with their ledgers; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root
        self._files = Files(spark)
        names = self._files.children(f"{root}/{LEDGER}")
        self.entries = {n: self._ledger(n).newest()[1] for n in names}

    def _ledger(self, day: str) -> Ledger:
        return Ledger(self._spark, f"{self._root}/{LEDGER}/{day}")

    def days(self) -> set[str]:
        """Days that have a snapshot, or should."""
        stored = {d for d in self._files.children(self._root) if len(d) == 8 and d.isdigit()}
        return stored | {d for d, entry in self.entries.items() if entry}

    def made_of(self, day: str | None) -> dict[str, str]:
        """Mark of each day that a snapshot holds, by its ledger."""
        return self.entries.get(day, {}).get("days", {}) if day else {}

    def totals(self, day: str) -> DataFrame:
        path = f"{self._root}/{TOTALS}/{self.entries[day]['totals']}"
        return self._spark.read.schema("uid string, item string, cnt bigint").parquet(path)

    def write(
        self, day: str, counts: DataFrame, days: dict[str, str], values: Sequence[str] | None
    ) -> None:
        """Counts first, then the snapshot, then the entry that makes both count."""
        name = uuid.uuid4().hex
        counts.write.parquet(f"{self._root}/{TOTALS}/{name}")
        stored = self._spark.read.schema(counts.schema).parquet(f"{self._root}/{TOTALS}/{name}")
        staging = f"{self._root}/{STAGING}{name}"
        write_table(pivot_counts(stored, "item", values, weight="cnt"), staging)
        self._files.delete(f"{self._root}/{day}")
        self._files.move(staging, f"{self._root}/{day}")
        self.entries[day] = {"days": days, "totals": name}
        self._ledger(day).append(self.entries[day])

    def clean(self) -> None:
        """Drop what lost or earlier runs left and no entry names."""
        named = {entry.get("totals") for entry in self.entries.values()}
        for name in self._files.children(f"{self._root}/{TOTALS}"):
            if name not in named:
                self._files.delete(f"{self._root}/{TOTALS}/{name}")
        for name in self._files.children(self._root):
            if name.startswith(STAGING):
                self._files.delete(f"{self._root}/{name}")


def _update(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    values: Sequence[str] | None,
    date_from: str | None,
    date_to: str | None,
) -> str:
    marks = _day_marks(spark, input_dir)
    if date_from is not None:
        marks = marks.filter(F.col("day") >= date_from)
    if date_to is not None:
        marks = marks.filter(F.col("day") <= date_to)
    # One line per calendar day.
    seen = {r["day"]: r["mark"] for r in marks.collect()}
    snapshots = _Snapshots(spark, output_dir)
    newest = max((d for d, e in snapshots.entries.items() if e), default=None)
    outside = {
        d: m
        for d, m in snapshots.made_of(newest).items()
        if (date_from is not None and d < date_from) or (date_to is not None and d > date_to)
    }
    current = outside | seen
    if not current:
        raise ValueError("no events in range")

    def upto(day: str) -> dict[str, str]:
        return {d: m for d, m in current.items() if d <= day}

    last = max(current)
    holding = {d for d in snapshots.entries if snapshots.made_of(d) == upto(d)}
    for day in sorted((snapshots.days() | {last}) - holding):
        base = max((d for d in holding if d < day), default=None)
        new = [d for d in upto(day) if base is None or d > base]
        if not upto(day):
            continue  # a snapshot before all events: not ours to change
        events = _read_events(spark, input_dir, date_from=min(new, default=day), date_to=day)
        counts = _counts(events.filter(F.col("date").isin(new)))
        if base is not None:
            both = snapshots.totals(base).unionByName(counts)
            counts = both.groupBy("uid", "item").agg(F.sum("cnt").alias("cnt"))
        snapshots.write(day, counts, upto(day), values)
        holding.add(day)
    snapshots.clean()
    return f"{output_dir}/{last}"
