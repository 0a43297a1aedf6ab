"""Loads, snapshots and counts after runs that were lost at any step, and after replays."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from clickloom.plans import event_split, user_item_matrix
from clickloom.sources import kafka, loads, readers
from clickloom.sources.schemas import SHOP_VISITS, STORED_VISITS
from clickloom.storage import Files, Ledger
from clickloom.streaming import scoring

T0, DAY = 1_704_067_200_000, 86_400_000


class Lost(Exception):
    pass


class Steps:
    """Counts everything that changes files; the step of a given number fails before it is made."""

    def __init__(self, monkeypatch):
        self.made, self.fails_at = 0, None
        for kind, names in ((Files, ("delete", "move", "create")), (DataFrameWriter, ("parquet", "json"))):
            for name in names:
                monkeypatch.setattr(kind, name, self._counted(getattr(kind, name)))

    def _counted(self, own):
        def run(*args, **kwargs):
            self.made += 1
            if self.made == self.fails_at:
                raise Lost
            return own(*args, **kwargs)

        return run

    def lost_at(self, number, job) -> bool:
        """Whether the job was lost at that step of its own."""
        self.made, self.fails_at = 0, number
        try:
            job()
        except Lost:
            return True
        finally:
            self.fails_at = None
        return False


@pytest.fixture
def steps(monkeypatch):
    return Steps(monkeypatch)


def messages(rows, *events):
    """``(offset, user, event type, day)`` as messages of one partition."""
    data = [(u, e, "c", "x", T0 + d * DAY) for _, u, e, d in events]
    places = [("t", 0, o) for o, *_ in events]
    values = kafka.json_messages(rows(data, SHOP_VISITS)).collect()
    return rows(
        [(*p, v.value) for p, v in zip(places, values)],
        "topic string, partition int, offset long, value string",
    )


def stored(spark, path):
    found = []
    for tree in event_split.EVENT_TYPES:
        if os.path.exists(f"{path}/{tree}"):
            rows = readers.read_days(spark, f"{path}/{tree}", STORED_VISITS).collect()
            found += [(tree, r.uid, r.date) for r in rows]
    return sorted(found)


EVENTS = [(0, "a", "view", 0), (1, "b", "buy", 0), (2, "c", "view", 1), (3, "d", "other", 1)]
ALL = [("buy", "b", "20240101"), ("view", "a", "20240101"), ("view", "c", "20240102")]


def test_a_topic_read_again_gives_each_event_once(spark, rows, tmp_path):
    path = str(tmp_path)
    first = event_split.split_messages(messages(rows, *EVENTS[1:2]), path)
    assert first == {"t/0": [(1, 2)]}
    # From the earliest offset, with messages before and after those that are loaded.
    assert event_split.split_messages(messages(rows, *EVENTS), path) == {"t/0": [(0, 1), (2, 4)]}
    assert event_split.split_messages(messages(rows, *EVENTS), path) == {}
    assert stored(spark, path) == ALL
    assert loads.Loads(spark, path).next_offsets("t") == {0: 4}


def test_overlap_is_refused(spark, rows, tmp_path):
    own = loads.Loads(spark, str(tmp_path))
    write = lambda tree, folder: spark.range(1).write.json(folder)
    own.publish("one", ["view"], write, {"t/0": [(0, 5)]})
    own.publish("one", ["view"], write, {"t/0": [(0, 6)]})
    with pytest.raises(loads.OverlapError):
        own.publish("two", ["view"], write, {"t/0": [(5, 9)]})
    own.publish("two", ["view"], write, {"t/0": [(6, 9)], "t/1": [(0, 9)]})
    assert own.next_offsets("t") == {0: 9, 1: 9}


def test_a_named_load_moves_with_its_events(spark, rows, tmp_path):
    """An event that is on another day in the second version of a load leaves the first day."""
    for day in (0, 3):
        events = event_split.decode_events(messages(rows, (0, "a", "view", day)))
        event_split.split_events(events, str(tmp_path), load="x")
    assert stored(spark, str(tmp_path)) == [("view", "a", "20240104")]


def test_loads_lost_at_any_step(spark, rows, steps, tmp_path):
    number, lost = 0, True
    while lost:
        number += 1
        path = str(tmp_path / str(number))
        event_split.split_messages(messages(rows, *EVENTS[:2]), path)
        again = messages(rows, *EVENTS)
        lost = steps.lost_at(number, lambda: event_split.split_messages(again, path))
        event_split.split_messages(again, path)
        assert stored(spark, path) == ALL, number
        assert not [n for n in os.listdir(path) if n.startswith(loads.STAGING)]
    assert number > 8


def cells(spark, path):
    found = [r.asDict() for r in spark.read.parquet(path).collect()]
    return {r["uid"]: {k: v for k, v in r.items() if v and k != "uid"} for r in found}


def test_snapshots_lost_at_any_step(spark, rows, steps, tmp_path):
    source = str(tmp_path / "in")
    build = user_item_matrix.build_snapshot

    def load(*events):
        event_split.split_messages(messages(rows, *events), source)

    load((0, "a", "view", 0), (1, "b", "buy", 0), (2, "a", "view", 4))
    number, lost = 0, True
    while lost:
        number += 2 if number else 1
        target = str(tmp_path / f"out{number}")
        build(spark, source, target, update=True, date_to="20240101")
        lost = steps.lost_at(number, lambda: build(spark, source, target, update=True))
        path = build(spark, source, target, update=True)
        assert cells(spark, path) == {"a": {"view_x": 2}, "b": {"buy_x": 1}}, number
        assert cells(spark, f"{target}/20240101") == {"a": {"view_x": 1}, "b": {"buy_x": 1}}
    # A lost update after a late load, on the last target.
    load((3, "a", "view", 2))
    assert steps.lost_at(3, lambda: build(spark, source, target, update=True))
    assert cells(spark, build(spark, source, target, update=True))["a"] == {"view_x": 3}


def test_a_normal_day_reads_one_snapshot_and_one_day(spark, rows, monkeypatch, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    read = []
    own = user_item_matrix._read_events

    def noted(spark, input_dir, **days):
        read.append((days["date_from"], days["date_to"]))
        return own(spark, input_dir, **days)

    monkeypatch.setattr(user_item_matrix, "_read_events", noted)
    for day in range(3):
        event_split.split_messages(messages(rows, (day, "a", "view", day)), source)
        path = user_item_matrix.build_snapshot(spark, source, target, update=True)
    assert read == [(f"2024010{d}", f"2024010{d}") for d in (1, 2, 3)]
    assert cells(spark, path) == {"a": {"view_x": 3}}
    assert user_item_matrix.build_snapshot(spark, source, target, update=True) == path
    assert len(read) == 3
    # As many folders of counts as snapshots.
    assert len(os.listdir(f"{target}/{user_item_matrix.TOTALS}")) == 3


def changed(rows, *counts):
    return rows(list(counts), "uid string, domain string, cnt long")


def held(store):
    return {(r.uid, r.domain): r.cnt for r in store.read().collect()}


def test_replayed_batches_change_nothing(spark, rows, tmp_path):
    store = scoring.CountStore(spark, str(tmp_path), "run", buckets=4)
    for n in range(5):
        batch = changed(rows, ("a", "x", n + 1), (f"u{n}", "y", 1))
        touched = store.write(batch, n)
        before = held(store)
        assert store.write(batch, n) == touched and held(store) == before
        store.write(changed(rows, ("z", "late", 9)), n - 1)
        assert held(store) == before
    assert before == {("a", "x"): 5} | {(f"u{n}", "y"): 1 for n in range(5)}


def test_counts_lost_at_any_step(spark, rows, steps, tmp_path):
    batches = [[("a", "x", 1), ("b", "x", 1)], [("a", "x", 2)], [("a", "x", 3), ("b", None, 1)]]
    number, lost = 0, True
    while lost:
        number += 1
        store = scoring.CountStore(spark, str(tmp_path / str(number)), "run", buckets=3)
        for n, batch in enumerate(batches[:2]):
            store.write(changed(rows, *batch), n)
        lost = steps.lost_at(number, lambda: store.write(changed(rows, *batches[2]), 2))
        store.write(changed(rows, *batches[2]), 2)
        assert held(store) == {("a", "x"): 3, ("b", "x"): 1, ("b", None): 1}, number
    assert number > 3


def test_a_batch_reads_the_buckets_of_its_users(spark, rows, tmp_path):
    """Files read depend on the users of a batch, not on those of the store."""
    counts = []
    for users in (40, 400):
        store = scoring.CountStore(spark, str(tmp_path / str(users)), "run", buckets=16)
        store.write(changed(rows, *[(f"u{i}", "x", 1) for i in range(users)]), 0)
        touched = store.write(changed(rows, ("u1", "x", 2)), 1)
        assert len(touched) == 1
        counts.append(len(store.read(touched).inputFiles()))
        assert store.read().filter("cnt = 2").count() == 1 and store.read().count() == users
    assert counts == [1, 1]


def test_ledger_entries_appear_whole(spark, tmp_path, steps):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.newest() == (-1, {})
    for n in range(4):
        ledger.append({"n": n})
    assert steps.lost_at(2, lambda: ledger.append({"n": 9}))  # written, not yet under its name
    assert ledger.newest() == (3, {"n": 3})
    ledger.append({"n": 4})
    assert ledger.newest() == (4, {"n": 4})
