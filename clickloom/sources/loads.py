"""Loads of dated trees: what they cover, and their replacement as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import Files, Ledger

# Offsets of each partition of a topic, ``{"topic/partition": [(first, after the last), ...]}``.
Ranges = dict[str, list[tuple[int, int]]]

LEDGER = "_loads"
STAGING = "_staging-"


class OverlapError(ValueError):
    """A load would bring messages that another load has brought."""


def offset_ranges(messages: DataFrame) -> Ranges:
    """Offsets that messages with ``topic``, ``partition`` and ``offset`` cover; one row each."""
    rows = messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last")
    )
    return {
        f"{r['topic']}/{r['partition']}": [(r["first"], r["last"] + 1)] for r in rows.collect()
    }


def within(ranges: Ranges) -> F.Column:
    """Whether a message lies in one of the ranges."""
    found = F.lit(False)
    for name, parts in ranges.items():
        topic, partition = name.rsplit("/", 1)
        place = (F.col("topic") == topic) & (F.col("partition") == int(partition))
        for first, after in parts:
            found |= place & (F.col("offset") >= first) & (F.col("offset") < after)
    return found


def _without(part: tuple[int, int], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a range without others."""
    left, at = [], part[0]
    for first, after in sorted(taken):
        if first > at:
            left.append((at, min(first, part[1])))
        at = max(at, after)
        if at >= part[1]:
            break
    if at < part[1]:
        left.append((at, part[1]))
    return [(a, b) for a, b in left if a < b]


class Loads:
    """Loads below a root, each in ``{tree}/$load=load_{name}`` of one or more trees.

    A load is written to a hidden folder first. The ledger entry that names it is the point where
    it counts: it holds the moves that put the load in the place of its predecessor. A run that is
    lost before leaves a folder nobody reads; after it, the next run makes the moves that are
    still due. Other loads are never touched. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._root = root.rstrip("/")
        self._files = Files(spark)
        self._ledger = Ledger(spark, f"{self._root}/{LEDGER}")

    def _known(self) -> dict[str, Ranges]:
        return self._ledger.newest()[1].get("loads", {})

    def _taken(self, name: str, but: str | None = None) -> list[tuple[int, int]]:
        loads = self._known().items()
        return [tuple(part) for load, r in loads if load != but for part in r.get(name, [])]

    def missing(self, ranges: Ranges) -> Ranges:
        """Parts of the ranges that no load covers."""
        left = {
            name: [rest for part in parts for rest in _without(part, self._taken(name))]
            for name, parts in ranges.items()
        }
        return {n: parts for n, parts in left.items() if parts}

    def next_offsets(self, topic: str) -> dict[int, int]:
        """For each partition of a topic, the offset after the last one loaded."""
        found: dict[int, int] = {}
        for ranges in self._known().values():
            for name, parts in ranges.items():
                own, partition = name.rsplit("/", 1)
                if own == topic:
                    ends = [after for _, after in parts]
                    found[int(partition)] = max(ends + [found.get(int(partition), 0)])
        return found

    def finish(self) -> None:
        """Make the moves of the newest load that are still due, and drop what no load names."""
        for source, target in self._ledger.newest()[1].get("moves", []):
            if self._files.exists(f"{self._root}/{source}"):
                self._files.delete(f"{self._root}/{target}")
                self._files.move(f"{self._root}/{source}", f"{self._root}/{target}")
        for name in self._files.children(self._root):
            if name.startswith(STAGING):
                self._files.delete(f"{self._root}/{name}")

    def publish(
        self,
        name: str,
        trees: Sequence[str],
        write: Callable[[str, str], None],
        ranges: Ranges | None = None,
    ) -> None:
        """Write a load with ``write(tree, folder)`` and put it in the place of its predecessor.

        A load with ranges must not overlap another one; its own name may come again with any.
        """
        self.finish()
        for place, parts in (ranges or {}).items():
            taken = self._taken(place, but=name)
            if any(_without(part, taken) != [part] for part in parts):
                raise OverlapError(f"load {name} brings offsets of {place} that are loaded already")
        staging = f"{STAGING}{uuid.uuid4().hex}"
        moves = [(f"{staging}/{tree}", f"{tree}/$load=load_{name}") for tree in trees]
        for tree, (source, _) in zip(trees, moves):
            write(tree, f"{self._root}/{source}")
        loads = self._known() | {name: ranges or {}}
        self._ledger.append({"loads": loads, "moves": moves})
        self.finish()
