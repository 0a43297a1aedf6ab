"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Items and documents are sequences of words (lower-cased, without marks). For every item size, the
windows of that many words of a document are embedded by random walks (Chakraborty, Goldenberg,
Koucky): a walk repeats a symbol or moves on by a random bit of symbol and step, so that sequences
with few edits end up with few differing places. Each repetition has its own walk and samples a few
places of it; a window whose sampled symbols equal those of an item is a candidate. Every other repetition
walks windows from their last word to their first, so edits at either end leave one direction a long
equal stretch. The number of repetitions follows from the wanted recall. Candidates are verified by
the edit distance between the whole item and the best passage around the window.

Before the walks, windows are left out that hold fewer words, or runs of two to four words, of all
items, and then fewer runs of the items of their size, than the allowed edits permit; they cannot
match. The benchmark is a stated query set: it is sent in blocks of bounded
size, each of which meets all documents.

Null texts and texts without words match nothing, and neither do items without words. Items so
short that the allowed share of edits rounds to none must occur word by word. Repeated rows get the
same result and repeated items are found each; ties between passages go to the first one. An empty
benchmark or table gives no hits. An input column named like the output column is replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MARKS = b".,;:!?'\"()[]{}-"
# Bytes of item texts in one block.
BLOCK_BYTES = 8_000_000
# Words that are searched at once, and walks at once.
WORDS_AT_ONCE = 1 << 20
AT_ONCE = 1 << 18
# Longest runs of words that windows must share with items.
LONGEST_RUN = 4
# Item sizes within this ratio share a first test of their windows.
SIZE_STEP = 1.2

HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("distance", T.LongType()),
        ]
    )
)
_HITS = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("item_id", "start", "n_words", "distance")])
)


@dataclass(frozen=True)
class Settings:
    """``share`` of an item's words may be edited. ``agreeing`` is the share of embedding places
    that a passage with so many edits, spread or together, shares at least on average; ``samples``
    of them are compared."""

    share: float = 0.2
    recall: float = 0.999
    agreeing: float = 0.5
    samples: int = 3
    seed: int = 11

    @property
    def repetitions(self) -> int:
        miss = 1 - self.agreeing**self.samples
        return math.ceil(math.log(1 - self.recall) / math.log(miss))

    def edits(self, n_words: int) -> int:
        return int(self.share * n_words)


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(None, MARKS).split()


def best_passage(item: list[int], words: list[int]) -> tuple[int, int]:
    """Least edit distance of the item to any passage of ``words``, and the first end of such a
    passage; bit-parallel, a bit per item word (Myers)."""
    n = len(item)
    places: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        places[w] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(words):
        eq = places.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | (full & ~((eq | down) | rise))
        down = rise & (eq | down)
        if score < best:
            best, end = score, j + 1
    return best, end


def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words at each place."""
    n = max(0, len(words) - size + 1)
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        hashes = (hashes ^ words[k : n + k].astype(np.uint64)) * np.uint64(0x9E6C63D0676A9A99)
        hashes ^= hashes >> np.uint64(29)
    return hashes


class Walks:
    """All repetitions of one direction over windows of ``n`` words, and the items' buckets.

    A walk moves on every other step, so about twice the item's words cover the item. The walks of
    all windows in all repetitions take their steps together, as one array; each hash begins with
    a number of its repetition, so one sorted array holds what the items have.
    """

    def __init__(self, n: int, settings: Settings, backwards: bool):
        self.n = n
        bits, samples, begin = [], [], []
        for r in range(int(backwards), settings.repetitions, 2):
            rng = np.random.default_rng([settings.seed, n, r])
            steps = max(1, 2 * n)
            samples.append(np.sort(rng.integers(0, steps, settings.samples)))
            bits.append(rng.integers(1, 2**63, steps, dtype=np.uint64) * np.uint64(2))
            begin.append(rng.integers(1, 2**63, dtype=np.uint64))
        self.repetitions = len(bits)
        # By step and repetition: the random bits, and how many samples are taken there.
        self.odd = np.array(bits).reshape(self.repetitions, -1).T + np.uint64(1)
        taken = np.array(samples).reshape(self.repetitions, -1)
        self.last = taken.max(1, initial=0)
        self.taken = (taken[None] == np.arange(len(self.odd))[:, None, None]).sum(2)
        self.begin = np.array(begin, np.uint64)
        self.known: list[np.ndarray] = []
        self.buckets: dict[int, list[int]] = {}

    def learn(self, own: list[int], words: np.ndarray) -> None:
        """Store the buckets of the items ``own``, whose words follow each other in ``words``."""
        known: list[list[np.ndarray]] = []
        buckets = defaultdict(list)
        for start, h in zip(*self._walk(words, np.arange(len(own)) * self.n, known)):
            buckets[int(h)].append(own[int(start) // self.n])
        self.known = [np.unique(np.concatenate(found)) for found in known]
        self.buckets = dict(buckets)

    def meet(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Windows that fall in a bucket of items, with these items; a window for each bucket."""
        at_once = max(1, AT_ONCE // max(1, self.repetitions))
        for lo in range(0, len(starts), at_once):
            found, hashes = self._walk(words, starts[lo : lo + at_once])
            for start, h in zip(found.tolist(), hashes.tolist()):
                if h in self.buckets:
                    yield start, self.buckets[h]

    def _walk(self, words: np.ndarray, starts: np.ndarray, learned: list | None = None):
        """Starts and last hashes of the walks that end in a bucket, by repetition.

        The embedding of a window continues with 0 once the walk has left it. A walk ends where
        its hash is none that items have after so many samples; with ``learned``, none ends, and
        the hashes after each number of samples are added to it.
        """
        found, ends = [], []
        rep = np.repeat(np.arange(self.repetitions, dtype=np.int32), len(starts))
        at = np.tile(starts.astype(np.int32), self.repetitions)
        first, hashes = at, self.begin[rep]
        over = len(words) - 1
        for step in range(len(self.odd)):
            if not len(rep):
                break
            symbol = words[np.minimum(at, over)].astype(np.uint64)
            symbol[at - first >= self.n] = 0
            taken = self.taken[step]
            for again in range(taken.max(initial=0)):
                here = np.flatnonzero((taken > again)[rep])
                after = (hashes[here] ^ symbol[here]) * np.uint64(0x9E6C63D0676A9A99)
                after ^= after >> np.uint64(29)
                hashes[here] = after
                if not len(here):
                    continue
                count = self.taken[:step].sum(0) + again
                if learned is not None:
                    levels = count[rep[here]]
                    for level in np.unique(levels):
                        while len(learned) <= level:
                            learned.append([])
                        learned[level].append(after[levels == level])
                    continue
                stays = np.ones(len(rep), bool)
                levels = count[rep[here]]
                for level in np.unique(levels):
                    part = here if (levels == level).all() else here[levels == level]
                    there, own = self.known[level], hashes[part]
                    where = np.minimum(np.searchsorted(there, own), len(there) - 1)
                    stays[part] = there[where] == own
                rep, at, first = rep[stays], at[stays], first[stays]
                hashes, symbol = hashes[stays], symbol[stays]
            done = self.last[rep] == step
            if done.any():
                found.append(first[done])
                ends.append(hashes[done])
                going = ~done
                rep, at, first = rep[going], at[going], first[going]
                hashes, symbol = hashes[going], symbol[going]
            moved = (symbol + np.uint64(1)) * self.odd[step][rep] >> np.uint64(63)
            at = at + moved.astype(np.int32)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found]), np.concatenate([none.astype(np.uint64), *ends])


class Index:
    """LSH tables of a block of items."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings = settings
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        for item_id, text in items:
            number = self.vocabulary.setdefault
            words = [number(w, len(self.vocabulary) + 1) for w in plain_words(text)]
            if words:
                self.items.append((item_id, words))
        gap = np.zeros(1, np.int64)
        lined_up = np.concatenate([gap, *([*words, 0] for _, words in self.items)])
        self.runs = self._runs(lined_up)
        self.by_size: dict[int, list[int]] = defaultdict(list)
        for k, (_, words) in enumerate(self.items):
            self.by_size[len(words)].append(k)
        # Of each size of items and of runs: which of all runs those items have.
        self.runs_of = {
            n: [
                np.isin(runs, found)
                for runs, found in zip(
                    self.runs, self._runs(np.concatenate([[*self.items[k][1], 0] for k in own]))
                )
            ]
            for n, own in self.by_size.items()
        }
        self.size_classes: list[list[int]] = []
        for n in sorted(self.by_size):
            if self.size_classes and n <= SIZE_STEP * self.size_classes[-1][0]:
                self.size_classes[-1].append(n)
            else:
                self.size_classes.append([n])
        self.walks = [
            {n: self._tables(n, backwards) for n in self.by_size} for backwards in (False, True)
        ]

    @staticmethod
    def _runs(words: np.ndarray) -> list[np.ndarray]:
        return [np.unique(_run_hashes(words, size)) for size in range(2, LONGEST_RUN + 1)]

    def _tables(self, n: int, backwards: bool) -> Walks:
        """Walks over items of ``n`` words in one direction, and the buckets they fall in."""
        own = self.by_size[n]
        words = [self.items[k][1][:: -1 if backwards else 1] for k in own]
        walks = Walks(n, self.settings, backwards)
        walks.learn(own, np.concatenate([np.array(w, np.int64) for w in words]))
        return walks

    def _known(self, words: np.ndarray) -> tuple[list[np.ndarray], list[tuple]]:
        """Of each size of run: whether items have the run that begins at a place; from two words
        on also these places and the numbers of their runs."""
        found, places = [words > 0], []
        for size, runs in enumerate(self.runs, 2):
            flags = found[-1][:-1] & found[-1][1:]
            at = np.flatnonzero(flags)
            hashes = _run_hashes(words, size)[at]
            where = np.minimum(np.searchsorted(runs, hashes), len(runs) - 1)
            same = runs[where] == hashes
            flags[at] = same
            found.append(flags)
            places.append((at[same], where[same]))
        return found, places

    def _starts(self, seen: list[np.ndarray], sizes: list[int]):
        """``(n, starts)`` of the windows of each size with enough words and runs of items.

        ``seen`` has for each size of run the number of item runs before each place. An edit costs
        a window that begins with the passage at most one word of the item, and at most as many
        runs as a run has words.
        """
        edits = self.settings.edits
        total = len(seen[0]) - 1
        least = sizes[0]
        first = np.arange(total)
        ends = np.minimum(first + least, total)
        first = first[seen[0][ends] - seen[0][first] >= least - edits(sizes[-1])]
        for n in sizes:
            starts = first
            for size, before in enumerate(seen, 1):
                wanted = n - size + 1 - size * edits(n)
                if wanted > 0:
                    ends = np.minimum(starts + n - size + 1, len(before) - 1)
                    lo = np.minimum(starts, len(before) - 1)
                    starts = starts[before[ends] - before[lo] >= wanted]
            if len(starts):
                yield n, starts

    def _of_one_size(
        self, places: list[tuple[np.ndarray, np.ndarray]], n: int, starts: np.ndarray
    ) -> np.ndarray:
        """The ``starts`` whose windows also hold enough runs of the items of ``n`` words."""
        for size in range(LONGEST_RUN, 1, -1):
            wanted = n - size + 1 - size * self.settings.edits(n)
            if wanted > 0 and len(starts):
                at, runs = places[size - 2]
                own = at[self.runs_of[n][size - 2][runs]]
                held = np.searchsorted(own, starts + n - size + 1) - np.searchsorted(own, starts)
                starts = starts[held >= wanted]
        return starts

    def candidates(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Windows that share a bucket with an item, by item: the word at which the walk began, and
        the first word."""
        found = defaultdict(list)
        # Windows may begin before the first word and end after the last one.
        pad = max(self.by_size, default=0)
        words = np.pad(words, pad)
        total = len(words)
        known, places = self._known(words)
        seen = [np.concatenate([[0], np.cumsum(flags)]) for flags in known]
        for sizes in self.size_classes:
            for n, starts in self._starts(seen, sizes):
                starts = self._of_one_size(places, n, starts[starts <= total - n])
                for backwards in (False, True):
                    walks = self.walks[backwards][n]
                    # A walk back begins at the last word, as the same windows serve both.
                    own = total - n - starts[::-1] if backwards else starts
                    line = words[::-1] if backwards else words
                    for start, items in walks.meet(line, own):
                        last = total - 1 - start - pad
                        window = (
                            (last, last - n + 1) if backwards else (start - pad, start - pad)
                        )
                        for k in items:
                            found[k].append(window)
        return found

    def hits(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text the items that occur in it up to the allowed edits, with the best passage.

        Texts are searched together, some words at a time, with a gap around each.
        """
        out: list[list[dict]] = [[] for _ in texts]
        bounds, joined = [], [0]
        for d, text in enumerate(texts):
            words = plain_words(text)
            bounds.append((len(joined), len(joined) + len(words), d))
            joined += map(self.vocabulary.get, words, repeat(0))
            joined.append(0)
            if len(joined) >= WORDS_AT_ONCE or d == len(texts) - 1:
                self._search(np.array(joined, np.int64), bounds, out)
                bounds, joined = [], [0]
        return out

    def _search(self, words: np.ndarray, bounds: list[tuple], out: list[list[dict]]) -> None:
        ends = [hi for _, hi, _ in bounds]
        for k, windows in self.candidates(words).items():
            item_id, item = self.items[k]
            n, allowed = len(item), self.settings.edits(len(item))
            of_text = defaultdict(set)
            for place, start in set(windows):
                of_text[min(bisect_left(ends, place), len(ends) - 1)].add(start)
            for t, own in of_text.items():
                lo, hi, d = bounds[t]
                best = None
                for a, b in _regions(sorted(own), n, allowed, lo, hi):
                    distance, end = best_passage(item, words[a:b].tolist())
                    if distance <= allowed and (best is None or distance < best[0]):
                        best = (distance, max(0, a - lo + end - n))
                if best:
                    out[d].append(
                        {"item_id": item_id, "start": best[1], "n_words": n, "distance": best[0]}
                    )
        for _, _, d in bounds:
            out[d].sort(key=lambda h: (h["item_id"], h["start"]))


def _regions(
    starts: list[int], n: int, allowed: int, least: int, most: int
) -> list[tuple[int, int]]:
    """Stretches around windows, as wide as the allowed edits reach; touching ones are joined."""
    slack = 2 * allowed
    regions: list[list[int]] = []
    for s in starts:
        lo, hi = max(least, s - slack), min(most, s + n + slack)
        if regions and lo <= regions[-1][1]:
            regions[-1][1] = hi
        else:
            regions.append([lo, hi])
    return [(lo, hi) for lo, hi in regions]


def _blocks(
    benchmark: DataFrame, item_id: str, text: str
) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size; one item alone may be larger."""
    items = benchmark.select(
        F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")
    ).dropna()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r.item_id, r.text) for r in items.filter(part == k).collect()]


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    hits: str = "hits",
) -> DataFrame:
    """Add ``hits``, an array of ``(item_id, start, n_words, distance)``, empty for clean texts.

    ``start`` is the number of words before the passage, taken to be as long as the item.
    """
    found = []
    for block in _blocks(benchmark, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast((block, settings))
        found.append(_hits_of(sent)(F.col(text)))
    return docs.withColumn(hits, F.concat(*found))


def _hits_of(sent):
    @F.arrow_udf(HITS)
    def run(texts: pa.Array) -> pa.Array:
        # Kept with the block, which a worker holds for all its tasks.
        if not hasattr(sent, "index"):
            sent.index = Index(*sent.value)
        return pa.array(sent.index.hits(texts.to_pylist()), _HITS)

    return run
