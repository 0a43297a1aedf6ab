"""Line dedup by pairwise alignment.

A line that few documents hold links each of its documents with the first one that holds it (the
least id). So does every run of lines, from each line to the one at which the run reaches
`RUN_WORDS` words or `RUN_CHARS` characters, however many documents hold it; a long line is a run of
its own. A shared passage of that size is thus found whatever its lines' length and number of
copies, and at every size of the table. Linked pairs are aligned by patience diff on line hashes: equal heads
and tails match, then lines that occur once on either side anchor the rest in their longest common
order, and the gaps between anchors are aligned alike. What is left over is aligned again, so moved
blocks are found too. Aligned lines are deleted from the later document.

A pair always holds the first document of a line or run, so a line in a third of all documents gives one
pair a document and not all pairs. Only line hashes meet in a pair. Joins
on what grows with the documents are hash-partitioned at every size, never broadcast.

Lines are parts between ``\\n``, compared without blanks at their ends; lines without a word never
match, stay, and part no run. Null texts stay null, empty ones empty. Rows without an id are left as they are.
Repeated rows count as one document and get the same result; rows that share an id but not a text
are different documents, ordered by a hash of the text. An empty table gives an empty result. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..storage import Workspace
from .common import add_fields

# A line is rare up to this number of documents.
RARE_HOLDERS = 10
# A run ends with the line at which it has so many words, or so many characters.
RUN_WORDS = 20
RUN_CHARS = 100
# Multiplier of the hash of a run, odd, and its inverse modulo 2^64.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
# ASCII blanks around and between words.
BLANKS = "[\\x20\\x09-\\x0D]"

_KEY = ["__id", "__text"]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.withColumns({"__id": F.col(doc_id).cast("long"), "__text": F.xxhash64(text)})


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(line: Column) -> Column:
    return F.regexp_replace(line, f"^{BLANKS}+|{BLANKS}+$", "")


def _line_key(line: Column) -> Column:
    """Hash of a line without the blanks around it; null without a word."""
    plain = _plain(line)
    return F.when(plain != "", F.xxhash64(plain))


def _anchors(later: list, earlier: list) -> list[tuple[int, int]]:
    """Lines that occur once on either side, in their longest common order."""
    once_l = {v for v, n in Counter(later).items() if n == 1}
    once_e = {v for v, n in Counter(earlier).items() if n == 1}
    at = {v: j for j, v in enumerate(earlier) if v in once_e}
    pairs = [(i, at[v]) for i, v in enumerate(later) if v in once_l and v in at]
    ends: list[int] = []
    tops: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(ends, j)
        if pile:
            before[k] = tops[pile - 1]
        ends[pile : pile + 1] = [j]
        tops[pile : pile + 1] = [k]
    chain = []
    k = tops[-1] if tops else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def patience(later: list, earlier: list) -> list[tuple[int, int]]:
    """Aligned positions of two lists, rising on both sides."""
    found = []
    todo = [(0, len(later), 0, len(earlier))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and later[a] == earlier[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1] == earlier[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        i, j = a, c
        for x, y in _anchors(later[a:b], earlier[c:d]):
            todo.append((i, a + x, j, c + y))
            found.append((a + x, c + y))
            i, j = a + x + 1, c + y + 1
        if (i, j) != (a, c):
            todo.append((i, b, j, d))
    return sorted(found)


def common_lines(later: list, earlier: list) -> list[int]:
    """Positions in ``later`` of lines aligned with ``earlier``, moved blocks included."""
    shared = set(earlier) - {None}
    left = [(i, v) for i, v in enumerate(later) if v in shared]
    own = set(later)
    there = [v for v in earlier if v is not None and v in own]
    found = []
    while left and there:
        aligned = {i for i, _ in patience([v for _, v in left], there)}
        if not aligned:
            break
        found += [left[i][0] for i in aligned]
        left = [x for i, x in enumerate(left) if i not in aligned]
    return sorted(found)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _aligned(later: pa.Array, earlier: pa.Array) -> pa.Array:
    pairs = zip(later.to_pylist(), earlier.to_pylist())
    return pa.array([common_lines(x, y) for x, y in pairs], pa.list_(pa.int32()))


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _mask(positions: pa.Array, sizes: pa.Array) -> pa.Array:
    """One flag per line, set where it is deleted."""
    masks = []
    for deleted, n in zip(positions.to_pylist(), sizes.to_pylist()):
        mask = np.zeros(n, bool)
        mask[deleted] = True
        masks.append(mask)
    return pa.array(masks, pa.list_(pa.bool_()))


def _run_ends(sizes: np.ndarray, least: int) -> np.ndarray:
    """For each line the end of the shortest run from it that adds up to ``least``."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    return np.searchsorted(before, before[:-1] + least)


def run_keys(keys: np.ndarray, words: np.ndarray, chars: np.ndarray, stops: np.ndarray):
    """Hash of the run that starts at each line, and whether it ends before its text does.

    Lines of several texts lie one after another; ``stops`` has the end of each line's text. Each
    line has a word, so a run has at most `RUN_WORDS` lines.
    """
    ends = np.minimum(_run_ends(words, RUN_WORDS), _run_ends(chars, RUN_CHARS))
    whole = ends <= stops
    n = len(keys)
    with np.errstate(over="ignore"):
        steps = np.multiply.accumulate(np.full(n + 1, STEP, "uint64"))
        backs = np.multiply.accumulate(np.full(n + 1, BACK, "uint64"))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(keys * steps[:n], dtype="uint64")])
        own = (sums[np.minimum(ends, n)] - sums[:n]) * backs[:n]
        own ^= own >> np.uint64(29)
        own *= np.uint64(STEP)
    return own, whole


_UNIT = T.StructType([T.StructField("key", T.LongType()), T.StructField("run", T.BooleanType())])


@F.arrow_udf(T.ArrayType(_UNIT))
def _units(lines: pa.Array) -> pa.Array:
    """What may link a text: its runs, and its lines that are too short for a run of one."""
    stored = lines.flatten()
    sizes = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype("int64")
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    there = stored.field("key").is_valid().to_numpy(zero_copy_only=False)
    text_of = text_of[there]
    keys = stored.field("key").filter(pa.array(there)).to_numpy().view("uint64")
    words, chars = (
        stored.field(f).filter(pa.array(there)).to_numpy().astype("int64") for f in ("words", "chars")
    )
    stops = np.cumsum(np.bincount(text_of, minlength=len(sizes)))[text_of]
    runs, whole = run_keys(keys, words, chars, stops)
    short = (words < RUN_WORDS) & (chars < RUN_CHARS)
    held = np.concatenate([text_of[whole], text_of[short]])
    order = np.argsort(held, kind="stable")
    key = np.concatenate([runs[whole], keys[short]])[order].view("int64")
    is_run = np.arange(len(held))[order] < whole.sum()
    starts = np.concatenate([[0], np.cumsum(np.bincount(held, minlength=len(sizes)))])
    found = pa.StructArray.from_arrays([pa.array(key), pa.array(is_run)], ["key", "run"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), found)


def _first_holders(keys: DataFrame) -> DataFrame:
    """Distinct ``(document, first document)`` of linking lines and runs."""
    holder = F.struct(*_KEY)
    entries = keys.select(*_KEY, F.explode(_units("lines")).alias("unit"))
    held = entries.select(*_KEY, "unit.key", "unit.run").distinct()
    first = (
        held.groupBy("key", "run")
        .agg(F.count("*").alias("n"), F.min(holder).alias("first"))
        .filter((F.col("n") > 1) & (F.col("run") | (F.col("n") <= RARE_HOLDERS)))
        .select(
            "key", "run", F.col("first.__id").alias("first_id"), F.col("first.__text").alias("first_text")
        )
    )
    later = (F.col("__id") > F.col("first_id")) | (F.col("__text") != F.col("first_text"))
    return (
        held.join(first.hint("merge"), ["key", "run"])
        .filter(later)
        .select(*_KEY, "first_id", "first_text")
        .distinct()
    )


def line_masks(docs: DataFrame, work: Workspace, doc_id: str, text: str) -> DataFrame:
    """``(__id, __text, __mask)`` of the documents that lose lines, staged in ``work``."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = _keyed(plain, "doc_id", "text").filter("__id IS NOT NULL AND text IS NOT NULL")
    described = rows.select(
        *_KEY,
        F.transform(
            _lines(F.col("text")),
            lambda x: F.struct(
                _line_key(x).alias("key"),
                F.size(F.split(_plain(x), f"{BLANKS}+")).alias("words"),
                F.length(_plain(x)).alias("chars"),
            ),
        ).alias("lines"),
    )
    keys = work.stage(described.dropDuplicates(_KEY), "line-keys")
    pairs = work.stage(_first_holders(keys), "line-pairs")
    hashes = keys.select(*_KEY, F.col("lines.key").alias("later"))
    first = keys.select(
        F.col("__id").alias("first_id"),
        F.col("__text").alias("first_text"),
        F.col("lines.key").alias("earlier"),
    )
    aligned = (
        pairs.join(first.hint("merge"), ["first_id", "first_text"])
        .join(hashes.hint("merge"), _KEY)
        .select(
            *_KEY,
            F.size("later").alias("n_lines"),
            F.explode(_aligned("later", "earlier")).alias("position"),
        )
    )
    deleted = aligned.groupBy(*_KEY).agg(
        F.collect_set("position").alias("positions"), F.max("n_lines").alias("n_lines")
    )
    return work.stage(
        deleted.select(*_KEY, _mask("positions", "n_lines").alias("__mask")), "line-masks"
    )


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the kept lines as its text, ``n_lines`` and ``n_deleted``."""
    with Workspace(docs.sparkSession) as work:
        masks = line_masks(docs, work, doc_id, text)
        work.keep(masks)
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda _, i: ~F.get(F.col("__mask"), i))
    found = F.struct(
        F.when(F.col("__mask").isNull(), F.col(text))
        .otherwise(F.array_join(kept, "\n"))
        .alias(text),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("__mask", lambda x: x)), F.lit(0))
        .cast("long")
        .alias("n_deleted"),
    )
    joined = _keyed(docs, doc_id, text).join(masks.hint("merge"), _KEY, "left")
    return add_fields(joined, found, [text, "n_lines", "n_deleted"]).drop(*_KEY, "__mask")
