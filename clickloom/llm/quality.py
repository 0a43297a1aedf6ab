"""Quality rules: distance between a document's histograms and those of its language.

Two histograms describe a document: how often each character class occurs, and how often the
common words of a language occur. The references are the same histograms of each language over all
documents. A document is rejected when even the nearest language is farther away, by
Jensen-Shannon distance, than a threshold. Histograms of short texts are noise, so a minimum length
guards either test.

Null texts count as empty; they have no words and fail the base rule. Rows without a language are
judged like all others but add to no reference. Rows of a language with too few words for a
reference are judged by the base rule only. Without any reference (an empty table, no
language) the distances are null and only the base rule decides. Equal rows are judged alike; input
columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import Workspace
from .common import add_fields, byte_texts, text_udf, words

SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?'\"()-"

# Least share of a language's words that makes a word common: at most 1 / share words each.
COMMON_SHARE = 0.002
# A language is a reference from so many words on, whatever the size of the table.
LANGUAGE_WORDS = 5_000
# Entries a worker counts before it hands its partial counts on.
COUNTER_ENTRIES = 200_000


@dataclass(frozen=True)
class Rules:
    """Thresholds of the verdict; distances lie between 0 and 1.

    The distance of n words from their own reference shrinks as one over the root of n, so a limit
    is ``base + noise / sqrt(n)``. Texts below ``guard_words`` are not held against any reference.
    """

    least_words: int = 50
    most_repeated: float = 0.5
    guard_words: int = 50
    class_base: float = 0.17
    class_noise: float = 0.7
    common_base: float = 0.25
    common_noise: float = 1.6

    def too_far(self, n_words: int, by_class: float | None, by_common: float | None) -> bool:
        if n_words < max(1, self.guard_words) or by_class is None or by_common is None:
            return False
        noise = 1 / math.sqrt(n_words)
        return (
            by_class > self.class_base + self.class_noise * noise
            or by_common > self.common_base + self.common_noise * noise
        )


FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("class_distance", T.DoubleType()),
        T.StructField("common_distance", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def _class_table() -> bytes:
    """Class of each byte; the first byte of a longer character stands for the whole."""
    table = bytearray(256)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            kind = 1
        elif c.islower():
            kind = 2
        elif c.isupper():
            kind = 3
        elif c.isdigit():
            kind = 4
        elif c in "\n\r":
            kind = 5
        elif c.isspace():
            kind = 6
        elif b in MARKS:
            kind = 7
        elif c.isprintable():
            kind = 8
        else:
            kind = 9
        table[b] = kind
    return bytes(table)


CLASS_OF = _class_table()
CLASSES = range(1, 10)
# Bytes inside a longer character.
INNER_BYTES = bytes(range(0x80, 0xC0))


def class_counts(text: bytes) -> list[int]:
    kinds = text.translate(CLASS_OF, INNER_BYTES)
    return [kinds.count(k) for k in CLASSES]


def plain_words(found: list[bytes]) -> list[bytes]:
    """Words without marks at their ends, A-Z lower-cased."""
    return [w.strip(MARKS) for w in found]


def repeated_words(found: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(found) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    often = counts[which] > 1
    inside = np.zeros(len(found), bool)
    for shift in range(3):
        inside[shift : len(often) + shift] |= often
    return int(inside.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, kind, item, n)`` summed over a bounded number of entries at a time.

    Kind ``t`` is the number of words, ``c`` a character class, ``w`` a word.
    """
    counts: Counter = Counter()

    def flush():
        keys = list(counts)
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array([k[2] for k in keys], pa.binary()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            ["lang", "kind", "item", "n"],
        )
        counts.clear()
        return rows

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
            found = plain_words(words(text.lower()))
            counts[lang, "t", b""] += len(found)
            for kind, n in zip(CLASSES, class_counts(text)):
                if n:
                    counts[lang, "c", b"%d" % kind] += n
            for word, n in Counter(found).items():
                counts[lang, "w", word] += n
            if len(counts) >= COUNTER_ENTRIES:
                yield flush()
    yield flush()


def reference_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, kind, item, n)`` over all rows that have a text and a language."""
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    partial = rows.dropna().mapInArrow(
        _partial_counts, "lang string, kind string, item binary, n long"
    )
    return partial.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language, each summing to 1; the last common-word bin is all others."""

    lang: str
    classes: tuple[float, ...]
    common: dict[bytes, float]


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> list[Reference]:
    """Reference histograms of every language with enough words."""
    with Workspace(df.sparkSession) as work:
        counts = work.stage(reference_counts(df, text, lang), "quality-counts")
        totals = counts.filter("kind = 't'").select("lang", F.col("n").alias("total"))
        large = totals.filter(F.col("total") >= LANGUAGE_WORDS)
        wanted = (F.col("kind") == "c") | (F.col("n") >= COMMON_SHARE * F.col("total"))
        rows = (
            counts.filter("kind != 't' and item != X''")
            .join(large, "lang")
            .filter(wanted)
            .collect()
        )
    found = []
    for name in sorted({r.lang for r in rows}):
        own = [r for r in rows if r.lang == name]
        classes = {int(r.item): r.n for r in own if r.kind == "c"}
        common = {bytes(r.item): r.n / r.total for r in own if r.kind == "w"}
        total = sum(classes.values())
        found.append(Reference(name, tuple(classes.get(k, 0) / total for k in CLASSES), common))
    return found


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms that sum to 1."""
    middle = (p + q) / 2

    def divergence(a):
        at = a > 0
        return float((a[at] * np.log2(a[at] / middle[at])).sum())

    return math.sqrt(max(0.0, (divergence(p) + divergence(q)) / 2))


class Judge:
    """Applies the rules; one per worker and call."""

    def __init__(self, references: list[Reference], rules: Rules):
        self.rules = rules
        self.references = []
        for r in references:
            place = {w: i for i, w in enumerate(r.common)}
            common = np.array([*r.common.values(), max(0.0, 1 - sum(r.common.values()))])
            self.references.append((np.array(r.classes), place, common))

    def nearest_classes(self, text: bytes) -> float | None:
        counts = np.array(class_counts(text), float)
        if not self.references or not counts.sum():
            return None
        own = counts / counts.sum()
        return min(js_distance(own, classes) for classes, _, _ in self.references)

    def nearest_common(self, found: list[bytes]) -> float | None:
        if not self.references or not found:
            return None
        counts = Counter(plain_words(found))
        best = []
        for _, place, common in self.references:
            own = np.zeros(len(common))
            for word, at in place.items():
                own[at] = counts.get(word, 0)
            own[-1] = len(found) - own[:-1].sum()
            best.append(js_distance(own / len(found), common))
        return min(best)

    def __call__(self, text: bytes | None) -> dict:
        text, rules = text or b"", self.rules
        found = words(text)
        n = len(found)
        repeated = repeated_words(found)
        base_failed = n < rules.least_words or repeated > rules.most_repeated * n
        by_class = self.nearest_classes(text)
        by_common = self.nearest_common(words(text.lower()))
        return {
            "n_words": n,
            "word_chars": len(b"".join(found).translate(None, INNER_BYTES)),
            "n_symbols": sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))),
            "n_dup_lines": duplicate_lines(text),
            "n_repeat_words": repeated,
            "base_failed": base_failed,
            "class_distance": by_class,
            "common_distance": by_common,
            "kept": not base_failed and not rules.too_far(n, by_class, by_common),
        }


def apply(
    df: DataFrame,
    references: list[Reference],
    rules: Rules = Rules(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Add counts, distances and verdicts to every row."""
    sent = df.sparkSession.sparkContext.broadcast((references, rules))

    def per_text(texts):
        judge = Judge(*sent.value)
        return [judge(t) for t in texts]

    value = text_udf(FIELDS, per_text)(F.col(text))
    if lang not in df.columns:
        return add_fields(df, value, FIELDS.names)
    own = F.col(lang).cast("string")
    without = own.isNotNull() & ~own.isin([r.lang for r in references])
    found = add_fields(df.withColumn("__without_reference", without), value, FIELDS.names)
    by_base = F.when(F.col("__without_reference"), ~F.col("base_failed")).otherwise(F.col("kept"))
    return found.withColumn("kept", by_base).drop("__without_reference")
