"""Language ID with word-first backoff.

A word of the training texts is scored by its log frequency in each language. Any other word falls
back to its character n-grams: the longest length of which some are known decides, shorter ones are
tried only when none is. The scores of all words of a text add up.

The vocabulary holds the words and n-grams with a least share of any language's counts, so its
size is bounded by ``1 / share`` entries a language however large the corpus; rarer words are what
the fall-back is for. Counts cover all training rows, and an entry has its count in every language.
Every language with a word in the training rows is a class.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when no row
can be trained on. Repeated rows are counted as often as they occur and predicted alike. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..storage import Workspace
from .common import add_fields, text_udf

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
# Longest n-gram; a word is padded by one blank at either end before it is cut.
LONGEST = 5
# Least share of a language's words, or of its n-grams of one length, that an entry must have.
WORD_SHARE = 1 / 50_000
GRAM_SHARE = 1 / 20_000
# Weight of a known n-gram set against a known word.
BACKOFF_WEIGHT = 0.5
COUNTER_ENTRIES = 200_000
# Characters of words whose n-grams are counted together.
SPELLED_AT_ONCE = 20_000
# Words of a text that are scored together.
WORDS_AT_ONCE = 100_000
# Scores of unseen words that a worker remembers, over all languages.
REMEMBERED = 800_000

FIELDS = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def text_words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, word, n)`` summed over a bounded number of entries at a time."""
    counts: dict[str, Counter] = defaultdict(Counter)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = counts[lang]
            held -= len(own)
            own.update(text_words(text))
            held += len(own)
            if held >= COUNTER_ENTRIES:
                yield _rows({(k,): v for k, v in counts.items()}, [("lang", pa.string())], "word")
                counts.clear()
                held = 0
    yield _rows({(k,): v for k, v in counts.items()}, [("lang", pa.string())], "word")


def _rows(counts: dict[tuple, Counter], heads: list[pa.Field], item: str) -> pa.RecordBatch:
    """Each counter's items with their counts, behind the values of its key."""
    columns = [
        pa.array([k[i] for k, own in counts.items() for _ in own], kind)
        for i, (_, kind) in enumerate(heads)
    ]
    columns.append(pa.array([x for own in counts.values() for x in own], pa.string()))
    columns.append(pa.array([n for own in counts.values() for n in own.values()], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, [*(name for name, _ in heads), item, "n"])


def _partial_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, size, gram, n)`` of counted words, summed in the same way."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    heads = [("lang", pa.string()), ("size", pa.int32())]
    once: dict[str, list[str]] = defaultdict(list)
    spelled = 0

    def count_once():
        for lang, words in once.items():
            for size in range(1, LONGEST + 1):
                counts[lang, size].update(joined_grams(words, size))
        once.clear()

    for batch in batches:
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if n == 1:  # most words
                once[lang].append(word)
            else:
                for size in range(1, LONGEST + 1):
                    own = counts[lang, size]
                    for gram in grams(word, size):
                        own[gram] = own.get(gram, 0) + n
            spelled += len(word)
            if spelled >= SPELLED_AT_ONCE:
                count_once()
                spelled = 0
                if sum(map(len, counts.values())) >= COUNTER_ENTRIES:
                    yield _rows(counts, heads, "gram")
                    counts.clear()
    count_once()
    yield _rows(counts, heads, "gram")


def joined_grams(words: list[str], size: int) -> list[str]:
    """N-grams of all words; one that reaches over two words holds both their blanks."""
    if size == 1:
        return list("".join(words))
    text = f" {'  '.join(words)} "
    found = [text[i : i + size] for i in range(len(text) - size + 1)]
    return [g for g in found if "  " not in g]


@dataclass(frozen=True)
class Model:
    """Log frequencies: a row of ``scores`` for each entry, a column for each language."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: list[dict[str, int]]
    scores: np.ndarray

    @cached_property
    def scorer(self) -> Scorer:
        """One scorer for all batches of a worker that holds the model."""
        return Scorer(self)


def _log_frequencies(rows, size_of, languages) -> tuple[dict[str, int], np.ndarray]:
    """Entries and their smoothed log frequencies; an entry a language lacks counts a half."""
    place: dict[str, int] = {}
    at = {lang: i for i, lang in enumerate(languages)}
    cells = [(place.setdefault(item, len(place)), at[lang], n) for lang, item, n in rows]
    counts = np.full((len(place), len(languages)), 0.5)
    for i, j, n in cells:
        counts[i, j] = n
    totals = np.array([size_of[lang] for lang in languages], float)
    return place, np.log(counts / (totals + 0.5 * max(1, len(place)))).astype("float32")


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count every training row that has a text and a language."""
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    with Workspace(df.sparkSession) as work:
        partial = rows.mapInArrow(_partial_counts, "lang string, word string, n long")
        counts = work.stage(
            partial.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words"
        )
        totals = work.stage(
            counts.groupBy("lang").agg(F.sum("n").alias("total")), "language-totals"
        )
        size_of = {r.lang: r.total for r in totals.collect()}
        languages = sorted(size_of)
        words = _frequent(counts, totals, "word", WORD_SHARE)
        spelled = counts.mapInArrow(
            _partial_grams, "lang string, size int, gram string, n long"
        )
        pieces = work.stage(
            spelled.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "language-grams"
        )
        word_rows = [tuple(r) for r in words.collect()]
        gram_rows = {}
        gram_sizes = {}
        for size in range(1, LONGEST + 1):
            own = pieces.filter(F.col("size") == size)
            sums = own.groupBy("lang").agg(F.sum("n").alias("total"))
            gram_sizes[size] = {r.lang: r.total for r in sums.collect()}
            gram_rows[size] = [tuple(r) for r in _frequent(own, sums, "gram", GRAM_SHARE).collect()]
    total = sum(size_of.values())
    prior = np.log([size_of[lang] / total for lang in languages]) if languages else np.zeros(0)
    words_at, parts = _log_frequencies(word_rows, size_of, languages)
    tables, places, offset = [parts], [], len(parts)
    for size in range(1, LONGEST + 1):
        sizes = {lang: gram_sizes[size].get(lang, 0) for lang in languages}
        place, scores = _log_frequencies(gram_rows[size], sizes, languages)
        places.append({g: i + offset for g, i in place.items()})
        tables.append(scores)
        offset += len(scores)
    return Model(languages, prior, words_at, places, np.concatenate(tables))


def _frequent(counts: DataFrame, totals: DataFrame, item: str, share: float) -> DataFrame:
    """Counts in all languages of the entries with at least ``share`` of any language's ``total``."""
    own = counts.join(totals, "lang")
    entries = own.filter(F.col("n") >= F.lit(share) * F.col("total")).select(item).distinct()
    return counts.join(entries, item, "left_semi").select("lang", item, "n")


class Scorer:
    """Scores texts by a model, and remembers the scores of unseen words."""

    def __init__(self, model: Model):
        self.model = model
        width = max(1, len(model.languages))
        self._room = max(1000, REMEMBERED // width)
        self._unseen = np.zeros((self._room, width))
        self._forget()

    def _forget(self) -> None:
        self._place = dict(self.model.words)
        self._used = 0

    def backed_off(self, word: str) -> list[int]:
        """Entries of the word's known n-grams of the longest length that has any."""
        for size in range(min(LONGEST, len(word) + 2), 0, -1):
            place = self.model.grams[size - 1].get
            if at := [p for g in grams(word, size) if (p := place(g)) is not None]:
                return at
        return []

    def _remember(self, words: set[str]) -> None:
        """Scores of unseen words, the weighted mean of their n-grams, after the model's rows."""
        scores = self.model.scores
        found = [(w, p) for w in words if (p := self.backed_off(w))]
        unknown = len(scores) + self._room
        self._place.update(dict.fromkeys(words, unknown))
        if not found:
            return
        sizes = np.array([len(p) for _, p in found])
        flat = scores[np.array([x for _, p in found for x in p])].astype(float)
        sums = np.add.reduceat(flat, np.cumsum(sizes) - sizes)
        end = self._used + len(found)
        self._unseen[self._used : end] = BACKOFF_WEIGHT * sums / sizes[:, None]
        self._place.update(zip((w for w, _ in found), range(len(scores) + self._used, len(scores) + end)))
        self._used = end

    def sums(self, found: list[str]) -> np.ndarray:
        """Summed word scores; an unseen word counts the weighted mean of its n-grams."""
        at = list(map(self._place.get, found))
        if None in at:
            if len(self._place) - len(self.model.words) + len(found) > self._room:
                self._forget()
            self._remember(set(found).difference(self._place))
            at = list(map(self._place.__getitem__, found))
        at = np.array(at)
        scores = self.model.scores
        rest = at[at >= len(scores)] - len(scores)
        total = scores[at[at < len(scores)]].sum(0, dtype=float)
        return total + self._unseen[rest[rest < self._room]].sum(0)

    def __call__(self, text: str) -> tuple[str, float]:
        found = text_words(text)
        languages = self.model.languages
        if not found or not languages:
            return UNDETERMINED, 0.0
        total = self.model.prior.copy()
        step = min(WORDS_AT_ONCE, self._room)
        for start in range(0, len(found), step):
            total += self.sums(found[start : start + step])
        shares = np.exp(total - total.max())
        best = int(shares.argmax())
        return languages[best], float(shares[best] / shares.sum())


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the posterior of the predicted language."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def per_text(texts):
        score = sent.value.scorer
        found = [score((t or b"").decode()) for t in texts]
        return [{"lang_pred": lang, "score": score} for lang, score in found]

    return add_fields(df, text_udf(FIELDS, per_text)(F.col(text)), FIELDS.names)


def known_language(lang: str = "lang") -> Column:
    """Whether a row names a language that a prediction could return."""
    return F.col(lang).isNotNull() & (F.col(lang) != UNDETERMINED)
