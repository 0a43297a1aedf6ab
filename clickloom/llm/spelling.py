"""Spelling variants: words one edit apart, found with an index of variable-length grams.

A dictionary holds all grams of `SHORTEST` code points; a gram's extensions are kept only where it
is frequent, up to `LONGEST`. A word is decomposed from the left into the longest grams of the
dictionary, those inside an earlier one left out. For each place of a word a bound says which grams
an edit there can affect: those that hold the place, those on the left that could grow over it and
swallow others, and those on the right that could be swallowed from it. A near word has all the
others, with the same text before the last one on the left and after the first one on the right.

So a list is kept for each two grams of a word that an edit may lie between, by that outer text and
the word's length, and a word is merged with the lists of the two grams next to the affected ones,
for each place. The list of a frequent gram is never read as a whole. Where an edit could affect
all grams of a word, near words find it from their side; words like that among each other meet
through grams of `SHORTEST`, of which an edit affects two. Every merged pair is verified by its edit
distance, so the dictionary decides the time only and never the result.

Null texts have no words; bytes that are no UTF-8 count as U+FFFD, which ends a word. A null id
counts as the empty text. Repeated rows count as often as they occur. Among near words of equal
count the least in code-point order is the form. Other columns of the input do not matter. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import Workspace

# Code points of the shortest and longest grams.
SHORTEST = 2
LONGEST = 3
# A gram that occurs for more than this share of the words is extended.
FREQUENT = 0.02
# Most extended grams in the dictionary, those of the most frequent grams; workers hold it.
DICTIONARY = 200_000
# Distinct words a worker counts before it hands them on.
COUNTED = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# Words


def document_words(doc_id, raw: bytes | None, one_in: int) -> Counter:
    """Count of each word of one text, the words that the planted deletions leave included.

    Only A-Z are lower-cased. A run whose crc32 with the id is divisible by ``one_in`` loses the
    code point at that number modulo its length.
    """
    # On UTF-8 bytes ``lower`` changes A-Z only.
    runs = Counter(_RUN.findall((raw or b"").lower().decode(errors="replace")))
    if not one_in:
        return runs
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def word_counts(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    one_in: int = 0,
    least_length: int = 5,
    least_n: int = 3,
) -> DataFrame:
    """``(word, n)`` of all words long and frequent enough, over all whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()

        def rows():
            words = pa.array(counts.keys(), pa.string())
            return pa.RecordBatch.from_arrays(
                [words, pa.array(counts.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            raw = batch.column(1).cast(pa.binary())
            for doc_id, one in zip(batch.column(0), raw):
                counts.update(document_words(doc_id.as_py(), one.as_py(), one_in))
                if len(counts) >= COUNTED:
                    yield rows()
                    counts.clear()
        yield rows()

    partial = df.select(id_column, text).mapInArrow(run, "word string, n long")
    long_enough = partial.filter(F.length("word") >= least_length)
    counts = long_enough.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_n)


# Grams


def gram_counts(words: DataFrame) -> DataFrame:
    """``(gram, n)``: occurrences of every gram of `SHORTEST` to `LONGEST` in the word list."""
    grams = [
        F.when(
            F.length("word") >= q,
            F.transform(
                F.sequence(F.lit(1), F.length("word") - (q - 1)),
                lambda at, q=q: F.substring(F.col("word"), at, F.lit(q)),
            ),
        ).otherwise(F.array())
        for q in range(SHORTEST, LONGEST + 1)
    ]
    listed = words.select(F.explode(F.flatten(F.array(*grams))).alias("gram"))
    return listed.groupBy("gram").agg(F.count("*").alias("n"))


def pruned_grams(counts: DataFrame, n_words: int) -> DataFrame:
    """``gram`` of the dictionary: all shortest grams, and extensions of frequent ones."""
    size = F.length("gram")
    frequent = F.col("n") > FREQUENT * n_words
    stems = counts.filter((size < LONGEST) & frequent).select(
        F.col("gram").alias("stem"), F.col("n").alias("stem_n")
    )
    longer = counts.filter(size > SHORTEST).withColumn("stem", F.expr("left(gram, length(gram) - 1)"))
    extended = (
        longer.join(stems, "stem")
        .orderBy(F.desc("stem_n"), "stem", "gram")
        .limit(DICTIONARY)
        .select("gram")
    )
    return counts.filter(size == SHORTEST).select("gram").unionByName(extended)


@dataclass(frozen=True)
class Gram:
    start: int
    end: int


# Ends of the text before, and start of the text after, what an edit may affect.
Gap = tuple[int, int]


class GramIndex:
    """What a dictionary of grams says of words."""

    def __init__(self, grams: set[str]):
        self._grams = grams
        self._longest = max(map(len, grams), default=SHORTEST)
        self._heads = {g[:k] for g in grams for k in range(1, len(g))}
        self._tails = {g[k:] for g in grams for k in range(1, len(g))}

    def decompose(self, word: str) -> list[Gram]:
        """Longest grams from the left, without those inside an earlier one."""
        found, reached = [], 0
        for start in range(len(word) - SHORTEST + 1):
            end = start + SHORTEST
            for stop in range(min(len(word), start + self._longest), end, -1):
                if word[start:stop] in self._grams:
                    end = stop
                    break
            if end > reached:
                found.append(Gram(start, end))
                reached = end
        return found

    def _growing_from(self, word: str, left: int) -> int:
        """First place from which a gram could grow over an edit at ``left``."""
        for start in range(max(0, left - self._longest + 1), left):
            if word[start:left] in self._heads:
                return start
        return left

    def _swallowed_to(self, word: str, right: int) -> int:
        """Place up to which a gram from an edit before ``right`` could reach."""
        for end in range(min(len(word), right + self._longest - 1), right, -1):
            if word[right:end] in self._tails:
                return end
        return right

    def gaps(self, word: str, grams: list[Gram]) -> tuple[set[Gap], bool]:
        """The gap between unaffected grams for each place of an edit, and whether every place
        leaves a gram alone."""
        n = len(word)
        before, after = [], []
        for place in range(n + 1):
            grown = self._growing_from(word, place)
            ends = [g.end for g in grams if g.end <= place and g.start < grown]
            before.append(ends[-1] if ends else 0)
            swallowed = self._swallowed_to(word, place)
            starts = [g.start for g in grams if g.start >= place and g.end > swallowed]
            after.append(starts[0] if starts else n)
        return _between(before, after, n)


def _between(before: list[int], after: list[int], n: int) -> tuple[set[Gap], bool]:
    """Gaps around an insertion before each place, and around each place's code point."""
    found = {(before[i], after[i]) for i in range(n + 1)}
    found |= {(before[i], after[i + 1]) for i in range(n)}
    return found - {(0, n)}, (0, n) not in found


def short_grams(word: str) -> list[Gram]:
    return [Gram(i, i + SHORTEST) for i in range(len(word) - SHORTEST + 1)]


def short_gaps(word: str) -> set[Gap]:
    """Gaps of grams of `SHORTEST`, which no other gram grows over or swallows."""
    n = len(word)
    before = [i if i >= SHORTEST else 0 for i in range(n + 1)]
    after = [i if i <= n - SHORTEST else n for i in range(n + 1)]
    return _between(before, after, n)[0]


def all_gaps(word: str, grams: list[Gram], widest: int) -> set[Gap]:
    """Every gap between two grams, or a gram and an end of the word, up to a width."""
    n = len(word)
    ends = [0, *(g.end for g in grams)]
    starts = [*(g.start for g in grams), n]
    found = {(e, s) for e in ends for s in starts if 0 <= s - e <= widest}
    return found - {(0, n)}


def gap_keys(word: str, gaps: set[Gap], kind: str, lengths: tuple[int, ...]) -> Iterator[str]:
    """Names of lists: the text on both sides of a gap, and the length of the words in the list."""
    for start, end in gaps:
        for more in lengths:
            yield f"{kind}{len(word) + more}{word[:start]}|{word[end:]}"


def word_lists(index: GramIndex, word: str) -> tuple[bool, list[str], list[str]]:
    """Whether some edit could affect all grams, the lists a word is in, those it is merged with."""
    grams = index.decompose(word)
    gaps, whole = index.gaps(word, grams)
    own = [*gap_keys(word, all_gaps(word, grams, len(word)), "v", (0,))]
    merged = [*gap_keys(word, gaps, "v", (-1, 0, 1))]
    if not whole:
        # Next to a gap of two code points at most, after an edit of three.
        wide = all_gaps(word, short_grams(word), SHORTEST + 1)
        own += gap_keys(word, wide | _end_gaps(word), "s", (0,))
        merged += gap_keys(word, short_gaps(word), "s", (-1, 0, 1))
    return not whole, own, merged


def _end_gaps(word: str) -> set[Gap]:
    """Gaps at the ends of a word, whatever their width up to one gram and an edit."""
    n = len(word)
    return {(0, i) for i in range(1, SHORTEST + 2) if i < n} | {
        (n - i, n) for i in range(1, SHORTEST + 2) if i < n
    }


# Pairs


def _lists(words: DataFrame, grams: set[str]) -> DataFrame:
    held = words.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex(held.value)
        for batch in batches:
            found = [word_lists(index, w) for w in batch.column(0).to_pylist()]
            partial, own, merged = (list(c) for c in zip(*found)) if found else ([], [], [])
            keys = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(partial, pa.bool_()), pa.array(own, keys), pa.array(merged, keys)],
                ["word", "n", "partial", "own", "merged"],
            )

    layout = "word string, n long, partial boolean, own array<string>, merged array<string>"
    return words.select("word", "n").mapInArrow(run, layout)


def near_pairs(words: DataFrame, work: Workspace) -> DataFrame:
    """``(a, a_n, b, b_n)``: each two words of ``(word, n)`` one edit apart, once."""
    counts = work.stage(gram_counts(words), "spelling-grams")
    # At most all shortest grams over the letters, and `DICTIONARY`.
    dictionary = {r["gram"] for r in pruned_grams(counts, words.count()).collect()}
    lists = work.stage(_lists(words, dictionary), "spelling-lists")

    def entries(column: str) -> DataFrame:
        key = F.explode(column).alias("key")
        rows = lists.select("word", "n", "partial", key)
        return rows.select("word", "n", "partial", F.xxhash64("key").alias("list"))

    found = entries("merged").alias("a").join(entries("own").alias("b"), "list")
    # From one side is enough, unless that side could not name all its lists.
    once = (F.col("a.word") < F.col("b.word")) | (
        F.col("b.partial") & (F.col("a.word") != F.col("b.word"))
    )
    near = F.levenshtein("a.word", "b.word", 1) == 1
    first = F.col("a.word") < F.col("b.word")

    def side(name: str) -> list:
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        return [F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)]

    (a, b), (a_n, b_n) = side("word"), side("n")
    pairs = found.filter(once & near)
    return pairs.select(a.alias("a"), a_n.alias("a_n"), b.alias("b"), b_n.alias("b_n")).distinct()


def _roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """``(word, root)``: the last form reached from each word of ``(word, form)``.

    Each round doubles the steps. A form occurs at least twice as often as its word, so steps are
    no more than the logarithm of the greatest count.
    """
    roots = work.stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
        )
        after = work.stage(step, "spelling-roots")
        work.drop(roots)
        roots = after.select("word", "root")
        if after.filter("on").isEmpty():
            return roots


def variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``(word, n)``.

    The form is the near word of greatest count where that is at least twice the word's own.
    """
    with Workspace(words.sparkSession) as work:
        stored = work.stage(words, "spelling-words")
        pairs = work.stage(near_pairs(stored, work), "spelling-pairs")
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("n"))
        both = both.unionByName(
            pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("n"))
        )
        best = F.min(F.struct((-F.col("n")).alias("n"), F.col("near").alias("near"))).alias("best")
        around = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
        rows = stored.join(around, "word", "left")
        is_form = -F.col("best.n") >= 2 * F.col("n")
        judged = work.stage(
            rows.select(
                "word",
                "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(is_form, F.col("best.near")).alias("form"),
                F.when(is_form, -F.col("best.n")).alias("form_n"),
            ),
            "spelling-judged",
        )
        roots = _roots(judged.filter("form IS NOT NULL"), work)
        found = work.stage(judged.join(roots, "word", "left"), "spelling-found")
        work.keep(found)
    root = F.coalesce("root", "word").alias("root")
    return found.select("word", "form", root, "n", "n_near", "form_n")
