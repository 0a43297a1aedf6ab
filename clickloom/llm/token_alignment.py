"""Alignment of two tokenizers' tokens by the byte offsets where tokens of both end.

The cumulative ends of either tokenizer go to a dictionary from end to index. The sorted
intersection of their keys slices both id lists into groups; links, the pairs of tokens whose byte
ranges overlap, are expanded inside each slice.

Both tokenizers give a segment the same tokens alone and inside its text when it begins with a
space or line feed after a character that is no white space, as no token of either reaches over
such a place (the vocabulary is asked; where it has one, texts are not cut). So a text is cut there
and a worker aligns each distinct segment of its documents once.

Counts of linked id pairs are of the whole corpus. Workers write documents in blocks of about
`BLOCK` characters: the distinct segments of each document, and once for a block its distinct pairs
with their totals. Only those pairs are exploded, summed and joined with their count, and each
block's pairs meet its documents again; no row is made for a document's link.

Texts that are null or empty, or that the tokens of either tokenizer do not spell exactly (such as
ones with U+2581), have no tokens: zeros and an empty digest. Bytes that are no UTF-8 count as
U+FFFD. Repeated rows each count and each have a result; other columns of the input are left out.
An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import Workspace
from .bpe import byte_symbols

# Characters of documents whose distinct pairs are written together, and that are cut at once.
BLOCK = 8_000_000
LOT = 1_000_000
# Characters of new segments that either tokenizer gets at once.
JOINED = 10_000
# Segments a worker remembers, twice over; longer ones are aligned each time.
REMEMBERED = 150_000
REMEMBERED_LENGTH = 64

_SEGMENT = re.compile(r"\s+\S*(?:[^\S \n]\s*\S*)*")

Slice = tuple[int, int, int, int]


def slices(a_lengths: Iterable[int], b_lengths: Iterable[int]) -> list[Slice]:
    """``(a from, a to, b from, b to)`` of each group between two ends that both lists share."""
    a_ends = _ends(a_lengths)
    b_ends = _ends(b_lengths)
    found, i, j = [], 0, 0
    for end in sorted(a_ends.keys() & b_ends.keys()):
        i_next, j_next = a_ends[end], b_ends[end]
        found.append((i, i_next, j, j_next))
        i, j = i_next, j_next
    return found


def _ends(lengths: Iterable[int]) -> dict[int, int]:
    """Number of tokens up to each cumulative end."""
    return {end: n for n, end in enumerate(accumulate(lengths), 1)}


def links(a_lengths: list[int], b_lengths: list[int], part: Slice) -> list[tuple[int, int]]:
    """Positions of the overlapping tokens of one group."""
    i, i_end, j, j_end = part
    if i_end - i == 1 or j_end - j == 1:
        return [(x, y) for x in range(i, i_end) for y in range(j, j_end)]
    found, a_at, b_at = [], a_lengths[i], b_lengths[j]
    while True:
        found.append((i, j))
        if a_at == b_at:
            return found  # only the group's last tokens end together
        if a_at < b_at:
            i += 1
            a_at += a_lengths[i]
        else:
            j += 1
            b_at += b_lengths[j]


class Segment(NamedTuple):
    """Aligned tokens of one segment; ``pairs`` has a 64-bit ``A id * 2^32 + B id`` for each link."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes


class Aligner:
    """Tokenizer A of a byte-level BPE file and tokenizer B of a piece model."""

    def __init__(self, a_definition: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(a_definition)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        symbols = byte_symbols()
        size = self._a.get_vocab_size()
        entries = map(self._a.id_to_token, range(size))
        self.a_bytes = [bytes(symbols[c] for c in t) if t else b"" for t in entries]

        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        plain = [p.replace("▁", " ") for p in pieces]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.encode()
            for i, p in enumerate(plain)
        ]
        self._a_sizes = np.array(list(map(len, self.a_bytes)))
        self._b_sizes = np.array(list(map(len, self.b_bytes)))
        self._a_names = list(map(str, range(len(self.a_bytes))))
        self._b_names = list(map(str, range(len(self.b_bytes))))
        # With the mark that follows a token inside its group, and at its end.
        self._a_marked = np.array([[n + m for n in self._a_names] for m in ",|"], object)
        self._b_marked = np.array([[n + m for n in self._b_names] for m in ",;"], object)
        self._space = self._b.piece_to_id("▁")
        self._cuts = not any(re.search(r"\S |\n", p) for p in plain)
        self._new: dict[str, Segment | None] = {}
        self._old: dict[str, Segment | None] = {}

    def segments(self, text: str) -> list[str]:
        """Parts of space and text that either tokenizer encodes apart."""
        if not text:
            return []
        return _SEGMENT.findall(" " + text) if self._cuts else [" " + text]

    def tokens(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of either tokenizer for each segment, encoded apart."""
        a = self._a.encode_batch(parts, add_special_tokens=False)
        # B puts a space before a text: a segment's own, or one that is taken off again.
        b = self._b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        for part, left, right in zip(parts, a, b):
            if part == " ":
                right = [self._space]  # B puts no space before nothing
            elif part[0] != " " and right and right[0] == self._space:
                right = right[1:]
            yield left.ids, right

    def _align_joined(self, parts: list[str]) -> list[Segment | None]:
        """Alignment of many segments as one text, which every segment ends like a word."""
        raw = [p.encode() for p in parts]
        ends = np.cumsum(list(map(len, raw)))
        text = "".join(parts)
        # Without the offsets in the text, which nothing needs.
        a = np.array(self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids, "i8")
        b = np.array(self._b.encode(text[1:], num_threads=1), "i8")
        a_raw = b"".join(map(self.a_bytes.__getitem__, a.tolist()))
        b_ids = b.tolist()
        b_raw = b"".join(map(self.b_bytes.__getitem__, b_ids))
        if not a_raw == b_raw == b"".join(raw):
            return self._align_alone(parts)
        a_sizes, b_sizes = self._a_sizes[a], self._b_sizes[b]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        group_ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        # Tokens of either list up to the end of each group.
        a_cut = np.searchsorted(a_ends, group_ends) + 1
        b_cut = np.searchsorted(b_ends, group_ends) + 1
        # Overlaps lie inside a slice: from the token that an A token starts in to its end's.
        first = np.searchsorted(b_ends, a_ends - a_sizes, "right")
        many = np.searchsorted(b_ends, a_ends, "left") - first + 1
        links_to = np.cumsum(many)
        b_at = np.arange(links_to[-1]) + np.repeat(first - links_to + many, many)
        pairs = ((np.repeat(a, many) << 32) + b[b_at]).tobytes()
        a_to = np.searchsorted(a_ends, ends) + 1
        b_to = np.searchsorted(b_ends, ends) + 1
        groups_to = np.searchsorted(group_ends, ends) + 1
        if not np.array_equal(group_ends[groups_to - 1], ends):
            return self._align_alone(parts)  # some token reached over a cut
        pairs_to = links_to[a_to - 1] * 8
        names = self._written(a, b, a_cut, b_cut)
        found, i, j, g, p = [], 0, 0, 0, 0
        for i_to, j_to, g_to, p_to in zip(*(x.tolist() for x in (a_to, b_to, groups_to, pairs_to))):
            groups = "".join(names[i + j : i_to + j_to - 1]) + self._b_names[b_ids[j_to - 1]]
            found.append(Segment(i_to - i, j_to - j, g_to - g, groups, pairs[p:p_to]))
            i, j, g, p = i_to, j_to, g_to, p_to
        return found

    def _written(self, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> list[str]:
        """Names of all tokens in the order and with the marks that groups are written with."""
        a_last, b_last = np.zeros(len(a), "i8"), np.zeros(len(b), "i8")
        a_last[a_cut - 1] = b_last[b_cut - 1] = 1
        names = np.empty(len(a) + len(b), object)
        # A group's A tokens come after the B tokens of earlier groups, and before its own.
        sizes = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        names[np.arange(len(a)) + np.repeat(b_cut - sizes[1], sizes[0])] = self._a_marked[a_last, a]
        names[np.arange(len(b)) + np.repeat(a_cut, sizes[1])] = self._b_marked[b_last, b]
        return names.tolist()

    def _align_alone(self, parts: list[str]) -> list[Segment | None]:
        return [self._align(p, a, b) for p, (a, b) in zip(parts, self.tokens(parts))]

    def _align_all(self, parts: list[str]) -> Iterator[tuple[str, Segment | None]]:
        together, alone, size = [], [], 0
        for part in parts:
            if self._cuts and not part[-1].isspace() and (together or part[0] == " "):
                together.append(part)
                size += len(part)
                if size >= JOINED:
                    yield from zip(together, self._align_joined(together))
                    together, size = [], 0
            else:
                alone.append(part)
        if together:
            yield from zip(together, self._align_joined(together))
        if alone:
            yield from zip(alone, self._align_alone(alone))

    def _align(self, part: str, a: list[int], b: list[int]) -> Segment | None:
        raw = part.encode()
        a_raw = [self.a_bytes[t] for t in a]
        b_raw = [self.b_bytes[t] for t in b]
        if b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            return None
        a_lengths, b_lengths = list(map(len, a_raw)), list(map(len, b_raw))
        a_names, b_names = [self._a_names[t] for t in a], [self._b_names[t] for t in b]
        groups, pairs = [], array("q")
        for group in slices(a_lengths, b_lengths):
            i, i_end, j, j_end = group
            if i_end - i == 1 and j_end - j == 1:
                groups.append(f"{a_names[i]}|{b_names[j]}")
                pairs.append((a[i] << 32) + b[j])
                continue
            groups.append(f"{','.join(a_names[i:i_end])}|{','.join(b_names[j:j_end])}")
            pairs.extend((a[x] << 32) + b[y] for x, y in links(a_lengths, b_lengths, group))
        return Segment(len(a), len(b), len(groups), ";".join(groups), pairs.tobytes())

    def aligned(self, parts: set[str]) -> dict[str, Segment | None]:
        """Every segment's alignment; None where the tokens do not spell it."""
        found, missing = {}, []
        for part in parts:
            if part in self._new:
                found[part] = self._new[part]
            elif part in self._old:
                found[part] = self._new[part] = self._old[part]
            else:
                missing.append(part)
        for part, segment in self._align_all(missing):
            found[part] = segment
            if len(part) <= REMEMBERED_LENGTH:
                self._new[part] = found[part]
        if len(self._new) > REMEMBERED:
            self._new, self._old = {}, self._new
        return found


@functools.lru_cache(maxsize=2)
def aligner(a_definition: str, b_model: bytes) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    return Aligner(a_definition, b_model)


class _Block:
    """Documents written together, by the distinct segments they are made of."""

    def __init__(self, number: int):
        self.number = number
        self.size = 0
        self._place: dict[str, int] = {}
        self._segments: list[Segment] = []
        self._groups: list[str] = []
        self._ids: list = []
        self._made_of: list[np.ndarray] = []
        self._digests: list[str] = []

    def add(self, ids: list, texts: list[str], own: Aligner) -> None:
        parts = [own.segments(t) for t in texts]
        place = self._place
        for part, segment in own.aligned(set().union(*parts).difference(place)).items():
            place[part] = -1 if segment is None else len(self._segments)
            if segment is not None:
                self._segments.append(segment)
                self._groups.append(segment.groups)
        groups = self._groups
        for doc_id, text, cut in zip(ids, texts, parts):
            places = list(map(place.__getitem__, cut))
            if -1 in places:
                places = []
            joined = ";".join(map(groups.__getitem__, places))
            self._ids.append(doc_id)
            self._made_of.append(np.array(places, "<i4"))
            self._digests.append(hashlib.sha256(joined.encode()).hexdigest() if places else "")
            self.size += len(text)

    def __len__(self) -> int:
        return len(self._ids)

    def rows(self, layout: pa.Schema) -> pa.RecordBatch:
        segments = self._segments
        sizes = np.array([len(s.pairs) // 8 for s in segments], "i8")
        pairs, place = np.unique(
            np.frombuffer(b"".join(s.pairs for s in segments), "i8"), return_inverse=True
        )
        flat = np.concatenate([*self._made_of, np.array([], "<i4")])
        times = np.bincount(flat, minlength=len(segments)).astype("f8")
        # Sums of whole numbers far below 2^53.
        totals = np.bincount(place, np.repeat(times, sizes), len(pairs)).astype("i8")
        starts = np.cumsum([0, *map(len, self._made_of)])

        def sums(values: Iterable[int]) -> list:
            return [*segment_sums(np.array(list(values), "i8"), flat, starts), None]

        n = len(self._ids)
        columns = {
            "block": [self.number] * (n + 1),
            "is_block": [False] * n + [True],
            "id": [*self._ids, None],
            "n_a": sums(s.n_a for s in segments),
            "n_b": sums(s.n_b for s in segments),
            "n_groups": sums(s.n_groups for s in segments),
            "n_links": sums(sizes),
            "groups_sha256": [*self._digests, None],
            "segments": [*self._made_of, None],
            "pairs": [None] * n + [pairs],
            "totals": [None] * n + [totals],
            "sizes": [None] * n + [sizes],
            "places": [None] * n + [place.astype("i4")],
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) for f in layout], schema=layout
        )


def segment_sums(values: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each document's segments."""
    running = np.concatenate([[0], np.cumsum(values[flat])])
    return running[starts[1:]] - running[starts[:-1]]


def _blocks_schema(id_type: T.DataType) -> T.StructType:
    fields = "block long, is_block boolean, n_a long, n_b long, n_groups long, n_links long, "
    fields += "groups_sha256 string, segments array<int>, pairs array<long>, totals array<long>, "
    fields += "sizes array<long>, places array<int>"
    return T.StructType([T.StructField("id", id_type), *T._parse_datatype_string(fields).fields])


def _blocks(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of all documents (``id, text``) and of their blocks."""
    spark = df.sparkSession
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    schema = _blocks_schema(df.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        own = aligner(*files.value)
        layout = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for ids, texts in _lots(batches):
            block.add(ids, texts, own)
            if block.size >= BLOCK:
                yield block.rows(layout)
                number += 1
                block = _Block(number)
        if len(block):
            yield block.rows(layout)

    return df.select("id", "text").mapInArrow(run, schema)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about `LOT` characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        raw_texts = batch.column(1).cast(pa.binary()).to_pylist()
        for doc_id, raw in zip(batch.column(0).to_pylist(), raw_texts):
            ids.append(doc_id)
            texts.append((raw or b"").decode(errors="replace"))
            size += len(texts[-1])
            if size >= LOT:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def pair_counts(block_pairs: DataFrame) -> DataFrame:
    """``(pair, n)``: links of each id pair in the whole corpus."""
    return block_pairs.groupBy("pair").agg(F.sum("total").alias("n"))


def _with_best(counts: DataFrame) -> DataFrame:
    """Add ``best``: whether no other A id is linked more often with the pair's B id."""
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    rows = counts.select("pair", "n", b)
    top = rows.groupBy("b").agg(F.max("n").alias("top"))
    return rows.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _block_results(schema: T.StructType):
    """Function of a block's rows and of its pairs with their counts."""

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        layout = to_arrow_schema(schema)
        is_block = rows.column("is_block").to_numpy(zero_copy_only=False).astype(bool)
        head = rows.filter(pa.array(is_block))
        docs = rows.filter(pa.array(~is_block))
        sizes = head.column("sizes").combine_chunks().flatten().to_numpy()
        places = head.column("places").combine_chunks().flatten().to_numpy()
        order = np.argsort(pairs.column("pair").to_numpy())
        made_of = docs.column("segments").combine_chunks()
        flat = made_of.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(made_of.value_lengths().to_numpy())])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sums = {}
        for name, column in (("n_best", "best"), ("count_sum", "n")):
            values = pairs.column(column).to_numpy(zero_copy_only=False).astype("i8")[order]
            running = np.concatenate([[0], np.cumsum(values[places])])
            of_segment = running[ends[1:]] - running[ends[:-1]]
            sums[name] = pa.array(segment_sums(of_segment, flat, starts))
        found = [sums[f.name] if f.name in sums else docs.column(f.name) for f in layout]
        return pa.Table.from_arrays(found, schema=layout)

    return run


def align(
    df: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts and digest of every document's groups and links, with the corpus' pair counts."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    spark = df.sparkSession
    with Workspace(spark) as work:
        stored = work.stage(_blocks(docs, a_path, b_path), "alignment-blocks")
        block_pairs = stored.filter("is_block").select(
            "block", F.explode(F.arrays_zip("pairs", "totals")).alias("p")
        )
        block_pairs = block_pairs.select(
            "block", F.col("p.pairs").alias("pair"), F.col("p.totals").alias("total")
        )
        counts = work.stage(pair_counts(block_pairs), "alignment-pairs")
        own_pairs = block_pairs.select(F.col("block").alias("of_block"), "pair")
        back = own_pairs.join(_with_best(counts), "pair")
        own = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
        schema = T.StructType(
            [docs.schema["id"]]
            + [T.StructField(n, T.LongType()) for n in own]
            + [T.StructField("groups_sha256", T.StringType())]
        )
        rows = stored.drop("pairs", "totals")
        met = rows.groupBy("block").cogroup(back.groupBy("of_block"))
        found = met.applyInArrow(_block_results(schema), schema)
        work.keep(stored, counts)
    return found.withColumnRenamed("id", id_column)


def aligned_groups(
    df: DataFrame, a_path: str, b_path: str, text: str = "text", groups: str = "groups"
) -> DataFrame:
    """Add ``groups``: the ids of both tokenizers between each two ends that they share."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = df.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    @F.arrow_udf("array<struct<a: array<int>, b: array<int>>>")
    def run(texts):
        own = aligner(*files.value)
        out = []
        for raw in texts.cast(pa.binary()).to_pylist():
            parts = own.segments((raw or b"").decode(errors="replace"))
            found = own.aligned(set(parts))
            listed = [found[p] for p in parts]
            out.append([] if None in listed else [g for s in listed for g in _listed(s.groups)])
        ids = pa.list_(pa.int32())
        return pa.array(out, pa.list_(pa.struct([("a", ids), ("b", ids)])))

    return df.withColumn(groups, run(F.col(text)))


def _listed(groups: str) -> Iterator[dict[str, list[int]]]:
    for group in groups.split(";"):
        a, b = group.split("|")
        yield {"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))}
