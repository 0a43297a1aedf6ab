"""Byte-level BPE by a local rank file, through the tiktoken library.

The library parts a text by a pattern and merges each match. Long texts reach it in pieces, cut
where a match ends in any context: between a character that is no white space and a white space, or
between a letter or digit and a mark. White space runs of more than `LONG_RUN` characters, which
the library's pattern cannot walk, are parted here as the pattern would and merged as single
pieces. Decoding joins the vocabulary's bytes, so ids of half a character stay bytes.

Null texts count as empty; bytes that are no UTF-8 count as U+FFFD. Texts of any length are encoded
whole. Equal rows are encoded alike, and input columns named like an output column are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_fields, text_udf

# Characters the library gets at once.
PIECE = 100_000
# Longest run of white space that the library's pattern walks.
LONG_RUN = 500

# Places where a match of the pattern ends whatever stands around them. Only long assigned letters
# are named, as libraries differ about new ones.
_CUT = re.compile(
    r"(?<=\S)(?=[ \t\n\r])|(?<=[0-9A-Za-z一-龥ぁ-ゔァ-ヺ가-힣])(?=[!-&(-/:-@、。，！？])"
)
_RUN = regex.compile(r"\p{White_Space}{%d,}" % (LONG_RUN + 1))

DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def pieces(text: str) -> Iterator[tuple[str, bool]]:
    """``(piece, whole)``: parts of a text that can be encoded apart; a ``whole`` one is one match
    of the pattern."""
    start = 0
    if len(text) > LONG_RUN:
        for run in _RUN.finditer(text):
            yield from ((p, False) for p in _cut(text, start, run.start()))
            # Before other text the last white space goes with what follows.
            start = run.end() - (run.end() < len(text))
            yield text[run.start() : start], True
    yield from ((p, False) for p in _cut(text, start, len(text)))


def _cut(text: str, start: int, end: int) -> Iterator[str]:
    while end - start > PIECE:
        found = _CUT.search(text, start + PIECE, end)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    if start < end:
        yield text[start:end]


class RankCodec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines()) if t}
        self._library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.names = {r: str(r) for r in table.values()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_RUN:
            return self._library.encode_ordinary(text)
        ids = []
        for piece, whole in pieces(text):
            encode = self._library._encode_single_piece if whole else self._library.encode_ordinary
            ids += encode(piece)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self._library.decode_bytes(ids)


@functools.lru_cache(maxsize=4)
def codec(ranks: bytes, pattern: str) -> RankCodec:
    """One codec per worker process, rank file and pattern."""
    return RankCodec(ranks, pattern)


def _ranks(spark, path: str):
    """The rank file, read where the query is made and sent to every worker once."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add ``ids``, the whole text's token ids as an array of ints."""
    ranks = _ranks(df.sparkSession, ranks_path)

    @F.arrow_udf("array<int>")
    def run(texts):
        import pyarrow as pa

        own = codec(ranks.value, pattern)
        found = [own.encode(_text(t)) for t in texts.cast(pa.binary()).to_pylist()]
        offsets = np.cumsum([0, *map(len, found)]).astype("int32")
        flat = np.fromiter((i for f in found for i in f), "int32", int(offsets[-1]))
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return df.withColumn(ids, run(F.col(text)))


def decode(
    df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", raw: str = "raw"
) -> DataFrame:
    """Add ``raw``, the bytes of the ids; null ids give no bytes."""
    ranks = _ranks(df.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def run(rows):
        import pyarrow as pa

        own = codec(ranks.value, pattern)
        return pa.array([own.decode(r or []) for r in rows.to_pylist()], pa.binary())

    return df.withColumn(raw, run(F.col(ids)))


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add the token count and the digests of the ids, as text, and of the decoded bytes."""
    ranks = _ranks(df.sparkSession, ranks_path)

    def per_text(texts):
        own = codec(ranks.value, pattern)
        out = []
        for raw in texts:
            ids = own.encode(_text(raw))
            listed = " ".join(map(own.names.__getitem__, ids))
            out.append(
                {
                    "n_tokens": len(ids),
                    "ids_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(own.decode(ids)).hexdigest(),
                }
            )
        return out

    return add_fields(df, text_udf(DIGEST, per_text)(F.col(text)), DIGEST.names)


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode(errors="replace")
