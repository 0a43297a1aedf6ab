"""Byte-level BPE: a priority queue of merge ranks over a linked list of symbols.

Encoding parts a text into pre-tokens and merges the symbols of each. A queue holds the rank and
place of every adjacent pair; entries whose symbols have since been merged are stale and skipped.
Decoding concatenates the vocabulary strings.

Null texts count as empty. Texts of any length are encoded whole: memory is in proportion to the
longest text of a batch. Equal rows are encoded alike, and input columns named like an output
column are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_fields, text_udf

# Fixed value: how byte-level vocabularies part a text before merging.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Most pre-tokens a worker remembers; the memory is emptied when full.
REMEMBERED = 200_000
# A remembered pre-token is at most this long.
REMEMBERED_LENGTH = 64

DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies, by rule: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Codec:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        model = parsed["model"]
        if (
            model.get("type") != "BPE"
            or parsed.get("normalizer")
            or (parsed.get("pre_tokenizer") or {}).get("type") != "ByteLevel"
            or parsed["pre_tokenizer"].get("add_prefix_space")
            or model.get("ignore_merges")
        ):
            raise ValueError("not a plain byte-level BPE file")
        added = {}
        for token in parsed.get("added_tokens", ()):
            if any(token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"added token {token['content']!r} needs more than its text")
            added[token["content"]] = token["id"]
        symbols = byte_symbols()

        def raw(token: str) -> bytes:
            if all(c in symbols for c in token):
                return bytes(symbols[c] for c in token)
            return token.encode()

        vocabulary = model["vocab"]
        self.strings = {i: raw(t) for t, i in vocabulary.items()}
        self.strings |= {i: raw(t) for t, i in added.items()}
        self.of_byte = [0] * 256
        for char, byte in symbols.items():
            self.of_byte[byte] = vocabulary[char]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = (vocabulary[left], vocabulary[right])
            self.merges[key] = (rank, vocabulary[left + right])
        self.added = added
        by_length = sorted(added, key=len, reverse=True)
        self.added_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if added else None
        )
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the pair of least rank, the leftmost among equals."""
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        after = [*range(1, n + 1)]
        before = [*range(-1, n - 1)]
        merges = self.merges
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # stale: one of the two symbols has been merged since
            ids[i] = merges[left, right][1]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((ids[i], ids[k])):
                    heapq.heappush(queue, (found[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], ids[i]))):
                heapq.heappush(queue, (found[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def _packed(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            found = np.array(self.merge(piece.encode()), "<u4").tobytes()
            if len(piece) <= REMEMBERED_LENGTH:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.added_pattern.split(text) if self.added_pattern else [text]
        out = []
        for n, part in enumerate(parts):
            if n % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            else:
                out += map(self._packed, self.pre_tokens.findall(part))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """Concatenated vocabulary strings; bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(packed, "<u4").tolist()
        joined = b"".join(map(self.strings.__getitem__, ids))
        return joined.decode(errors="replace").encode()


@functools.lru_cache(maxsize=4)
def codec(definition: str) -> Codec:
    """One codec per worker process and vocabulary file."""
    return Codec(definition)


def _definition(spark, vocabulary_path: str):
    """The vocabulary file's text, read where the query is made and sent to every worker once."""
    with open(vocabulary_path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the whole text's token ids as an array of ints."""
    definition = _definition(df.sparkSession, vocabulary_path)

    @F.arrow_udf("array<int>")
    def run(texts):
        import pyarrow as pa

        own = codec(definition.value)
        packed = [own.encode(t or "") for t in texts.to_pylist()]
        offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype("int32")
        flat = np.frombuffer(b"".join(packed), "<u4").astype("int32")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return df.withColumn(ids, run(F.col(text)))


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, the decoded ids; null ids decode to the empty text."""
    definition = _definition(df.sparkSession, vocabulary_path)

    @F.arrow_udf("string")
    def run(rows):
        import pyarrow as pa

        own = codec(definition.value)
        packed = (np.array(r or [], "<u4").tobytes() for r in rows.to_pylist())
        return pa.array([own.decode(p).decode() for p in packed], pa.string())

    return df.withColumn(text, run(F.col(ids)))


def round_trip(df: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Add the token count and the digests of the ids and of the decoded text."""
    definition = _definition(df.sparkSession, vocabulary_path)

    def per_text(texts):
        own = codec(definition.value)
        out = []
        for raw in texts:
            packed = own.encode((raw or b"").decode())
            out.append(
                {
                    "n_tokens": len(packed) // 4,
                    "ids_sha256": hashlib.sha256(packed).hexdigest(),
                    "decoded_sha256": hashlib.sha256(own.decode(packed)).hexdigest(),
                }
            )
        return out

    return add_fields(df, text_udf(DIGEST, per_text)(F.col(text)), DIGEST.names)
