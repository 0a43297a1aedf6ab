"""Near-duplicates by MinHash: banding, signature check, exact check, connected components.

A document's set holds its distinct five-word shingles as 64-bit hashes. Equal sets form a class,
named by its smallest id. Signatures are the minima of universal hashes; bands of them put classes
in buckets. Within a bucket, a class is compared with a hub and not with every other: first the
most central member, then, where a bucket still holds several components, members of its smallest
components against all others. So a bucket costs about its size however many copies it holds, and
no pair that could join two components stays unseen. A pair passes when its signatures do not
rule it out and its full sets then have the wanted similarity.

The join of a bucket with its hubs carries a sketch of each set and makes no row of a pair that the
sketches rule out. The parity of the hashes in each of 1,024 places differs in at most as many
places as the sets differ in shingles, so that test loses no link; it is sharp for sets of some
hundred shingles. The lowest bits of the signature serve larger sets.

At a similarity of 0.75 a pair shares none of the 60 bands of 6 with probability 8e-6, and its
signature checks fail with probability below 1e-6 each.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text with fewer than five words has
its whole sequence as its only shingle. Null, empty and wordless texts have the empty set and are
linked with nothing. A row without an id is in no component and is kept. Repeated rows get the same
result; rows that share an id but not a text are linked as different texts. An empty table gives an
empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..storage import Workspace
from .common import byte_texts, words
from .components import components

SHINGLE = 5
BANDS, ROWS = 60, 6
# Links need at least this similarity, as a fraction.
SIMILARITY = (75, 100)
# Least share of agreeing signature entries, five standard deviations below the similarity.
LEAST_AGREEING = 0.75 - 5 * (0.75 * 0.25 / (BANDS * ROWS)) ** 0.5
# Places of the parity sketch, and most differing lowest bits of two signatures (half of the differing
# entries differ there), five standard deviations above the similarity.
PARITY = 1024
MOST_BITS = BANDS * ROWS * 0.125 + 5 * (BANDS * ROWS * 0.125 * 0.875) ** 0.5
# Members of a bucket's smallest components that one further round compares with the others.
HUBS = 512
# Word hashes a worker remembers; shingles hashed at once.
REMEMBERED = 300_000
AT_ONCE = 2048


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + 1


PLACE = _odd(1, SHINGLE)
FACTOR = _odd(2, BANDS * ROWS).astype(np.uint64)
OFFSET = _odd(3, BANDS * ROWS).astype(np.uint64)
BAND = _odd(4, BANDS * ROWS).astype(np.uint64)
HIGH = np.uint64(32)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits of each hash spread over all its bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """Shingle sets of texts; the hashes of words met before are remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a whole text."""
        found = words((text or b"").lower())
        n = len(found)
        if not n:
            return np.zeros(0, np.uint64)
        if n < SHINGLE:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=n)], np.uint64)
        hashes = np.fromiter(map(self._hash, found), np.uint64, n)
        total = hashes[: n - SHINGLE + 1] * PLACE[0]
        for i in range(1, SHINGLE):
            total += hashes[i : n - SHINGLE + 1 + i] * PLACE[i]
        return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``a * x + b``, upper 32 bits, over the set."""
    least = np.full(BANDS * ROWS, 2**32 - 1, np.uint64)
    for start in range(0, len(shingles), AT_ONCE):
        part = shingles[start : start + AT_ONCE, None]
        np.minimum(least, ((part * FACTOR + OFFSET) >> HIGH).min(0), out=least)
    return least


def band_hashes(least: np.ndarray) -> np.ndarray:
    """One hash per band, which also names the band."""
    sums = (least * BAND).reshape(BANDS, ROWS).sum(1, dtype=np.uint64)
    return _mixed(sums + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def sketch(shingles: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Parities of the hashes by place, then the lowest bits of the signature, as 64-bit numbers."""
    parity = np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    bits = np.zeros(-(-len(least) // 64) * 64, np.uint8)
    bits[: len(least)] = least & np.uint64(1)
    return np.packbits(np.concatenate([parity.astype(np.uint8), bits])).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text_key, n_shingles, set_key, bands, signature, sketch)``; no set key for the
    empty set.

    A signature entry is kept as its lowest byte, which differing minima share in 1 of 256 cases.
    """
    shingles = Shingles()
    for batch in batches:
        sizes, keys, bands, signatures, sketches = [], [], [], [], []
        for text in byte_texts(batch.column(1)):
            own = shingles(text)
            sizes.append(len(own))
            if len(own):
                least = signature(own)
                keys.append(blake2b(own.tobytes(), digest_size=16).digest())
                bands.append(band_hashes(least))
                signatures.append(least.astype(np.uint8).tobytes())
                sketches.append(sketch(own, least))
            else:
                keys.append(None)
                bands.append(None)
                signatures.append(None)
                sketches.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
                pa.array(sketches, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_key", "n_shingles", "set_key", "bands", "signature", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, shingles)``: whole sets as packed sorted hashes."""
    shingles = Shingles()
    for batch in batches:
        packed = [shingles(t).tobytes() for t in byte_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "shingles"]
        )


@F.arrow_udf(T.BooleanType())
def _agree(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two signatures agree in enough entries."""
    least = LEAST_AGREEING * BANDS * ROWS
    return pa.array(
        [
            int((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).sum()) >= least
            for x, y in zip(a.to_pylist(), b.to_pylist())
        ]
    )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    part, whole = SIMILARITY
    return whole * shared >= part * (len(a) + len(b) - shared)


@F.arrow_udf(T.BooleanType())
def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(
        [
            similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
            for x, y in zip(a.to_pylist(), b.to_pylist())
        ]
    )


def _sides(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Add ``{column}_u`` and ``{column}_v`` to pairs of ids."""
    for side in ("u", "v"):
        named = values.select(
            F.col("doc_id").alias(side), F.col(column).alias(f"{column}_{side}")
        )
        pairs = pairs.join(named.hint("merge"), side)
    return pairs


def _verified(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, work: Workspace
) -> DataFrame:
    """Pairs whose signatures agree and whose full sets are similar, staged in ``work``."""
    with Workspace(pairs.sparkSession) as own:
        agreeing = own.stage(
            _sides(pairs, classes, "signature")
            .filter(_agree("signature_u", "signature_v"))
            .select("u", "v"),
            "minhash-agreeing",
        )
        ids = agreeing.select(F.col("u").alias("doc_id")).union(agreeing.select("v")).distinct()
        sets = own.stage(
            texts.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(
                _sets, "doc_id long, shingles binary"
            ),
            "minhash-sets",
        )
        confirmed = _sides(agreeing, sets, "shingles").filter(_similar("shingles_u", "shingles_v"))
        return work.stage(confirmed.select("u", "v").distinct(), "minhash-links")


def _members(classes: DataFrame, work: Workspace) -> DataFrame:
    """``(bucket, doc_id, hub)`` of the buckets with several classes, staged in ``work``.

    The hub of a bucket is its most central member: the one whose buckets hold most classes in
    all. Among copies of one text that is the copy with the fewest changes of its own, which is
    the likeliest to be similar to all others.
    """
    entries = classes.select("doc_id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sized = work.stage(entries.join(shared.hint("merge"), "bucket"), "minhash-sized")
    weight = sized.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    weighed = work.stage(
        sized.select("bucket", "doc_id").join(weight.hint("merge"), "doc_id"), "minhash-weighed"
    )
    first = F.struct(F.col("weight"), (-F.col("doc_id")).alias("order"))
    hubs = weighed.groupBy("bucket").agg((-F.max(first)["order"]).alias("hub"))
    members = weighed.select("bucket", "doc_id").join(hubs.hint("merge"), "bucket")
    found = work.stage(members, "minhash-members")
    work.drop(sized, weighed)
    return found


def _possible() -> Column:
    """Whether the sketches of a row's two sides leave the wanted similarity possible.

    With ``d`` shingles in one of two sets only, ``a`` and ``b`` in each, the similarity is reached
    if ``(whole + part) * d <= (whole - part) * (a + b)``.
    """
    part, whole = SIMILARITY
    split = PARITY // 64

    def differing(places: range) -> Column:
        return reduce(
            operator.add,
            (F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("hub_sketch")[i])) for i in places),
        )

    both = F.col("n_shingles") + F.col("hub_shingles")
    return ((whole + part) * differing(range(split)) <= (whole - part) * both) & (
        differing(range(split, split + -(-BANDS * ROWS // 64))) <= MOST_BITS
    )


def _further_pairs(
    members: DataFrame, sketches: DataFrame, own: Workspace
) -> tuple[DataFrame, DataFrame]:
    """Possible pairs across components, and the members that all others have now met.

    ``members`` has ``(bucket, doc_id, component)`` of buckets with several components.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    sized = own.stage(members.join(sizes, ["bucket", "component"]), "minhash-sized")
    order = Window.partitionBy("bucket").orderBy("size", "component", "doc_id")
    hubs = own.stage(
        sized.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HUBS),
        "minhash-hubs",
    )
    hub = hubs.join(sketches.hint("merge"), "doc_id").select(
        "bucket",
        F.col("doc_id").alias("hub"),
        F.col("component").alias("hub_component"),
        F.col("n_shingles").alias("hub_shingles"),
        F.col("sketch").alias("hub_sketch"),
    )
    sketched = sized.join(sketches.hint("merge"), "doc_id")
    across = (
        sketched.join(hub.hint("merge"), "bucket")
        .filter(F.col("component") != F.col("hub_component"))
        .filter(_possible())
    )
    pairs = across.select(
        F.least("hub", "doc_id").alias("u"), F.greatest("hub", "doc_id").alias("v")
    ).distinct()
    return pairs, hubs.select("bucket", "doc_id")


def _open_buckets(members: DataFrame, joined: DataFrame) -> DataFrame:
    """``(bucket, doc_id, component)`` of the buckets that hold several components."""
    named = joined.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
    placed = members.join(named, "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    several = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    return placed.join(several, "bucket", "left_semi")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("text_key"),
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks the rows that have it.
    """
    return _components(_keyed(docs, doc_id, text)).drop("text_key")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; repeated rows become one."""
    found = _components(_keyed(docs, doc_id, text)).filter("kept")
    kept = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"))
    keys = {"__id": F.col(doc_id).cast("long"), "__text": F.xxhash64(text)}
    same = F.col("a.__id").eqNullSafe(F.col("b.__id")) & (F.col("a.__text") == F.col("b.__text"))
    staying = docs.withColumns(keys).alias("a").join(
        kept.hint("merge").alias("b"), same, "left_semi"
    )
    return staying.dropDuplicates(list(keys)).drop(*keys)


def _components(texts: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_shingles, component_id, kept)`` of ``(doc_id, text, text_key)``."""
    spark = texts.sparkSession
    described = texts.mapInArrow(
        _describe,
        "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, "
        "signature binary, sketch array<long>",
    )
    texts = texts.select("doc_id", "text")
    with Workspace(spark) as work:
        rows = work.stage(described, "minhash-rows")
        narrow = rows.select("doc_id", "text_key", "n_shingles", "set_key")
        named = narrow.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
        class_of = work.stage(
            named.groupBy("set_key").agg(F.min("doc_id").alias("class")), "minhash-classes"
        )
        least = class_of.select("set_key", F.col("class").alias("doc_id"))
        wide = rows.join(least.hint("merge"), ["set_key", "doc_id"], "left_semi")
        classes = work.stage(
            wide.dropDuplicates(["set_key", "doc_id"]).select(
                "doc_id", "n_shingles", "bands", "signature", "sketch"
            ),
            "minhash-representatives",
        )
        members = _members(classes, work)
        first = members.select(
            F.least("hub", "doc_id").alias("u"), F.greatest("hub", "doc_id").alias("v")
        )
        tested = work.stage(first.filter("u < v").distinct(), "minhash-tested")
        links = _verified(tested, classes, texts, work)
        joined = components(links, work)
        # The hub has met all others of its bucket.
        rest = members.filter("doc_id != hub")
        open_buckets = work.stage(_open_buckets(rest, joined), "minhash-open")
        sketches = work.stage(
            classes.select("doc_id", "n_shingles", "sketch").join(
                open_buckets.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"
            ),
            "minhash-sketches",
        )
        while not open_buckets.isEmpty():
            with Workspace(spark) as own:
                pairs, done = _further_pairs(open_buckets, sketches, own)
                new = own.stage(pairs.join(tested, ["u", "v"], "left_anti"), "minhash-new")
                links = _verified(new, classes, texts, work)
                tested = work.stage(tested.unionByName(new), "minhash-tested")
                if not links.isEmpty():
                    joined = components(joined.unionByName(links), work)
                rest = open_buckets.select("bucket", "doc_id").join(
                    done, ["bucket", "doc_id"], "left_anti"
                )
                open_buckets = work.stage(_open_buckets(rest, joined), "minhash-open")
        component_of = joined.select(F.col("u").alias("class"), F.col("v").alias("component"))
        result = (
            narrow.join(class_of, "set_key", "left")
            .join(component_of, "class", "left")
            .select(
                "doc_id",
                "text_key",
                "n_shingles",
                F.when(
                    F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id")
                ).alias("component_id"),
            )
        )
        result = result.withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        )
        stored = work.stage(result, "minhash-result")
        work.keep(stored)
    return stored
