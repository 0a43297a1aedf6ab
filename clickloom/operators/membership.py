"""Early reduction of logs to the members of a key set, by a Bloom filter built once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..storage import Workspace
from .visits import restrict_to

# Bits of the filter for each member, and the places of a member: 1.2 % of other keys pass.
BITS_PER_MEMBER = 10
PLACES = 4
# The filter is sent to every executor, so it ends at 16 MB; larger sets are semi-joined.
MOST_BITS = 1 << 27


def _places(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits)) for i in range(PLACES)]


def filter_bits(members: int) -> int:
    """Size of the filter: the power of two from `BITS_PER_MEMBER` bits a member on."""
    return 1 << max(6, (members * BITS_PER_MEMBER - 1).bit_length())


def bloom_filter(members: DataFrame, key: str, bits: int) -> DataFrame:
    """One row ``words``: the filter as 64-bit words. Null members are left out."""
    place = members.filter(F.col(key).isNotNull()).select(
        F.explode(F.array(*_places(key, bits))).alias("place")
    )
    # A word and a bit of it; sums by word come before the exchange.
    word = F.shiftrightunsigned("place", 6).alias("at")
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    set_words = place.groupBy(word).agg(F.bit_or(bit).alias("word"))
    every = members.sparkSession.range(bits // 64).withColumnRenamed("id", "at")
    filled = every.join(set_words, "at", "left").select(
        F.struct("at", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("entry")
    )
    ordered = F.array_sort(F.collect_list("entry"))
    return filled.agg(F.transform(ordered, lambda e: e["word"]).alias("words"))


def may_hold(words: Column, key: str, bits: int) -> Column:
    """False only for keys that are surely no members; null keys are none."""
    hit = F.col(key).isNotNull()
    for place in _places(key, bits):
        word = F.get(words, F.shiftrightunsigned(place, 6).cast("int"))
        hit = hit & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return hit


class Members:
    """A key set to which logs are reduced before their first exchange.

    Members are counted first. Up to `MOST_BITS` their filter is built once, stored, and tested in
    each log's scan stage; it lets every member and about one in eighty other keys pass, so what
    follows must not count on exactness. Larger sets are met by a semi-join, which is exact.
    """

    def __init__(self, members: DataFrame, key: str, work: Workspace, most_bits: int = MOST_BITS):
        self._members, self._key = members, key
        self.bits = filter_bits(members.count())
        self._words = None
        if self.bits <= most_bits:
            self._words = work.stage(bloom_filter(members, key, self.bits), "members")

    def reduce(self, rows: DataFrame) -> DataFrame:
        """Rows whose key may be a member; the columns stay."""
        if self._words is None:
            return restrict_to(rows, self._members, self._key)
        return rows.filter(may_hold(self._words.scalar(), self._key, self.bits))
