"""K-d tree sharding: recursive weighted medians along the widest metadata dimension.

A node is a box of rows. It is cut across the dimension in which it is widest, against the spread of
the whole table, at the weighted quantile that gives either side the bytes of its share of the
shards; leaves that hold one target's bytes are the shards. All nodes of a level are cut in the same
passes: the place of a cut is narrowed digit by digit, each pass summing the bytes of a node's rows
by the next digit, map-side first. No pass sorts or moves rows, and what comes back to the driver is
one line per open cut.

Rows are ordered by the dimension, then by the crc32 of the text and by a hash of the id, so equal
texts with equal metadata stay together unless a cut falls between them. Rows alike in all of these
are not parted. A null counts as the least value of its dimension and a null text as 0 bytes; empty
and very long texts weigh what they hold, and a text larger than the target makes a large shard. An
empty table gives an empty result. Input columns named like an output column are replaced.

Every shard numbers its rows from 0 without gaps: rows are counted by shard and block of a hash,
blocks get their starts from those counts, and only the rows of one block are numbered together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import Workspace

# A place in a dimension has 48 bits, the order of rows alike there another 48.
PLACE_BITS = 48
TIE_BITS = 48
# Bits that one pass settles.
DIGIT = 12
# Most shards of one tree.
MOST_SHARDS = 2048
# Rows of a block that are numbered together, about.
BLOCK_ROWS = 50_000


@dataclass(frozen=True)
class Node:
    """Rows numbered ``number`` that shall become ``shards`` shards from ``first`` on."""

    number: int
    first: int
    shards: int


def text_place(value: Column) -> Column:
    """The first six bytes of a text as a number; the order of the texts, as far as it goes."""
    bytes_ = F.substring(F.encode(value.cast("string"), "UTF-8"), 1, 6)
    digits = F.rpad(F.hex(bytes_), 12, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0))


def log_place(value: Column) -> Column:
    """A size on a logarithmic scale of 48 bits."""
    return F.coalesce(
        (F.log2(F.greatest(value.cast("double"), F.lit(0.0)) + 1) * 2**42).cast("long"), F.lit(0)
    )


def _bits(column: str, low: int, n: int) -> Column:
    return F.shiftright(F.col(column), low).bitwiseAND((1 << n) - 1)


def _of_nodes(rows: DataFrame, values: dict[int, tuple], columns: Sequence[str]) -> DataFrame:
    """Join each row with the values of its node; at most one line per shard is broadcast."""
    lines = ", ".join(f"({k}, {', '.join(map(repr, v))})" for k, v in values.items())
    names = ", ".join(["node", *columns])
    nodes = rows.sparkSession.sql(f"SELECT * FROM VALUES {lines} AS nodes({names})")
    return rows.join(F.broadcast(nodes), "node")


def _widest(rows: DataFrame, dims: Sequence[str], spread: dict[str, int]) -> dict[int, tuple]:
    """Number of the dimension of the largest extent of every node, and the node's bytes."""
    bounds = rows.groupBy("node").agg(
        F.sum("size").alias("total"),
        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("low", F.min), ("high", F.max))],
    )
    found = {}
    for r in bounds.collect():
        extent = [(r[f"high_{d}"] - r[f"low_{d}"]) / spread[d] for d in dims]
        found[r.node] = (extent.index(max(extent)), r.total)
    return found


def _cuts(keyed: DataFrame, wanted: dict[int, float]) -> dict[int, tuple[int, int]]:
    """``(place, tie)`` of each node: its rows up to there go left and hold the wanted bytes.

    Pass by pass a cut's digits are found from the highest on, as the first digit at which the
    bytes so far reach those wanted on the left.
    """
    found = {k: [0, 0] for k in wanted}
    left = dict(wanted)
    for at, (column, bits) in enumerate((("place", PLACE_BITS), ("tie", TIE_BITS))):
        for low in range(bits - DIGIT, -1, -DIGIT):
            state = {k: (v[0], v[1], f"{left[k]:.3f}") for k, v in found.items()}
            inside = _of_nodes(keyed, state, ["at_place", "at_tie", "target"])
            if column == "tie":
                inside = inside.filter("place = at_place")
            prefix = F.shiftright(column, low + DIGIT) == F.shiftright(f"at_{column}", low + DIGIT)
            sums = (
                inside.filter(prefix)
                .groupBy("node", _bits(column, low, DIGIT).alias("digit"))
                .agg(F.sum("size").alias("size"), F.max("target").cast("double").alias("target"))
            )
            until = Window.partitionBy("node").orderBy("digit")
            sums = sums.withColumns(
                {
                    "before": F.sum("size").over(until) - F.col("size"),
                    "last": F.max("digit").over(Window.partitionBy("node")),
                }
            )
            reached = (
                sums.filter("before + size >= target OR digit = last")
                .groupBy("node")
                .agg(F.min(F.struct("digit", "before")).alias("at"))
            )
            for r in reached.collect():
                found[r.node][at] |= r["at"].digit << low
                left[r.node] -= r["at"].before
    return {k: tuple(v) for k, v in found.items()}


def kd_shards(rows: DataFrame, dims: Sequence[str], shards: int, work: Workspace) -> DataFrame:
    """Replace ``node`` by ``shard``; ``rows`` has ``node`` 0, ``size``, ``tie`` and ``dims``.

    The result is staged in ``work``. A node without rows is not cut; its shards stay empty.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"between 1 and {MOST_SHARDS} shards, not {shards}")
    spread = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first().asDict()
    spread = {d: max(1, v or 0) for d, v in spread.items()}
    nodes = [Node(0, 0, shards)]
    while any(n.shards > 1 for n in nodes):
        widest = _widest(rows, dims, spread)
        nodes = [n for n in nodes if n.number in widest]
        if not nodes:
            break
        along = {n.number: (widest[n.number][0],) for n in nodes}
        place = F.element_at(F.array(*dims), F.col("along") + 1)
        keyed = work.stage(
            _of_nodes(rows, along, ["along"]).withColumn("place", place).drop("along"),
            "shard-keyed",
        )
        wanted = {
            n.number: widest[n.number][1] * (n.shards // 2) / n.shards
            for n in nodes
            if n.shards > 1
        }
        cuts = _cuts(keyed, wanted)
        # Nodes that are shards already go along uncut: all their rows go left.
        children, state = [], {}
        for n in nodes:
            half = n.shards // 2 if n.shards > 1 else 1
            state[n.number] = (*cuts.get(n.number, (1 << PLACE_BITS, 0)), len(children))
            children += [
                Node(len(children), n.first, half),
                Node(len(children) + 1, n.first + half, n.shards - half),
            ]
        placed = _of_nodes(keyed, state, ["at_place", "at_tie", "child"])
        goes_left = F.expr("place < at_place OR (place = at_place AND tie <= at_tie)")
        node = (F.col("child") + F.when(goes_left, 0).otherwise(1)).alias("node")
        previous, nodes = rows, children
        rows = work.stage(placed.select(*_kept(placed), node), "shard-rows")
        work.drop(previous, keyed)
    if not nodes:
        return rows.withColumnRenamed("node", "shard")
    shard_of = {n.number: (n.first,) for n in nodes}
    return work.stage(_of_nodes(rows, shard_of, ["shard"]).drop("node"), "shard-leaves")


def _kept(placed: DataFrame) -> list[str]:
    gone = {"node", "place", "at_place", "at_tie", "child"}
    return [c for c in placed.columns if c not in gone]


def with_slots(rows: DataFrame, order: Sequence[str], work: Workspace) -> DataFrame:
    """Add ``slot``, the number of a row within its shard from 0 on, by blocks of ``tie``."""
    blocks = max(1, rows.count() // BLOCK_ROWS)
    placed = rows.withColumn("block", F.pmod(F.xxhash64("tie", *order), F.lit(blocks)))
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    earlier = (
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = work.stage(
        counts.select(
            "shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
        ),
        "shard-starts",
    )
    within = Window.partitionBy("shard", "block").orderBy("tie", *order)
    numbered = placed.withColumn("within", F.row_number().over(within) - 1)
    return (
        numbered.join(starts, ["shard", "block"])
        .withColumn("slot", (F.col("start") + F.col("within")).cast("long"))
        .drop("block", "start", "within")
    )


def shard_documents(
    docs: DataFrame,
    target_bytes: int | None = None,
    shards: int = 8,
    doc_id: str = "doc_id",
    text: str = "text",
    texts: Sequence[str] = ("source", "lang"),
    sizes: Sequence[str] = ("n_chars",),
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    Leaves hold about ``target_bytes``, or without it an equal part of all bytes each. ``texts`` and
    ``sizes`` name the metadata dimensions; sizes are cut on a logarithmic scale.
    """
    crc = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0))
    id_hash = F.xxhash64(F.col(doc_id)).bitwiseAND((1 << 16) - 1)
    dims = [f"dim{i}" for i in range(len(texts) + len(sizes))]
    places = [text_place(F.col(c)) for c in texts] + [log_place(F.col(c)) for c in sizes]
    spark = docs.sparkSession
    with Workspace(spark) as work:
        rows = work.stage(
            docs.select(
                F.col(doc_id).alias("doc_id"),
                (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                crc.alias("text_crc32"),
                (F.shiftleft(crc, 16) + id_hash).alias("tie"),
                F.lit(0).alias("node"),
                *[p.alias(d) for d, p in zip(dims, places)],
            ),
            "shard-input",
        )
        if target_bytes:
            total = rows.agg(F.sum("size")).first()[0] or 0
            shards = max(1, round(total / target_bytes))
        placed = kd_shards(rows, dims, shards, work)
        slotted = with_slots(placed, ["doc_id"], work)
        result = work.stage(
            slotted.select(
                "doc_id",
                "size",
                "text_crc32",
                F.lit("bytes").alias("law"),
                "shard",
                "slot",
                F.lit(None).cast("int").alias("grown_shard"),
            ),
            "shards",
        )
        work.keep(result)
    return result
