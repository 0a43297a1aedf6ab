"""Random forests of two classes grown on counted rows, many forests and tree counts at once.

The trees are those of Spark's ``RandomForestClassifier`` with its defaults: features in at most
``max_bins`` bins, rows drawn with Poisson weights, a share of the features tried at each node, Gini
gain, equal neighbouring leaves merged, soft votes. Three things differ. Rows that no tree can tell
apart are counted before the fit, and a tree draws the sum of their weights at once. Bins come from
all rows, not from a sample. Each tree has a seed of its own, so the first n trees of a forest are the
forest of n trees: one forest holds every smaller one. Draws do not depend on partitions; the ends of
the bins of a feature with many values may move by 1/2048 of the rows with them.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..storage import Workspace, delete_path, shared_path

# Cells, which are sets of rows alike for every tree, that one task holds at a time.
BLOCK_CELLS = 65536
# Trees whose node counts are summed in one row.
GROUP_TREES = 50
# Rows whose rank is looked up for the bins of a feature, and the error of a rank as a share.
RANKS, RANK_ERROR = 256, 2048
# A gain of less is one of rounding.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class Growth:
    """What the trees of a forest share."""

    seed: int
    depth: int
    max_bins: int

    @classmethod
    def of(cls, forest: RandomForestClassifier) -> Growth:
        """The settings of an estimator; those that are not followed here must have their defaults."""
        for param, value in forest.extractParamMap().items():
            default = _PLAIN.get(param.name, value)
            if value != default:
                raise ValueError(f"{param.name}={value} is not followed, only {default}")
        if not 2 <= forest.getMaxBins() <= 256:
            raise ValueError("bins are numbered in one byte")
        return cls(forest.getSeed(), forest.getMaxDepth(), forest.getMaxBins())


_PLAIN = {
    "bootstrap": True, "featureSubsetStrategy": "auto", "impurity": "gini", "minInfoGain": 0.0,
    "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0,
    "thresholds": None, "weightCol": None,
}


def _cuts(values: Sequence[float], max_bins: int) -> np.ndarray:
    """Upper ends of all bins but the last, from a feature's values at even ranks."""
    distinct = np.unique(np.asarray(values, "float64"))
    if len(distinct) <= max_bins:
        return (distinct[:-1] + distinct[1:]) / 2
    places = np.arange(1, max_bins) * (len(values) - 1) // max_bins
    ends = np.unique(np.sort(np.asarray(values, "float64"))[places])
    return ends[ends < distinct[-1]]


def bin_ends(rows: DataFrame, max_bins: int) -> dict[int, list[np.ndarray]]:
    """Ends of the bins of each feature, for each forest of ``(forest, values)``."""
    size = F.size("values")
    first, last = rows.agg(F.min(size), F.max(size)).first()
    if first is None or first != last:
        raise ValueError("a forest needs rows, with as many features each")
    ranks = F.lit(np.arange(RANKS + 1) / RANKS)  # one literal; a list would be one for each rank
    found = rows.groupBy("forest").agg(
        *[F.percentile_approx(F.get("values", i), ranks, RANK_ERROR).alias(f"f{i}") for i in range(last)]
    )
    return {r.forest: [_cuts(v, max_bins) for v in r[1:]] for r in found.collect()}


def _binned(ends: dict[int, list[np.ndarray]], folds: int):
    """Batches of ``(fold, label, values)`` to a row of each forest, which holds out a fold or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            labels = batch["label"].to_numpy(zero_copy_only=False)
            if not np.isin(labels, (0.0, 1.0)).all():
                raise ValueError("labels are 0 and 1")
            fold = batch["fold"].to_numpy(zero_copy_only=False)
            values = batch["values"].flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            if np.isnan(values).any():
                raise ValueError("a feature is NaN")
            size = values.shape[1]
            starts = pa.py_buffer((np.arange(rows + 1) * size).astype("int32"))
            for forest, own in ends.items():
                bins = np.empty((rows, size), "uint8")
                for i, cuts in enumerate(own):
                    bins[:, i] = np.searchsorted(cuts, values[:, i], "left")
                texts = pa.Array.from_buffers(pa.binary(), rows, [None, starts, pa.py_buffer(bins)])
                held = pa.array(fold == forest) if forest < folds else pa.array([False] * rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([forest] * rows, pa.int32()), texts, pa.array(labels.astype("int32")), held],
                    ["forest", "bins", "label", "held"],
                )

    return run


@dataclass
class Trees:
    """Trees of one forest as heaps: node n has the children 2n + 1 and 2n + 2.

    ``feature`` is -1 at a leaf; rows of a bin up to ``cut`` go left. ``counts`` of both classes are
    those of the rows drawn.
    """

    feature: np.ndarray
    cut: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Trees:
        nodes = 2 ** (depth + 1) - 1
        return cls(
            np.full((trees, nodes), -1, "int32"),
            np.zeros((trees, nodes), "uint8"),
            np.zeros((trees, nodes, 2)),
        )

    def add(self, level: int, trees: slice, feature, cut, counts, below) -> None:
        """Splits of a level, with the counts of its nodes and of both children of each."""
        first, n = 2**level - 1, 2**level
        self.feature[trees, first : first + n] = feature
        self.cut[trees, first : first + n] = cut
        if level == 0:
            self.counts[trees, 0] = counts[:, 0]
        self.counts[trees, 2 * first + 1 : 2 * (first + n) + 1] = below.reshape(len(below), 2 * n, 2)

    def merged(self) -> Trees:
        """The trees where a node with two leaves of the same class is a leaf, from below."""
        feature, larger = self.feature.copy(), self.counts[:, :, 1] > self.counts[:, :, 0]
        for node in reversed(range(feature.shape[1] // 2)):
            left, right = 2 * node + 1, 2 * node + 2
            leaves = (feature[:, left] < 0) & (feature[:, right] < 0)
            feature[leaves & (larger[:, left] == larger[:, right]), node] = -1
        return Trees(feature, self.cut, self.counts)

    def probability(self) -> np.ndarray:
        """Share of the class 1 among the rows of each node; a tree that drew no row has 1/2."""
        total = self.counts.sum(axis=2)
        return np.where(total > 0, self.counts[:, :, 1] / np.maximum(total, 1), 0.5)


def _share(size: int) -> int:
    """Features tried at a node."""
    return math.ceil(math.sqrt(size))


def _tried(seed: int, forest: int, tree: int, level: int, size: int) -> np.ndarray:
    """Features tried at each node of a level, in a row each."""
    rng = np.random.default_rng([seed, 1, forest, tree, level])
    return np.argsort(rng.random((2**level, size)), axis=1)[:, : _share(size)]


def _places(tried: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, int]:
    """Where the counts of each tried feature of a node begin, and how many places there are."""
    ends = np.cumsum(bins[tried].ravel())
    return np.concatenate(([0], ends[:-1])).reshape(tried.shape), int(ends[-1])


def _cells(cells) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins, label, rows to fit on and rows held out of the cells of a block."""
    bins, *numbers = cells.values.flatten()
    flat = np.frombuffer(b"".join(bins.to_pylist()), "uint8")
    return (flat.reshape(len(bins), -1), *(x.to_numpy(zero_copy_only=False) for x in numbers))


def _codes(bins: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Places of cells among the counts of a feature, by bin and class."""
    return 2 * bins.astype("uint8" if bins.max(initial=0) < 128 else "uint16") + label[:, None].astype("uint8")


def _drawn(rows: np.ndarray, seed: int, forest: int, tree: int, block: int) -> np.ndarray:
    """How often a tree draws the rows of each cell: a sum of Poisson numbers is one itself."""
    return np.random.default_rng([seed, 0, forest, tree, block]).poisson(rows)


def _count(codes, fitted, trees: Trees, tree: int, at: tuple, level: int, n_bins) -> np.ndarray:
    """Rows of each class by node, tried feature and bin, of one tree at one level."""
    seed, forest, block = at
    size, flat = codes.shape[1], codes.ravel()
    drawn = _drawn(fitted, seed, forest, tree, block)
    rows = np.flatnonzero(drawn)
    drawn, first, node = drawn[rows], rows * size, np.zeros(len(rows), "int64")
    feature, cut = trees.feature[tree], 2 * trees.cut[tree].astype("int64") + 1
    for _ in range(level):
        split = feature.take(node)
        if split.min(initial=0) < 0:
            drawn, first, node, split = (x[split >= 0] for x in (drawn, first, node, split))
        node = 2 * node + 1 + (flat.take(first + split) > cut.take(node))
    node -= 2**level - 1
    tried = _tried(seed, forest, tree, level, size)
    starts, places = _places(tried, n_bins)
    own = tried.take(node, axis=0)
    own += first[:, None]
    own = (2 * starts).take(node, axis=0) + flat.take(own)
    weights = np.repeat(drawn.astype("float64"), own.shape[1])
    return np.bincount(own.ravel(), weights, 2 * places).astype("int64")


def _node_counts(model, sizes, growth: Growth, level: int, parts: int):
    """Rows of blocks to rows ``(forest, trees, counts)`` of each group of trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                forest, block, part = (batch[c][i].as_py() for c in ("forest", "block", "part"))
                trees = model.value[forest]
                bins, label, fitted, _ = _cells(batch["cells"][i])
                codes = _codes(bins, label)
                at = growth.seed, forest, block
                total = len(trees.feature)
                groups = range(0, total, GROUP_TREES)
                for first in list(groups)[part::parts]:
                    counts = [
                        _count(codes, fitted, trees, t, at, level, sizes[forest])
                        for t in range(first, min(first + GROUP_TREES, total))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([forest], pa.int32()),
                            pa.array([first], pa.int32()),
                            pa.array([np.concatenate(counts).tobytes()], pa.binary()),
                        ],
                        ["forest", "first", "counts"],
                    )

    return run


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity times rows."""
    return total - (counts**2).sum(axis=-1) / np.maximum(total, 1)


def best_splits(counts: np.ndarray):
    """Place among the tried features, last bin to the left, gain and counts of both sides of the
    best split of each node, from counts by node, tried feature, bin and class."""
    left = counts.cumsum(axis=2)
    whole = left[:, :1, -1:, :]
    right = whole - left
    sides = [side.sum(axis=-1) for side in (left, right)]
    rows = whole.sum(axis=-1)
    gain = _gini(whole, rows) - _gini(left, sides[0]) - _gini(right, sides[1])
    gain = np.where((sides[0] > 0) & (sides[1] > 0), gain / np.maximum(rows, 1), 0.0)
    nodes, _, bins = gain.shape
    best = gain.reshape(nodes, -1).argmax(axis=1)
    feature, cut, each = best // bins, best % bins, np.arange(nodes)
    below = np.stack([left[each, feature, cut], right[each, feature, cut]], axis=1)
    return feature, cut, gain[each, feature, cut], whole[:, 0, 0], below


def _chosen(sizes, growth: Growth, level: int, trees: int):
    """Sum the counts of a group of trees over the blocks, and split each node."""

    def run(table: pa.Table) -> pa.Table:
        forest, first = table["forest"][0].as_py(), table["first"][0].as_py()
        total = sum(np.frombuffer(c.as_buffer(), "int64") for chunk in table["counts"].chunks for c in chunk)
        n_bins, found, at = sizes[forest], [], 0
        for tree in range(first, min(first + GROUP_TREES, trees)):
            tried = _tried(growth.seed, forest, tree, level, len(n_bins))
            starts, places = _places(tried, n_bins)
            own = total[at : at + 2 * places].reshape(places, 2)
            at += 2 * places
            # Bins that a feature lacks stay empty; a split after them leaves no row on the right.
            bins = np.arange(growth.max_bins)
            there = bins < n_bins[tried][:, :, None]
            spread = np.where(there, starts[:, :, None] + bins, 0)
            counts = np.where(there[..., None], own[spread], 0).astype("float64")
            feature, cut, gain, whole, below = best_splits(counts)
            feature = np.where(gain > LEAST_GAIN, tried[np.arange(len(tried)), feature], -1)
            below = np.where((feature >= 0)[:, None, None], below, 0)
            found.append([feature.astype("int32"), cut.astype("uint8"), whole, below])
        parts = [pa.array([np.stack(x).tobytes()], pa.binary()) for x in zip(*found)]
        keys = [pa.array([forest], pa.int32()), pa.array([first], pa.int32())]
        return pa.Table.from_arrays([*keys, *parts], ["forest", "first", *_SPLIT])

    return run


_SPLIT = ("feature", "cut", "counts", "below")


class CountedRows:
    """Rows of labelled vectors as counted cells, for a forest without each fold and one of all.

    Forest ``f`` is fitted on all folds but ``f`` and scored on that one; forest ``folds`` is fitted
    on all rows.
    """

    def __init__(self, work: Workspace, rows: DataFrame, folds: int, growth: Growth):
        """``rows`` are ``(fold, label, features)``; what is stored belongs to ``work``."""
        self._spark, self.folds, self.growth = rows.sparkSession, folds, growth
        rows = rows.select(
            "fold",
            F.col("label").cast("double").alias("label"),
            vector_to_array("features").alias("values"),
        )
        forests = F.filter(F.sequence(F.lit(0), F.lit(folds)), lambda f: f != F.col("fold"))
        self.ends = bin_ends(
            rows.select(F.explode(forests).alias("forest"), "values"), growth.max_bins
        )
        self._sizes = {f: np.array([len(c) + 1 for c in own]) for f, own in self.ends.items()}
        layout = "forest int, bins binary, label int, held boolean"
        binned = rows.mapInArrow(_binned(self.ends, folds), layout)
        counted = work.stage(
            binned.groupBy("forest", "bins", "label").agg(
                F.count_if(~F.col("held")).alias("fitted"), F.count_if("held").alias("held")
            ),
            "forest-cells",
        )
        most = counted.groupBy("forest").count().agg(F.max("count")).first()[0]
        self._blocks = math.ceil(most / BLOCK_CELLS)
        block = F.pmod(F.xxhash64("bins"), F.lit(self._blocks)).cast("int").alias("block")
        cell = F.struct("bins", "label", "fitted", "held")
        self._cells = work.stage(
            counted.groupBy("forest", block).agg(F.array_sort(F.collect_list(cell)).alias("cells")),
            "forest-blocks",
        )

    def grow(self, forests: Sequence[int], trees: int) -> dict[int, Trees]:
        """Trees of the forests, level by level, each level one job over all blocks."""
        growth, sizes = self.growth, self._sizes
        found = {f: Trees.empty(trees, growth.depth) for f in forests}
        tasks = 4 * self._spark.sparkContext.defaultParallelism
        parts = max(1, min(tasks // (len(forests) * self._blocks), math.ceil(trees / GROUP_TREES)))
        blocks = self._cells.filter(F.col("forest").isin(list(forests)))
        units = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        if parts > 1:
            units = units.repartition(len(forests) * self._blocks * parts)
        keys = "forest int, first int"
        for level in range(growth.depth):
            model = self._spark.sparkContext.broadcast(found)
            counted = units.mapInArrow(
                _node_counts(model, sizes, growth, level, parts), f"{keys}, counts binary"
            )
            splits = counted.groupBy("forest", "first").applyInArrow(
                _chosen(sizes, growth, level, trees),
                keys + "".join(f", {c} binary" for c in _SPLIT),
            )
            for r in splits.collect():
                own = slice(r.first, min(r.first + GROUP_TREES, trees))
                n, nodes = own.stop - own.start, 2**level
                found[r.forest].add(
                    level,
                    own,
                    np.frombuffer(r.feature, "int32").reshape(n, nodes),
                    np.frombuffer(r.cut, "uint8").reshape(n, nodes),
                    np.frombuffer(r.counts, "float64").reshape(n, nodes, 2),
                    np.frombuffer(r.below, "float64").reshape(n, nodes, 2, 2),
                )
            model.destroy()
        return {f: own.merged() for f, own in found.items()}

    def held_out_scores(self, found: dict[int, Trees], tree_counts: Sequence[int]) -> DataFrame:
        """``(fold, label, n, scores)``: mean votes of the first trees, as many as each count says."""
        model = self._spark.sparkContext.broadcast(found)
        blocks = self._cells.filter(F.col("forest").isin(list(found)))
        return blocks.mapInArrow(
            _scores(model, list(tree_counts), self.growth.depth),
            "fold int, label double, n double, scores array<double>",
        )

    def model(self, forest: RandomForestClassifier, trees: Trees) -> RandomForestClassificationModel:
        """Spark's model of the trees fitted on all rows, read from a stored table of their nodes."""
        return _spark_model(self._spark, forest, trees, self.ends[self.folds])


def _scores(model, tree_counts: list[int], depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                forest = batch["forest"][i].as_py()
                trees = model.value[forest]
                bins, label, _, held = _cells(batch["cells"][i])
                rows = np.flatnonzero(held)
                if len(rows):
                    scores = _votes(trees, bins[rows], tree_counts, depth)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([forest] * len(rows), pa.int32()),
                            pa.array(label[rows].astype("float64")),
                            pa.array(held[rows].astype("float64")),
                            pa.array(list(scores), pa.list_(pa.float64())),
                        ],
                        ["fold", "label", "n", "scores"],
                    )

    return run


def _votes(trees: Trees, bins: np.ndarray, tree_counts: list[int], depth: int) -> np.ndarray:
    """Mean probability of the class 1 over the first trees, a column for each count."""
    probability, each = trees.probability(), np.arange(len(bins))
    summed, out = np.zeros(len(bins)), np.empty((len(bins), len(tree_counts)))
    for tree in range(max(tree_counts)):
        feature, cut = trees.feature[tree], trees.cut[tree]
        node = np.zeros(len(bins), "int64")
        for _ in range(depth):
            split = feature[node]
            below = 2 * node + 1 + (bins[each, split] > cut[node])
            node = np.where(split >= 0, below, node)
        summed += probability[tree][node]
        for i, n in enumerate(tree_counts):
            if n == tree + 1:
                out[:, i] = summed / n
    return out


def _node_table(trees: Trees, ends: list[np.ndarray]) -> pa.Table:
    """Nodes as Spark stores them, numbered in each tree as met from the root, left before right."""
    inner, counts = trees.feature >= 0, trees.counts
    half, size, there = inner.shape[1] // 2, np.ones(inner.shape, "int32"), np.zeros_like(inner)
    number = np.zeros(inner.shape, "int32")
    for node in reversed(range(half)):
        size[:, node] += inner[:, node] * (size[:, 2 * node + 1] + size[:, 2 * node + 2])
    there[:, 0] = True
    for node in range(half):
        left, right = 2 * node + 1, 2 * node + 2
        there[:, left] = there[:, right] = there[:, node] & inner[:, node]
        number[:, left] = number[:, node] + 1
        number[:, right] = number[:, left] + size[:, left]
    tree, node = np.nonzero(there)
    splits = inner[tree, node]
    left = np.where(splits, 2 * node + 1, 0)
    right = np.where(splits, 2 * node + 2, 0)
    own, rows = counts[tree, node], counts[tree, node].sum(axis=1)
    impure = _gini(counts, counts.sum(axis=2))
    gain = (impure[tree, node] - impure[tree, left] - impure[tree, right]) / np.maximum(rows, 1)
    feature = trees.feature[tree, node]
    end = [ends[f][c] for f, c in zip(feature[splits], trees.cut[tree, node][splits])]

    def lists(lengths, values) -> pa.Array:
        starts = np.concatenate(([0], np.cumsum(lengths))).astype("int32")
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(values, pa.float64()))

    none = np.full(len(tree), -1, "int32")
    split = pa.StructArray.from_arrays(
        [pa.array(feature), lists(splits, end), pa.array(none)],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    columns = {
        "id": pa.array(number[tree, node]),
        "prediction": pa.array((own[:, 1] > own[:, 0]).astype("float64")),
        "impurity": pa.array(impure[tree, node] / np.maximum(rows, 1)),
        "impurityStats": lists(np.full(len(tree), 2), own.ravel()),
        "rawCount": pa.array(rows.astype("int64")),
        "gain": pa.array(np.where(splits, gain, -1.0)),
        "leftChild": pa.array(np.where(splits, number[tree, left], none)),
        "rightChild": pa.array(np.where(splits, number[tree, right], none)),
        "split": split,
    }
    data = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    return pa.table([pa.array(tree.astype("int32")), data], ["treeID", "nodeData"])


def _spark_model(spark, forest: RandomForestClassifier, trees: Trees, ends) -> RandomForestClassificationModel:
    size, kind = len(trees.feature), "org.apache.spark.ml.classification."
    shared = {
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "defaultParamMap": {"impurity": forest.getImpurity()},
    }

    def said(name: str, uid: str, params: list, **more) -> str:
        own = {p.name: forest.getOrDefault(p) for p in params}
        return json.dumps({"class": kind + name, "uid": uid, "paramMap": own} | shared | more)

    tree_params = [forest.maxDepth, forest.maxBins, forest.seed]
    forest_params = [p for p in forest.params if forest.isSet(p) and p.name != "numTrees"]
    each = [
        (t, said("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", tree_params), 1.0)
        for t in range(size)
    ]
    whole = said(
        "RandomForestClassificationModel",
        forest.uid,
        [*forest_params, forest.numTrees],
        numFeatures=len(ends),
        numClasses=2,
        numTrees=size,
    )
    path = shared_path(spark, "forest-model")
    try:
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(_node_table(trees, ends)).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)
    finally:
        delete_path(spark, path)
