"""Batched inference by models of one's own, loaded once per worker."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

# A model takes ``(rows, values)`` and gives ``(rows, scores)``.
Model = Callable[[np.ndarray], np.ndarray]

# Models of this worker by the name of the call that uses them; the last one only.
_LOADED: dict[str, Model] = {}


def _model(name: str, load: Callable[[], Model]) -> Model:
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = load()
    return _LOADED[name]


def _matrix(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of whole vectors in a batch, and these vectors as a matrix."""
    lengths = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    wrong = lengths[(lengths != size) & (lengths >= 0)]
    if len(wrong):
        raise ValueError(f"a vector has {wrong[0]} values and not {size}")
    there = np.flatnonzero(lengths >= 0)
    flat = vectors.take(pa.array(there)).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype("float64").reshape(len(there), size)
    whole = ~np.isnan(matrix).any(axis=1)
    return there[whole], matrix[whole]


def score_batches(
    rows: DataFrame,
    load: Callable[[], Model],
    size: int,
    vector: str = "features",
    output: str = "scores",
    batch_rows: int = 1024,
) -> DataFrame:
    """Add the scores of each row's vector by the model that ``load`` gives.

    ``load`` runs in the workers, once in each and again only in a worker that replaces a lost one;
    it reads the model's file from shared storage or holds what `broadcast_model` sent. The model
    sees ``batch_rows`` vectors at most, never an empty batch, whatever the size of Arrow's batches,
    and must score each row by itself. Null vectors and vectors with a null or NaN have null scores;
    a vector of another ``size`` fails the job. The other columns stay in the JVM; an input column
    named like the output is replaced.
    """
    name = uuid.uuid4().hex

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(name, load)
        for batch in batches:
            places, matrix = _matrix(batch, size)
            found: list = [None] * len(batch)
            for start in range(0, len(places), batch_rows):
                scores = np.asarray(model(matrix[start : start + batch_rows]), "float64")
                for place, own in zip(places[start : start + batch_rows], scores, strict=True):
                    found[place] = own
            yield pa.array(found, pa.list_(pa.float64()))

    return rows.withColumn(output, score(F.col(vector)))


def class_means(rows: DataFrame, label: str = "label", vector: str = "features") -> DataFrame:
    """``(label, mean)``: the mean vector of each class, from one aggregate per place.

    Rows without a label or with a null vector do not count.
    """
    values = rows.filter(F.col(label).isNotNull()).select(label, F.posexplode(vector))
    means = values.groupBy(label, "pos").agg(F.avg("col").alias("mean"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(label).agg(F.transform(ordered, lambda e: e["mean"]).alias("mean"))


class NearestMean:
    """Scores of a vector: its squared distance from each class mean, in the order of labels."""

    def __init__(self, means: np.ndarray):
        self._means = means

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        gaps = vectors[:, None, :] - self._means[None, :, :]
        return np.einsum("rcv,rcv->rc", gaps, gaps)


def broadcast_model(
    means: DataFrame, label: str = "label", most_classes: int = 10_000
) -> tuple[list, int, Callable[[], Model]]:
    """Labels, vector size and ``load`` of the nearest-mean model of a table of class means.

    The model is sent to every worker, so more than ``most_classes`` are an error.
    """
    held = means.orderBy(label).limit(most_classes + 1).collect()
    if len(held) > most_classes:
        raise ValueError(f"more than {most_classes} classes")
    matrix = np.array([r["mean"] for r in held])
    sent = means.sparkSession.sparkContext.broadcast(matrix)
    return [r[label] for r in held], matrix.shape[1], lambda: NearestMean(sent.value)


def nearest_class(
    rows: DataFrame, labels: list, scores: str = "scores", output: str = "nearest"
) -> DataFrame:
    """Add the label of the least score; of equal ones the first label's, null without scores."""
    least = F.array_position(scores, F.array_min(scores)).cast("int")
    return rows.withColumn(output, F.get(F.array(*map(F.lit, labels)), least - 1))
