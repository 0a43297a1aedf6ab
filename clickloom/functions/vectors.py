"""Expressions over array-of-double columns: scores, soft-max, fixed scaling, sparse vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, functions as F, types as T

# Per-channel mean and standard deviation used to scale colour vectors.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
CHANNEL_MAX = 255.0


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def double_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(x: Column, w: Column) -> Column:
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def with_bias(x: Column | str) -> Column:
    """The feature row with the bias term 1 in front."""
    return F.concat(F.array(F.lit(1.0)), _as_column(x))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def logistic_score(x: Column | str, weights: Sequence[float]) -> Column:
    """Probability of the positive class; ``weights[0]`` is the bias."""
    return sigmoid(dot(with_bias(x), double_array(weights)))


def softmax(scores: Column | str) -> Column:
    """Soft-max, shifted by the greatest score so that no exponent overflows."""
    scores = _as_column(scores)
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda s, v: s + F.exp(v - top))
    return F.transform(scores, lambda v: F.exp(v - top) / total)


def log_softmax_at(scores: Column | str, index: Column | str) -> Column:
    """Logarithm of the soft-max of the entry at the 0-based ``index``."""
    scores = _as_column(scores)
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda s, v: s + F.exp(v - top))
    return F.get(scores, _as_column(index)) - top - F.ln(total)


def argmax(scores: Column | str) -> Column:
    """0-based position of the greatest entry, the first of equal ones."""
    scores = _as_column(scores)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_name(index: Column | str, labels: Column) -> Column:
    """Label at the 0-based ``index`` of the label array."""
    return F.get(labels, _as_column(index))


def element_at_position(values: Column | str, position: int) -> Column:
    """Entry at a 1-based position; null beyond the end."""
    return F.get(_as_column(values), F.lit(position - 1))


def scale_channels(
    pixels: Column | str,
    mean: Sequence[float] = CHANNEL_MEAN,
    std: Sequence[float] = CHANNEL_STD,
    top: float = CHANNEL_MAX,
) -> Column:
    """Scale interleaved channel values to [0, 1] and standardise each by its fixed mean and std."""
    m, s = double_array(mean), double_array(std)
    k = len(mean)
    return F.transform(
        pixels,
        lambda v, i: (v / F.lit(top) - F.get(m, i % k)) / F.get(s, i % k),
    )


def unscale_channels(
    scaled: Column | str,
    mean: Sequence[float] = CHANNEL_MEAN,
    std: Sequence[float] = CHANNEL_STD,
) -> Column:
    """Back from standardised to [0, 1] values, clipped to that range."""
    m, s = double_array(mean), double_array(std)
    k = len(mean)
    return F.transform(
        scaled,
        lambda v, i: F.least(
            F.greatest(v * F.get(s, i % k) + F.get(m, i % k), F.lit(0.0)), F.lit(1.0)
        ),
    )


def dense_counts(entries: Column, size: Column) -> Column:
    """Array of ``size`` counts from position-sorted ``(pos, cnt)`` structs, zeros in the gaps.

    Linear in ``size``: each entry brings the zeros between it and the entry before.
    """
    zero = F.lit(0).cast("long")
    positions = F.transform(entries, lambda e: e["pos"])
    before = F.slice(F.concat(F.array(F.lit(-1)), positions), F.lit(1), F.size(entries))
    filled = F.zip_with(
        entries,
        before,
        lambda e, p: F.concat(F.array_repeat(zero, e["pos"] - p - 1), F.array(e["cnt"])),
    )
    last = F.coalesce(F.array_max(positions), F.lit(-1))
    return F.concat(F.flatten(filled), F.array_repeat(zero, size - last - 1))


def sparse_vector(size: Column, entries: Column) -> Column:
    """ML vector from index-sorted ``(pos, cnt)`` structs.

    Spark has no column function for sparse vectors. The JSON reader fills the vector type from
    its public storage layout, so the rows stay in the JVM.
    """
    layout = F.struct(
        F.struct(
            F.lit(0).alias("type"),
            size.alias("size"),
            F.transform(entries, lambda e: e["pos"]).alias("indices"),
            F.transform(entries, lambda e: e["cnt"].cast("double")).alias("values"),
        ).alias("vector")
    )
    schema = T.StructType([T.StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(layout), schema)["vector"]
