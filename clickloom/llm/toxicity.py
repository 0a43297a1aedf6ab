"""Toxicity: a factorization machine over hashed terms.

Terms are a text's words and the leading characters of its words, hashed into a fixed number of
features; a feature's value falls with the number of terms of the text. Each feature has a weight
and a short vector. The score of a text is the logistic function of the weighted sum plus the inner
products of all pairs of vectors, so that pairs of terms count beyond what either adds alone.

The machine is fitted on a bounded sample of the labelled rows (``sample_rows``, by a hash of the
id, from all of them): their hashed terms go to one task, which runs a fixed number of passes. All
texts are scored whole.

Null and empty texts have no terms and score the bias alone. Rows with a null label are not learned
from. Repeated rows are learned from as often as they occur and score alike. Without any row to
learn from, every score is 0. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_fields, text_udf

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
FEATURES = 1 << 18
# A feature's value is this over the root of the number of features of its text.
VALUE_SCALE = 3.0
# Steps of the vectors against those of the weights.
VECTOR_RATE = 0.3
# Hashed words a worker remembers.
REMEMBERED = 300_000

FIELDS = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds what the fit sees; features of fewer than ``least_texts`` texts of the
    sample are ignored, and so are those whose number of toxic texts is within ``least_deviation``
    standard deviations of what chance gives; the rest are those of the optimiser."""

    sample_rows: int = 12_000
    least_texts: int = 5
    least_deviation: float = 3.5
    factors: int = 4
    passes: int = 8
    batch: int = 128
    rate: float = 0.2
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights`` and ``vectors`` hold a row for each known feature; ``row_of`` has the row of each
    hashed feature, or their number for an unknown one."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    row_of: np.ndarray

    def rows(self, features: list[int]) -> np.ndarray:
        """Rows of a text's known features."""
        found = self.row_of[np.asarray(features, np.int64)]
        return found[found < len(self.weights)]


class Terms:
    """Hashed terms of texts; the hashes of words met before are remembered."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            names = [f"w {word}", *(f"p {word[:n]}" for n in PREFIXES if len(word) >= n)]
            found = tuple(zlib.crc32(n.encode()) % FEATURES for n in names)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def __call__(self, text: str) -> list[int]:
        """Distinct features of a text, in order."""
        distinct: set[int] = set()
        for word in set(WORD.findall(text.lower())):
            distinct.update(self.of_word(word))
        return sorted(distinct)


def _value(counts):
    """Value of each feature of a text with so many of them."""
    return VALUE_SCALE / np.sqrt(np.maximum(counts, 1))


def margins(model: Model, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Scores before the logistic function of texts whose features lie one after another."""
    out = np.full(len(counts), model.bias, "float64")
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[filled]
    value = _value(counts[filled])
    out[filled] += value * np.add.reduceat(model.weights[flat], starts)
    vectors = model.vectors[flat]
    sums = np.add.reduceat(vectors, starts)
    squares = np.add.reduceat((vectors * vectors).sum(1), starts)
    out[filled] += 0.5 * value**2 * ((sums * sums).sum(1) - squares)
    return out


def train(samples: list[tuple[np.ndarray, int]], settings: Settings) -> Model:
    """Minibatch AdaGrad on the logistic loss; both classes weigh alike."""
    rng = np.random.default_rng(settings.seed)
    texts = np.bincount(np.concatenate([f for f, _ in samples]).astype(int), minlength=FEATURES)
    toxic = np.bincount(
        np.concatenate([f for f, y in samples if y] or [np.zeros(0)]).astype(int),
        minlength=FEATURES,
    )
    labels = np.array([y for _, y in samples], float)
    share = labels.mean()
    spread = np.sqrt(np.maximum(texts * share * (1 - share), 1e-9))
    telling = np.abs(toxic - texts * share) >= settings.least_deviation * spread
    known = np.flatnonzero((texts >= settings.least_texts) & telling)
    row_of = np.full(FEATURES, len(known), "int32")
    row_of[known] = np.arange(len(known))
    weights = np.zeros(len(known), "float32")
    vectors = rng.normal(0, 0.01, (len(known), settings.factors)).astype("float32")
    model = Model(0.0, weights, vectors, row_of)
    if share in (0.0, 1.0):
        return Model(4.0 if share else -4.0, weights, 0 * vectors, row_of)
    past_w = np.full(weights.shape, 1e-6, "float32")
    past_v = np.full(vectors.shape, 1e-6, "float32")
    cost = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    found = [model.rows(f) for f, _ in samples]
    bias, past_b = 0.0, 1e-6
    for _ in range(settings.passes):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), settings.batch):
            texts = [t for t in order[start : start + settings.batch] if len(found[t])]
            if not texts:
                continue
            counts = np.array([len(found[t]) for t in texts])
            flat = np.concatenate([found[t] for t in texts])
            value = _value(counts)
            margin = margins(Model(bias, weights, vectors, row_of), flat, counts)
            off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[texts]
            off = off * cost[texts] / len(texts)
            of_text = np.repeat(np.arange(len(texts)), counts)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            sums = np.add.reduceat(vectors[flat], starts)
            slope_w = (off * value)[of_text]
            slope_v = (off * value**2)[of_text][:, None] * (sums[of_text] - vectors[flat])
            used, where = np.unique(flat, return_inverse=True)
            grad_w = np.bincount(where, slope_w, len(used)) + settings.decay * weights[used]
            grad_v = np.stack(
                [np.bincount(where, slope_v[:, k], len(used)) for k in range(settings.factors)], 1
            )
            grad_v += settings.decay * vectors[used]
            past_w[used] += grad_w**2
            past_v[used] += grad_v**2
            weights[used] -= settings.rate * grad_w / np.sqrt(past_w[used])
            vectors[used] -= VECTOR_RATE * settings.rate * grad_v / np.sqrt(past_v[used])
            past_b += off.sum() ** 2
            bias -= settings.rate * off.sum() / np.sqrt(past_b)
    return Model(float(bias), weights, vectors, row_of)


def fit(
    rows: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Model | None:
    """Fit on a sample of about ``settings.sample_rows`` labelled rows; None without any."""
    known = rows.filter(F.col(label).isNotNull())
    total = known.count()
    if not total:
        return None
    part = F.pmod(F.xxhash64(F.lit(settings.seed), F.col(id_column)), F.lit(1_000_000))
    sample = known.filter(part < int(1_000_000 * min(1.0, settings.sample_rows / total)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            lists = [terms(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.list_(pa.int32())), batch.column(1)], ["features", "label"]
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for batch in batches:
            lists, labels = batch.column(0), batch.column(1).to_pylist()
            samples += [
                (lists[i].values.to_numpy(zero_copy_only=False), y) for i, y in enumerate(labels)
            ]
        if not samples:
            return
        model = train(samples, settings)
        yield pa.RecordBatch.from_pydict(
            {
                "bias": [model.bias],
                "weights": [model.weights.tobytes()],
                "vectors": [model.vectors.tobytes()],
                "rows": [model.row_of.tobytes()],
            }
        )

    features = sample.select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("label")
    ).mapInArrow(hashed, "features array<int>, label int")
    found = (
        features.repartition(1)
        .mapInArrow(fitted, "bias double, weights binary, vectors binary, rows binary")
        .first()
    )
    if found is None:
        return None
    vectors = np.frombuffer(found.vectors, "float32").reshape(-1, settings.factors)
    weights = np.frombuffer(found.weights, "float32")
    return Model(found.bias, weights, vectors, np.frombuffer(found.rows, "int32"))


def score(
    df: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """Add ``score`` and ``predicted``, 1 from ``threshold`` on."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def per_text(texts):
        own, terms = sent.value, Terms()
        if own is None:
            return [{"score": 0.0, "predicted": 0} for _ in texts]
        found = []
        for raw in texts:
            rows = own.rows(terms((raw or b"").decode()))
            margin = margins(own, rows, np.array([len(rows)]))[0]
            found.append(float(1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
        return [{"score": s, "predicted": int(s >= threshold)} for s in found]

    return add_fields(df, text_udf(FIELDS, per_text)(F.col(text)), FIELDS.names)
