"""Gender and age class of a user from the domains they visit: training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, IndexToString
from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import sparse_vector
from ..operators.domains import domain_totals, top_domains
from ..operators.encoders import label_indexer
from ..operators.visits import domain_tokens, user_domain_counts
from ..storage import stage

# Most vocabulary terms, iterations and ridge strength of the trainer.
VOCABULARY_SIZE = 2**18
MAX_ITER = 10
REG_PARAM = 0.001
TARGET = "gender_age"


def vocabulary_terms(counts: DataFrame, size: int = VOCABULARY_SIZE) -> list[str]:
    """All domains, the most frequent first; ties in alphabetical order.

    A fitted bag-of-words model holds its terms on the driver, so more than ``size`` domains are
    refused; pass the counts of the domains that shall be terms.
    """
    rows = top_domains(domain_totals(counts), size + 1).collect()
    if len(rows) > size:
        raise ValueError(f"more than {size} domains for the vocabulary")
    rows.sort(key=lambda r: (-r["count"], r["domain"]))
    return [r["domain"] for r in rows]


def bag_of_domains(counts: DataFrame, terms: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``(*keys, features)``: counts of the vocabulary terms as an ML vector.

    Equal to counting a user's full token list, but built from per-domain counts: a user's entry
    list is bounded by the vocabulary, however many visits they made. Users without any known
    term get the zero vector.
    """
    spark = counts.sparkSession
    index = spark.createDataFrame(list(enumerate(terms)), "pos int, domain string")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "cnt"))
    entries = (
        counts.join(F.broadcast(index), "domain", "left")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    vector = sparse_vector(F.lit(len(terms)), F.col("entries"))
    return entries.select(*keys, vector.alias("features"))


def train(visits: DataFrame, strip: str = "prefix", **params) -> PipelineModel:
    """Fit on labelled visits ``(uid, gender_age, timestamp, url)``; see `train_counts`."""
    return train_counts(user_domain_counts(visits, strip, ("uid", TARGET)), **params)


def train_counts(
    counts: DataFrame,
    vocabulary_size: int = VOCABULARY_SIZE,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
) -> PipelineModel:
    """Fit on labelled counts ``(uid, gender_age, domain, cnt)``.

    The model takes rows with a token array ``domain_features`` and adds
    ``prediction_gender_age``; the label column may be absent when scoring.
    """
    keys = ("uid", TARGET)
    counts = stage(counts.filter(F.col(TARGET).isNotNull()), "domain-counts")
    terms = vocabulary_terms(counts, vocabulary_size)
    users = stage(bag_of_domains(counts, terms, keys), "training-rows")
    indexer = label_indexer(users, TARGET)
    classifier = LogisticRegression(maxIter=max_iter, regParam=reg_param, aggregationDepth=2)
    model = classifier.fit(indexer.transform(users))
    indexer.setHandleInvalid("keep")  # scored rows may carry a label unseen in training
    bag = CountVectorizerModel.from_vocabulary(terms, "domain_features", "features")
    names = IndexToString(
        inputCol="prediction", outputCol=f"prediction_{TARGET}", labels=indexer.labels
    )
    return PipelineModel(stages=[bag, indexer, model, names])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_logs(model: PipelineModel, logs: DataFrame, strip: str = "prefix") -> DataFrame:
    """``(uid, gender_age)`` of each nested log row, batch or stream.

    The prediction uses the visits of that row only.
    """
    tokens = domain_tokens(logs, strip).select("uid", "domain_features")
    scored = model.transform(tokens)
    return scored.select("uid", F.col(f"prediction_{TARGET}").alias(TARGET))


def score_counts(model: PipelineModel, counts: DataFrame) -> DataFrame:
    """``(uid, gender_age)`` of each user from their counts ``(uid, domain, cnt)``."""
    bag, _, classifier, names = model.stages
    users = bag_of_domains(counts, bag.vocabulary, ["uid"])
    scored = names.transform(classifier.transform(users))
    return scored.select("uid", F.col(f"prediction_{TARGET}").alias(TARGET))
