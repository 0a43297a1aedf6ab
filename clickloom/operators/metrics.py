"""Exact classification metrics as distributed aggregates; each returns a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import log_softmax_at
from .ranks import running_sums, value_bounds, with_value_bucket

# Fixed value: probabilities are kept this far from 0 and 1 before the logarithm.
CLIP = 1e-10


def roc_auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of a score against a 0/1 label; equal scores count half.

    Rows are counted per distinct score first. With hard 0/1 predictions as the score this is
    the balanced accuracy.
    """
    scored = rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias("score"), (F.col(label) == 1).alias("positive")
    )
    counts = scored.groupBy("score").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )
    bucketed = with_value_bucket(counts, "score", value_bounds(scored, "score"))
    ranked = running_sums(bucketed, "score", ["neg"])
    won = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))


def binary_log_loss(label: str, probability: str):
    """Clipped log-loss of one row."""
    p = F.least(F.greatest(F.col(probability), F.lit(CLIP)), F.lit(1 - CLIP))
    y = F.col(label)
    return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))


def log_loss(rows: DataFrame, label: str, probability: str) -> DataFrame:
    return rows.agg(F.avg(binary_log_loss(label, probability)).alias("log_loss"))


def cross_entropy(rows: DataFrame, label: str, scores: str) -> DataFrame:
    """Mean multi-class cross-entropy of raw scores; ``label`` is the class position."""
    return rows.agg((-F.avg(log_softmax_at(scores, label))).alias("cross_entropy"))


def accuracy(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    return rows.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def confusion(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(actual, predicted, n)``: one row per pair of classes that occurs."""
    return rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_scores(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(label, precision, recall, f1, support)`` of each class; 0 where undefined."""
    n, hit = F.col("n"), F.col("actual") == F.col("predicted")
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"),
            n.alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(hit, n).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            F.lit(0).cast("long").alias("support"),
            n.alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        confusion(rows, actual, predicted)
        .select(F.inline(sides))
        .groupBy("label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
    )

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return sums.select(
        "label",
        share(F.col("hits"), F.col("predicted")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def classification_report(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Scores per class, then the rows ``macro avg`` and ``weighted avg``."""
    per_class = class_scores(rows, actual, predicted)
    names = ["precision", "recall", "f1"]
    weight = F.col("support")
    macro = per_class.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return (
        per_class.withColumn("label", F.col("label").cast("string"))
        .unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
    )


def weighted_f1(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean of the class F1 scores, weighted by support."""
    weight = F.col("support")
    return class_scores(rows, actual, predicted).agg(
        (F.sum(F.col("f1") * weight) / F.sum(weight)).alias("weighted_f1")
    )
