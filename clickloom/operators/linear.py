"""Elastic-net logistic regression: the objective's gradient, its loss and the fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import double_array, logistic_score, with_bias
from .metrics import binary_log_loss


def logit_scores(
    rows: DataFrame, features: str, weights: Sequence[float], threshold: float = 0.5
) -> DataFrame:
    """Add ``probability`` and the decision ``predicted`` for fixed weights, bias first."""
    scored = rows.withColumn("probability", logistic_score(features, weights))
    return scored.withColumn("predicted", F.col("probability") >= threshold)


def elastic_net_gradient(
    rows: DataFrame,
    features: str,
    label: str,
    weights: Sequence[float],
    l1: float,
    l2: float,
) -> DataFrame:
    """``(pos, gradient)`` of the penalised mean log-loss at the given weights, bias at 0.

    The bias is not penalised. One aggregate with a mean per dimension reads each row once, and
    the shuffle carries one row per task.
    """
    residual = logistic_score(features, weights) - F.col(label)
    terms = rows.select(residual.alias("r"), with_bias(features).alias("x"))
    means = [F.avg(F.col("r") * F.get("x", F.lit(j))) for j in range(len(weights))]
    w = F.get(double_array(weights), F.col("pos"))
    penalty = F.when(F.col("pos") > 0, l1 * F.signum(w) + 2 * l2 * w).otherwise(0.0)
    found = terms.agg(F.array(*means).alias("means"))
    spread = found.select(F.posexplode("means").alias("pos", "mean"))
    return spread.select("pos", (F.col("mean") + penalty).alias("gradient"))


def batch_losses(
    batches: DataFrame, features: str, label: str, weights: Sequence[float]
) -> DataFrame:
    """``(batch, n, loss)``: mean log-loss of each batch at fixed weights."""
    scored = logit_scores(batches, features, weights)
    return scored.groupBy("batch").agg(
        F.count("*").alias("n"), F.avg(binary_log_loss(label, "probability")).alias("loss")
    )


def elastic_net(l1: float, l2: float, max_iter: int = 100, **params) -> LogisticRegression:
    """Estimator of: mean log-loss + ``l1`` * |w| + ``l2`` * |w|², bias unpenalised.

    Spark penalises ``reg * (a |w| + (1 - a) / 2 * |w|²)``.
    """
    reg = l1 + 2 * l2
    return LogisticRegression(
        regParam=reg,
        elasticNetParam=l1 / reg if reg else 0.0,
        standardization=False,
        maxIter=max_iter,
        **params,
    )


def inverse_strength(c: float, n: int) -> float:
    """``regParam`` equal to the inverse regularisation strength ``c`` over ``n`` rows."""
    return 1.0 / (c * n)
