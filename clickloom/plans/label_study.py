"""Classification of labelled vectors: split, label encoder, linear head, report."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import argmax
from ..operators.encoders import label_indexer
from ..operators.metrics import classification_report
from ..operators.splits import stratified_split
from ..storage import stage


def fit_head(
    train: DataFrame, labels_from: DataFrame, label: str = "label", max_iter: int = 30
) -> PipelineModel:
    """Linear classifier on frozen feature vectors.

    ``labels_from`` holds all labelled rows: one encoder, alphabetical, serves every part.
    """
    encoder = label_indexer(labels_from, label, "label_index", "alphabetAsc")
    head = LogisticRegression(
        featuresCol="vector", labelCol="label_index", family="multinomial", maxIter=max_iter
    )
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=encoder.labels)
    vectors = train.withColumn("vector", array_to_vector("features"))
    # Rows without a label are not learned from. Only once the training rows have their classes
    # may scoring meet unknown labels; else these would count as one more class.
    encoder.setHandleInvalid("skip")
    prepared = stage(encoder.transform(vectors).select("label_index", "vector"), "head-train")
    encoder.setHandleInvalid("keep")
    return PipelineModel(stages=[encoder, head.fit(prepared), names])


def predict(model: PipelineModel, rows: DataFrame, id_column: str) -> DataFrame:
    """``(id, label, class_index, predicted, probabilities)`` of each row."""
    scored = model.transform(rows.withColumn("vector", array_to_vector("features")))
    probabilities = vector_to_array("probability")
    return scored.select(
        id_column,
        "label",
        argmax(probabilities).alias("class_index"),
        "predicted",
        probabilities.alias("probabilities"),
    )


def run(
    rows: DataFrame, id_column: str, label: str = "label"
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model, hold-out predictions and hold-out report of a 75 to 25 stratified study."""
    parts = stage(stratified_split(rows, id_column, label), "label-study")
    model = fit_head(parts.filter(F.col("part") == "train"), parts, label)
    scored = predict(model, parts.filter(F.col("part") == "test"), id_column)
    actual = scored.withColumn("actual", F.col("label").cast("string"))
    return model, scored, classification_report(actual, "actual", "predicted")
