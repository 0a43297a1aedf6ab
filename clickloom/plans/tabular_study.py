"""Binary classification study on a table: cleaning, linear and tree models, predictions."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..operators.cleaning import coerce_numeric, impute_mean
from ..operators.encoders import observed_levels, one_hot, standardize
from ..operators.forest import CountedRows, Growth
from ..operators.linear import inverse_strength
from ..operators.metrics import roc_auc
from ..operators.splits import hash_share, train_test_split
from ..storage import Workspace, stage

# The grids searched, folds, split share and seed.
C_GRID = (100.0, 10.0, 1.0, 0.1, 0.01, 0.001)
LEARNING_RATES = (0.03, 0.1)
DEPTHS = (4, 6, 10)
LEAF_PENALTIES = (1.0, 3.0, 5.0, 7.0, 9.0)
TREE_COUNTS = (50, 100, 500, 1000, 2000)
FOLDS = 5
# Boosting rounds unless the caller sets another number.
BOOSTING_ROUNDS = 20
TRAIN_SHARE = 0.8
SEED = 42
PARALLELISM = 4


@dataclass(frozen=True)
class Table:
    """Column roles of a study table."""

    id: str
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    dirty: tuple[str, ...] = ()


@dataclass(frozen=True)
class Parts:
    """Prepared train and test rows with their vector ``features`` and double ``label``.

    ``max_bins`` is what a tree needs to split the widest categorical feature.
    """

    train: DataFrame
    test: DataFrame
    max_bins: int = 32


def clean(rows: DataFrame, table: Table, fit_on: DataFrame | None = None) -> DataFrame:
    """Dirty numbers become null, null numbers become the mean of ``fit_on``."""
    columns = list(table.numeric)
    source = coerce_numeric(fit_on if fit_on is not None else rows, table.dirty)
    return impute_mean(coerce_numeric(rows, table.dirty), columns, source)


def split(rows: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Raw train and test rows, 80 to 20, from one stored copy."""
    parts = stage(train_test_split(rows, table.id, TRAIN_SHARE, SEED), "study-parts")
    return (
        parts.filter(F.col("part") == "train").drop("part"),
        parts.filter(F.col("part") == "test").drop("part"),
    )


def _labelled(rows: DataFrame, table: Table) -> DataFrame:
    return rows.withColumn("label", F.col(table.target).cast("double"))


def linear_parts(
    rows: DataFrame, table: Table, levels: dict[str, Sequence[str]] | None = None
) -> Parts:
    """One-hot columns and numbers, all scaled by the train rows, as one vector.

    Both parts are stored, because each fit reads the train rows many times.
    """
    train, test = split(rows, table)
    levels = levels or observed_levels(rows, table.categorical)
    wide_train = stage(one_hot(clean(train, table), levels), "study-train")
    wide_test = one_hot(clean(test, table, fit_on=train), levels)
    columns = [c for c in wide_train.columns if c not in (table.id, table.target)]
    assembler = VectorAssembler(inputCols=columns, outputCol="features")

    def prepared(part: DataFrame, name: str) -> DataFrame:
        scaled = assembler.transform(standardize(part, columns, fit_on=wide_train))
        return stage(_labelled(scaled, table).select(table.id, "label", "features"), name)

    return Parts(prepared(wide_train, "linear-train"), prepared(wide_test, "linear-test"))


def tree_parts(rows: DataFrame, table: Table) -> Parts:
    """Indexed categories and raw numbers as one vector; trees split categories as such."""
    train, test = split(rows, table)
    indexed = [f"{c}_index" for c in table.categorical]
    pipeline = Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(table.categorical), outputCols=indexed, handleInvalid="keep"
            ),
            VectorAssembler(inputCols=[*table.numeric, *indexed], outputCol="features"),
        ]
    )
    clean_train = clean(train, table)
    model = pipeline.fit(clean_train)

    def prepared(part: DataFrame) -> DataFrame:
        # The vector column's metadata names its categorical entries; a stored copy keeps it.
        frame = _labelled(model.transform(part), table).select(table.id, "label", "features")
        return stage(frame, "tree-part")

    widest = max((len(labels) + 1 for labels in model.stages[0].labelsArray), default=0)
    test_part = prepared(clean(test, table, fit_on=train))
    return Parts(prepared(clean_train), test_part, max(Parts.max_bins, widest))


def _auc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)


def with_folds(rows: DataFrame, id_column: str, folds: int = FOLDS) -> DataFrame:
    """Add ``fold``, from 0 on, by a seeded hash of the id: the same however rows are partitioned."""
    share = hash_share(f"fold-{SEED}", id_column)
    return rows.withColumn("fold", F.floor(share * folds).cast("int"))


def _cross_validate(
    estimator: Estimator, grid: list, train: DataFrame, evaluator, id_column: str
) -> CrossValidatorModel:
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=FOLDS,
        foldCol="fold",
        parallelism=PARALLELISM,
        seed=SEED,
    )
    return validator.fit(with_folds(train, id_column))


def search_results(spark, grid: list, scores: Sequence[float]) -> DataFrame:
    """One row per grid point: its parameters, its mean score, and whether it is the best."""
    best = max(scores)
    rows = []
    for n, (point, score) in enumerate(zip(grid, scores)):
        named = ", ".join(
            f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name)
        )
        rows.append((n, named, float(score), bool(score == best)))
    # At most one row per point of the caller's grid.
    return spark.createDataFrame(rows, "point int, params string, score double, best boolean")


def search_logistic(
    train: DataFrame, id_column: str, c_grid: Sequence[float] = C_GRID
) -> CrossValidatorModel:
    """Five-fold search of the inverse regularisation strength by ROC-AUC.

    The strength counts against the rows a fold is fitted on, which are all but one part.
    """
    n = train.count() * (FOLDS - 1) / FOLDS
    lr = LogisticRegression(standardization=False)
    grid = ParamGridBuilder().addGrid(lr.regParam, [inverse_strength(c, n) for c in c_grid])
    return _cross_validate(lr, grid.build(), train, _auc(), id_column)


def fit_boosted(
    train: DataFrame, held_out: DataFrame | None = None, max_iter: int = BOOSTING_ROUNDS, **params
) -> Model:
    """Boosted trees; with ``held_out`` rows, boosting stops once they no longer improve.

    These rows steer the fit, so they must not be the rows the model is judged by.
    """
    gbt = GBTClassifier(maxIter=max_iter, seed=SEED, **params)
    if held_out is None:
        return gbt.fit(train)
    marked = train.withColumn("held_out", F.lit(False)).unionByName(
        held_out.withColumn("held_out", F.lit(True))
    )
    return gbt.setValidationIndicatorCol("held_out").fit(marked)


@dataclass(frozen=True)
class Search:
    """Grid points with their scores on held-out rows, and the model of the best one."""

    grid: list
    scores: list[float]
    best: Model


def search_boosted(
    train: DataFrame,
    id_column: str,
    learning_rates: Sequence[float] = LEARNING_RATES,
    depths: Sequence[int] = DEPTHS,
    leaf_penalties: Sequence[float] = LEAF_PENALTIES,
    max_iter: int = BOOSTING_ROUNDS,
    **params,
) -> Search:
    """Search of step size, depth and leaf regularisation on one held-out fold.

    Spark's boosted trees have no leaf penalty; a least gain per split, growing with the penalty,
    takes its place.
    """
    gbt = GBTClassifier(maxIter=max_iter, seed=SEED, **params)
    grid = (
        ParamGridBuilder()
        .addGrid(gbt.stepSize, list(learning_rates))
        .addGrid(gbt.maxDepth, list(depths))
        .addGrid(gbt.minInfoGain, [p / 1000 for p in leaf_penalties])
        .build()
    )
    folded = with_folds(train, id_column)
    fitted, held = folded.filter("fold > 0"), folded.filter("fold = 0")
    scores: list[float] = [0.0] * len(grid)
    models: list[Model | None] = [None] * len(grid)
    points = gbt.fitMultiple(fitted, grid)

    def one(_) -> None:
        n, model = next(points)
        models[n], scores[n] = model, _auc().evaluate(model.transform(held))

    with ThreadPoolExecutor(PARALLELISM) as pool:
        list(pool.map(one, grid))
    best = gbt.copy(grid[scores.index(max(scores))]).fit(train)
    return Search(grid, scores, best)


def search_forest(
    train: DataFrame, id_column: str, tree_counts: Sequence[int] = TREE_COUNTS
) -> CrossValidatorModel:
    """Five-fold search of the number of trees by ROC-AUC; the best forest is fitted on all rows.

    A forest of n trees is the first n trees of a larger one, so each fold grows the largest forest
    and every count is scored on its own part of it.
    """
    forest = RandomForestClassifier(seed=SEED)
    grid = ParamGridBuilder().addGrid(forest.numTrees, list(tree_counts)).build()
    auc = _auc().setRawPredictionCol("score").setWeightCol("n")
    validator = CrossValidator(
        estimator=forest, estimatorParamMaps=grid, evaluator=auc, numFolds=FOLDS, foldCol="fold", seed=SEED
    )
    with Workspace(train.sparkSession) as work:
        rows = CountedRows(work, with_folds(train, id_column), FOLDS, Growth.of(forest))
        grown = rows.grow(range(FOLDS), max(tree_counts))
        scored = work.stage(rows.held_out_scores(grown, tree_counts), "forest-scores")

        def one(point: tuple[int, int]) -> float:
            fold, n = point
            held = scored.filter(F.col("fold") == fold)
            return auc.evaluate(held.select("label", "n", F.get("scores", n).alias("score")))

        points = [(fold, n) for fold in range(FOLDS) for n in range(len(grid))]
        with ThreadPoolExecutor(PARALLELISM) as pool:
            found = np.reshape(list(pool.map(one, points)), (FOLDS, len(grid)))
        means = found.mean(axis=0)
        best = forest.copy(grid[int(means.argmax())])
        model = rows.model(best, rows.grow([FOLDS], best.getNumTrees())[FOLDS])
    searched = CrossValidatorModel(model, means.tolist(), [], found.std(axis=0).tolist())
    return validator._copyValues(searched)


def cross_validated_accuracy(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    estimator: LogisticRegression,
    id_column: str,
) -> list[float]:
    """Mean accuracy over five folds of a scaler and a classifier, fitted anew in each fold."""
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
            estimator,
        ]
    )
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    labelled = rows.withColumn("label", F.col(label).cast("double"))
    found = _cross_validate(pipeline, [{}], labelled, evaluator, id_column)
    return [float(v) for v in found.avgMetrics]


def predictions(model: Model, rows: DataFrame, id_column: str) -> DataFrame:
    """``(id, label, predicted, probability)`` of each row; probability of the class 1."""
    scored = model.transform(rows)
    return scored.select(
        id_column,
        "label",
        F.col("prediction").alias("predicted"),
        vector_to_array("probability")[1].alias("probability"),
    )


def hold_out_auc(model: Model, test: DataFrame, id_column: str) -> DataFrame:
    """One row with the ROC-AUC of the probabilities and of the hard predictions."""
    scored = predictions(model, test, id_column)
    soft = roc_auc(scored, "label", "probability").scalar()
    hard = roc_auc(scored, "label", "predicted").withColumnRenamed("roc_auc", "roc_auc_hard")
    return hard.select(soft.alias("roc_auc"), "roc_auc_hard")
