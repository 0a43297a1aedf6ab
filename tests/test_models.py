from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from clickloom.plans import label_study, tabular_study as study
from clickloom.operators import forest, linear
from clickloom.storage import Workspace

TABLE = study.Table("id", "y", ("a", "b"), ("c",), ("b",))


@pytest.fixture(scope="module")
def table_rows(spark):
    rng = np.random.default_rng(11)
    data = []
    for i in range(600):
        a, c = float(rng.normal()), "uvw"[i % 3]
        y = int(a + (c == "u") + rng.normal() * 0.5 > 0.3)
        b = " " if i % 10 == 0 else str(round(float(rng.normal()), 3))
        data.append((i, a, b, c if i % 50 else None, y))
    return spark.createDataFrame(data, "id int, a double, b string, c string, y int")


@pytest.fixture(scope="module")
def linear_parts(table_rows):
    return study.linear_parts(table_rows, TABLE)


def test_linear_parts_are_scaled_by_train(linear_parts):
    train = np.array([r.features.toArray() for r in linear_parts.train.collect()])
    assert train.shape == (480, 5) and linear_parts.test.count() == 120
    assert np.abs(train.mean(axis=0)).max() < 1e-9
    assert train.std(axis=0) == pytest.approx([1.0] * 5)


def test_logistic_search_beats_chance(linear_parts):
    model = study.search_logistic(linear_parts.train, "id", (1.0, 0.001))
    found = study.hold_out_auc(model, linear_parts.test, "id").first()
    assert found.roc_auc > 0.85 and 0.7 < found.roc_auc_hard <= found.roc_auc + 0.05
    assert len(model.avgMetrics) == 2


def test_trees_know_their_categories(table_rows):
    parts = study.tree_parts(table_rows, TABLE)
    attributes = parts.train.schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attributes["nominal"]] == ["c_index"]
    model = study.fit_boosted(parts.train, parts.test, max_iter=5, maxBins=parts.max_bins)
    assert study.hold_out_auc(model, parts.test, "id").first().roc_auc > 0.85


def test_forest_search(linear_parts):
    model = study.search_forest(linear_parts.train, "id", (5, 10))
    assert study.hold_out_auc(model, linear_parts.test, "id").first().roc_auc > 0.8


def test_cross_validated_accuracy(table_rows):
    found = study.cross_validated_accuracy(
        table_rows, ["a"], "y", linear.elastic_net(0.0, 0.01), "id"
    )
    assert len(found) == 1 and found[0] > 0.7


def test_folds_and_searches_do_not_depend_on_partitions(linear_parts):
    found = []
    for parts in (3, 11):
        train = linear_parts.train.repartition(parts)
        folds = {r.id: r.fold for r in study.with_folds(train, "id").collect()}
        search = study.search_logistic(train, "id", (1.0, 0.01))
        boosted = study.search_boosted(train, "id", (0.1,), (3,), (1.0, 9.0), max_iter=3)
        scores = [round(v, 6) for v in [*search.avgMetrics, *boosted.scores]]
        found.append((folds, scores))
        results = study.search_results(train.sparkSession, boosted.grid, boosted.scores).collect()
        assert len(results) == 2 and any(r.best for r in results)
    assert found[0] == found[1]
    assert set(found[0][0].values()) == set(range(study.FOLDS))


def test_stronger_regularisation_for_smaller_c():
    assert linear.inverse_strength(10.0, 100) == pytest.approx(0.001)
    assert isinstance(linear.elastic_net(0.1, 0.1), LogisticRegression)
    assert linear.elastic_net(0.0, 0.0).getRegParam() == 0.0


def test_label_study(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(3, 5)) * 4
    names = ["moe", "bart", "lisa"]
    data = [
        (i, names[i % 3], (centres[i % 3] + rng.normal(size=5)).tolist()) for i in range(240)
    ]
    rows = spark.createDataFrame(data, "id int, label string, features array<double>")
    model, scored, report = label_study.run(rows, "id")
    assert list(model.stages[0].labels) == sorted(names)
    found = scored.collect()
    assert len(found) == 60
    assert all(sorted(names)[r.class_index] == r.predicted for r in found)
    assert all(sum(r.probabilities) == pytest.approx(1) for r in found)
    assert all(len(r.probabilities) == len(names) for r in found)
    unknown = rows.filter("label IS NULL OR id % 2 = 0").selectExpr(
        "id", "if(id % 4 = 0, null, label) AS label", "features"
    )
    head = label_study.fit_head(unknown.dropna(), unknown)
    assert head.stages[1].numClasses == len(names)
    scores = {r.label: r.f1 for r in report.collect()}
    assert scores["weighted avg"] > 0.9 and set(names) < set(scores)
    unlabelled = rows.drop("label").selectExpr("id", "features", "cast(null as string) label")
    assert label_study.predict(model, unlabelled, "id").count() == 240


def _auc_of_first_trees(model, rows, n):
    """ROC-AUC by the votes of the first n trees of a Spark forest."""
    scores, labels = np.zeros(0), np.zeros(0)
    for tree in model.trees[:n]:
        found = sorted((r.id, r.label, r.probability[1]) for r in tree.transform(rows).collect())
        labels = np.array([r[1] for r in found])
        scores = (scores if len(scores) else 0) + np.array([r[2] for r in found])
    ones, zeros = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return ((ones - zeros > 1e-9) + (abs(ones - zeros) <= 1e-9) / 2).mean()


def test_a_larger_forest_holds_the_smaller_ones(linear_parts):
    both = study.search_forest(linear_parts.train, "id", (7, 60))
    for n, score in zip((7, 60), both.avgMetrics):
        alone = study.search_forest(linear_parts.train, "id", (n,))
        assert alone.avgMetrics == [score]
        assert alone.bestModel.getNumTrees == n
    assert [p.name for p in both.getEstimatorParamMaps()[0]] == ["numTrees"]


def test_forests_do_not_depend_on_partitions_or_blocks(linear_parts, monkeypatch):
    found = []
    for parts, cells in ((3, 65536), (11, 65536), (5, 100)):
        monkeypatch.setattr(forest, "BLOCK_CELLS", cells)
        search = study.search_forest(linear_parts.train.repartition(parts), "id", (5, 20))
        found.append(search.avgMetrics)
    assert found[0] == found[1]
    # Other blocks are other draws of the same rows.
    assert found[2] != found[0] and found[2] == pytest.approx(found[0], abs=0.05)


def test_forest_search_is_as_good_as_sparks(linear_parts):
    rows = study.with_folds(linear_parts.train, "id").cache()
    found = study.search_forest(linear_parts.train, "id", (40,))
    scores = []
    for fold in range(study.FOLDS):
        model = RandomForestClassifier(numTrees=40, seed=1).fit(rows.filter(f"fold != {fold}"))
        scores.append(study._auc().evaluate(model.transform(rows.filter(f"fold = {fold}"))))
    assert found.avgMetrics[0] == pytest.approx(np.mean(scores), abs=0.03)


def test_the_stored_forest_votes_as_the_counted_one(spark, linear_parts):
    rows = study.with_folds(linear_parts.train, "id")
    growth = forest.Growth(3, 4, 32)
    with Workspace(spark) as work:
        counted = forest.CountedRows(work, rows, study.FOLDS, growth)
        grown = counted.grow([0], 12)
        # The trees without fold 0, with their bins, as a model of Spark's.
        ends = counted.ends[0]
        model = forest._spark_model(
            spark, RandomForestClassifier(numTrees=12, seed=3, maxDepth=4), grown[0], ends
        )
        scored = counted.held_out_scores(grown, (5, 12)).collect()
    held = rows.filter("fold = 0")
    for i, n in enumerate((5, 12)):
        pairs = [(r.scores[i], r.label, r.n) for r in scored]
        s, y, w = (np.array(x) for x in zip(*pairs))
        ones, zeros = s[y == 1][:, None], s[y == 0][None, :]
        better = (ones - zeros > 1e-9) + (abs(ones - zeros) <= 1e-9) / 2
        weight = w[y == 1][:, None] * w[y == 0][None, :]
        assert (better * weight).sum() / weight.sum() == pytest.approx(
            _auc_of_first_trees(model, held, n)
        )
    assert sum(r.n for r in scored) == held.count() and model.getNumTrees == 12
    votes = {round(r.probability[1], 9) for r in model.transform(held).collect()}
    assert votes == {round(r.scores[1], 9) for r in scored}


def test_a_search_grows_each_fold_once(linear_parts, monkeypatch):
    grown, grow = [], forest.CountedRows.grow

    def seen(rows, forests, trees):
        grown.append((list(forests), trees))
        return grow(rows, forests, trees)

    monkeypatch.setattr(forest.CountedRows, "grow", seen)
    found = study.search_forest(linear_parts.train, "id", (4, 9))
    best = (4, 9)[int(np.argmax(found.avgMetrics))]
    assert grown == [(list(range(study.FOLDS)), 9), ([study.FOLDS], best)]


def test_rows_alike_are_counted_before_they_are_drawn(spark, linear_parts):
    rows = study.with_folds(linear_parts.train, "id")
    sizes = []
    for copies in (1, 20):
        many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        with Workspace(spark) as work:
            counted = forest.CountedRows(work, many, study.FOLDS, forest.Growth(1, 5, 32))
            cells = counted._cells.select("forest", F.explode("cells").alias("c"))
            found = cells.agg(F.count("*"), F.sum("c.fitted"), F.sum("c.held")).first()
            sizes.append((found[0], found[1] // copies, found[2] // copies))
    # Each row is fitted on by the forests of the other folds and of all rows.
    n = rows.count()
    assert sizes[0][1:] == sizes[1][1:] == (study.FOLDS * n, n)
    # Ends of bins lie at ranks, which copies move by less than a row.
    assert sizes[1][0] == pytest.approx(sizes[0][0], rel=0.02)
    # A cell of many rows is drawn as often as each of its rows alone.
    drawn = np.array([forest._drawn(np.array([1000, 1]), 1, 0, t, 0) for t in range(2000)])
    assert drawn.mean(axis=0) == pytest.approx([1000, 1], rel=0.1)
    assert drawn.var(axis=0) == pytest.approx([1000, 1], rel=0.15)


def test_best_split_by_brute_force():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 6, size=(40, 3, 5, 2)).astype(float)
    counts[:, 1:] = rng.permuted(counts[:, :1].repeat(2, 1), axis=2)
    counts[0] = counts[0] * [1, 0]
    place, cut, gain, whole, below = forest.best_splits(counts)

    def gini(c):
        return 1 - ((c / c.sum()) ** 2).sum()

    for n in range(40):
        total, best = counts[n, 0].sum(axis=0), 0.0
        for f in range(3):
            for b in range(4):
                left, right = counts[n, f, : b + 1].sum(axis=0), counts[n, f, b + 1 :].sum(axis=0)
                if left.sum() and right.sum():
                    rest = left.sum() * gini(left) + right.sum() * gini(right)
                    best = max(best, gini(total) - rest / total.sum())
        assert gain[n] == pytest.approx(best, abs=1e-12)
        assert whole[n].tolist() == total.tolist()
        if best > 1e-9:
            left = counts[n, place[n], : cut[n] + 1].sum(axis=0)
            assert below[n].tolist() == [left.tolist(), (total - left).tolist()]


def test_bins_have_the_values_of_few_and_even_parts_of_many():
    assert forest._cuts([-1.0, -1.0, 3.0, 4.0], 32).tolist() == [1.0, 3.5]
    assert forest._cuts([2.0, 2.0], 32).tolist() == []
    cuts = forest._cuts([i / 256 for i in range(257)], 32)
    assert len(cuts) == 31 and np.diff(cuts) == pytest.approx([1 / 32] * 30)


def test_forest_fails_on_what_it_does_not_follow(linear_parts):
    with pytest.raises(ValueError, match="subsamplingRate"):
        forest.Growth.of(RandomForestClassifier(seed=1, subsamplingRate=0.5))
    with pytest.raises(Exception, match="labels are 0 and 1"):
        study.search_forest(linear_parts.train.withColumn("label", F.lit(2.0)), "id", (2,))
