"""Dictionary of domains as a table, and a classifier that holds no list of them.

Term ids are global ranks: the most frequent domain is 0, equal counts in alphabetical order. They
are found in ordered ranges, so neither one task nor the driver sees all domains. Counts meet the
dictionary in a join, which Spark broadcasts only if it is small.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import sparse_vector
from ..operators.domains import domain_totals
from ..operators.encoders import label_indexer
from ..operators.ranks import running_sums
from ..storage import Files, Workspace
from .gender_age import MAX_ITER, REG_PARAM, TARGET

# Most terms of a classifier by default; its weights take 8 bytes a term and class.
TERMS = 10_000_000


def dictionary(counts: DataFrame, work: Workspace) -> DataFrame:
    """``(term, domain, count)`` of every domain in ``(..., domain, cnt)``, staged in ``work``."""
    totals = domain_totals(counts).filter(F.col("domain").isNotNull())
    spark = counts.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = totals.repartitionByRange(ranges, F.desc("count"), "domain")
    # Stored, so that the ranges are the same in every use.
    placed = work.stage(ordered.withColumn("_bucket", F.spark_partition_id()), "domain-ranges")
    keyed = placed.withColumns({"_key": F.struct(-F.col("count"), "domain"), "_one": F.lit(1)})
    ranked = running_sums(keyed, "_key", ["_one"])
    found = ranked.select(F.col("before__one").cast("long").alias("term"), "domain", "count")
    return work.stage(found, "domain-dictionary")


def cut(terms: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The ``size`` most frequent terms, and one row that says what is left out.

    ``(terms, visits, terms_left_out, visits_left_out)``: numbers of the whole dictionary and of
    the terms beyond the cut.
    """
    beyond = F.col("term") >= size
    report = terms.agg(
        F.count("*").alias("terms"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("visits"),
        F.count_if(beyond).alias("terms_left_out"),
        F.coalesce(F.sum(F.when(beyond, F.col("count"))), F.lit(0)).alias("visits_left_out"),
    )
    return terms.filter(~beyond), report


def bag_of_terms(counts: DataFrame, terms: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``(*keys, features)``: counts of the terms as a sparse vector of ``size`` places."""
    entry = F.when(
        F.col("term").isNotNull(), F.struct(F.col("term").cast("int").alias("pos"), "cnt")
    )
    bags = (
        counts.join(terms.select("domain", "term"), "domain", "left")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    return bags.select(*keys, sparse_vector(F.lit(size), F.col("entries")).alias("features"))


class DomainModel:
    """Classifier of users by a dictionary table: terms, weights and class names."""

    def __init__(
        self, terms: DataFrame, size: int, classifier: LogisticRegressionModel, labels: list[str]
    ):
        self.terms = terms
        self.size = size
        self.classifier = classifier
        self.labels = labels

    def score(self, counts: DataFrame) -> DataFrame:
        """``(uid, gender_age)`` of each user of ``(uid, domain, cnt)``."""
        users = bag_of_terms(counts, self.terms, ["uid"], self.size)
        scored = self.classifier.transform(users)
        names = F.array(*map(F.lit, self.labels))
        return scored.select("uid", F.get(names, F.col("prediction").cast("int")).alias(TARGET))

    def save(self, path: str) -> None:
        """Write the dictionary as a table next to the weights, in a new folder.

        The class names come last: without them `load` finds no model.
        """
        self.terms.write.parquet(f"{path}/terms")
        self.classifier.save(f"{path}/classifier")
        about = {"size": self.size, "labels": self.labels}
        Files(self.terms.sparkSession).create(f"{path}/about.json", json.dumps(about))

    @staticmethod
    def load(spark: SparkSession, path: str) -> DomainModel:
        about = json.loads(Files(spark).read(f"{path}/about.json"))
        terms = spark.read.schema("term bigint, domain string, count bigint").parquet(f"{path}/terms")
        classifier = LogisticRegressionModel.load(f"{path}/classifier")
        return DomainModel(terms, about["size"], classifier, about["labels"])


def train(
    counts: DataFrame,
    work: Workspace,
    size: int = TERMS,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
) -> tuple[DomainModel, DataFrame]:
    """Fit on labelled counts ``(uid, gender_age, domain, cnt)``; the model and `cut`'s report.

    The model reads its terms from ``work``: save it before the work ends.
    """
    labelled = work.stage(counts.filter(F.col(TARGET).isNotNull()), "domain-counts")
    terms, report = cut(dictionary(labelled, work), size)
    found = report.first()
    places = max(1, found["terms"] - found["terms_left_out"])
    bags = bag_of_terms(labelled, terms, ["uid", TARGET], places)
    users = work.stage(bags, "training-rows")
    indexer = label_indexer(users, TARGET)
    classifier = LogisticRegression(maxIter=max_iter, regParam=reg_param, aggregationDepth=2)
    fitted = classifier.fit(indexer.transform(users))
    return DomainModel(terms, places, fitted, list(indexer.labels)), report
