"""Click-log inputs derived from the driver's tables (rules in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import epoch_millis, utc_date_compact
from ..functions.urls import url_domain
from ..operators.visits import user_domain_counts

# The site categories, by length of the domain modulo 4.
SITE_CATEGORIES = ("Arts and Entertainment", "Home-and Garden", "News", "Shopping")
# The words product names are made of.
NAME_FIRST = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
NAME_SECOND = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
# Product types.
PRODUCT_TYPES = ("economy", "large", "medium", "promo", "small", "standard")
# Levels of the study's categorical columns.
LANGS = ("de", "en", "es", "fr")
SOURCES = tuple(f"src{i}" for i in range(20))
# Entries of a vector and number of its classes.
EMBEDDING_SIZE, CLASSES = 64, 10
# Most visits in one nested log row.
LOG_ROW_EVENTS = 1000

SHOP_COLUMNS = [f"shop_{a}_{b}" for a in NAME_FIRST for b in NAME_SECOND]
WEB_COLUMNS = ["web_arts_and_entertainment", "web_home_and_garden", "web_news", "web_shopping"]
ITEM_COLUMNS = [f"{e}_{t}_{i}" for e in ("view", "buy") for t in PRODUCT_TYPES for i in range(10)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _row_count(dimension: DataFrame) -> Column:
    """Number of rows of a table whose key is dense from 0."""
    return dimension.select(F.count("*")).scalar()


def web_visits(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, uid, timestamp, url)``: each event visits the page its id points to."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select(
        *keep,
        F.col("user_id").cast("string").alias("uid"),
        epoch_millis("ts").alias("timestamp"),
        (F.col("event_id") % _row_count(pages)).alias("page_id"),
    )
    return events.join(pages, "page_id").drop("page_id")


def weblogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, block, visits)``: nested logs, one row per user and block of event ids.

    A block holds a fixed number of ids, so no array grows with a user's total visits.
    """
    visits = web_visits(spark, sf_dir, keep=("event_id",))
    block = F.floor(F.col("event_id") / LOG_ROW_EVENTS).alias("block")
    return visits.groupBy("uid", block).agg(
        F.array_sort(F.collect_list(F.struct("timestamp", "url"))).alias("visits")
    )


def gender_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, gender_age)``: a class for every customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"),
        F.col("c_mktsegment").alias("gender_age"),
    )


def labelled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, gender_age, domain, cnt)``: counted before the join, which then has no hot user."""
    counts = user_domain_counts(web_visits(spark, sf_dir))
    return counts.join(gender_age(spark, sf_dir), "uid")


def shop_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, event_type, category, item_id, timestamp, date)`` of views and purchases."""
    part = table(spark, sf_dir, "part")
    item = F.concat("p_type", F.lit("-"), (F.col("p_partkey") % 10).cast("string"))
    products = part.select(
        "p_partkey", F.col("p_name").alias("category"), item.alias("item_id")
    )
    millis = epoch_millis("ts")
    kind = F.when(F.col("event_type") == "purchase", "buy").otherwise(F.col("event_type"))
    events = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("view", "purchase"))
        .select(
            F.col("user_id").cast("string").alias("uid"),
            kind.alias("event_type"),
            millis.alias("timestamp"),
            utc_date_compact(millis).alias("date"),
            (F.col("event_id") % _row_count(part)).alias("p_partkey"),
        )
    )
    return events.join(products, "p_partkey").select(
        "uid", "event_type", "category", "item_id", "timestamp", "date"
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, segment, nation)`` of all customers; most of them never visit."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )


def domain_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(domain, category)`` of every domain among the pages."""
    names = F.array(*map(F.lit, SITE_CATEGORIES))
    domains = table(spark, sf_dir, "pages").select(url_domain("url").alias("domain")).distinct()
    return domains.filter(F.col("domain").isNotNull()).select(
        "domain", F.get(names, F.length("domain") % 4).alias("category")
    )


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as a tabular study.

    ``(doc_id, n_chars, quality, lang, source, TotalSpent, toxic)``; ``TotalSpent`` is text, with
    a blank for every 17th document.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    spent = F.when(F.col("doc_id") % 17 == 0, " ").otherwise(F.col("n_chars").cast("string"))
    return labels.join(documents, "doc_id").select(
        "doc_id", "n_chars", "quality", "lang", "source", spent.alias("TotalSpent"), "toxic"
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, toxic, p)``: a fixed score of each labelled document."""
    p = 1 / (1 + F.exp(-(F.col("n_chars") - 2500) / 1000))
    return study(spark, sf_dir).select("doc_id", "toxic", p.alias("p"))


def class_weight(label: int, j: int) -> float:
    """Weight of entry ``j`` for a class: a fixed rule that gives values from -1.1 to 1.1."""
    return ((label * 31 + j * 17) % 23 - 11) / 10


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, scores)``: ten raw class scores, each a weighted sum of the whole vector."""

    def score(label: int):
        weights = F.array(*[F.lit(class_weight(label, j)) for j in range(EMBEDDING_SIZE)])
        products = F.zip_with("embedding", weights, lambda v, w: v.cast("double") * w)
        return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)

    scores = F.array(*[score(label) for label in range(CLASSES)]).alias("scores")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", scores)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, features)``: whole vectors as doubles."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )


def daily_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(epoch, n, metric)``: events per day of the month and their mean value, one decimal."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.dayofmonth("ts").alias("epoch"))
        .agg(F.count("*").alias("n"), F.round(F.avg("value"), 1).alias("metric"))
    )
