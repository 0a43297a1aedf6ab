"""

Every query reads whole tables below ``sf_dir``, or tables Spark derives from them; only those whose
feature it is (samples, top-n, hold-out parts, full batches) return a part.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

import oracle_queries
from clickloom.functions import names, times, urls, vectors
from clickloom.operators import (
    cleaning,
    domains,
    encoders,
    linear,
    metrics,
    pivots,
    splits,
    stats,
    time_features,
    visits,
)
from clickloom.plans import (
    batch_inference,
    data_mart as mart,
    domain_dictionary as dictionary_plan,
    event_split as event_plan,
    gender_age,
    label_study,
    tabular_study,
    user_item_matrix as matrix_plan,
    web_features,
)
from clickloom.sources import kafka, readers, sample_tables as tables, writers
from clickloom.sources.schemas import STORED_VISITS, WEBLOGS
from clickloom.storage import Workspace, shared_path
from clickloom.streaming import delivery, scoring

# The training-data operators and their pipeline may be absent; all else works without them.
try:
    import corpus_pipeline
    from clickloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "clickloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TOP_N = oracle_queries.TOP_N
STUDY = tabular_study.Table(
    id="doc_id",
    target="toxic",
    numeric=("n_chars", "quality", "TotalSpent"),
    categorical=("lang", "source"),
    dirty=("TotalSpent",),
)
STUDY_LEVELS = {"lang": tables.LANGS, "source": tables.SOURCES}


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    _QUERIES[fn.__name__] = fn
    return fn


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the web feature table of all users."""
    return feature_store(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    if llm_queries is None:
        return dict(_QUERIES)
    return _QUERIES | llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return oracle_queries.all_queries()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle_queries.all_queries() | llm_queries.oracle_sql() | pipeline


def _joined(array) -> F.Column:
    """Array as comma-separated text, so that engines compare it alike."""
    return F.array_join(F.transform(array, lambda v: v.cast("string")), ",")


# Sources and sinks


@query
def read_source(spark, sf_dir):
    customers = readers.read_source(spark, "parquet", f"{sf_dir}/customer.parquet")
    return customers.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query
def scan_json_visits(spark, sf_dir):
    path = shared_path(spark, "weblogs-json")
    tables.weblogs(spark, sf_dir).select("uid", "visits").write.json(path)
    return visits.explode_visits(readers.read_json(spark, path, WEBLOGS))


@query
def parse_json_props(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    events = tables.table(spark, sf_dir, "events")
    return readers.parse_json_column(events, "props", schema, keep=("event_id",))


@query
def scan_csv(spark, sf_dir):
    customers = tables.table(spark, sf_dir, "customer")
    path = shared_path(spark, "customer-csv")
    customers.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, customers.schema)


@query
def path_labels(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select(
        "page_id",
        names.parent_folder("url").alias("folder"),
        names.file_name("url").alias("file"),
    )


def _split_tree(spark, sf_dir) -> str:
    """Shop visits sent as JSON messages and split into dated trees."""
    messages = kafka.json_messages(tables.shop_visits(spark, sf_dir).drop("date"))
    path = shared_path(spark, "events")
    event_plan.split_events(event_plan.decode_events(messages), path)
    return path


@query
def file_manifest(spark, sf_dir):
    manifest = readers.file_manifest(spark, _split_tree(spark, sf_dir), "*.json")
    return manifest.groupBy("label").agg((F.min("length") > 0).alias("filled"))


@query
def event_split(spark, sf_dir):
    path = _split_tree(spark, sf_dir)
    layout = T.StructType(STORED_VISITS.fields + [T.StructField("$date", T.StringType())])
    trees = [
        readers.read_json(spark, f"{path}/{t}", layout).withColumn("tree", F.lit(t))
        for t in event_plan.EVENT_TYPES
    ]
    return (
        visits.union_logs(*trees)
        .groupBy("tree", "event_type", "date", F.col("`$date`").alias("folder"))
        .agg(F.count("*").alias("n"), F.sum("timestamp").alias("sum_timestamp"))
    )


@query
def topic_reload(spark, sf_dir):
    """A topic read in part, then from its earliest offset, then once more: each event once."""
    with Workspace(spark) as work:
        events = tables.shop_visits(spark, sf_dir).drop("date")
        values = kafka.json_messages(events).withColumns(
            {
                "topic": F.lit("shop"),
                "partition": F.spark_partition_id() % 2,
                "offset": F.monotonically_increasing_id(),
            }
        )
        messages = work.stage(values, "topic")
        middle = messages.agg(F.floor(F.avg("offset"))).scalar()
        path = shared_path(spark, "reloaded")
        for part in (messages.filter(F.col("offset") < middle), messages, messages):
            event_plan.split_messages(part, path)
    layout = T.StructType(STORED_VISITS.fields + [T.StructField("$date", T.StringType())])
    trees = [
        readers.read_json(spark, f"{path}/{t}", layout).withColumn("tree", F.lit(t))
        for t in event_plan.EVENT_TYPES
    ]
    return (
        visits.union_logs(*trees)
        .groupBy("tree", "event_type", "date", F.col("`$date`").alias("folder"))
        .agg(F.count("*").alias("n"), F.sum("timestamp").alias("sum_timestamp"))
    )


@query
def rows_to_json(spark, sf_dir):
    return kafka.json_messages(tables.clients(spark, sf_dir), "clients")


@query
def submission(spark, sf_dir):
    """The prediction file read back: hold-out ids, and whether each has a probability."""
    parts = tabular_study.linear_parts(tables.study(spark, sf_dir), STUDY, STUDY_LEVELS)
    model = tabular_study.LogisticRegression().fit(parts.train)
    scored = tabular_study.predictions(model, parts.test, "doc_id")
    path = shared_path(spark, "submission")
    writers.write_predictions(scored, path, "doc_id", "probability", value_name="Churn")
    layout = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Churn", T.DoubleType())])
    found = readers.read_csv(spark, path, layout)
    return found.select("Id", _probability("Churn").alias("valid"))


# Filters, nulls, cleaning


@query
def filter_views(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.filter(F.col("event_type") == "view").select("event_id", "user_id", "value")


@query
def filter_not_null(spark, sf_dir):
    study = cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    return study.filter(F.col("TotalSpent").isNotNull()).select("doc_id", "TotalSpent")


@query
def filter_null(spark, sf_dir):
    study = cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    return study.filter(F.col("TotalSpent").isNull()).select("doc_id", "lang")


@query
def filter_in_set(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    wanted = F.col("event_type").isin("view", "purchase") & (F.col("value") > 10)
    return events.filter(wanted).select("event_id", "event_type", "value")


@query
def coerce_numeric(spark, sf_dir):
    study = cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    return study.select("doc_id", "TotalSpent")


@query
def impute_mean(spark, sf_dir):
    study = cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    filled = cleaning.impute_mean(study, ["TotalSpent"])
    return filled.select("doc_id", F.round("TotalSpent", 6).alias("TotalSpent"))


@query
def null_census(spark, sf_dir):
    return cleaning.null_census(
        cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    )


@query
def sample_rows(spark, sf_dir):
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return cleaning.sample_rows(documents, 8, "doc_id")


@query
def sample_share(spark, sf_dir):
    """A tenth of the documents, decided row by row."""
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return cleaning.sample_share(documents, 0.1, "doc_id")


@query
def fill_zero(spark, sf_dir):
    study = cleaning.coerce_numeric(tables.study(spark, sf_dir), ["TotalSpent"])
    return pivots.fill_zero(study).select("doc_id", "TotalSpent", "lang")


# Scalar functions


@query
def url_domain(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", urls.url_host("url").alias("host"), urls.url_domain("url").alias("domain")
    )


@query
def url_domain_legacy(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.url_domain("url", "legacy").alias("domain"))


@query
def url_domain_literal(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    host = urls.strip_www(urls.url_host("url"), "literal")
    return pages.select("page_id", host.alias("domain"))


@query
def normalize_name(spark, sf_dir):
    part = tables.table(spark, sf_dir, "part")
    return part.select("p_partkey", names.normalize_name("shop_", "p_name").alias("name"))


@query
def item_key(spark, sf_dir):
    logs = tables.shop_visits(spark, sf_dir)
    return logs.select("uid", "timestamp", names.item_key("event_type", "item_id").alias("item"))


@query
def display_name(spark, sf_dir):
    part = tables.table(spark, sf_dir, "part")
    label = F.concat("p_type", F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")))
    return part.select("p_partkey", names.display_name(label).alias("name"))


@query
def utc_date(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    millis = times.epoch_millis("ts")
    return events.select(
        "event_id",
        millis.alias("timestamp"),
        times.utc_date_compact(millis).alias("day"),
        times.utc_date_text(millis).alias("date_text"),
        times.utc_time_text(millis).alias("time_text"),
        times.utc_weekday(millis).alias("weekday"),
        times.utc_hour(millis).alias("hour"),
    )


@query
def text_times(spark, sf_dir):
    """Times written in several layouts, and texts that are none, back to milliseconds."""
    second = F.substring(times.utc_time_text(times.epoch_millis("ts")), 1, 19)
    day, month, year = (F.substring(second, *at) for at in ((9, 2), (6, 2), (1, 4)))
    texts = [
        second,
        F.concat(F.replace(second, F.lit(" "), F.lit("T")), F.lit("+02:00")),
        F.concat_ws(".", day, month, F.concat(year, F.substring(second, 11, 6))),
        F.substring(second, 1, 10),
        F.concat(year, month, day),
        F.concat(F.lit("31.02."), year, F.lit(" 10:00")),
        F.lit("  "),
        F.lit(None).cast("string"),
    ]
    kind = F.pmod("event_id", F.lit(len(texts))).cast("int")
    text = F.get(F.array(*texts), kind).alias("text")
    written = tables.table(spark, sf_dir, "events").select("event_id", text)
    return cleaning.parse_times(written, "text").withColumn("day", times.utc_date_text("millis"))


@query
def explode_visits(spark, sf_dir):
    return visits.explode_visits(tables.weblogs(spark, sf_dir))


# Joins and pivots


@query
def union_visits(spark, sf_dir):
    logs = tables.shop_visits(spark, sf_dir)
    return visits.union_logs(
        *[logs.filter(F.col("event_type") == t) for t in event_plan.EVENT_TYPES]
    )


@query
def visits_of_clients(spark, sf_dir):
    views = tables.shop_visits(spark, sf_dir).filter(F.col("event_type") == "view")
    return visits.restrict_to(views, tables.clients(spark, sf_dir)).select("uid", "category")


def _web_category_counts(spark, sf_dir, key):
    return mart.web_category_counts(
        tables.web_visits(spark, sf_dir), tables.domain_categories(spark, sf_dir), key
    )


@query
def web_category_counts(spark, sf_dir):
    return _web_category_counts(spark, sf_dir, "domain")


@query
def web_category_counts_host(spark, sf_dir):
    return _web_category_counts(spark, sf_dir, "host")


@query
def shop_matrix(spark, sf_dir):
    return mart.shop_matrix(tables.shop_visits(spark, sf_dir), tables.SHOP_COLUMNS)


@query
def shop_counts(spark, sf_dir):
    views = tables.shop_visits(spark, sf_dir).filter(F.col("event_type") == "view")
    named = views.select("uid", names.normalize_name("shop_", "category").alias("category"))
    return pivots.long_counts(named, "category")


@query
def web_matrix(spark, sf_dir):
    return mart.web_matrix(
        tables.web_visits(spark, sf_dir),
        tables.domain_categories(spark, sf_dir),
        tables.WEB_COLUMNS,
    )


def _data_mart(spark, sf_dir, key):
    return mart.data_mart(
        tables.clients(spark, sf_dir),
        tables.shop_visits(spark, sf_dir),
        tables.web_visits(spark, sf_dir),
        tables.domain_categories(spark, sf_dir),
        tables.SHOP_COLUMNS,
        tables.WEB_COLUMNS,
        key,
    )


@query
def data_mart(spark, sf_dir):
    return _data_mart(spark, sf_dir, "domain")


@query
def data_mart_host(spark, sf_dir):
    return _data_mart(spark, sf_dir, "host")


@query
def user_item_matrix(spark, sf_dir):
    return matrix_plan.user_item_matrix(
        tables.shop_visits(spark, sf_dir), tables.ITEM_COLUMNS
    )


@query
def matrix_update(spark, sf_dir):
    """Daily loads with default arguments; together they equal the whole matrix.

    The first load leaves a day out that comes late, the last one brings the rest of a day that is
    loaded already, and the update runs once more than there are loads.
    """
    events = tables.shop_visits(spark, sf_dir)
    late = F.col("date") == "20240110"
    rest = (F.col("date") == "20240112") & (F.col("timestamp") % 2 == 0)
    new = F.col("date") > "20240120"
    loads = [~late & ~rest & ~new, new, late, rest]
    source, target = shared_path(spark, "loads"), shared_path(spark, "matrix")
    for load in loads:
        messages = kafka.json_messages(events.filter(load).drop("date"))
        event_plan.split_events(event_plan.decode_events(messages), source)
        matrix_plan.build_snapshot(
            spark, source, target, update=True, values=tables.ITEM_COLUMNS
        )
    path = matrix_plan.build_snapshot(
        spark, source, target, update=True, values=tables.ITEM_COLUMNS
    )
    return spark.read.parquet(path)


@query
def matrix_snapshot_date(spark, sf_dir):
    return matrix_plan.snapshot_date(tables.shop_visits(spark, sf_dir))


# Web features


@query
def domain_counts(spark, sf_dir):
    return domains.domain_counts(tables.web_visits(spark, sf_dir)).orderBy(F.desc("count"))


def _top(spark, sf_dir):
    counts = domains.domain_counts(tables.web_visits(spark, sf_dir))
    return domains.top_domains(counts, TOP_N)


@query
def top_domains(spark, sf_dir):
    return _top(spark, sf_dir)


@query
def top_domain_vocab(spark, sf_dir):
    return domains.vocabulary(_top(spark, sf_dir)).select(_joined("domains").alias("domains"))


@query
def distinct_users(spark, sf_dir):
    return stats.distinct_count(tables.web_visits(spark, sf_dir), "uid")


@query
def user_domain_grid(spark, sf_dir):
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    return domains.user_domain_grid(counts, _top(spark, sf_dir)).select("uid", "domain")


@query
def domain_positions(spark, sf_dir):
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    return domains.user_domain_grid(counts, _top(spark, sf_dir))


@query
def domain_vector(spark, sf_dir):
    vector = domains.domain_vector(tables.web_visits(spark, sf_dir), TOP_N)
    return vector.select("uid", _joined("domain_features").alias("domain_features"))


@query
def vector_probe(spark, sf_dir):
    vector = domains.domain_vector(tables.web_visits(spark, sf_dir), TOP_N)
    return vector.select(
        "uid",
        *[
            vectors.element_at_position("domain_features", p).alias(f"col{p}")
            for p in oracle_queries.PROBES
        ],
    )


@query
def web_day(spark, sf_dir):
    return time_features.weekday_counts(tables.web_visits(spark, sf_dir))


@query
def web_hour(spark, sf_dir):
    return time_features.hour_counts(tables.web_visits(spark, sf_dir))


@query
def work_evening(spark, sf_dir):
    counts = time_features.work_evening(tables.web_visits(spark, sf_dir))
    shares = ["web_fraction_work_hours", "web_fraction_evening_hours"]
    return counts.withColumns({c: F.round(c, 6) for c in shares})


@query
def feature_store(spark, sf_dir):
    features = web_features.feature_store(
        tables.web_visits(spark, sf_dir), user_item_matrix(spark, sf_dir), TOP_N
    )
    shares = ["web_fraction_work_hours", "web_fraction_evening_hours"]
    return features.withColumns(
        {"domain_features": _joined("domain_features")} | {c: F.round(c, 6) for c in shares}
    )


@query
def domain_tokens(spark, sf_dir):
    tokens = visits.domain_tokens(tables.weblogs(spark, sf_dir))
    return tokens.select("uid", "block", _joined("domain_features").alias("domain_features"))


@query
def domain_dictionary(spark, sf_dir):
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    with Workspace(spark) as work:
        found = dictionary_plan.dictionary(counts, work)
        work.keep(found)
    return found


@query
def dictionary_cut(spark, sf_dir):
    """What a cut at the most frequent half of the domains leaves out."""
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    with Workspace(spark) as work:
        terms = dictionary_plan.dictionary(counts, work)
        work.keep(terms)
    return dictionary_plan.cut(terms, terms.count() // 2)[1]


@query
def bag_of_domains(spark, sf_dir):
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    terms = gender_age.vocabulary_terms(counts)
    bags = gender_age.bag_of_domains(counts, terms, ["uid"])
    numbers = vector_to_array("features").cast("array<bigint>")
    return bags.select("uid", _joined(numbers).alias("features"))


# Statistics


@query
def row_counts(spark, sf_dir):
    return stats.row_counts({t: tables.table(spark, sf_dir, t) for t in oracle_queries.TABLES})


@query
def value_counts(spark, sf_dir):
    return stats.value_counts(tables.study(spark, sf_dir), ["lang", "source", "toxic"])


@query
def class_balance(spark, sf_dir):
    balance = stats.class_balance(tables.study(spark, sf_dir), "toxic")
    return balance.withColumn("share", F.round("share", 6))


@query
def histogram(spark, sf_dir):
    bins = stats.histogram(tables.table(spark, sf_dir, "documents"), "n_chars")
    return bins.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query
def boxplot(spark, sf_dir):
    return stats.box_plot(tables.table(spark, sf_dir, "lineitem"), "l_extendedprice").select(
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        "outliers",
    )


@query
def quantiles(spark, sf_dir):
    found = stats.quantiles(
        tables.table(spark, sf_dir, "documents"), "n_chars", oracle_queries.SHARES
    )
    return found.withColumn("value", F.round("value", 6))


@query
def weighted_metric(spark, sf_dir):
    mean = stats.weighted_mean(tables.daily_metric(spark, sf_dir), "metric", "n")
    return mean.select(F.round("metric", 6).alias("metric"))


@query
def best_epoch(spark, sf_dir):
    return stats.best_row(tables.daily_metric(spark, sf_dir), "metric", "epoch")


# Encoders and splits


@query
def label_vocab(spark, sf_dir):
    return encoders.label_vocabulary(tables.gender_age(spark, sf_dir), "gender_age")


@query
def label_index(spark, sf_dir):
    labels = tables.gender_age(spark, sf_dir)
    return encoders.label_indexer(labels, "gender_age").transform(labels).select("uid", "label")


@query
def one_hot(spark, sf_dir):
    study = tables.study(spark, sf_dir).select("doc_id", "lang", "source")
    return encoders.one_hot(study, STUDY_LEVELS)


@query
def ordered_target(spark, sf_dir):
    """Target statistics of two categories from the rows earlier in a seeded order."""
    study = tables.study(spark, sf_dir).select("doc_id", "lang", "source", "toxic")
    found = encoders.ordered_target(study, ["lang", "source"], "toxic", "doc_id", seed=7)
    rounded = {c: F.round(c, 9) for c in ("lang_target", "source_target")}
    return found.withColumns(rounded)


@query
def target_encode(spark, sf_dir):
    """Documents without a label, by the statistics of those with one."""
    study = tables.study(spark, sf_dir)
    table = encoders.target_table(study, "source", "toxic")
    prior = encoders.target_prior(study, "toxic")
    labelled = study.select("doc_id")
    others = tables.table(spark, sf_dir, "documents").select("doc_id", "source")
    others = others.join(labelled, "doc_id", "left_anti")
    found = encoders.with_target(others, table, "source", prior)
    return found.withColumn("source_target", F.round("source_target", 9))


@query
def standardize(spark, sf_dir):
    columns = ["n_chars", "quality"]
    study = tables.study(spark, sf_dir).select("doc_id", *columns)
    return encoders.standardize(study, columns).withColumns(
        {c: F.round(c, 6) for c in columns}
    )


@query
def train_test_split(spark, sf_dir):
    documents = tables.table(spark, sf_dir, "documents").select("doc_id")
    return splits.train_test_split(documents, "doc_id")


@query
def stratified_split(spark, sf_dir):
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splits.stratified_split(documents, "doc_id", "lang")


@query
def epoch_batches(spark, sf_dir):
    documents = tables.table(spark, sf_dir, "documents").select("doc_id")
    return splits.epoch_batches(documents, "doc_id", oracle_queries.BATCH_SIZE, epoch=1)


# Scores and metrics


@query
def logit_score(spark, sf_dir):
    scored = linear.logit_scores(
        tables.vectors(spark, sf_dir), "features", oracle_queries.VECTOR_WEIGHTS
    )
    return scored.select("vec_id", F.round("probability", 6).alias("probability"), "predicted")


@query
def enet_gradient(spark, sf_dir):
    rows = tables.vectors(spark, sf_dir).select(
        "features", (F.col("label") == 0).cast("int").alias("y")
    )
    gradient = linear.elastic_net_gradient(
        rows, "features", "y", oracle_queries.VECTOR_WEIGHTS, l1=0.1, l2=0.1
    )
    return gradient.select("pos", F.round("gradient", 6).alias("gradient"))


@query
def batch_loss(spark, sf_dir):
    rows = tables.study(spark, sf_dir).select(
        "doc_id",
        "toxic",
        F.array((F.col("n_chars") - 2500) / 1000, F.col("quality").cast("double")).alias("x"),
    )
    batches = splits.epoch_batches(rows, "doc_id", oracle_queries.BATCH_SIZE)
    losses = linear.batch_losses(batches, "x", "toxic", oracle_queries.STUDY_WEIGHTS)
    return losses.withColumn("loss", F.round("loss", 6))


@query
def log_loss(spark, sf_dir):
    loss = metrics.log_loss(tables.scores(spark, sf_dir), "toxic", "p")
    return loss.select(F.round("log_loss", 6).alias("log_loss"))


@query
def roc_auc(spark, sf_dir):
    area = metrics.roc_auc(tables.scores(spark, sf_dir), "toxic", "p")
    return area.select(F.round("roc_auc", 6).alias("roc_auc"))


@query
def roc_auc_hard(spark, sf_dir):
    scored = tables.scores(spark, sf_dir).withColumn("hard", (F.col("p") >= 0.5).cast("int"))
    area = metrics.roc_auc(scored, "toxic", "hard")
    return area.select(F.round("roc_auc", 6).alias("roc_auc"))


def _predicted(spark, sf_dir):
    raw = tables.raw_scores(spark, sf_dir)
    return raw.withColumn("predicted", vectors.argmax("scores"))


@query
def softmax(spark, sf_dir):
    raw = tables.raw_scores(spark, sf_dir)
    parts = raw.select("vec_id", F.posexplode(vectors.softmax("scores")).alias("pos", "p"))
    return parts.withColumn("p", F.round("p", 6))


@query
def argmax_label(spark, sf_dir):
    raw = _predicted(spark, sf_dir)
    vocabulary = encoders.label_vocabulary(raw, "label")
    labels = vocabulary.agg(F.array_sort(F.collect_list("label"))).scalar()
    return raw.withColumn("labels", labels).select(
        "vec_id",
        F.col("predicted").alias("class_index"),
        vectors.class_name("predicted", F.col("labels")).alias("class_name"),
    )


@query
def accuracy(spark, sf_dir):
    found = metrics.accuracy(_predicted(spark, sf_dir), "label", "predicted")
    return found.select(F.round("accuracy", 6).alias("accuracy"))


@query
def weighted_f1(spark, sf_dir):
    found = metrics.weighted_f1(_predicted(spark, sf_dir), "label", "predicted")
    return found.select(F.round("weighted_f1", 6).alias("weighted_f1"))


@query
def classification_report(spark, sf_dir):
    report = metrics.classification_report(_predicted(spark, sf_dir), "label", "predicted")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query
def cross_entropy(spark, sf_dir):
    found = metrics.cross_entropy(tables.raw_scores(spark, sf_dir), "label", "scores")
    return found.select(F.round("cross_entropy", 6).alias("cross_entropy"))


@query
def fixed_standardize(spark, sf_dir):
    pixels = F.transform("features", lambda v: F.abs(v) * 255)
    scaled = tables.vectors(spark, sf_dir).select(
        "vec_id", vectors.scale_channels(pixels).alias("scaled")
    )
    both = F.arrays_zip("scaled", vectors.unscale_channels("scaled").alias("restored"))
    return scaled.select("vec_id", F.posexplode(both).alias("pos", "v")).select(
        "vec_id",
        "pos",
        F.round("v.scaled", 6).alias("scaled"),
        F.round("v.restored", 6).alias("restored"),
    )


# Models


def _probability(column) -> F.Column:
    """Whether the column holds a number from 0 to 1."""
    return F.coalesce(F.col(column).between(0, 1), F.lit(False))


def _valid(scored) -> DataFrame:
    """Hold-out ids, and whether each has a class and a probability that belong together."""
    agree = (F.col("probability") >= 0.5) == (F.col("predicted") == 1)
    return scored.select("doc_id", (_probability("probability") & agree).alias("valid"))


@query
def train_gender_age(spark, sf_dir):
    """Train on all labelled visits, store and load the model, score every user.

    ``known``: the predicted class is one of the training classes.
    """
    model = gender_age.train_counts(tables.labelled_counts(spark, sf_dir))
    path = shared_path(spark, "gender-age-model")
    gender_age.save(model, path)
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    classes = tables.gender_age(spark, sf_dir).select("gender_age").distinct()
    scored = gender_age.score_counts(gender_age.load(path), counts)
    known = classes.withColumn("known", F.lit(True))
    return scored.join(known, "gender_age", "left").select(
        "uid", F.coalesce("known", F.lit(False)).alias("known")
    )


def _searched(parts, grid, scores, values: dict[str, str]) -> DataFrame:
    """One row per grid point: its values, the training rows, and whether it has a score."""
    found = tabular_study.search_results(parts.train.sparkSession, grid, scores)
    named = {
        column: F.regexp_extract("params", rf"\b{param}=([^,]+)", 1).cast("double")
        for column, param in values.items()
    }
    best = F.sum(F.col("best").cast("int")).over(Window.partitionBy())
    return found.withColumns(named).select(
        *values,
        F.lit(parts.train.count()).cast("long").alias("train_rows"),
        (_probability("score") & (best >= 1)).alias("scored"),
    )


@query
def grid_search(spark, sf_dir):
    parts = tabular_study.linear_parts(tables.study(spark, sf_dir), STUDY, STUDY_LEVELS)
    model = tabular_study.search_logistic(parts.train, "doc_id")
    found = _searched(
        parts, model.getEstimatorParamMaps(), model.avgMetrics, {"strength": "regParam"}
    )
    folds = tabular_study.FOLDS
    fitted = F.col("train_rows") * (folds - 1) / folds
    c = F.round(1 / (F.col("strength") * fitted), 6)
    return found.select(c.alias("c"), "train_rows", "scored")


@query
def gbt_churn(spark, sf_dir):
    parts = tabular_study.tree_parts(tables.study(spark, sf_dir), STUDY)
    folded = tabular_study.with_folds(parts.train, "doc_id")
    fitted, held = folded.filter("fold > 0"), folded.filter("fold = 0")
    model = tabular_study.fit_boosted(fitted, held, maxBins=parts.max_bins)
    return _valid(tabular_study.predictions(model, parts.test, "doc_id"))


@query
def gbt_grid(spark, sf_dir):
    parts = tabular_study.tree_parts(tables.study(spark, sf_dir), STUDY)
    found = tabular_study.search_boosted(parts.train, "doc_id", maxBins=parts.max_bins)
    values = {"step": "stepSize", "depth": "maxDepth", "gain": "minInfoGain"}
    return _searched(parts, found.grid, found.scores, values)


@query
def rf_churn(spark, sf_dir):
    parts = tabular_study.linear_parts(tables.study(spark, sf_dir), STUDY, STUDY_LEVELS)
    model = tabular_study.search_forest(parts.train, "doc_id")
    return _searched(parts, model.getEstimatorParamMaps(), model.avgMetrics, {"trees": "numTrees"})


@query
def elastic_net(spark, sf_dir):
    """Whether the fitted weights are optimal, by dimension: where a weight is 0 the loss may
    slope by the penalty, elsewhere the penalised gradient must be 0."""
    parts = tabular_study.linear_parts(tables.study(spark, sf_dir), STUDY, STUDY_LEVELS)
    l1 = l2 = 0.01
    model = linear.elastic_net(l1, l2, tol=1e-9).fit(parts.train)
    weights = [model.intercept, *model.coefficients.toArray().tolist()]
    rows = parts.train.select(vector_to_array("features").alias("features"), "label")
    gradient = linear.elastic_net_gradient(rows, "features", "label", weights, l1, l2)
    weight = F.get(vectors.double_array(weights), F.col("pos"))
    slack = F.when((weight == 0) & (F.col("pos") > 0), l1).otherwise(0.0)
    return gradient.select("pos", (F.abs("gradient") <= slack + 0.001).alias("optimal"))


@query
def cv_accuracy(spark, sf_dir):
    """Rows of each fold, and whether the mean accuracy over the folds beats a coin."""
    study = encoders.one_hot(
        tabular_study.clean(tables.study(spark, sf_dir), STUDY), STUDY_LEVELS
    )
    features = [c for c in study.columns if c not in (STUDY.id, STUDY.target)]
    found = tabular_study.cross_validated_accuracy(
        study, features, STUDY.target, linear.elastic_net(0.01, 0.01), STUDY.id
    )
    sizes = tabular_study.with_folds(study, STUDY.id).groupBy("fold").agg(F.count("*").alias("n"))
    return sizes.withColumn("accurate", F.lit(0.5 < found[0] <= 1))


@query
def linear_head(spark, sf_dir):
    """Hold-out rows with the number of classes, and whether the named class is the likeliest."""
    _, scored, _ = label_study.run(tables.vectors(spark, sf_dir), "vec_id")
    named = F.col("predicted") == F.col("class_index").cast("string")
    return scored.select(
        "vec_id", "label", F.size("probabilities").alias("classes"), named.alias("named")
    )


@query
def linear_head_report(spark, sf_dir):
    """Supports of the hold-out report, and whether its figures are shares."""
    report = label_study.run(tables.vectors(spark, sf_dir), "vec_id")[2]
    shares = _probability("precision") & _probability("recall") & _probability("f1")
    return report.select("label", "support", shares.alias("shares"))


@query
def own_model(spark, sf_dir):
    """Each vector's nearest class mean and its distance, by a model loaded once per worker."""
    rows = tables.vectors(spark, sf_dir)
    labels, size, load = batch_inference.broadcast_model(batch_inference.class_means(rows))
    scored = batch_inference.score_batches(rows, load, size)
    nearest = batch_inference.nearest_class(scored, labels)
    distance = F.round(F.array_min("scores"), 4).alias("distance")
    return nearest.select("vec_id", "nearest", F.size("scores").alias("classes"), distance)


# Streams


def _messages(spark, sf_dir) -> DataFrame:
    """Nested logs as a stream of JSON messages."""
    path = shared_path(spark, "messages")
    logs = tables.weblogs(spark, sf_dir).select("uid", "visits")
    kafka.json_messages(logs).write.text(path)
    return spark.readStream.text(path)


@query
def stream_tokens_stateless(spark, sf_dir):
    path, checkpoint = shared_path(spark, "tokens"), shared_path(spark, "tokens-checkpoint")
    tokens = scoring.message_tokens(_messages(spark, sf_dir))
    scoring.run_available(scoring.append_to_table(tokens, path, checkpoint))
    return spark.read.parquet(path).select(
        "uid", _joined("domain_features").alias("domain_features")
    )


@query
def stream_tokens_stateful(spark, sf_dir):
    path, checkpoint = shared_path(spark, "counts"), shared_path(spark, "counts-checkpoint")
    counts = scoring.running_counts(_messages(spark, sf_dir))
    store = scoring.CountStore(spark, path, "run")
    scoring.run_available(scoring.store_counts(counts, store, checkpoint))
    return store.read()


@query
def counts_replay(spark, sf_dir):
    """Running counts in three batches, each of which comes twice, and an old one again."""
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    store = scoring.CountStore(spark, shared_path(spark, "replayed"), "run", buckets=16)
    own = F.pmod(F.xxhash64("uid", "domain"), F.lit(2))
    half = counts.withColumn("cnt", F.ceil(F.col("cnt") / 2).cast("long"))
    batches = [half, counts.filter(own == 0), counts.filter(own == 1)]
    for number, batch in enumerate(batches):
        for _ in range(2):
            store.write(batch, number)
    store.write(half, 1)
    return store.read()


@query
def outbox_replay(spark, sf_dir):
    """Visits per user and domain sent in two batches: one is lost halfway, and both come again."""
    counts = visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    path = shared_path(spark, "outbox")
    target = f"{path}/target"
    layout = "key STRING, value STRING"
    lost = []

    def send(rows):
        if not lost:
            lost.append(rows)
            rows.filter(F.pmod(F.xxhash64("key"), F.lit(2)) == 0).write.parquet(target)
            raise ConnectionError("lost halfway")
        rows.write.mode("append").parquet(target)

    def sent(batch_id, since):
        found = spark.read.schema(layout).parquet(target)
        return found.filter(F.col("key").startswith(delivery.key_prefix("run", batch_id)))

    outbox = delivery.Outbox(spark, path, "run", ("uid", "domain"), send, sent)
    own = F.pmod(F.xxhash64("uid", "domain"), F.lit(2))
    for batch_id in (0, 0, 1, 0, 1):
        try:
            outbox(counts.filter(own == batch_id), batch_id)
        except ConnectionError:
            continue
    message = F.from_json("value", counts.schema).alias("m")
    return spark.read.schema(layout).parquet(target).select(message).select("m.*")


@query
def stream_score(spark, sf_dir):
    """Scores of the users in a stream, next to the batch scores of their whole logs."""
    model = gender_age.train_counts(tables.labelled_counts(spark, sf_dir))
    path, checkpoint = shared_path(spark, "scores"), shared_path(spark, "scores-checkpoint")
    store = scoring.CountStore(spark, shared_path(spark, "score-counts"), "run")
    scores = delivery.ScoreTable(spark, path)
    writer = scoring.score_users(model, _messages(spark, sf_dir), store, checkpoint, scores)
    scoring.run_available(writer)
    batch = gender_age.score_counts(
        model, visits.user_domain_counts(tables.web_visits(spark, sf_dir))
    ).withColumnRenamed(gender_age.TARGET, "batch_score")
    both = scores.read().join(batch, "uid", "full")
    agrees = F.coalesce(F.col(gender_age.TARGET) == F.col("batch_score"), F.lit(False))
    return both.select("uid", agrees.alias("agrees"))
