"""Streaming decode, tokens and scores of web-log messages."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.urls import url_domain
from ..operators.visits import domain_tokens, explode_visits, restrict_to
from ..plans.gender_age import score_counts, score_logs
from ..sources.kafka import stream_topic
from ..sources.readers import parse_json_column
from ..sources.schemas import WEBLOGS
from ..storage import Files, Ledger
from .delivery import topic_outbox

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def decode_logs(messages: DataFrame) -> DataFrame:
    """``(uid, visits)`` of JSON messages in ``value``."""
    return parse_json_column(messages, "value", WEBLOGS)


def message_tokens(messages: DataFrame, strip: str = "prefix") -> DataFrame:
    """``(uid, domain_features)`` of each message; needs no state and runs in append mode."""
    return domain_tokens(decode_logs(messages), strip)


def score_messages(model: PipelineModel, messages: DataFrame, strip: str = "prefix") -> DataFrame:
    """``(uid, gender_age)`` of each message by the fitted pipeline."""
    return score_logs(model, decode_logs(messages), strip)


def running_counts(
    messages: DataFrame,
    strip: str = "prefix",
    period: str | None = None,
    watermark: str = "2 days",
) -> DataFrame:
    """Visits per user and domain over all messages so far; write it in update mode.

    State is one number per user and domain, spread over both keys, so a user with very many
    messages neither fills one task nor grows one row. It still grows with the pairs seen. With
    ``period`` (such as ``1 day``) counts are kept per visit period and the watermark drops the
    state of closed ones.
    """
    visits = explode_visits(decode_logs(messages)).filter(F.col("uid").isNotNull())
    domain = url_domain("url", strip).alias("domain")
    if period is None:
        rows = visits.select("uid", domain)
        return rows.groupBy("uid", "domain").agg(F.count("*").alias("cnt"))
    rows = visits.select("uid", domain, F.timestamp_millis("timestamp").alias("at"))
    rows = rows.withWatermark("at", watermark)
    counts = rows.groupBy(F.window("at", period), "uid", "domain").agg(F.count("*").alias("cnt"))
    return counts.select(F.col("window.start").alias("period"), "uid", "domain", "cnt")


class CountStore:
    """Table of running counts, in buckets by user.

    It lies in ``{path}/{run}``; give each checkpoint a ``run`` of its own, so that a fresh
    checkpoint never meets the batches of an old one. A ledger names the folder that holds each
    bucket. A batch reads and rewrites only the buckets of its users, into a folder of its own, and
    counts when its ledger entry stands; what that entry no longer names is deleted after the next
    one. So a batch that was lost at any step runs again, and one that has been entered changes
    nothing when it comes again, whatever its number.
    """

    def __init__(self, spark: SparkSession, path: str, run: str, buckets: int = 256):
        self._spark = spark
        self._root = f"{path.rstrip('/')}/{run}"
        self._buckets = buckets
        self._ledger = Ledger(spark, f"{self._root}/_batches")
        self._files = Files(spark)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64("uid"), F.lit(self._buckets)).cast("int")

    def _touched(self, users: DataFrame) -> list[int]:
        """Buckets of the users: at most as many rows as there are buckets."""
        rows = users.select(self._bucket().alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in rows)

    def _read(self, entry: dict, buckets: list[int] | None) -> DataFrame:
        held = entry.get("buckets", {})
        wanted = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        paths = [f"{self._root}/{held[b]}/bucket={b}" for b in wanted]
        return self._spark.read.schema(entry["schema"]).parquet(*paths)

    def write(self, changed: DataFrame, batch_id: int) -> list[int]:
        """Enter the changed counts of a batch; returns the buckets it touches."""
        touched = self._touched(changed)
        last, entry = self._ledger.newest()
        if batch_id <= last:
            return touched  # entered before
        buckets = dict(entry.get("buckets", {}))
        folder = f"batch={batch_id}"
        rows = changed
        if any(str(b) in buckets for b in touched):
            rows = self._read(entry, touched).unionByName(changed)
        if touched:
            # A running count never falls, so the greatest one is the newest.
            keys = [c for c in changed.columns if c != "cnt"]
            (
                rows.groupBy(*keys)
                .agg(F.max("cnt").alias("cnt"))
                .withColumn("bucket", self._bucket())
                .hint("rebalance", "bucket")
                .write.mode("overwrite")
                .partitionBy("bucket")
                .parquet(f"{self._root}/{folder}")
            )
        buckets |= dict.fromkeys(map(str, touched), folder)
        # The entry before this one may still be read; what only older ones name may go.
        spare = [
            f"{held}/bucket={b}" for b, held in entry.get("buckets", {}).items() if buckets[b] != held
        ]
        schema = T.StructType([f for f in changed.schema if f.name != "cnt"] + [changed.schema["cnt"]])
        layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        content = {"buckets": buckets, "schema": layout, "spare": spare}
        for old in entry.get("spare", []):
            self._files.delete(f"{self._root}/{old}")
        self._ledger.append(content, batch_id)
        return touched

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """Current counts, of all users or those of some buckets."""
        return self._read(self._ledger.newest()[1], buckets)


def store_counts(counts: DataFrame, store: CountStore, checkpoint: str) -> DataStreamWriter:
    """Writer of every changed count to a store.

    The pairs seen soon outgrow executor memory: set ``spark.sql.streaming.stateStore.providerClass``
    to `STATE_STORE`, which keeps state on disk, in the session that runs the stream.
    """
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(store.write)
        .option("checkpointLocation", checkpoint)
    )


def score_users(
    model: PipelineModel,
    messages: DataFrame,
    store: CountStore,
    checkpoint: str,
    deliver: Callable[[DataFrame, int], None],
    strip: str = "prefix",
) -> DataStreamWriter:
    """Writer that scores, in each micro-batch, the users whose counts changed.

    A user is scored from the counts of all their messages so far, as the model was fitted.
    ``deliver`` gets ``(uid, gender_age)`` and the number of the batch; a batch may come again, which
    an `Outbox` and a `ScoreTable` of `delivery` allow for.
    """

    def score(changed: DataFrame, batch_id: int) -> None:
        buckets = store.write(changed, batch_id)
        if buckets:
            users = changed.select("uid").distinct()
            deliver(score_counts(model, restrict_to(store.read(buckets), users)), batch_id)

    return (
        running_counts(messages, strip)
        .writeStream.outputMode("update")
        .foreachBatch(score)
        .option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now, then stop; for catch-up runs and tests."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_to_table(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer of an append stream to a parquet table, each row exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def score_topic(
    spark: SparkSession,
    model_path: str,
    servers: str,
    input_topic: str,
    output_topic: str,
    store_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Score the users of one topic to another until stopped, each batch sent exactly once.

    ``trigger`` has the arguments of the writer's ``trigger``, such as
    ``{"processingTime": "1 minute"}``; ``options`` are those of `stream_topic`.
    """
    model = PipelineModel.load(model_path)
    run = hashlib.md5(checkpoint.encode()).hexdigest()
    writer = score_users(
        model,
        stream_topic(spark, servers, input_topic, **options),
        CountStore(spark, store_path, run),
        checkpoint,
        topic_outbox(spark, f"{store_path}/_outbox", run, servers, output_topic),
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
