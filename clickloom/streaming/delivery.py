"""Delivery of micro-batches exactly once: an outbox, and a ledger of what has been sent."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.gender_age import TARGET
from ..sources.kafka import read_topic
from ..storage import Files, Ledger

# How far the clocks of this driver and of the brokers may differ.
CLOCK_MARGIN_MS = 600_000


def batch_key(run: str, batch_id: int, *columns: str) -> Column:
    """Key of a message: run, number of the batch, and its row's own key."""
    return F.to_json(F.array(F.lit(run), F.lit(str(batch_id)), *[F.col(c).cast("string") for c in columns]))


def key_prefix(run: str, batch_id: int) -> str:
    """What the keys of a batch, and of no other, begin with."""
    return json.dumps([run, str(batch_id)], separators=(",", ":"), ensure_ascii=False)[:-1] + ","


class Outbox:
    """Sends the rows of each batch once, however often the batch comes and wherever a run is lost.

    A batch is first written to the outbox and counts as written when its note stands; from then on
    a replay sends these rows and not those that it brings, which may be in other order. The ledger
    holds the batch once all of it is sent. Only a batch that was lost between note and ledger asks
    the target which of its keys are there, and sends the others. One writer at a time.

    ``send`` takes rows ``(key, value)``; ``sent`` takes the number of a batch and the time in
    milliseconds before which none of it was sent, and gives the ``key`` of what is there. A send
    must be over when it fails or returns, as Spark's own writers are; rows with a null column in
    ``columns`` have a key like any other, rows with equal keys in one batch are an error of the
    caller.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        run: str,
        columns: tuple[str, ...],
        send: Callable[[DataFrame], None],
        sent: Callable[[int, int], DataFrame],
    ):
        self._spark, self._run, self._columns = spark, run, columns
        self._root = f"{path.rstrip('/')}/{run}"
        self._send, self._sent = send, sent
        self._files = Files(spark)
        self._ledger = Ledger(spark, f"{self._root}/_sent")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        last, _ = self._ledger.newest()
        if batch_id <= last:
            return  # sent before
        folder, note = f"{self._root}/batch={batch_id}", f"{self._root}/batch={batch_id}.json"
        if self._files.exists(note):
            since = json.loads(self._files.read(note))["since"]
            held = self._spark.read.schema("key STRING, value STRING").parquet(folder)
            there = self._sent(batch_id, since).select("key").distinct()
            self._send(held.join(there, "key", "left_anti"))
        else:
            value = F.to_json(F.struct(*rows.columns)).alias("value")
            key = batch_key(self._run, batch_id, *self._columns).alias("key")
            rows.select(key, value).write.mode("overwrite").parquet(folder)
            since = int(time.time() * 1000)
            self._files.create(note, json.dumps({"since": since}))
            self._send(self._spark.read.schema("key STRING, value STRING").parquet(folder))
        self._ledger.append({}, batch_id)
        # A run lost from here on leaves the outbox of a sent batch; it is never read again.
        self._files.delete(note)
        self._files.delete(folder)


def topic_outbox(
    spark: SparkSession, path: str, run: str, servers: str, topic: str, key: str = "uid"
) -> Outbox:
    """Outbox of a topic. After a lost run the topic is read from the time of the note on."""

    def send(rows: DataFrame) -> None:
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        rows.write.format("kafka").options(**options).save()

    def sent(batch_id: int, since: int) -> DataFrame:
        found = read_topic(
            spark,
            servers,
            topic,
            startingTimestamp=since - CLOCK_MARGIN_MS,
            startingOffsetsByTimestampStrategy="latest",
        )
        keys = found.select(F.col("key").cast("string").alias("key"))
        return keys.filter(F.col("key").startswith(key_prefix(run, batch_id)))

    return Outbox(spark, path, run, (key,), send, sent)


class ScoreTable:
    """Newest score of each user, as batches on top of a compacted part.

    A batch's folder replaces itself, so a replay changes nothing. Every ``compact_after`` batches
    the newest scores go to a fresh folder, which counts from its ledger entry; what it covers is
    deleted one compaction later, while no reader holds it any more. Batches that an entry covers
    are not taken again.
    """

    def __init__(self, spark: SparkSession, path: str, compact_after: int = 50):
        self._spark, self._root = spark, path.rstrip("/")
        self._files = Files(spark)
        self._ledger = Ledger(spark, f"{self._root}/_compacted")
        self._compact_after = compact_after

    def __call__(self, scores: DataFrame, batch_id: int) -> None:
        last, entry = self._ledger.newest()
        if batch_id <= last:
            return
        scores.select("uid", TARGET).write.mode("overwrite").parquet(f"{self._root}/batch={batch_id}")
        if len(self._batches(last)) >= self._compact_after:
            self._compact(batch_id, entry)

    def _batches(self, after: int) -> list[int]:
        names = [n.removeprefix("batch=") for n in self._files.children(self._root) if n.startswith("batch=")]
        return sorted(int(n) for n in names if int(n) > after)

    def _compact(self, batch_id: int, entry: dict) -> None:
        folder = f"newest={batch_id}"
        last, _ = self._ledger.newest()
        covered = [f"batch={n}" for n in self._batches(last)]
        self.read().write.mode("overwrite").parquet(f"{self._root}/{folder}")
        for old in entry.get("spare", []):
            self._files.delete(f"{self._root}/{old}")
        spare = covered + ([entry["folder"]] if entry else [])
        self._ledger.append({"folder": folder, "spare": spare}, batch_id)

    def read(self) -> DataFrame:
        """``(uid, gender_age)``: one row per user, the score of the last batch they were in."""
        last, entry = self._ledger.newest()
        layout = f"uid STRING, {TARGET} STRING"
        folders = [(n, f"batch={n}") for n in self._batches(last)]
        if entry:
            folders.insert(0, (last, entry["folder"]))
        paths = [f"{self._root}/{name}" for _, name in folders]
        if not paths:
            return self._spark.createDataFrame([], layout)
        found = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|newest)=(\d+)/[^/]*$", 1)
        rows = self._spark.read.schema(layout).parquet(*paths)
        rows = rows.select("uid", TARGET, found.cast("long").alias("batch"))
        return rows.groupBy("uid").agg(F.max_by(TARGET, "batch").alias(TARGET))
