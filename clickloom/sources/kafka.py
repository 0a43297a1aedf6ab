"""Kafka reads and writes. The connector package comes with the deployment."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter


# What Kafka's reader takes for the ends of a partition.
ENDS = {"earliest": -2, "latest": -1}
Offset = str | int | dict[int, int]


def offsets(
    topic: str, offset: Offset = "earliest", partitions: int = 1, others: str = "earliest"
) -> str:
    """``earliest`` or ``latest`` as they are; a number for every partition; or one per partition.

    Spark wants all partitions of the topic named. Partitions a dict leaves out get ``others``.
    """
    if isinstance(offset, str) and offset in ENDS:
        return offset
    if isinstance(offset, dict):
        named = {int(p): ENDS.get(o, o) for p, o in offset.items()}
        given = {p: ENDS[others] for p in range(partitions)} | named
    else:
        given = dict.fromkeys(range(partitions), int(offset))
    per_partition = {str(p): int(o) for p, o in sorted(given.items())}
    return json.dumps({topic: per_partition}, separators=(",", ":"))


def kafka_options(
    servers: str,
    topic: str,
    offset: Offset = "earliest",
    partitions: int = 1,
    until: Offset | None = None,
    **options,
) -> dict[str, str]:
    """Options of a read. ``until`` bounds a batch read; ``options`` are passed on by name, such as
    ``maxOffsetsPerTrigger``, ``minPartitions`` or, with underscores for dots, security settings."""
    known = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets(topic, offset, partitions),
    }
    if until is not None:
        known["endingOffsets"] = offsets(topic, until, partitions, "latest")
    return known | {k.replace("_", "."): str(v) for k, v in options.items()}


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """All messages from the offset up to ``until``, or now; see `kafka_options`."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int = 1_000_000, **options
) -> DataFrame:
    """Stream of the messages from the offset on.

    A micro-batch takes at most ``max_per_trigger`` messages, so a topic's history is worked off in
    bounded steps; see `kafka_options`.
    """
    options = {"maxOffsetsPerTrigger": max_per_trigger} | options
    found = kafka_options(servers, topic, **options)
    return spark.readStream.format("kafka").options(**found).load()


def json_messages(rows: DataFrame, topic: str | None = None) -> DataFrame:
    """Each row as a JSON text in ``value``, null fields left out; and the target topic."""
    value = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select(value) if topic is None else rows.select(value, F.lit(topic).alias("topic"))


def write_topic_stream(
    rows: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    """Writer of a stream of rows to a topic; call ``start()`` on it."""
    return (
        json_messages(rows, topic)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
