"""Shop events from a message topic to one dated JSON tree per event type."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.times import utc_date_compact
from ..sources.kafka import read_topic
from ..sources.loads import Loads, Ranges, offset_ranges, within
from ..sources.readers import parse_json_column
from ..sources.schemas import SHOP_VISITS
from ..sources.writers import load_digest, write_days
from ..storage import Workspace

# Event types that get a tree of their own.
EVENT_TYPES = ("view", "buy")
# Place of a message in its topic.
PLACE = ("topic", "partition", "offset")


def decode_events(
    messages: DataFrame, schema: T.StructType = SHOP_VISITS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Shop events of JSON messages in ``value``, with the UTC day as ``date``."""
    events = parse_json_column(messages, "value", schema, keep)
    return events.withColumn("date", utc_date_compact("timestamp"))


def _publish(
    events: DataFrame, output: str, name: str, event_types: Sequence[str], ranges: Ranges | None
) -> None:
    def write(event_type: str, folder: str) -> None:
        write_days(events.filter(F.col("event_type") == event_type), folder)

    Loads(events.sparkSession, output).publish(name, event_types, write, ranges)


def split_events(
    events: DataFrame,
    output: str,
    event_types: Sequence[str] = EVENT_TYPES,
    load: str | None = None,
) -> None:
    """Write ``{output}/{event_type}/$load={load}/$date={yyyyMMdd}`` for each event type.

    The events are stored once, so all trees come from one scan of the source and agree about its
    messages. ``load`` names this load, which replaces the one of that name as a whole. By default
    a digest of the rows does, so that only the very same rows replace each other: for messages
    with offsets use `split_messages`.
    """
    with Workspace(events.sparkSession) as work:
        landed = work.stage(events.filter(F.col("event_type").isin(*event_types)), "events")
        name = load if load is not None else load_digest(landed)
        _publish(landed, output, name, event_types, None)


def split_messages(
    messages: DataFrame,
    output: str,
    event_types: Sequence[str] = EVENT_TYPES,
    schema: T.StructType = SHOP_VISITS,
) -> Ranges:
    """Write the events of messages whose offsets no load has brought; return what was new.

    ``messages`` have ``value`` and their place in the topic. Reading a topic again from any offset
    gives each event once, also when a run was lost at any step.
    """
    spark = messages.sparkSession
    loads = Loads(spark, output)
    loads.finish()
    with Workspace(spark) as work:
        landed = work.stage(decode_events(messages, schema, PLACE), "messages")
        missing = loads.missing(offset_ranges(landed))
        if not missing:
            return {}
        name = hashlib.md5(json.dumps(missing, sort_keys=True).encode()).hexdigest()
        _publish(landed.filter(within(missing)).drop(*PLACE), output, name, event_types, missing)
        return missing


def split_topic(
    spark: SparkSession, servers: str, topic: str, output: str, partitions: int = 1, **options
) -> Ranges:
    """Load the messages of a topic that came since the last load; options as in `read_topic`."""
    start = Loads(spark, output).next_offsets(topic) or "earliest"
    messages = read_topic(
        spark, servers, topic, offset=start, partitions=partitions, **options
    )
    return split_messages(messages, output)
