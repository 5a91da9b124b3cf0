"""Broker messages as rows."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _text(c: C) -> C:
    return F.decode(c, "UTF-8")


def message_id() -> C:
    """Keyed messages: a digest of topic, partition and key; keyless ones: their place."""
    place = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    keyed = F.sha2(F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"), _text(F.col("key"))), 256)
    return F.when(F.col("key").isNotNull(), keyed).otherwise(place)


def payload() -> C:
    """The value as JSON text: as it is if it is JSON, else as a JSON string."""
    text = _text(F.col("value"))
    return F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.to_json(F.struct(text.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(text.alias("x")))) - 6))


def continuous(messages: DataFrame) -> DataFrame:
    """``msg_id, data, _order``: the shape of a stream that is merged by id, latest order first."""
    return messages.select(message_id().alias("msg_id"), payload().alias("data"), F.col("offset").cast("long").alias("_order"))


def bounded(messages: DataFrame, name: str = "_message") -> DataFrame:
    """One row per message with its place, key, time and data in a struct, and a unique id."""
    body = F.struct(
        F.col("partition"), F.col("topic"), _text(F.col("key")).alias("key"), F.col("offset"),
        F.struct(F.lit("create").alias("type"), F.unix_millis("timestamp").alias("value")).alias("ts"), payload().alias("data"),
    )
    unique = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return messages.select(unique.alias("msg_id"), body.alias(name))


def from_time(messages: DataFrame, start) -> DataFrame:
    """Messages at or after a time, for bounded reads."""
    return messages.filter(F.col("timestamp") >= F.lit(start).cast("timestamp"))
