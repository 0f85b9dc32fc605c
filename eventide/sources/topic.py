"""Topic codecs: raw events and processed events as key/value records.

The codec works on any DataFrame with the Kafka source layout (``key``,
``value`` binary, ``topic``, ``partition``, ``offset``), so it runs the same
on a Kafka read, a Kafka stream, or a frame rendered from the given tables.
The Kafka connector jar is optional; ``read_topic`` fails clearly without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.clean import normalize_processed
from eventide.schemas import PROCESSED_TEXT, RAW_EVENT_JSON

RAW_TOPIC = "insurance.raw_events"
PROCESSED_TOPIC = "insurance.processed_events"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
OFFSET_BITS = 48


def read_topic(spark: SparkSession, servers: str, topic: str,
               starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """Bounded batch read of a topic (earliest..latest by default)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("endingOffsets", ending)
            .load())


def read_topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded read of a topic for Structured Streaming (T1 over a real broker)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Append key/value records to a topic (batch write)."""
    (df.select("key", "value").write.format("kafka")
       .option("kafka.bootstrap.servers", servers)
       .option("topic", topic).mode("append").save())


def encode_raw_events(raw: DataFrame, topic: str = RAW_TOPIC) -> DataFrame:
    """Raw events as keyed JSON records (key = user_id), Kafka source layout.

    The source ``event_id`` stands in for the topic offset.
    """
    payload = F.struct(
        F.date_format("event_time", EVENT_TIME_FORMAT).alias("event_time"),
        "user_id", "session_id", "event_type", "channel", "premium_amount")
    return raw.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def decode_events(topic_df: DataFrame) -> DataFrame:
    """Decode raw event JSON with the fixed schema; bad JSON gives NULL fields.

    The record's position becomes ``event_id``: offsets count per topic
    partition, so the partition goes into the high bits (partition << 48 |
    offset; unique for offsets below 2^48, and equal to the offset on
    partition 0).  The text time is parsed without raising.
    """
    data = F.from_json(F.col("value").cast("string"), RAW_EVENT_JSON)
    part = F.col("partition") if "partition" in topic_df.columns else F.lit(0)  # one-partition source
    position = F.shiftleft(part.cast("long"), OFFSET_BITS).bitwiseOR(F.col("offset"))
    return (topic_df.select(position.alias("event_id"), data.alias("data"))
            .select("event_id", "data.*")
            .withColumn("event_time",
                        F.try_to_timestamp("event_time", F.lit(EVENT_TIME_FORMAT)).cast("timestamp_ntz")))


def encode_processed(processed: DataFrame, topic: str = PROCESSED_TOPIC) -> DataFrame:
    """Every processed row as ``to_json(struct(*))``, keyed by user_id."""
    return processed.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*processed.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def decode_processed(topic_df: DataFrame, as_of: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Consumer side: JSON text rows to typed warehouse rows.

    ``carry`` keeps record columns (offset, raw value) next to the decoded row.
    """
    text = (topic_df.select(F.from_json(F.col("value").cast("string"), PROCESSED_TEXT).alias("r"), *carry)
            .select("r.*", *carry))
    return normalize_processed(text, as_of, carry)
