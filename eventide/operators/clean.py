"""Event cleaning, derived attributes, keys and the processed-event projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import as_of_ts, parse_time_best_effort
from eventide.schemas import PROCESSED_COLUMNS

DATA_SOURCE = "spark_etl"


def clean_events(raw: DataFrame) -> DataFrame:
    """Keep rows with user, time, session and a positive premium.

    Zero premiums (blank in the CSV, see ingest) are dropped on purpose.
    """
    return raw.filter(
        F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
        & F.col("session_id").isNotNull() & F.col("premium_amount").isNotNull()
        & (F.col("premium_amount") > 0)
    )


def derive_event_attributes(df: DataFrame) -> DataFrame:
    """event_date, hour, day of week (1 = Sunday), tenure days, is_purchase."""
    return (df
            .withColumn("event_date", F.to_date("event_time"))
            .withColumn("event_hour", F.hour("event_time"))
            .withColumn("event_day_of_week", F.dayofweek("event_time"))
            .withColumn("user_tenure_days", F.datediff("event_date", "signup_date"))
            .withColumn("is_purchase", F.when(F.col("event_type") == "purchase", 1).otherwise(0)))


BUSINESS_KEY = ["event_time", "user_id", "session_id", "event_type", "channel", "premium_amount"]


def event_key(df: DataFrame, cols: list[str] | None = None, name: str = "event_key") -> DataFrame:
    """Deterministic 64-bit key from the business columns.

    Unlike a per-partition counter it is the same on every run and under any
    partitioning; two identical deliveries get the same key (dedup intent).
    """
    cols = cols or BUSINESS_KEY
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in cols]))


def key_classes(keyed: DataFrame, key: str = "event_key") -> DataFrame:
    """Events that share a key: the smallest event id of each class and its number of deliveries."""
    return (keyed.groupBy(key).agg(F.min("event_id").alias("class_id"), F.count(F.lit(1)).alias("deliveries"))
            .drop(key))


def finalize_processed(df: DataFrame, as_of: str) -> DataFrame:
    """Lineage columns and the 17-column processed-event layout."""
    return (df.withColumn("processing_time", as_of_ts(as_of))
              .withColumn("data_source", F.lit(DATA_SOURCE))
              .select(*PROCESSED_COLUMNS))


def normalize_processed(text: DataFrame, as_of: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Warehouse-side normalisation of processed events arriving as text.

    Dates and times are parsed by best effort (NULL if unparsable), the device
    type is trimmed and an ingestion time is stamped.  ``carry`` columns
    (e.g. the record's offset) are passed through at the end.
    """
    return text.select(
        "event_id",
        parse_time_best_effort(F.col("event_time")).alias("event_time"),
        "user_id", "session_id", "event_type", "channel", "premium_amount",
        parse_time_best_effort(F.col("signup_date")).cast("date").alias("signup_date"),
        "city",
        F.trim(F.col("device_type")).alias("device_type"),
        "user_tenure_days",
        parse_time_best_effort(F.col("event_date")).cast("date").alias("event_date"),
        "event_hour", "event_day_of_week", "is_purchase",
        parse_time_best_effort(F.col("processing_time")).alias("processing_time"),
        "data_source",
        as_of_ts(as_of).alias("ingestion_time"),
        *carry,
    )


def warehouse_events(processed: DataFrame, as_of: str) -> DataFrame:
    """Batch form of P7 for typed input: trim device_type, stamp ingestion_time."""
    return (processed.withColumn("device_type", F.trim("device_type"))
                     .withColumn("ingestion_time", as_of_ts(as_of)))
