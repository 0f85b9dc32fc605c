"""Declared schemas: one StructType per external shape, never inference.

Fixed values: the column names and types are the contracts of the tables.
"""

from pyspark.sql import types as T

# Raw event as sent on the events topic / stored in the events CSV.
RAW_EVENT_JSON = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("premium_amount", T.LongType()),
])

# The six CSV fields read as text first, so bad values are counted, not fatal.
EVENT_CSV_TEXT = T.StructType([
    T.StructField(n, T.StringType()) for n in
    ["event_time", "user_id", "session_id", "event_type", "channel", "premium_amount"]
])

USER_CSV_TEXT = T.StructType([
    T.StructField(n, T.StringType()) for n in ["user_id", "signup_date", "city", "device_type"]
])

PROCESSED_COLUMNS = [
    "event_id", "event_time", "user_id", "session_id", "event_type", "channel",
    "premium_amount", "signup_date", "city", "device_type", "user_tenure_days",
    "event_date", "event_hour", "event_day_of_week", "is_purchase",
    "processing_time", "data_source",
]

# Processed event as text, the shape the warehouse consumer receives (all dates as text).
PROCESSED_TEXT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("premium_amount", T.LongType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("user_tenure_days", T.IntegerType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("event_day_of_week", T.IntegerType()),
    T.StructField("is_purchase", T.IntegerType()),
    T.StructField("processing_time", T.StringType()),
    T.StructField("data_source", T.StringType()),
])

# Stream source layout: the raw event with a real timestamp for watermarks.
RAW_EVENT_STREAM = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("premium_amount", T.LongType()),
])

# Monitor logs written by the quality jobs (column sets of the seven logs).
HEALTH_LOG = T.StructType([
    T.StructField("check_time", T.TimestampNTZType()),
    T.StructField("component", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("threshold_value", T.DoubleType()),
    T.StructField("details", T.StringType()),
    T.StructField("alert_level", T.IntegerType()),
])

CHECK_LOG = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("check_time", T.TimestampNTZType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("check_type", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("expected_value", T.DoubleType()),
    T.StructField("actual_value", T.DoubleType()),
    T.StructField("deviation_percent", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("details", T.StringType()),
    T.StructField("affected_rows", T.ArrayType(T.LongType())),
])

SYNC_LAG_LOG = T.StructType([
    T.StructField("metric_time", T.TimestampNTZType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("lag_seconds", T.LongType()),
    T.StructField("source_timestamp", T.TimestampNTZType()),
    T.StructField("target_timestamp", T.TimestampNTZType()),
    T.StructField("records_behind", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("alert_threshold", T.LongType()),
])
