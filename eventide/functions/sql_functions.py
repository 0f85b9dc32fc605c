"""Quality checks as SQL-defined functions of a session (F1, F2); temporary, without Python code.

``register`` defines them; afterwards any SQL text of the session may call them:
``complete_record`` (D12), ``outside_fences`` (D11), ``sync_status`` and the
table function ``sync_row`` (D3).  Nulls: a null value, or a null array, makes a
record incomplete; a null value or fence is no outlier; a null lag is critical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.columns import as_of_ts
from eventide.operators.windows import exact_percentiles

DEFINITIONS = (
    """complete_record(vals ARRAY<STRING>) RETURNS INT
       RETURN CASE WHEN forall(vals, v -> v IS NOT NULL AND v <> '') THEN 1 ELSE 0 END""",
    """outside_fences(v DOUBLE, q1 DOUBLE, q3 DOUBLE, k DOUBLE) RETURNS BOOLEAN
       RETURN coalesce(v < q1 - k * (q3 - q1) OR v > q3 + k * (q3 - q1), false)""",
    """sync_status(lag BIGINT, synced BIGINT, lagging BIGINT) RETURNS STRING
       RETURN CASE WHEN lag <= synced THEN 'synced' WHEN lag <= lagging THEN 'lagging' ELSE 'critical_lag' END""",
    """sync_row(seen TIMESTAMP_NTZ, moment TIMESTAMP_NTZ, synced BIGINT, lagging BIGINT)
       RETURNS TABLE (lag_seconds BIGINT, status STRING, alert_threshold BIGINT)
       RETURN SELECT timestampdiff(SECOND, seen, moment), sync_status(timestampdiff(SECOND, seen, moment), synced, lagging), synced""",
)


def register(spark: SparkSession) -> None:
    """Define the functions in the session (again, if they are there)."""
    for d in DEFINITIONS:
        spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION " + d)


def completeness(events: DataFrame, table: str) -> DataFrame:
    """D12 as SQL text."""
    spark = events.sparkSession
    register(spark)
    return spark.sql("""
        SELECT :table AS table_name, 'user_id,session_id,city,device_type' AS column_list, count(*) AS total_records,
               CAST(sum(ok) AS BIGINT) AS complete_records, round(avg(ok) * 100.0, 2) AS completeness_percent
        FROM (SELECT complete_record(array(CAST(user_id AS STRING), session_id, city, device_type)) AS ok FROM {events})
        """, args={"table": table}, events=events)


def outliers(events: DataFrame, k: float = 1.5) -> DataFrame:
    """D11 as SQL text, over exact quartiles by event type."""
    spark = events.sparkSession
    register(spark)
    fences = exact_percentiles(events, "premium_amount", {"q1": 0.25, "q3": 0.75}, ["event_type"])
    return spark.sql("""
        SELECT e.event_id, e.event_type, e.premium_amount, f.q1, f.q3,
               f.q1 - :k * (f.q3 - f.q1) AS lower_bound, f.q3 + :k * (f.q3 - f.q1) AS upper_bound
        FROM {events} e JOIN {fences} f ON e.event_type <=> f.event_type
        WHERE outside_fences(e.premium_amount, f.q1, f.q3, :k)
        """, args={"k": float(k)}, events=events, fences=fences)


def freshness(events: DataFrame, as_of: str, source_system: str, target_table: str) -> DataFrame:
    """D3 as SQL text: one aggregate, then the table function on its row."""
    spark = events.sparkSession
    register(spark)
    timed = events.select("event_time", as_of_ts(as_of).alias("moment"))
    moment = spark.range(1).select(as_of_ts(as_of).alias("moment"))
    return spark.sql("""
        SELECT m.moment AS metric_time, :source AS source_system, :target AS target_table, r.lag_seconds,
               m.seen AS source_timestamp, m.moment AS target_timestamp, m.behind AS records_behind, r.status, r.alert_threshold
        FROM (SELECT (SELECT moment FROM {moment}) AS moment, max(event_time) AS seen,
                     count_if(event_time < moment - INTERVAL 1 HOUR) AS behind FROM {timed}) m,
             LATERAL sync_row(CAST(m.seen AS TIMESTAMP_NTZ), CAST(m.moment AS TIMESTAMP_NTZ), 300, 3600) r
        """, args={"source": source_system, "target": target_table}, timed=timed, moment=moment)
