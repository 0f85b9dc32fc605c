"""Dashboards over the monitor logs (D14-D21).  Each is a filter + group/sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import impact_rank, lookback, severity_rank


def health_dashboard(health: DataFrame, as_of: str, within: str = "1 HOUR") -> DataFrame:
    """Per component, its metrics as sorted 'name:value:status:level' text, and the max level."""
    h = health.filter(lookback(F.col("check_time"), as_of, within))
    item = F.concat_ws(":", "metric_name", F.col("metric_value").cast("bigint").cast("string"),
                       "status", F.col("alert_level").cast("string"))
    return (h.groupBy("component")
            .agg(F.sort_array(F.collect_list(item)).alias("metrics"),
                 F.max("alert_level").alias("max_severity"))
            .orderBy(F.desc("max_severity"), "component"))


def quality_issues(checks: DataFrame, as_of: str, within: str = "24 HOURS") -> DataFrame:
    """Non-passing checks, most severe (by rank, not alphabet) and newest first."""
    c = checks.filter((F.col("status") != "pass") & lookback(F.col("check_time"), as_of, within))
    return (c.select("table_name", "check_type", "check_name", "status", "severity",
                     "deviation_percent", "check_time", "details")
            .orderBy(severity_rank(F.col("severity")).desc(), F.desc("check_time"), "check_name"))


def quality_issue_counts(checks: DataFrame, as_of: str, within: str = "24 HOURS") -> DataFrame:
    """D15 (counts): non-passing checks by table and check type."""
    c = checks.filter((F.col("status") != "pass") & lookback(F.col("check_time"), as_of, within))
    return c.groupBy("table_name", "check_type").agg(F.count(F.lit(1)).alias("issues"))


def sync_lag_report(lags: DataFrame, as_of: str, within: str = "6 HOURS") -> DataFrame:
    """Lag over its alert threshold, worst first."""
    return (lags.filter((F.col("lag_seconds") > F.col("alert_threshold"))
                        & lookback(F.col("metric_time"), as_of, within))
            .select("source_system", "target_table", "lag_seconds", "status", "records_behind", "metric_time")
            .orderBy(F.desc("lag_seconds"), "source_system"))


def alert_counts(health: DataFrame, as_of: str, within: str = "5 MINUTES") -> DataFrame:
    """Critical and warning counts in the window (one aggregate, no join)."""
    h = health.filter(lookback(F.col("check_time"), as_of, within))
    return h.agg(F.count_if(F.col("alert_level") == 2).alias("critical_count"),
                 F.count_if(F.col("alert_level") == 1).alias("warning_count")) \
            .withColumn("verdict", F.when(F.col("critical_count") > 0, "critical")
                        .when(F.col("warning_count") > 0, "warning").otherwise("healthy"))


def top_alerts(health: DataFrame, as_of: str, within: str = "30 MINUTES", top: int = 10) -> DataFrame:
    """D17 (list): the top alerts of the window, most severe then newest."""
    h = health.filter((F.col("alert_level") > 0) & lookback(F.col("check_time"), as_of, within))
    return (h.select("component", "metric_name", "status", "details", "check_time", "alert_level")
            .orderBy(F.desc("alert_level"), F.desc("check_time"), "component", "metric_name")
            .limit(top))


def active_gaps(gaps: DataFrame, as_of: str, within: str = "24 HOURS") -> DataFrame:
    """Active gaps logged in the window, longest first."""
    return (gaps.filter((F.col("status") == "active") & lookback(F.col("alert_time"), as_of, within))
            .select("alert_type", "table_name", "time_gap_start", "time_gap_end",
                    "missing_duration_seconds", "estimated_missing_count", "status")
            .orderBy(F.desc("missing_duration_seconds"), "time_gap_start"))


def drift_summary(drift: DataFrame, as_of: str, within: str = "7 DAYS") -> DataFrame:
    """Per table: changes, kinds, highest impact (by rank), latest change."""
    d = drift.filter(lookback(F.col("change_time"), as_of, within))
    top = F.max_by("impact_level", impact_rank(F.col("impact_level")))
    return (d.groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("changes_count"),
                 F.sort_array(F.collect_set("change_type")).alias("change_types"),
                 top.alias("max_impact"),
                 F.max("change_time").alias("latest_change"))
            .orderBy(F.desc("changes_count"), "table_name"))


def load_trends(loads: DataFrame, as_of: str, within: str = "24 HOURS") -> DataFrame:
    """Per table and hour: rows, mean throughput, worst error rate, batches."""
    l = loads.filter(lookback(F.col("load_time"), as_of, within))
    return (l.groupBy("table_name", F.date_trunc("hour", "load_time").cast("timestamp_ntz").alias("hour"))
            .agg(F.sum("records_processed").alias("total_records"),
                 F.round(F.avg("throughput_records_per_second"), 4).alias("avg_throughput"),
                 F.max("error_rate_percent").alias("max_error_rate"),
                 F.count(F.lit(1)).alias("batch_count"))
            .orderBy(F.desc("hour"), F.desc("total_records")))


def lineage_report(lineage: DataFrame, as_of: str, within: str = "24 HOURS") -> DataFrame:
    """Per step: summed counts, mean loss percent, runs."""
    l = lineage.filter(lookback(F.col("lineage_time"), as_of, within))
    return (l.groupBy("source_table", "transformation_step", "target_table")
            .agg(F.sum("source_records").alias("total_source_records"),
                 F.sum("target_records").alias("total_target_records"),
                 F.round(F.avg("record_loss_percent"), 4).alias("avg_loss_percent"),
                 F.count(F.lit(1)).alias("transformation_count"))
            .orderBy(F.desc("avg_loss_percent"), "transformation_step"))
