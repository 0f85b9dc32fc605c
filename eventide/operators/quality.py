"""Data-quality checks (D1-D13, D22-D30) as Spark jobs.

Each check is a function ``(inputs, as_of, params) -> DataFrame`` whose rows
have the layout of the monitor log it feeds (check log, sync-lag log, health
log, gap log, drift log, load log, lineage log).  Thresholds are parameters.
Every aggregate is one pass with partial aggregation; samples of offending
ids are bounded top-k subqueries, never whole collected groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import (as_of_ts, completeness_flag, ladder, lookback,
                                        parse_time_best_effort, pct, safe_ratio,
                                        seconds_between)
from eventide.operators.windows import exact_percentiles, gaps_over, global_next

EVENTS_TABLE = "processed_events_storage"
SAMPLE_SIZE = 10


def check_id(table: Column, check_name: Column, as_of: str) -> Column:
    """Repeatable id of a check row: its key, not a random UUID."""
    return F.concat_ws(":", table, check_name, F.date_format(as_of_ts(as_of), "yyyyMMddHHmmss"))


def sample_ids(offending: DataFrame, id_col: str, k: int = SAMPLE_SIZE) -> Column:
    """The k smallest offending ids as an array (scalar subquery, bounded top-k)."""
    top = offending.select(F.col(id_col).cast("bigint").alias("id")).orderBy("id").limit(k)
    return top.select(F.coalesce(F.sort_array(F.collect_list("id")),
                                 F.array().cast("array<bigint>"))).scalar()


def _one_row(df: DataFrame) -> DataFrame:
    """A one-row frame that check rows built from scalar subqueries hang on."""
    return df.sparkSession.range(1)


def _scalar(df: DataFrame, agg: Column) -> Column:
    """``agg`` over the whole of ``df`` as a scalar subquery.

    Spark merges the scalar subqueries of one plan that aggregate the same
    input into a single aggregate (and reuses it), so the counters of every
    check written this way, even across the branches of a log, cost one pass
    over the table instead of one scan per check.
    """
    return df.select(agg).scalar()


def _check_row(df: DataFrame, as_of: str, table: str, check_type: str, name: str,
               expected: Column, actual: Column, deviation: Column, status: Column,
               severity: Column, errors: Column, total: Column, details: Column,
               affected: Column | None = None) -> DataFrame:
    return df.select(
        check_id(F.lit(table), F.lit(name), as_of).alias("check_id"),
        as_of_ts(as_of).alias("check_time"),
        F.lit(table).alias("table_name"), F.lit(check_type).alias("check_type"),
        F.lit(name).alias("check_name"),
        expected.cast("double").alias("expected_value"), actual.cast("double").alias("actual_value"),
        deviation.cast("double").alias("deviation_percent"), status.alias("status"),
        severity.alias("severity"), errors.cast("bigint").alias("error_count"),
        total.cast("bigint").alias("total_records"), details.alias("details"),
        (affected if affected is not None else F.array().cast("array<bigint>")).alias("affected_rows"))


# ---- D1-D3 ---------------------------------------------------------------
def check_completeness(events: DataFrame, as_of: str, days: int = 1,
                       pass_pct: float = 99.5, warn_pct: float = 95.0) -> DataFrame:
    """Share of recent events with a user id; status on the unrounded percent.

    Without recent events there is no share: the check fails with high severity.
    """
    recent = F.col("event_date") >= F.date_sub(as_of_ts(as_of).cast("date"), days)
    n = _scalar(events, F.count_if(recent))
    ok = _scalar(events, F.count_if(recent & (F.col("user_id") > 0)))
    p = safe_ratio(ok * 100.0, n)
    status = ladder(p, [(p >= pass_pct, "pass"), (p >= warn_pct, "warning")], "fail")
    sev = F.when(p.isNull() | (p < warn_pct), "high").otherwise("low")
    miss = n - ok
    affected = sample_ids(events.filter(recent & (~(F.col("user_id") > 0) | F.col("user_id").isNull())),
                          "event_id")
    return _check_row(_one_row(events), as_of, EVENTS_TABLE, "completeness", "user_id_completeness",
                      F.lit(100.0), F.round(p, 2), F.round(100.0 - p, 2), status, sev, miss, n,
                      F.concat(F.lit("Missing user_id count: "), miss.cast("string")), affected)


def check_duplicates(events: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    """Count - distinct event ids over recent events; a row only if they differ.

    One aggregation by event_id (partial before its shuffle) feeds the row
    count, the distinct ids and the sample of duplicated ids: the totals are
    merged scalar subqueries over it and the sample reuses its exchange, so
    the check shuffles the events once.
    """
    recent = events.filter(F.col("event_date") >= F.date_sub(as_of_ts(as_of).cast("date"), days))
    per_id = recent.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    n = F.coalesce(_scalar(per_id, F.sum("copies")), F.lit(0))
    d = _scalar(per_id, F.count("event_id"))  # NULL ids are rows but not distinct ids
    dup = n - d
    out = _check_row(_one_row(events), as_of, EVENTS_TABLE, "accuracy", "duplicate_events", F.lit(0.0),
                     F.round(dup, 2), F.lit(0.0), F.when(dup == 0, "pass").otherwise("fail"), F.lit("medium"),
                     dup, n, F.concat(F.lit("Duplicate event count: "), dup.cast("string")),
                     sample_ids(per_id.filter(F.col("copies") > 1), "event_id"))
    return out.filter(F.col("error_count") != 0)


def check_freshness(events: DataFrame, as_of: str, source_system: str = "etl_pipeline",
                    target_table: str = EVENTS_TABLE, synced_s: int = 300,
                    lagging_s: int = 3600) -> DataFrame:
    """D3: seconds since the newest event; a sync-lag log row."""
    now = as_of_ts(as_of)
    agg = _one_row(events).select(
        _scalar(events, F.max("event_time")).alias("src"),
        _scalar(events, F.count_if(F.col("event_time") < now - F.expr("INTERVAL 1 HOUR"))).alias("behind"))
    lag = seconds_between(F.col("src"), now)
    return agg.select(
        now.alias("metric_time"), F.lit(source_system).alias("source_system"),
        F.lit(target_table).alias("target_table"), lag.alias("lag_seconds"),
        F.col("src").alias("source_timestamp"), now.alias("target_timestamp"),
        F.col("behind").alias("records_behind"),
        ladder(lag, [(lag <= synced_s, "synced"), (lag <= lagging_s, "lagging")], "critical_lag").alias("status"),
        F.lit(synced_s).cast("bigint").alias("alert_threshold"))


# Per-source lag thresholds (warning, critical) in seconds.
LAG_THRESHOLDS = [
    ("mysql_cdc", "sync_delay", 60, 300),
    ("kafka_consumer", "consumer_lag", 300, 1800),
    ("etl_pipeline", "etl_delay", 600, 1800),
]


def sync_lag_rows(spark_events: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Lag rows per source: ETL (event time -> processing), consumer
    (processing -> ingestion), CDC (dimension update -> as_of)."""
    now = as_of_ts(as_of)
    ev, one = spark_events, _one_row(spark_events)
    etl = one.select(_scalar(ev, F.max("event_time")).alias("src"), _scalar(ev, F.max("processing_time")).alias("dst"),
                     _scalar(ev, F.count_if(F.col("event_time") < now - F.expr("INTERVAL 1 HOUR"))).alias("behind"))
    consumer = one.select(
        _scalar(ev, F.max("processing_time")).alias("src"), _scalar(ev, F.max("ingestion_time")).alias("dst"),
        _scalar(ev, F.count_if(F.col("processing_time") < F.col("ingestion_time")
                               - F.expr("INTERVAL 1 HOUR"))).alias("behind"))
    cdc = users.agg(F.max("updated_at").alias("src"), now.alias("dst"),
                    F.count_if(F.col("updated_at") < now - F.expr("INTERVAL 1 HOUR")).alias("behind"))

    def row(df: DataFrame, source: str, target: str) -> DataFrame:
        return df.select(now.alias("metric_time"), F.lit(source).alias("source_system"),
                         F.lit(target).alias("target_table"),
                         seconds_between(F.col("src"), F.col("dst")).alias("lag_seconds"),
                         F.col("src").alias("source_timestamp"), F.col("dst").alias("target_timestamp"),
                         F.col("behind").alias("records_behind"))
    return (row(etl, "etl_pipeline", "processed_events").unionByName(
            row(consumer, "kafka_consumer", EVENTS_TABLE)).unionByName(
            row(cdc, "mysql_cdc", "users")))


def sync_lag_status(lags: DataFrame) -> DataFrame:
    """Lag rows classified against per-source thresholds (health log rows).

    The threshold table is a fixed three-row frame, broadcast by construction.
    """
    spark: SparkSession = lags.sparkSession
    th = spark.createDataFrame(LAG_THRESHOLDS, "source_system string, metric_name string, "
                                               "warn_s long, crit_s long")
    j = lags.join(F.broadcast(th), "source_system")
    lag = F.col("lag_seconds")
    return j.select(
        F.col("metric_time").alias("check_time"), F.col("source_system").alias("component"),
        "metric_name", lag.cast("double").alias("metric_value"),
        ladder(lag, [(lag <= F.col("warn_s"), "healthy"), (lag <= F.col("crit_s"), "warning")],
               "critical").alias("status"),
        F.col("warn_s").cast("double").alias("threshold_value"),
        F.concat(F.col("source_system"), F.lit(" lag: "), lag.cast("string"), F.lit(" seconds")).alias("details"),
        F.when(lag > F.col("crit_s"), 2).when(lag > F.col("warn_s"), 1).otherwise(0).alias("alert_level"),
        "lag_seconds", "records_behind")


def with_lag_status(lags: DataFrame) -> DataFrame:
    """Sync-lag log rows with their status and alert threshold."""
    spark = lags.sparkSession
    th = spark.createDataFrame(LAG_THRESHOLDS, "source_system string, metric_name string, "
                                               "warn_s long, crit_s long")
    lag = F.col("lag_seconds")
    return (lags.join(F.broadcast(th), "source_system")
            .withColumn("status", ladder(lag, [(lag <= F.col("warn_s"), "synced"),
                                               (lag <= F.col("crit_s"), "lagging")], "critical_lag"))
            .withColumn("alert_threshold", F.col("warn_s"))
            .drop("metric_name", "warn_s", "crit_s"))


def volume_health(events: DataFrame, as_of: str, healthy: int = 50, warning: int = 20) -> DataFrame:
    """Events per hour (all of history, every hour of the span, empty ones too)."""
    hourly = hourly_counts(events)
    n = F.col("events")
    return hourly.select(
        F.col("hour").alias("check_time"), F.lit("processed_events").alias("component"),
        F.lit("hourly_volume").alias("metric_name"), n.cast("double").alias("metric_value"),
        ladder(n, [(n >= healthy, "healthy"), (n >= warning, "warning")], "critical").alias("status"),
        F.lit(float(healthy)).alias("threshold_value"),
        F.concat(F.lit("Events in hour: "), n.cast("string")).alias("details"),
        F.when(n < warning, 2).when(n < healthy, 1).otherwise(0).alias("alert_level"))


def hourly_counts(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Events per hour over the whole span, zero for empty hours.

    The hour grid is generated from the span (one row per hour: bounded by
    time, not by data) and left-joined to the partially aggregated counts.
    """
    counts = (events.groupBy(F.date_trunc("hour", ts_col).cast("timestamp_ntz").alias("hour"))
              .agg(F.count(F.lit(1)).alias("events")))
    lo = _scalar(events, F.date_trunc("hour", F.min(ts_col)).cast("timestamp_ntz"))
    hi = _scalar(events, F.date_trunc("hour", F.max(ts_col)).cast("timestamp_ntz"))
    grid = _one_row(events).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return grid.join(counts, "hour", "left").select("hour", F.coalesce("events", F.lit(0)).alias("events"))


# ---- D6 payload drift --------------------------------------------------------
# The processed-event payload contract (field, type).
PAYLOAD_CONTRACT = [
    ("event_id", "bigint"), ("event_time", "timestamp"), ("user_id", "bigint"),
    ("session_id", "string"), ("event_type", "string"), ("channel", "string"),
    ("premium_amount", "bigint"), ("signup_date", "date"), ("city", "string"),
    ("device_type", "string"), ("user_tenure_days", "int"), ("event_date", "date"),
    ("event_hour", "int"), ("event_day_of_week", "int"), ("is_purchase", "int"),
    ("processing_time", "timestamp"), ("data_source", "string"),
]
HIGH_IMPACT = ("event_id", "user_id", "event_time")


def _mistyped(value: Column, typ: Column) -> Column:
    ok = (F.when(typ == "bigint", value.try_cast("bigint").isNotNull())
          .when(typ == "int", value.try_cast("int").isNotNull())
          .when(typ == "timestamp", parse_time_best_effort(value).isNotNull())
          .when(typ == "date", parse_time_best_effort(value).isNotNull())
          .otherwise(F.lit(True)))
    return value.isNotNull() & ~ok


def payload_drift(payloads: DataFrame, table: str = EVENTS_TABLE,
                  contract: Sequence[tuple[str, str]] = PAYLOAD_CONTRACT) -> DataFrame:
    """Fields added, missing (absent or null) and mistyped across all JSON payloads.

    Each payload's keys are exploded from a string map (no fixed schema), so
    unknown fields are seen; the contract is a fixed small table (broadcast).
    """
    spark = payloads.sparkSession
    c = spark.createDataFrame(list(contract), "column_name string, expected_type string")
    kv = (payloads.select(F.explode(F.from_json(F.col("value").cast("string"), "map<string,string>"))
                          .alias("column_name", "v")))
    total = payloads.select(F.count(F.lit(1))).scalar()
    # one aggregation over the exploded pairs counts presence and type errors
    # (a field outside the contract has no expected type and is never mistyped)
    per_key = (kv.join(F.broadcast(c), "column_name", "left")
               .groupBy("column_name")
               .agg(F.count_if(F.col("v").isNotNull()).alias("present"),
                    F.count_if(_mistyped(F.col("v"), F.col("expected_type"))).alias("mistyped")))
    full = per_key.join(F.broadcast(c), "column_name", "full")
    added = full.filter(F.col("expected_type").isNull()).select(
        "column_name", F.lit("column_added").alias("change_type"), F.col("present").alias("rows_affected"))
    missing = full.filter(F.col("expected_type").isNotNull()).select(
        "column_name", F.lit("column_removed").alias("change_type"),
        (total - F.coalesce(F.col("present"), F.lit(0))).alias("rows_affected"))
    typed = full.filter(F.col("expected_type").isNotNull()).select(
        "column_name", F.lit("type_change").alias("change_type"),
        F.coalesce(F.col("mistyped"), F.lit(0)).alias("rows_affected"))
    out = added.unionByName(missing).unionByName(typed).filter(F.col("rows_affected") > 0)
    return out.select(
        F.lit(table).alias("table_name"), "column_name", "change_type",
        F.col("rows_affected").cast("bigint").alias("rows_affected"),
        F.when(F.col("column_name").isin(*HIGH_IMPACT), "high").otherwise("low").alias("impact_level"),
        F.lit("automated_check").alias("detected_by"))


def schema_drift(df: DataFrame, expected: Sequence[str], table: str = EVENTS_TABLE) -> DataFrame:
    """D6 (schema form): columns of a DataFrame not in the expected list, and vice versa."""
    spark = df.sparkSession
    have = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                 "column_name string, type string")
    want = spark.createDataFrame([(c,) for c in expected], "column_name string")
    added = have.join(want, "column_name", "left_anti").select(
        "column_name", F.lit("column_added").alias("change_type"), "type")
    removed = want.join(have, "column_name", "left_anti").select(
        "column_name", F.lit("column_removed").alias("change_type"), F.lit(None).cast("string").alias("type"))
    return added.unionByName(removed).select(F.lit(table).alias("table_name"), "*")


# ---- D7/D8 gaps -------------------------------------------------------------
def missing_event_gaps(events: DataFrame, as_of: str, lookback_interval: str = "24 HOURS",
                       min_gap_seconds: int = 3600, expected_event_type: str | None = None,
                       per_minute: int = 1, by_type: bool = False) -> DataFrame:
    """One row per gap longer than the threshold (gap log rows).

    Gaps run over all events, or those of one expected type; ``by_type`` adds
    the gaps of every type to those of all events, in the same pass.
    Thresholds under an hour take the global order of W1, for one scope.
    """
    ev = events.filter(lookback(F.col("event_time"), as_of, lookback_interval))
    if expected_event_type:
        ev = ev.filter(F.col("event_type") == expected_event_type)
    scope = F.lit(expected_event_type or "any")
    if min_gap_seconds < 3600:
        if by_type:
            raise ValueError("gaps of every type need a threshold of at least one hour")
        g = (global_next(ev.select("event_id", "event_time"), ["event_time", "event_id"], "event_time", "gap_end")
             .withColumnRenamed("event_time", "gap_start")
             .withColumn("gap_seconds", seconds_between(F.col("gap_start"), F.col("gap_end")))
             .filter(F.col("gap_seconds") > min_gap_seconds))
    elif by_type:
        g, scope = gaps_over(ev, min_gap_seconds, by="event_type"), F.col("scope")
    else:
        g = gaps_over(ev, min_gap_seconds)
    return g.select(
        as_of_ts(as_of).alias("alert_time"), F.lit("gap_detection").alias("alert_type"),
        F.lit(EVENTS_TABLE).alias("table_name"),
        F.col("gap_start").alias("time_gap_start"), F.col("gap_end").alias("time_gap_end"),
        F.col("gap_seconds").alias("missing_duration_seconds"),
        scope.alias("expected_event_type"),
        F.floor(F.col("gap_seconds") * per_minute / 60).cast("bigint").alias("estimated_missing_count"),
        F.lit("active").alias("status"))


def gap_severity(gaps: DataFrame) -> DataFrame:
    """Minor 1-4 h, major 4-24 h, critical over 24 h."""
    s = F.col("missing_duration_seconds")
    return gaps.withColumn("gap_severity", ladder(s, [(s > 86400, "critical"), (s > 14400, "major"),
                                                      (s > 3600, "minor")], "none"))


# ---- D9/D10 ---------------------------------------------------------------
def load_performance(parsed: DataFrame, table: str = EVENTS_TABLE,
                     source: str = "kafka_consumer", window_seconds: float = 3600.0) -> DataFrame:
    """Per hour of event time: rows loaded, rejected, throughput, error rate, status."""
    hour = F.date_trunc("hour", parse_time_best_effort(F.col("event_time"))).cast("timestamp_ntz")
    agg = (parsed.groupBy(hour.alias("load_time"))
           .agg(F.count_if(F.col("reject_reason").isNull()).alias("records_processed"),
                F.count_if(F.col("reject_reason").isNotNull()).alias("records_failed")))
    ok, bad = F.col("records_processed"), F.col("records_failed")
    return agg.select(
        "load_time", F.lit(table).alias("table_name"), F.lit(source).alias("source_system"),
        F.date_format("load_time", "H_yyyy-MM-dd").alias("batch_id"), ok, bad,
        F.lit(window_seconds).alias("processing_time_seconds"),
        F.round(ok / window_seconds, 2).alias("throughput_records_per_second"),
        F.coalesce(pct(bad, ok + bad), F.lit(0.0)).alias("error_rate_percent"),
        F.when(bad == 0, "success").when(ok == 0, "complete_failure").otherwise("partial_failure").alias("status"))


def lineage_step(source: DataFrame, target: DataFrame, source_table: str, step: str,
                 target_table: str, kind: str, as_of: str) -> DataFrame:
    """One lineage row: counts on both sides of a pipeline step (two scalar subqueries)."""
    s = source.select(F.count(F.lit(1))).scalar()
    t = target.select(F.count(F.lit(1))).scalar()
    spark = source.sparkSession
    loss = s - t
    return spark.range(1).select(
        as_of_ts(as_of).alias("lineage_time"), F.lit(source_table).alias("source_table"),
        s.alias("source_records"), F.lit(step).alias("transformation_step"),
        F.lit(target_table).alias("target_table"), t.alias("target_records"),
        loss.alias("record_loss_count"),
        F.coalesce(pct(loss, s), F.lit(0.0)).alias("record_loss_percent"),
        F.lit(kind).alias("transformation_type"),
        F.when(s > 0, "success").otherwise("critical").alias("status"),
        F.concat(F.lit("Source: "), s.cast("string"), F.lit(", Target: "), t.cast("string")).alias("details"))


def record_lineage(steps: Sequence[DataFrame]) -> DataFrame:
    """The lineage rows of a run, one per step."""
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


# ---- D11/D12 ------------------------------------------------------------------
def outliers_iqr(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                 k: float = 1.5) -> DataFrame:
    """Rows outside [Q1 - k*IQR, Q3 + k*IQR] of their group (exact quartiles).

    Quartiles come from ``exact_percentiles`` (value counts and a skew-safe
    running sum, so no group's values meet in one task); the one-row-per-group
    bounds join back on the group keys, or are scalar subqueries without groups.
    """
    v = F.col(value_col)
    q = exact_percentiles(df, value_col, {"q1": 0.25, "q3": 0.75}, group_cols)
    if not group_cols:
        j = df.select("*", q.select("q1").scalar().alias("q1"), q.select("q3").scalar().alias("q3"))
    else:
        names = {c: f"_group_{i}" for i, c in enumerate(group_cols)}
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]      # rows without a group are one group
        j = df.join(q.withColumnsRenamed(names), same).drop(*names.values())
    j = (j.withColumn("lower_bound", F.col("q1") - k * (F.col("q3") - F.col("q1")))
          .withColumn("upper_bound", F.col("q3") + k * (F.col("q3") - F.col("q1"))))
    return j.filter((v < F.col("lower_bound")) | (v > F.col("upper_bound")))


def completeness_by_column(df: DataFrame, cols: Sequence[str], table: str = EVENTS_TABLE) -> DataFrame:
    """Percent of rows whose listed columns are all present and non-empty."""
    return df.agg(
        F.lit(table).alias("table_name"), F.lit(",".join(cols)).alias("column_list"),
        F.count(F.lit(1)).alias("total_records"),
        F.sum(completeness_flag(cols)).cast("bigint").alias("complete_records"),
        F.round(F.avg(completeness_flag(cols)) * 100.0, 2).alias("completeness_percent"))


def outlier_rule(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """D11 as one rule row: how many rows lie outside their group's bounds."""
    outside = outliers_iqr(df, value_col, group_cols).select(F.count(F.lit(1))).scalar()
    return df.agg(F.lit(value_col).alias("column_name"), F.count(F.lit(1)).alias("checked_rows")).withColumn("violations", outside)


def completeness_rule(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D12 as one rule row: how many rows lack one of the columns."""
    return completeness_by_column(df, cols).select(
        F.col("column_list").alias("column_name"), (F.col("total_records") - F.coalesce("complete_records", F.lit(0))).alias("violations"),
        F.col("total_records").alias("checked_rows"))


# ---- D13 -------------------------------------------------------------------------
def critical_alerts(check_log: DataFrame, as_of: str, within: str = "1 HOUR") -> DataFrame:
    """Failed critical checks in the window, per table (health log rows)."""
    f = check_log.filter((F.col("severity") == "critical") & (F.col("status") == "fail")
                         & lookback(F.col("check_time"), as_of, within))
    n = F.count(F.lit(1))
    return (f.groupBy(F.col("table_name").alias("component"))
            .agg(n.alias("n"))
            .select(as_of_ts(as_of).alias("check_time"), "component",
                    F.lit("critical_alert").alias("metric_name"), F.col("n").cast("double").alias("metric_value"),
                    F.lit("critical").alias("status"), F.lit(0.0).alias("threshold_value"),
                    F.concat(F.lit("Critical alert count: "), F.col("n").cast("string")).alias("details"),
                    F.lit(2).alias("alert_level")))


# ---- D22-D30 ----------------------------------------------------------------------
# Value ranges of the stored columns; user ids are as wide as a long.
RANGE_RULES = [
    ("user_id", 0, 9223372036854775807), ("premium_amount", 0, 4294967295), ("event_hour", 0, 23),
    ("event_day_of_week", 1, 7), ("is_purchase", 0, 1), ("user_tenure_days", 0, 65535),
]


def range_violations(events: DataFrame, rules: Sequence[tuple[str, int, int]] = RANGE_RULES) -> DataFrame:
    """Per rule, values outside the expected range (one pass over the table)."""
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(lo).cast("bigint").alias("min_value"),
                     F.lit(hi).cast("bigint").alias("max_value"),
                     _scalar(events, F.count_if((F.col(c) < lo) | (F.col(c) > hi))).alias("violations"),
                     _scalar(events, F.count(F.col(c))).alias("checked_values")) for c, lo, hi in rules]
    return _one_row(events).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


SESSION_PATTERN = r"^s_[0-9]+_[0-9]{8}$"


def format_violations(lines_parsed: DataFrame) -> DataFrame:
    """Bad time text, non-integer user ids, non-numeric premiums, malformed session ids."""
    t = F.col("event_time")
    wide = lines_parsed.agg(
        F.count_if(t.isNotNull() & F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).isNull()).alias("event_time"),
        F.count_if(F.col("reject_reason") == "bad_user_id").alias("user_id"),
        F.count_if(F.col("reject_reason") == "bad_premium_amount").alias("premium_amount"),
        F.count_if(~F.coalesce(F.col("session_id"), F.lit("")).rlike(SESSION_PATTERN)).alias("session_id"),
        F.count(F.lit(1)).alias("n"))
    cols = ["event_time", "user_id", "premium_amount", "session_id"]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations"), F.col("n").alias("checked_rows"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


POLICY_DATES = ["policy_start_date", "policy_end_date"]  # the order columns D24 reads


def temporal_violations(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Events before the user's signup; policies ending before they start."""
    e = _one_row(events).select(
        F.lit("event_before_signup").alias("rule"),
        _scalar(events, F.count_if(F.col("event_date") < F.col("signup_date"))).alias("violations"),
        _scalar(events, F.count(F.lit(1))).alias("checked_rows"))
    o = orders.agg(F.count_if(F.col("policy_end_date") < F.col("policy_start_date")).alias("violations"),
                   F.count(F.lit(1)).alias("checked_rows")).select(
        F.lit("policy_end_before_start").alias("rule"), "violations", "checked_rows")
    return e.unionByName(o)


def field_consistency(events: DataFrame, purchases: DataFrame, orders: DataFrame) -> DataFrame:
    """is_purchase disagreeing with event_type; event premium vs matched order premium.

    The premium rule is over every (purchase, order) pair of a (user, day)
    (the J2 match) with an order premium, but the pairs are never formed:
    per (user, day), checked pairs = purchases x orders; per (user, day,
    premium), agreeing pairs = purchases x orders with that premium;
    violations = pairs with a purchase premium - agreeing pairs.  A hot
    (user, day) costs a few aggregated rows, not the product of its sizes.
    """
    a = _one_row(events).select(
        F.lit("is_purchase_vs_event_type").alias("rule"),
        _scalar(events, F.count_if((F.col("is_purchase") == 1) != (F.col("event_type") == "purchase")))
        .alias("violations"),
        _scalar(events, F.count(F.lit(1))).alias("checked_rows"))
    keys = ["user_id", "day"]
    p = purchases.select("user_id", F.col("event_date").alias("day"), F.col("premium_amount").alias("v"))
    o = (orders.filter(F.col("premium_amount").isNotNull())
         .select("user_id", F.col("order_date").alias("day"), F.col("premium_amount").alias("v")))
    per_day = (p.groupBy(*keys).agg(F.count(F.lit(1)).alias("np"), F.count("v").alias("np_v"))
               .join(o.groupBy(*keys).agg(F.count(F.lit(1)).alias("no")), keys))
    agreeing = (p.filter(F.col("v").isNotNull()).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("pv"))
                .join(o.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("ov")), [*keys, "v"])
                .select(F.sum(F.col("pv") * F.col("ov"))).scalar())
    b = per_day.agg(F.coalesce(F.sum(F.col("np") * F.col("no")), F.lit(0)).alias("checked_rows"),
                    F.coalesce(F.sum(F.col("np_v") * F.col("no")), F.lit(0)).alias("pairs_v")).select(
        F.lit("event_premium_vs_order_premium").alias("rule"),
        (F.col("pairs_v") - F.coalesce(agreeing, F.lit(0))).alias("violations"), "checked_rows")
    return a.unionByName(b)


def volume_anomalies(events: DataFrame, trailing: int = 24, drop_ratio: float = 0.5) -> DataFrame:
    """Hourly counts against the mean of the preceding ``trailing`` hours."""
    h = hourly_counts(events)
    w = Window.orderBy("hour").rowsBetween(-trailing, -1)  # one row per hour: bounded by the span
    avg = F.avg("events").over(w)
    return (h.withColumn("trailing_avg", F.round(avg, 4))
             .withColumn("ratio", F.round(safe_ratio(F.col("events"), avg), 4))
             .withColumn("is_drop", F.when(F.col("ratio") < drop_ratio, 1).otherwise(0)))


def arrival_frequency(events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Per hour: arrivals, mean gap to the next event, mean processing delay.

    The next event time comes from the global-order pass of W1 run over just
    the three columns needed, and the hourly aggregate reads its output
    directly: no join of the gaps back to the events.
    """
    base = events.select("event_id", "event_time", "processing_time")
    g = global_next(base, ["event_time", "event_id"], "event_time", "next_event_time", num_partitions)
    return (g.groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.round(F.avg(seconds_between(F.col("event_time"), F.col("next_event_time"))), 4)
                  .alias("avg_gap_seconds"),
                 F.round(F.avg(seconds_between(F.col("event_time"), F.col("processing_time"))), 4)
                  .alias("avg_processing_delay_seconds")))


def record_count_check(source: DataFrame, target: DataFrame, id_col: str = "event_id") -> DataFrame:
    """Expected (source) vs actual (target) rows and distinct source ids reached."""
    exp_ = source.select(F.count(F.lit(1))).scalar()
    act = target.select(F.count(F.lit(1))).scalar()
    ids = target.select(F.count_distinct(id_col)).scalar()
    return source.sparkSession.range(1).select(
        exp_.alias("expected_rows"), act.alias("actual_rows"), ids.alias("distinct_source_ids"),
        F.coalesce(pct(act - exp_, exp_), F.lit(0.0)).alias("deviation_percent"))


def sequence_breaks(events: DataFrame) -> DataFrame:
    """Purchases whose session has no earlier view or signup.

    Per session only the earliest (time, id) of a view/signup is kept
    (partial aggregation, skew-safe), then purchases join it many-to-one.
    """
    key = F.struct("event_time", "event_id")
    firsts = (events.filter(F.col("event_type").isin("view", "signup"))
              .groupBy("session_id").agg(F.min(key).alias("first_entry")))
    buys = events.filter(F.col("event_type") == "purchase").select(
        "event_id", "event_time", "session_id", "user_id", key.alias("k"))
    j = buys.join(firsts, "session_id", "left")
    return (j.filter(F.col("first_entry").isNull() | (F.col("first_entry") > F.col("k")))
            .select("event_id", "event_time", "session_id", "user_id"))


def referential_check(orphans: DataFrame, events: DataFrame, as_of: str,
                      fail_pct: float = 5.0) -> DataFrame:
    """Consistency check row: events whose user is unknown (from J7)."""
    n = _scalar(events, F.count(F.lit(1)))
    bad = _scalar(orphans, F.count(F.lit(1)))
    p = pct(bad, n)
    return _check_row(events.sparkSession.range(1), as_of, EVENTS_TABLE, "consistency", "orphan_user_events",
                      F.lit(0.0), p, p, F.when(bad == 0, "pass").when(p < fail_pct, "warning").otherwise("fail"),
                      F.when(p >= fail_pct, "critical").otherwise("medium"), bad, n,
                      F.concat(F.lit("Events with unknown user: "), bad.cast("string")),
                      sample_ids(orphans, "event_id"))


def violations_check(rules: DataFrame, as_of: str, check_type: str, name: str,
                     severity: str, rule_col: str = "column_name") -> DataFrame:
    """Fold a rule table (rule, violations, checked) into one check-log row."""
    agg = rules.agg(F.sum("violations").alias("bad"), F.max(F.col("checked_rows") if "checked_rows" in rules.columns
                                                          else F.col("checked_values")).alias("n"))
    bad = F.col("bad")
    return _check_row(agg, as_of, EVENTS_TABLE, check_type, name, F.lit(0.0), bad,
                      F.coalesce(pct(bad, F.col("n")), F.lit(0.0)),
                      F.when(bad == 0, "pass").otherwise("fail"),
                      F.lit(severity), bad, F.col("n"),
                      F.concat(F.lit(f"{name} violations: "), bad.cast("string")))
