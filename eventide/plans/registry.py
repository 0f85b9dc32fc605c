"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

``present`` renders the result for cross-engine comparison: dates as ISO
text, arrays as '|'-joined text (their order is already deterministic), and
session-zone timestamps as TIMESTAMP_NTZ.  Values are otherwise unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import AS_OF
from eventide.functions.columns import instant_to_ntz as _instant_to_ntz
from eventide.operators import clean, enrich, metrics
from eventide.plans import etl
from eventide.sources import fixtures
from eventide.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        elif isinstance(f.dataType, T.TimestampType):
            c = _instant_to_ntz(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, _fn=fn: present(_fn(Tables(spark, sf_dir))))
            for name, fn in QUERIES.items()}


def raw_queries() -> dict[str, Query]:
    """Same queries without presentation (native Spark types)."""
    return {name: (lambda spark, sf_dir, _fn=fn: _fn(Tables(spark, sf_dir)))
            for name, fn in QUERIES.items()}


# ---- C1 chain ------------------------------------------------------------
def _raw(t: Tables) -> DataFrame:
    return fixtures.raw_events(t.events)


def _users(t: Tables) -> DataFrame:
    return fixtures.users(t.customer, t.nation)


@register("clean_events")
def q_clean_events(t):
    return clean.clean_events(_raw(t))


@register("enrich_events")
def q_enrich_events(t):
    return enrich.enrich_events(clean.clean_events(_raw(t)), _users(t))


@register("derive_event_attributes")
def q_derive(t):
    return clean.derive_event_attributes(enrich.enrich_events(clean.clean_events(_raw(t)), _users(t)))


@register("run_etl")
def q_run_etl(t):
    return etl.processed_events(t, AS_OF)


# ---- aggregations ----------------------------------------------------------
@register("daily_event_metrics")
def q_daily_event_metrics(t):
    return metrics.daily_event_metrics(etl.stored_events(t, AS_OF))


# ---- orders -----------------------------------------------------------------
from eventide.operators import maintain, orders  # noqa: E402
from eventide.plans import orders_flow  # noqa: E402


def _sessions(t):
    return metrics.session_metrics(etl.stored_events(t, AS_OF))


@register("unified_orders")
def q_unified_orders(t):
    return orders_flow.unified(t)


@register("latest_version")
def q_latest_version(t):
    """U1 over all four product tables, a fifth of whose single-version orders was written a second time."""
    stored = None
    for kind in ("third_party", "body_injury", "medical", "fire"):
        part = getattr(fixtures, f"{kind}_orders")(t.orders).withColumn("insurance_type", F.lit(kind))
        stored = part if stored is None else stored.unionByName(part, allowMissingColumns=True)
    stored = stored.withColumnRenamed("vehicle_type", "product_type").select(*orders.UNIFIED_COLUMNS, "version")
    again = (stored.filter((F.col("insurance_type") != "third_party") & (F.col("order_id") % 5 == 0))
             .withColumn("premium_amount", F.col("premium_amount") + 7).withColumn("version", F.col("version") + 1)
             .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR")))
    return maintain.latest_version(stored.unionByName(again), ["insurance_type", "order_id", "user_id"])


@register("purchase_order_join")
def q_purchase_order_join(t):
    o = orders_flow.unified(t, columns=["order_date", "policy_number", "premium_amount"])
    j = orders.purchase_order_join(etl.purchases(t, AS_OF), o)
    return j.select("e.event_id", "e.user_id", "e.event_date", "e.premium_amount", "o.order_id",
                    "o.insurance_type", "o.policy_number", F.col("o.premium_amount").alias("order_premium_amount"))


@register("purchase_denormalized")
def q_purchase_denormalized(t):
    return orders_flow.denormalized_raw(t, AS_OF)


@register("dedup_denormalized")
def q_dedup_denormalized(t):
    return orders_flow.denormalized(t, AS_OF)


@register("purchase_denormalized_by_order_id")
def q_by_order_id(t):
    o = orders_flow.unified(t, columns=["policy_number", "coverage_amount"])
    return orders.purchase_denormalized_by_order_id(etl.purchases(t, AS_OF), o, orders_flow.payments(t))


@register("product_inner_join")
def q_product_inner_join(t):
    return orders.product_inner_join(etl.stored_events(t, AS_OF), fixtures.third_party_orders(t.orders),
                                     orders_flow.payments(t), "2024-01-01", "third_party")


def _denorm(t, rollup: str):
    """The denormalised table projected to what ``rollup`` reads (orders.READS)."""
    return orders_flow.denormalized(t, AS_OF, orders.READS[rollup])


@register("type_date_lookup")
def q_type_date_lookup(t):
    return orders.type_date_lookup(_denorm(t, "type_date_lookup"), "2024-01-01", "third_party")


@register("insurance_type_summary")
def q_insurance_type_summary(t):
    return orders.insurance_type_summary(_denorm(t, "insurance_type_summary"))


@register("user_daily_summary")
def q_user_daily_summary(t):
    return orders.user_daily_summary(_denorm(t, "user_daily_summary"))


@register("insurance_type_last_days")
def q_insurance_type_last_days(t):
    return orders.insurance_type_last_days(_denorm(t, "insurance_type_last_days"), AS_OF, 30)


@register("user_product_mix")
def q_user_product_mix(t):
    return orders.user_product_mix(_denorm(t, "user_product_mix"), _sessions(t), AS_OF, 90, 100)


@register("channel_product_performance")
def q_channel_product_performance(t):
    return orders.channel_product_performance(_denorm(t, "channel_product_performance"), AS_OF, 7)


@register("insurance_type_last_week")
def q_insurance_type_last_week(t):
    return orders.insurance_type_last_week(_denorm(t, "insurance_type_last_week"), AS_OF, 7)


@register("denormalized_overview")
def q_denormalized_overview(t):
    return orders.denormalized_overview(_denorm(t, "denormalized_overview"))


# ---- windows -----------------------------------------------------------------
from eventide.operators import windows  # noqa: E402


@register("event_gaps")
def q_event_gaps(t):
    return windows.event_gaps(etl.processed_events(t, AS_OF))


# ---- sources / sinks -----------------------------------------------------------
from eventide.functions.columns import as_of_ts, parse_time_best_effort, safe_ratio, seconds_between  # noqa: E402
from eventide.operators import quality, quantile_sketches, reports, schema_versions  # noqa: E402
from eventide.functions import sql_functions  # noqa: E402
from eventide.plans import quality_run, serving  # noqa: E402
from eventide.session import scratch_path  # noqa: E402
from eventide.sources import csv_ingest, incremental, layout, polling, topic  # noqa: E402
from eventide.schemas import PROCESSED_COLUMNS  # noqa: E402


@register("decode_events")
def q_decode_events(t):
    return topic.decode_events(topic.encode_raw_events(_raw(t)))


def _parsed_lines(t):
    return csv_ingest.parse_event_lines(fixtures.spoiled_events(_raw(t)))


@register("event_rejects")
def q_event_rejects(t):
    """The lines that give no event, with the reason."""
    return csv_ingest.reject_rows(_parsed_lines(t))


@register("user_rejects")
def q_user_rejects(t):
    """S3: the lines that give no user, with the reason; an id above 2**31 is a user."""
    rejects = csv_ingest.user_rejects(fixtures.spoiled_users(_users(t)))
    return rejects.select(F.substring_index("value", ",", 1).alias("written_id"), "reject_reason")


@register("ingest_events_csv")
def q_ingest_events_csv(t):
    return csv_ingest.good_rows(_parsed_lines(t))


@register("ingest_report")
def q_ingest_report(t):
    return csv_ingest.ingest_report(_parsed_lines(t))


@register("ingest_users_csv")
def q_ingest_users_csv(t):
    return csv_ingest.parse_user_lines(fixtures.spoiled_users(_users(t)), AS_OF)


@register("users_profile")
def q_users_profile(t):
    return csv_ingest.users_profile(_users(t))


@register("encode_processed")
def q_encode_processed(t):
    """S7 round trip: encode every processed row, decode it back on the consumer side."""
    return topic.decode_processed(topic.encode_processed(etl.processed_events(t, AS_OF)), AS_OF)


@register("normalize_processed")
def q_normalize_processed(t):
    """P7 on text rows whose dates are written in mixed layouts."""
    p = etl.processed_events(t, AS_OF)
    txt = p.select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
         .otherwise(F.date_format("event_time", "yyyy/MM/dd HH:mm:ss")).alias("event_time"),
        "user_id", "session_id", "event_type", "channel", "premium_amount",
        F.date_format("signup_date", "dd/MM/yyyy").alias("signup_date"), "city", "device_type",
        "user_tenure_days", F.col("event_date").cast("string").alias("event_date"),
        "event_hour", "event_day_of_week", "is_purchase",
        F.date_format("processing_time", "yyyy-MM-dd HH:mm:ss").alias("processing_time"), "data_source")
    return clean.normalize_processed(txt, AS_OF)


@register("incremental_load")
def q_incremental_load(t):
    """Users above the high-water mark of those already synced (the users seen in events)."""
    users = _users(t)
    synced = users.join(_raw(t).select("user_id").distinct(), "user_id", "left_semi")
    return incremental.incremental_load(users, synced, "user_id")


@register("write_partitioned")
def q_write_partitioned(t):
    """Denormalised purchases written by (month, type), sorted, bloom-indexed; read back."""
    spark = t.spark
    path = scratch_path(spark, "purchase_events_denormalized")
    d = orders_flow.denormalized(t, AS_OF).withColumn("insurance_type", F.coalesce("insurance_type", F.lit("none")))
    layout.write_partitioned(d, path, "event_date", ("insurance_type",), ("event_date", "event_id"),
                             ("policy_number",))
    back = spark.read.option("basePath", path).schema(
        d.schema.add("month", "string")).parquet(path)
    return back


@register("event_key")
def q_event_key(t):
    """P3 over events delivered twice: both deliveries of an event share its key, different events do not."""
    return clean.key_classes(clean.event_key(quality_run.double_delivery(_store(t))))


@register("scalar_functions")
def q_scalar_functions(t):
    s = etl.stored_events(t, AS_OF)
    parts = F.split("session_id", "_")
    return s.select(
        "event_id",
        parse_time_best_effort(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("parsed_time"),
        F.to_date("event_time").alias("event_day"),
        F.hour("event_time").alias("hour_of_day"),
        F.dayofweek("event_time").alias("day_of_week"),
        F.datediff("event_date", "signup_date").alias("days_since_signup"),
        seconds_between(F.col("event_time"), as_of_ts(AS_OF)).alias("seconds_to_as_of"),
        F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour_bucket"),
        F.date_format("event_time", "yyyyMM").alias("month_key"),
        F.trim("device_type").alias("device_trimmed"),
        F.concat("event_type", F.lit("/"), "channel").alias("label"),
        F.col("user_id").cast("string").alias("user_text"),
        F.coalesce("city", F.lit("unknown")).alias("city_or_unknown"),
        F.round(F.col("premium_amount") / F.lit(100.0), 2).alias("premium_units"),
        F.round(safe_ratio(F.col("premium_amount"), F.col("event_hour")), 4).alias("premium_per_hour"),
        F.when(F.col("premium_amount") > 5000, 1).otherwise(0).alias("is_big"),
        F.get_json_object(F.to_json(F.struct("channel", "premium_amount")), "$.channel").alias("json_channel"),
        F.size(parts).alias("session_parts"),
        F.when(F.forall(parts, lambda x: x != ""), 1).otherwise(0).alias("all_parts_nonempty"),
        F.size(F.filter(parts, lambda x: x.rlike("^[0-9]+$"))).alias("numeric_parts"),
        F.array_join(F.transform(parts, lambda x: F.upper(x)), "-").alias("upper_parts"),
    )


# ---- events: more roll-ups -----------------------------------------------------------
def _store(t):
    return etl.stored_events(t, AS_OF)


@register("daily_aggregate_metrics")
def q_daily_aggregate_metrics(t):
    return metrics.daily_aggregate_metrics(_store(t))


@register("session_metrics")
def q_session_metrics(t):
    return _sessions(t)


@register("session_kpis")
def q_session_kpis(t):
    return metrics.session_kpis(_sessions(t))


@register("session_kpis_sketch")
def q_session_kpis_sketch(t):
    """A4 per day and per month from stored day sketches; the estimate is random, so its error is compared."""
    sessions = _sessions(t)
    path = scratch_path(t.spark, "session-sketches")
    quantile_sketches.daily_session_sketches(sessions).write.parquet(path)
    report = quantile_sketches.period_report(sessions, t.spark.read.parquet(path))
    return report.select("period_kind", "period", "sessions", "avg_session_duration", "conversion_rate", "p95_exact",
                         (F.col("rank_error") <= quantile_sketches.RANK_ERROR).alias("p95_within"))


@register("category_values_report")
def q_category_values_report(t):
    return metrics.category_values_report(_store(t))


@register("null_counts")
def q_null_counts(t):
    return metrics.null_counts(etl.processed_events(t, AS_OF))


@register("daily_metrics_rollup")
def q_daily_metrics_rollup(t):
    return metrics.daily_metrics_rollup(metrics.daily_metrics_partials(_store(t)))


@register("daily_metrics_rollup_sketch")
def q_daily_metrics_rollup_sketch(t):
    return metrics.sketch_accuracy(_store(t))


@register("table_row_counts")
def q_table_row_counts(t):
    s = _store(t)
    return metrics.table_row_counts({
        "processed_events_storage": s,
        "daily_event_metrics": metrics.daily_event_metrics(s),
        "daily_aggregate_metrics": metrics.daily_aggregate_metrics(s),
        "session_metrics": metrics.session_metrics(s),
        "purchase_events_denormalized": orders_flow.denormalized(t, AS_OF, ())})


@register("signup_to_purchase_journey")
def q_journey(t):
    return metrics.signup_to_purchase_journey(_store(t))


@register("channel_attribution")
def q_channel_attribution(t):
    return metrics.channel_attribution(_store(t))


@register("orphan_events")
def q_orphan_events(t):
    return enrich.orphan_events(clean.clean_events(_raw(t)), _users(t))


@register("known_user_events")
def q_known_user_events(t):
    return enrich.known_user_events(clean.clean_events(_raw(t)), _users(t))


# ---- maintenance -----------------------------------------------------------------------
@register("dedup_events")
def q_dedup_events(t):
    return maintain.dedup_events(quality_run.double_delivery(_store(t)))


@register("retain_recent")
def q_retain_recent(t):
    return maintain.retain_recent(_store(t), "event_time", 7, AS_OF)


#: A date at which the first weeks of the stored events have passed their age.
RETENTION_AS_OF = "2025-01-15 00:00:00"


@register("retained_tables")
def q_retained_tables(t):
    """U4 on the stored layout: each table rewritten without its expired rows, by its own age."""
    paths = serving.write_tables(t, AS_OF)
    kept = {table: serving.rewrite_retained(t.spark, table, path, RETENTION_AS_OF) for table, path in paths.items()}
    before = metrics.table_row_counts({n: t.spark.read.parquet(p) for n, p in paths.items()})
    after = metrics.table_row_counts({n: t.spark.read.parquet(p) for n, p in kept.items()})
    days = F.lit(None)
    for table in paths:
        days = F.when(F.col("table_name") == table, maintain.RETENTION[table][1]).otherwise(days)
    return (before.withColumnRenamed("row_count", "rows_before")
            .join(after.withColumnRenamed("row_count", "rows_kept"), "table_name")
            .withColumn("days", days))


@register("layout_lookup")
def q_layout_lookup(t):
    """U6 on the stored layout: the session of the earliest event, and the policy of the earliest insured purchase."""
    paths = serving.write_tables(t, AS_OF)
    store = t.spark.read.parquet(paths["processed_events_storage"])
    denorm = t.spark.read.parquet(paths["purchase_events_denormalized"])
    first_event = store.orderBy("event_time", "event_id").select("session_id").first()
    insured = denorm.filter(F.col("policy_number").isNotNull())
    first_policy = insured.orderBy("event_time", "event_id", "policy_number").select("policy_number").first()
    by_session = maintain.point_lookup(store, "session_id", first_event and first_event[0])
    by_policy = maintain.point_lookup(denorm, "policy_number", first_policy and first_policy[0])
    cols = ["event_id", "user_id", "event_time"]
    return (by_session.select(F.lit("session").alias("lookup"), *cols, F.lit(None).cast("string").alias("policy_number"))
            .unionByName(by_policy.select(F.lit("policy").alias("lookup"), *cols, "policy_number")))


CURVE_FILES, CURVE_SHARE = 64, 0.4      # a lookup on either column of the clustered table touches at most this share


@register("clustered_lookup")
def q_clustered_lookup(t):
    """Events clustered on (user_id, event_date); the last user's and the last day's rows, and whether few files hold them."""
    path = scratch_path(t.spark, "clustered-events")
    layout.write_clustered(_store(t), path, ("user_id", "event_date"), CURVE_FILES, ("event_id",))
    table = t.spark.read.parquet(path)
    ranges = layout.file_ranges(table, ("user_id", "event_date"))
    found = []
    for column in ("user_id", "event_date"):
        value = ranges.agg(F.max(f"max_{column}").alias("v")).first().v       # from the files' ranges: one row a file
        rows = table.filter(F.col(column) == F.lit(value))
        few = layout.touched_share(ranges, column, F.lit(value)) <= CURVE_SHARE
        found.append(rows.select(F.lit(column).alias("looked_up"), "event_id", "user_id", "event_date", "premium_amount", few.alias("few_files")))
    return found[0].unionByName(found[1])


@register("point_lookup")
def q_point_lookup(t):
    """Lookup by the session of the earliest event (a key Spark derives; one row)."""
    s = _store(t)
    key = s.orderBy("event_time", "event_id").select("session_id").limit(1)
    return maintain.point_lookup_keys(s, key, "session_id")


@register("upsert_users")
def q_upsert_users(t):
    """Household-segment customers move to mobile devices in a version-2 change set."""
    cur = fixtures.users_versioned(t.customer, t.nation)
    hh = t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").cast("bigint").alias("user_id"))
    changes = (cur.join(hh, "user_id", "left_semi")
               .withColumn("device_type", F.lit("Mobile"))
               .withColumn("updated_at", as_of_ts(AS_OF))
               .withColumn("version", F.lit(2)))
    return maintain.upsert_users(cur, changes)


# ---- quality ---------------------------------------------------------------------------
def _logs(t):
    """Monitor logs; the warehouse table is written once to the shared folder."""
    return t.memo(("logs", AS_OF), lambda: quality_run.Logs(t, AS_OF, materialize=True))


def _lazy_logs(t):
    """Monitor logs that read the warehouse table in one pass, so nothing is written first."""
    return t.memo(("lazy logs", AS_OF), lambda: quality_run.Logs(t, AS_OF))


@register("check_completeness")
def q_check_completeness(t):
    return quality.check_completeness(_store(t), AS_OF)


@register("check_duplicates")
def q_check_duplicates(t):
    return quality.check_duplicates(quality_run.double_delivery(_store(t)), AS_OF)


@register("check_freshness")
def q_check_freshness(t):
    return quality.check_freshness(_store(t), AS_OF)


@register("sync_lag_status")
def q_sync_lag_status(t):
    return quality.sync_lag_status(_lazy_logs(t).sync_log())


@register("volume_health")
def q_volume_health(t):
    return quality.volume_health(_store(t), AS_OF)


@register("payload_drift")
def q_payload_drift(t):
    return quality.payload_drift(topic.encode_processed(etl.processed_events(t, AS_OF)))


def _deliveries(t) -> list[DataFrame]:
    """The stored events as four deliveries, by hour of day, whose files differ in nested fields, types and nulls."""
    path = scratch_path(t.spark, "deliveries")
    store = _store(t)
    store.withColumn("batch", F.expr("event_hour div 6")).write.partitionBy("batch").parquet(path)
    stored = t.spark.read.schema(store.schema.add("batch", "long")).parquet(path)

    def batch(k):
        return stored.filter(F.col("batch") == k).drop("batch")

    device = F.struct(F.col("device_type").alias("type"), F.col("city").alias("city"))
    return [
        batch(0),
        batch(1).withColumn("device", device),
        batch(2).withColumn("device", F.struct(F.col("device_type").alias("type")))
        .withColumn("premium_amount", F.col("premium_amount").cast("double"))
        .withColumn("session_id", F.when(F.col("is_purchase") == 0, F.col("session_id"))),
        batch(3).withColumn("device", F.struct(F.col("device_type").alias("type")))
        .withColumn("user_id", F.col("user_id").cast("string")).drop("city")
        .withColumn("tags", F.array(F.struct(F.col("channel").alias("name"))))]


@register("schema_drift_versions")
def q_schema_drift_versions(t):
    """D6 over versions: each delivery is registered (the last one twice, which adds no version), then compared."""
    path = scratch_path(t.spark, "schema-registry")
    start = datetime.fromisoformat(AS_OF)
    batches = _deliveries(t)
    for hour, df in enumerate([*batches, batches[-1]]):
        schema_versions.register_delivery(df, path, "processed_events_storage", start + timedelta(hours=hour))
    return schema_versions.drift(schema_versions.registry(t.spark, path))


@register("missing_event_gaps")
def q_missing_event_gaps(t):
    return _lazy_logs(t).gap_log()


@register("gap_severity")
def q_gap_severity(t):
    return quality.gap_severity(_lazy_logs(t).gap_log())


@register("load_performance")
def q_load_performance(t):
    return quality.load_performance(_parsed_lines(t))


@register("record_lineage")
def q_record_lineage(t):
    return _logs(t).lineage_log()


@register("outliers_iqr")
def q_outliers_iqr(t):
    return (quality.outliers_iqr(_store(t), "premium_amount", ["event_type"])
            .select("event_id", "event_type", "premium_amount", "q1", "q3", "lower_bound", "upper_bound"))


@register("completeness_by_column")
def q_completeness_by_column(t):
    return quality.completeness_by_column(_store(t), ["user_id", "session_id", "city", "device_type"])


@register("sql_outliers_iqr")
def q_sql_outliers_iqr(t):
    return sql_functions.outliers(_store(t))


@register("sql_completeness_by_column")
def q_sql_completeness_by_column(t):
    return sql_functions.completeness(_store(t), quality.EVENTS_TABLE)


@register("sql_check_freshness")
def q_sql_check_freshness(t):
    return sql_functions.freshness(_store(t), AS_OF, "etl_pipeline", quality.EVENTS_TABLE)


@register("critical_alerts")
def q_critical_alerts(t):
    return quality.critical_alerts(_logs(t).check_log(), AS_OF)


@register("health_dashboard")
def q_health_dashboard(t):
    return reports.health_dashboard(_logs(t).health_log(), AS_OF)


@register("quality_issues")
def q_quality_issues(t):
    return reports.quality_issues(_logs(t).check_log(), AS_OF)


@register("quality_issue_counts")
def q_quality_issue_counts(t):
    return reports.quality_issue_counts(_logs(t).check_log(), AS_OF)


@register("sync_lag_report")
def q_sync_lag_report(t):
    return reports.sync_lag_report(_lazy_logs(t).sync_log(), AS_OF)


@register("alert_counts")
def q_alert_counts(t):
    return reports.alert_counts(_logs(t).health_log(), AS_OF)


@register("top_alerts")
def q_top_alerts(t):
    return reports.top_alerts(_logs(t).health_log(), AS_OF)


@register("active_gaps")
def q_active_gaps(t):
    return reports.active_gaps(_lazy_logs(t).gap_log(), AS_OF)


@register("drift_summary")
def q_drift_summary(t):
    return reports.drift_summary(_logs(t).drift_log(), AS_OF)


@register("load_trends")
def q_load_trends(t):
    return reports.load_trends(_logs(t).load_log(), AS_OF, "30 DAYS")


@register("lineage_report")
def q_lineage_report(t):
    return reports.lineage_report(_logs(t).lineage_log(), AS_OF)


@register("range_violations")
def q_range_violations(t):
    return quality.range_violations(_store(t))


@register("format_violations")
def q_format_violations(t):
    return quality.format_violations(_parsed_lines(t))


@register("temporal_violations")
def q_temporal_violations(t):
    return quality.temporal_violations(_store(t), orders_flow.unified(t, columns=quality.POLICY_DATES))


@register("field_consistency")
def q_field_consistency(t):
    premiums = orders_flow.unified(t, columns=["order_date", "premium_amount"])
    return quality.field_consistency(_store(t), etl.purchases(t, AS_OF), premiums)


@register("volume_anomalies")
def q_volume_anomalies(t):
    return quality.volume_anomalies(_store(t))


@register("arrival_frequency")
def q_arrival_frequency(t):
    return quality.arrival_frequency(_store(t))


@register("record_count_check")
def q_record_count_check(t):
    return quality.record_count_check(etl.purchases(t, AS_OF), orders_flow.denormalized(t, AS_OF, ()))


@register("sequence_breaks")
def q_sequence_breaks(t):
    return quality.sequence_breaks(_store(t))


@register("affected_rows_sample")
def q_affected_rows_sample(t):
    s = _store(t)
    spark = t.spark
    breaks = quality.sequence_breaks(s)
    orphans = enrich.orphan_events(s, _users(t))
    rows = [(name, df) for name, df in (("sequence_breaks", breaks), ("orphan_user_events", orphans))]
    out = None
    for name, df in rows:
        r = spark.range(1).select(F.lit(name).alias("check_name"),
                                  df.select(F.count(F.lit(1))).scalar().alias("error_count"),
                                  quality.sample_ids(df, "event_id").alias("affected_rows"))
        out = r if out is None else out.unionByName(r)
    return out


@register("quality_check_log")
def q_quality_check_log(t):
    return _logs(t).check_log()


@register("quality_run")
def q_quality_run(t):
    """Write all logs to the shared folder, return the check log read back."""
    logs = quality_run.Logs(t, AS_OF, materialize=True)
    logs.run()
    return logs.stored("data_quality_checks")


# ---- streams ---------------------------------------------------------------------------
from eventide.schemas import RAW_EVENT_STREAM  # noqa: E402
import datetime as dt  # noqa: E402

from eventide.session import scratch_path  # noqa: E402
from eventide.operators import distincts  # noqa: E402
from eventide.streaming import stateful, streams  # noqa: E402


def _stream_of(t, df, name, time_col=None, max_files=None, to_ltz=None):
    """Stage a derived frame as a source directory and open it as a stream."""
    if to_ltz:
        df = streams.to_stream_time(df, to_ltz)
    path = streams.stage(df, name, time_col)
    return streams.read_stream(t.spark, path, df.schema, max_files)


@register("stream_ingest")
def q_stream_ingest(t):
    payloads = topic.encode_processed(etl.processed_events(t, AS_OF))
    path = streams.stage(payloads, "processed-topic", "offset")
    good, _ = streams.stream_ingest(t.spark, path, AS_OF, max_files=streams.batch_files(t.spark, path))
    return t.spark.read.parquet(good).drop("epoch")


@register("stream_dedup")
def q_stream_dedup(t):
    """Every event delivered twice, the second time a day of event time later (late, within the delay)."""
    twice = quality_run.double_delivery(_store(t))
    arrival = F.col("event_time") + F.when(F.col("ingestion_time") > as_of_ts(AS_OF), F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    staged = streams.stage(twice.withColumn("arrival", arrival), "redelivered", "arrival")
    s = streams.read_stream(t.spark, streams.in_arrival_order(t.spark, staged), twice.schema, streams.batch_files(t.spark, staged))
    out = scratch_path(t.spark, "last-writes")
    stateful.write_updates(stateful.last_writes(s), out, scratch_path(t.spark, "last-writes-checkpoint"),
                           partitions=streams.state_partitions(t.spark, staged))
    return stateful.current(t.spark, out, ["event_date", "event_id"]).select(*twice.columns)


@register("stream_enrich")
def q_stream_enrich(t):
    raw = _raw(t).select(*[f.name for f in RAW_EVENT_STREAM.fields])
    s = _stream_of(t, raw, "raw-events", "event_time", max_files=2, to_ltz="event_time")
    return streams.drain_append(t.spark, streams.stream_enrich(s, _users(t), AS_OF), "enrich")


@register("stream_daily_metrics")
def q_stream_daily_metrics(t):
    """T4 from mergeable partials; late events reach days of earlier batches."""
    late = _store(t).withColumn("arrival", F.col("event_time") + F.make_interval(hours=F.pmod(F.col("event_id"), F.lit(20)).cast("int")))
    staged = streams.in_arrival_order(t.spark, streams.stage(late, "store-daily", "arrival"))
    s = streams.read_stream(t.spark, staged, late.drop("arrival").schema, streams.batch_files(t.spark, staged))
    return t.spark.read.parquet(streams.stream_daily_partials(t.spark, s)).select("metric_date", "channel", "event_type", "city", "device_type",
        "total_events", "unique_users", "unique_sessions", "total_premium", "avg_premium")


@register("daily_metrics_exact_rollup")
def q_daily_metrics_exact_rollup(t):
    """A15 exact: partial rows of every hour (sums and id sets) merged to days."""
    events = _store(t).withColumnRenamed("event_date", "metric_date")
    _, measures, sets = distincts.daily_partials(events, metrics.DAILY_KEYS, block="event_hour")
    rows = distincts.daily_rollup(measures, sets, metrics.DAILY_KEYS)
    return rows.select(*metrics.DAILY_KEYS, "total_events", "unique_users", "unique_sessions", "total_premium", "purchase_events",
                       "total_users_with_premium")


@register("stream_session_metrics")
def q_stream_session_metrics(t):
    """T5: sessions from keyed state; files overlap in time, so sessions get late events over several batches."""
    late = _store(t).withColumn("arrival", F.col("event_time") + F.make_interval(hours=F.pmod(F.col("event_id"), F.lit(20)).cast("int")))
    staged = streams.stage(late, "store-sessions", "arrival")
    s = streams.read_stream(t.spark, streams.in_arrival_order(t.spark, staged), late.drop("arrival").schema,
                            streams.batch_files(t.spark, staged))
    out = scratch_path(t.spark, "sessions")
    stateful.write_updates(stateful.sessions(s, buckets=streams.state_buckets(t.spark, staged)), out,
                           scratch_path(t.spark, "sessions-checkpoint"),
                           partitions=streams.state_partitions(t.spark, staged))
    return stateful.current(t.spark, out, ["session_id", "user_id"])


@register("stream_purchase_payments")
def q_stream_purchase_payments(t):
    """T6 whole: every purchase with its orders and their payments, all three arriving as streams over several batches."""
    u = (orders_flow.unified(t, columns=["order_date", "policy_number", "premium_amount"])
         .withColumn("order_ts", streams.ntz_to_instant(F.col("order_date"))))
    f = orders_flow.payments(t).withColumn("payment_ts", streams.ntz_to_instant(F.col("payment_date")))
    frames = {"purchases": (streams.to_stream_time(etl.purchases(t, AS_OF)), "event_time"), "orders": (u, "order_ts"), "payments": (f, "payment_ts")}
    sources = {k: (streams.in_arrival_order(t.spark, streams.stage(df, k, at)), df.schema) for k, (df, at) in frames.items()}
    files = {k: streams.batch_files(t.spark, path) for k, (path, _) in sources.items()}
    paths = [path for path, _ in sources.values()]
    return stateful.drain_purchase_payments(t.spark, sources, dt.datetime(2026, 1, 1), max_files=files,
                                            partitions=streams.state_partitions(t.spark, *paths), buckets=streams.state_buckets(t.spark, *paths))


@register("stream_purchase_orders")
def q_stream_purchase_orders(t):
    """T6 over the whole source: every purchase with its orders, or without one."""
    staged = streams.to_stream_time(etl.purchases(t, AS_OF))
    path = streams.stage(staged, "purchases", "event_time")
    p = streams.read_stream(t.spark, path, staged.schema)
    u = (orders_flow.unified(t, columns=["order_date", "policy_number", "premium_amount"])
         .withColumn("order_ts", streams.ntz_to_instant(F.col("order_date"))))
    o = _stream_of(t, u, "orders", "order_ts")
    out = streams.drain_append(t.spark, streams.stream_purchase_orders(p, o), "purchase-orders")
    return streams.close_purchase_orders(out, t.spark.read.schema(staged.schema).parquet(path))


def _user_changes(t):
    cur = fixtures.users_versioned(t.customer, t.nation)
    hh = t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").cast("bigint").alias("user_id"))
    return (cur.join(hh, "user_id", "left_semi").withColumn("device_type", F.lit("Mobile"))
            .withColumn("updated_at", as_of_ts(AS_OF)).withColumn("version", F.lit(2)))


@register("stream_upsert_users")
def q_stream_upsert_users(t):
    s = _stream_of(t, _user_changes(t), "user-changes", None, max_files=2)
    log = streams.stream_upsert_users(t.spark, s)
    base = fixtures.users_versioned(t.customer, t.nation)
    return streams.current_users(base, t.spark.read.parquet(log))


@register("stream_poll_users")
def q_stream_poll_users(t):
    """Users polled by key in two runs; the lower half is there at the first, the second goes on at the stored mark."""
    users = _users(t).select(F.col("user_id").cast("long").alias("user_id"), "city")
    mid = users.agg(F.percentile_approx("user_id", 0.5)).first()[0] or 0
    path, sink, mark = (scratch_path(t.spark, n) for n in ("poll-users", "polled-users", "poll-mark"))
    for part in (users.filter(F.col("user_id") <= mid), users.filter(F.col("user_id") > mid)):
        part.write.mode("append").parquet(path)
        polling.poll(t.spark, path, users.schema, "user_id", sink, mark)
    return t.spark.read.schema(users.schema).parquet(sink)


@register("stream_freshness")
def q_stream_freshness(t):
    s = _stream_of(t, _store(t).select("event_id", "event_time"), "freshness", "event_time", to_ltz="event_time")
    return streams.drain_updates(t.spark, streams.stream_freshness(s), ["window_start"], "freshness")


@register("order_denormalization")
def q_order_denormalization(t):
    """Latest versions -> unified orders -> denormalised purchases -> dedup,
    written partitioned with its summaries; the stored table read back."""
    paths = orders_flow.run(t, AS_OF)
    return t.spark.read.parquet(paths["purchase_events_denormalized"]).drop("month")


@register("session_event_sequence")
def q_session_event_sequence(t):
    return metrics.session_event_sequence(_store(t))
