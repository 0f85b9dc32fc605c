"""Run the checks into their monitor logs, then the dashboards over the logs.

``Logs`` builds every log lazily from the given tables (the checks are jobs
stamped with ``as_of``).  ``stored`` writes a log once to its table and returns
the table's rows, those of earlier runs too; the dashboards and the logs that
build on other logs read it.  ``run`` writes all of them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide import AS_OF
from eventide.functions.columns import as_of_ts
from eventide.operators import clean, enrich, metrics, quality
from eventide.plans import etl, orders_flow
from eventide.session import scratch_path
from eventide.sources import csv_ingest, fixtures, topic
from eventide.sources.tables import Tables

GAP_LOOKBACK = "30 DAYS"
# The time column of each log table.
TIME_COLUMNS = {"data_quality_checks": "check_time", "sync_lag_metrics": "metric_time",
                "pipeline_health_status": "check_time", "missing_event_alerts": "alert_time",
                "schema_drift_monitoring": "change_time", "load_performance_metrics": "load_time",
                "data_lineage_tracking": "lineage_time"}


def double_delivery(store: DataFrame) -> DataFrame:
    """Every event delivered twice, the second copy one minute later (input of the dedup and duplicate queries only)."""
    again = store.withColumn("ingestion_time", F.col("ingestion_time") + F.expr("INTERVAL 1 MINUTE"))
    return store.unionByName(again)


COMPLETE_COLUMNS = ["user_id", "session_id", "city", "device_type"]


class Logs:
    """All monitor logs of one run.

    With ``materialize`` the warehouse table the checks read is written once
    as parquet under the shared checkpoint folder, so the seven checks and
    the lineage counts scan it instead of re-running the ETL each time, and,
    being columnar, each check reads only the columns it needs (an RDD
    checkpoint would be read whole every time).  It also cuts the lineage:
    a lost executor recomputes from files.

    Log rows lie under ``root`` by log, month and run stamp, and a run replaces
    its own stamp only, so a repeated run leaves the same rows.
    """

    def __init__(self, t: Tables, as_of: str = AS_OF, materialize: bool = False, root: str | None = None,
                 store: DataFrame | None = None):
        self.t, self.as_of, self.materialize = t, as_of, materialize
        self.root = root or scratch_path(t.spark, "monitor-logs")
        self._written: dict[str, DataFrame] = {}
        if store is not None:
            self.store = store      # a written warehouse table: read as it is

    # inputs ---------------------------------------------------------------
    @cached_property
    def raw(self):
        return fixtures.raw_events(self.t.events)

    @cached_property
    def users(self):
        return fixtures.users(self.t.customer, self.t.nation)

    @cached_property
    def store(self):
        s = etl.stored_events(self.t, self.as_of)
        if not self.materialize:
            return s
        path = scratch_path(self.t.spark, "warehouse-events")
        s.write.parquet(path)
        return self.t.spark.read.parquet(path)

    @cached_property
    def parsed_lines(self):
        return csv_ingest.parse_event_lines(csv_ingest.events_to_csv_lines(self.raw))

    # logs -------------------------------------------------------------------
    def check_log(self) -> DataFrame:
        a = self.as_of
        orphans = enrich.orphan_events(self.store, self.users)
        purchases = self.store.filter(F.col("event_type") == "purchase")
        premiums = orders_flow.unified(self.t, columns=["order_date", "premium_amount"])
        parts = [
            quality.check_completeness(self.store, a),
            quality.check_duplicates(self.store, a),
            quality.referential_check(orphans, self.store, a),
            quality.violations_check(quality.range_violations(self.store), a, "validity",
                                     "range_violations", "critical"),
            quality.violations_check(quality.format_violations(self.parsed_lines), a, "validity",
                                     "format_violations", "high"),
            quality.violations_check(
                quality.temporal_violations(self.store, orders_flow.unified(self.t, columns=quality.POLICY_DATES)),
                a, "validity", "temporal_violations", "high"),
            quality.violations_check(quality.field_consistency(self.store, purchases, premiums), a, "consistency",
                                     "field_consistency", "high"),
            quality.violations_check(quality.outlier_rule(self.store, "premium_amount", ["event_type"]), a, "validity",
                                     "outliers_iqr", "medium"),
            quality.violations_check(quality.completeness_rule(self.store, COMPLETE_COLUMNS), a, "completeness",
                                     "completeness_by_column", "medium"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def sync_log(self) -> DataFrame:
        fresh = quality.check_freshness(self.store, self.as_of)
        users = fixtures.users_versioned(self.t.customer, self.t.nation)
        lags = quality.sync_lag_rows(self.store, users, self.as_of).filter(
            F.col("source_system") != "etl_pipeline")
        return fresh.unionByName(quality.with_lag_status(lags))

    def health_log(self) -> DataFrame:
        """Health rows of this run, from its stored check log where that was written.

        Otherwise the checks stay lazy, and the filter on severity drops those
        that can't raise an alert.
        """
        name = "data_quality_checks"
        checks = self.stored(name, this_run=True) if name in self._written else self.check_log()
        h = quality.sync_lag_status(self.sync_log()).drop("lag_seconds", "records_behind")
        return (h.unionByName(quality.volume_health(self.store, self.as_of))
                 .unionByName(quality.critical_alerts(checks, self.as_of)))

    def gap_log(self) -> DataFrame:
        return quality.missing_event_gaps(self.store, self.as_of, GAP_LOOKBACK, 3600, by_type=True)

    def drift_log(self) -> DataFrame:
        payloads = topic.encode_processed(etl.processed_events(self.t, self.as_of))
        d = quality.payload_drift(payloads)
        return d.select(as_of_ts(self.as_of).alias("change_time"), "*",
                        F.concat(F.lit("Rows affected: "), F.col("rows_affected").cast("string")).alias("details"))

    def load_log(self) -> DataFrame:
        return quality.load_performance(self.parsed_lines)

    def lineage_log(self) -> DataFrame:
        a, t = self.as_of, self.t
        clean_ev = clean.clean_events(self.raw)
        processed = etl.processed_events(t, a)
        steps = [
            quality.lineage_step(self.raw, clean_ev, "raw_events", "validity_filter", "clean_events", "filter", a),
            quality.lineage_step(clean_ev, processed, "clean_events", "user_enrichment", "processed_events",
                                 "enrichment", a),
            quality.lineage_step(self.store, metrics.daily_aggregate_metrics(self.store), EVENTS_TABLE_NAME,
                                 "daily_aggregation", "daily_aggregate_metrics", "aggregation", a),
            quality.lineage_step(self.store.filter(F.col("event_type") == "purchase"),
                                 orders_flow.ops.denormalize(
                                     self.store.filter(F.col("event_type") == "purchase"),
                                     orders_flow.unified(t, columns=orders_flow.ops.order_columns_for(())),
                                     orders_flow.payments(t), a, ()),
                                 "purchase_events", "order_denormalization", "purchase_events_denormalized",
                                 "join", a),
        ]
        return quality.record_lineage(steps)

    BUILD = {"data_quality_checks": check_log, "sync_lag_metrics": sync_log, "pipeline_health_status": health_log,
             "missing_event_alerts": gap_log, "schema_drift_monitoring": drift_log,
             "load_performance_metrics": load_log, "data_lineage_tracking": lineage_log}

    def stored(self, name: str, this_run: bool = False) -> DataFrame:
        """Rows of a log table, of all runs or this one, after this run's rows were written (once)."""
        path = f"{self.root}/{name}"
        if name not in self._written:
            df = self.BUILD[name](self)
            (df.withColumn("month", F.date_format(TIME_COLUMNS[name], "yyyyMM"))
               .withColumn("run", F.lit(self.as_of)).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("month", "run").parquet(path))
            keyed = df.schema.add("month", "string").add("run", "string")
            self._written[name] = self.t.spark.read.schema(keyed).parquet(path)
        rows = self._written[name]
        if this_run:
            rows = rows.filter(F.col("run") == self.as_of)
        return rows.drop("month", "run")

    def run(self) -> dict[str, str]:
        """Write every log; returns log -> path."""
        for name in self.BUILD:
            self.stored(name)
        return {name: f"{self.root}/{name}" for name in self.BUILD}


EVENTS_TABLE_NAME = quality.EVENTS_TABLE


def run(t: Tables, as_of: str = AS_OF, root: str | None = None, store: DataFrame | None = None) -> dict[str, str]:
    """Write every log of one run under ``root``, over the written ``store`` where one is given; returns log -> path."""
    return Logs(t, as_of, materialize=True, root=root, store=store).run()
