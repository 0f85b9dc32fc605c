"""Serving layout: the warehouse tables written once, queried many times.

The original answers its dashboards from stored, pre-partitioned tables.
Here the same tables are written under the shared checkpoint folder by
(month[, insurance_type]), sorted inside files by their sort key (row-group
min/max prune ranges) with bloom filters on the point-lookup columns; the
roll-ups then read only the partitions and columns they need.  The dashboards
read the monitor logs that a quality run stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide import AS_OF
from eventide.operators import maintain, metrics, orders, reports
from eventide.plans import etl, orders_flow, quality_run
from eventide.session import scratch_path
from eventide.sources.layout import write_partitioned
from eventide.sources.tables import Tables


#: Per table: date column, partition columns after the month, sort columns, bloom filters.
LAYOUT = {
    "processed_events_storage": ("event_date", (), ("event_date", "event_id"), ("session_id",)),
    "session_metrics": ("first_event_time", (), ("session_id",), ("session_id",)),
    "purchase_events_denormalized": ("event_date", ("insurance_type",), ("event_date", "event_id"), ("policy_number",)),
}


def write_tables(t: Tables, as_of: str = AS_OF, root: str | None = None) -> dict[str, str]:
    """The three warehouse tables by month, each written once; returns their folders by table name."""
    root = root or scratch_path(t.spark, "warehouse")
    paths = {n: f"{root}/{n}" for n in LAYOUT}
    write_partitioned(etl.stored_events(t, as_of), paths["processed_events_storage"],
                      *LAYOUT["processed_events_storage"])
    # the written table is the input of the other two: no separate checkpoint of the store
    store = t.spark.read.parquet(paths["processed_events_storage"]).drop("month")
    write_partitioned(metrics.session_metrics(store), paths["session_metrics"], *LAYOUT["session_metrics"])
    purchases = store.filter("event_type = 'purchase'")
    # the purchases lie in a file: a narrow scan of them tells which orders can meet one
    met = orders.orders_met(orders_flow.unified(t), purchases)
    denorm = orders.denormalize(purchases, met, orders_flow.payments(t), as_of)
    write_partitioned(denorm, paths["purchase_events_denormalized"], *LAYOUT["purchase_events_denormalized"])
    return paths


def rewrite_retained(spark: SparkSession, table: str, path: str, as_of: str) -> str:
    """U4 on a stored table: the rows within its age, written by the same layout to a new folder, so readers of
    the old one are not disturbed and a rerun after a failure starts afresh.  Expired months are not read."""
    out = scratch_path(spark, f"{table}-retained")
    kept = maintain.retain_table(spark.read.parquet(path), table, as_of).drop("month")
    write_partitioned(kept, out, *LAYOUT[table])
    return out


def materialize(t: Tables, as_of: str = AS_OF, root: str | None = None) -> dict[str, str]:
    root = root or scratch_path(t.spark, "serving")
    tables = write_tables(t, as_of, root)
    paths = {"store": tables["processed_events_storage"], "sessions": tables["session_metrics"],
             "denorm": tables["purchase_events_denormalized"]}
    store = t.spark.read.parquet(paths["store"]).drop("month")
    logs = quality_run.run(t, as_of, f"{root}/monitor-logs", store)
    return paths | {"checks": logs["data_quality_checks"], "health": logs["pipeline_health_status"],
                    "lineage": logs["data_lineage_tracking"]}


def open_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {k: spark.read.parquet(p) for k, p in paths.items()}


SERVING = {
    "serve_insurance_type_last_days": lambda tb: orders.insurance_type_last_days(tb["denorm"], AS_OF, 30),
    "serve_user_product_mix": lambda tb: orders.user_product_mix(tb["denorm"], tb["sessions"], AS_OF, 90, 100),
    "serve_channel_product_performance": lambda tb: orders.channel_product_performance(tb["denorm"], AS_OF, 7),
    "serve_insurance_type_last_week": lambda tb: orders.insurance_type_last_week(tb["denorm"], AS_OF, 7),
    "serve_type_date_lookup": lambda tb: orders.type_date_lookup(tb["denorm"], "2024-01-01", "third_party"),
    "serve_daily_event_metrics": lambda tb: metrics.daily_event_metrics(tb["store"]),
    "serve_session_kpis": lambda tb: metrics.session_kpis(tb["sessions"]),
    "serve_health_dashboard": lambda tb: reports.health_dashboard(tb["health"], AS_OF),
    "serve_top_alerts": lambda tb: reports.top_alerts(tb["health"], AS_OF),
    "serve_quality_issues": lambda tb: reports.quality_issues(tb["checks"], AS_OF),
    "serve_lineage_report": lambda tb: reports.lineage_report(tb["lineage"], AS_OF),
}
