"""Table maintenance re-aimed as data jobs: versions, dedup, retention, lookup, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import as_of_ts


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` tuple.

    A ``groupBy`` with ``max_by`` over the whole row: it aggregates partially
    before the shuffle, so a key holding a third of all rows is reduced on
    every mapper instead of being sorted inside one task (as a
    ``row_number`` window would).  A maximum of structs is a sort aggregate, so
    the rows are first dealt to partitions of the advisory size (a REBALANCE,
    which also splits a hot key): a task sorts as much whatever the size of the
    input's splits.  Ties on the full order tuple are broken by
    the greatest row (lexicographic struct order), so the result is
    deterministic.  NULLs in the order columns rank lowest.
    """
    rest = [c for c in df.columns if c not in keys]
    rank: Column = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in rest])
    best = F.max(F.struct(rank.alias("r"), row.alias("w")))
    # keys come from the grouping columns themselves, so filters on them are
    # pushed below the aggregate (down to the scans) by Catalyst
    out = df.hint("rebalance", *keys, *order).groupBy(*keys).agg(best.alias("_best"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_best.w.`{c}`").alias(c) for c in df.columns])


def latest_version(df: DataFrame, keys: Sequence[str], version: str = "version",
                   tiebreak: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Highest version per key (replacing-table semantics, applied eagerly)."""
    return latest_by(df, keys, [version, *tiebreak])


def dedup_events(events: DataFrame) -> DataFrame:
    """Last write per (event_date, event_id), by ingestion_time."""
    return latest_by(events, ["event_date", "event_id"], ["ingestion_time"])


def retain_recent(df: DataFrame, ts_col: str, days: int, as_of: str) -> DataFrame:
    """U4: drop rows older than ``days`` before as_of (TTL as a filter)."""
    return df.filter(F.col(ts_col) > as_of_ts(as_of) - F.make_dt_interval(days=F.lit(days)))


# Days each stored table is kept, by its time column.
RETENTION = {
    "processed_events_storage": ("event_time", 365),
    "session_metrics": ("first_event_time", 365),
    "unified_order_details_storage": ("order_date", 365),
    "purchase_events_denormalized": ("event_time", 365),
    "pipeline_health_status": ("check_time", 90),
    "data_quality_checks": ("check_time", 180),
    "schema_drift_monitoring": ("change_time", 365),
    "sync_lag_metrics": ("metric_time", 30),
    "missing_event_alerts": ("alert_time", 90),
    "load_performance_metrics": ("load_time", 60),
    "data_lineage_tracking": ("lineage_time", 90),
}


def retain_table(df: DataFrame, table: str, as_of: str) -> DataFrame:
    """U4 by table: rows within the table's own age.  A table stored by ``month`` is pruned to the months that
    can hold such rows, so expired partitions are never read."""
    ts_col, days = RETENTION[table]
    kept = retain_recent(df, ts_col, days, as_of)
    if "month" in df.columns:
        first = F.date_format(as_of_ts(as_of) - F.make_dt_interval(days=F.lit(days)), "yyyyMM")
        kept = kept.filter(F.col("month").cast("string") >= first)
    return kept


def point_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with column == value (pushed to the parquet reader / bloom filters)."""
    return df.filter(F.col(column) == value)


def point_lookup_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """U6 for keys computed by Spark: semi join against a small key set."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(column)).distinct(), column, "left_semi")


def upsert_users(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Merge changed users into the dimension, latest version wins."""
    return latest_version(current.unionByName(changes, allowMissingColumns=True), ["user_id"])
