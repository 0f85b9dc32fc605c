"""Plan shapes that the scale design relies on (checked on the physical plans)."""

import re

from eventide.plans.registry import raw_queries


def _physical(df) -> str:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_purchase_filter_reaches_the_events_scan(spark, sf_dir):
    plan = _physical(raw_queries()["type_date_lookup"](spark, sf_dir))
    assert "EqualTo(event_type,purchase)" in plan


def test_session_rollup_has_no_distinct_expand(spark, sf_dir):
    plan = _physical(raw_queries()["session_metrics"](spark, sf_dir))
    assert "Expand" not in plan


def test_rollups_over_the_denormalised_table_carry_only_their_columns(spark, sf_dir):
    plan = _optimized(raw_queries()["insurance_type_summary"](spark, sf_dir))
    for unused in ("payment_method", "policy_number", "settlement_date", "vehicle_age"):
        assert unused not in plan


def test_check_log_counters_merge_into_one_subquery(spark, sf_dir):
    plan = _physical(raw_queries()["quality_check_log"](spark, sf_dir))
    assert "mergedValue" in plan


def test_denormalised_join_meets_reduced_orders(spark, sf_dir):
    # orders are reduced per (user, day, type) before the purchase join
    plan = _optimized(raw_queries()["dedup_denormalized"](spark, sf_dir))
    assert re.search(r"Aggregate \[user_id#\d+L?, order_date#\d+, insurance_type#\d+\]", plan)


def test_stored_lookup_and_retention_prune(spark, sf_dir):
    """Lookups reach the file reader; expired months are pruned as partitions."""
    from eventide.operators import maintain
    from eventide.plans import serving
    from eventide.sources.tables import Tables
    paths = serving.write_tables(Tables(spark, sf_dir))
    denorm = paths["purchase_events_denormalized"]
    plan = _physical(maintain.point_lookup(spark.read.parquet(denorm), "policy_number", "P17"))
    assert "EqualTo(policy_number,P17)" in plan
    store = spark.read.parquet(paths["processed_events_storage"])
    assert "EqualTo(session_id,s_1)" in _physical(maintain.point_lookup(store, "session_id", "s_1"))
    kept = maintain.retain_table(store, "processed_events_storage", "2026-01-01 00:00:00")
    assert re.search(r"PartitionFilters: \[[^\]]*month", _physical(kept)) and kept.count() == 0
    assert maintain.retain_table(store, "processed_events_storage", "2024-01-31 00:00:00").count() == store.count()
