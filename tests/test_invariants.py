"""Invariants and scale-shaped properties (skew, partitioning, sketches)."""

import pytest
import datetime as dt
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide import AS_OF
from eventide.operators import clean, maintain, metrics, windows
from eventide.plans import etl
from eventide.sources import fixtures
from eventide.sources.tables import Tables


def test_rollups_add_up_to_clean_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    store = etl.stored_events(t, AS_OF)
    n = store.count()
    assert metrics.daily_event_metrics(store).agg(F.sum("total_events")).first()[0] == n
    assert metrics.daily_aggregate_metrics(store).agg(F.sum("total_events")).first()[0] == n
    assert metrics.session_metrics(store).agg(F.sum("total_events")).first()[0] == n
    assert n == clean.clean_events(fixtures.raw_events(t.events)).count()


def test_latest_version_is_idempotent(spark, sf_dir):
    tp = fixtures.third_party_orders(Tables(spark, sf_dir).orders)
    once = maintain.latest_version(tp, ["order_id", "user_id"])
    twice = maintain.latest_version(once, ["order_id", "user_id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.agg(F.min("version")).first()[0] == 2


def test_event_key_stable_under_repartitioning(spark, sf_dir):
    raw = clean.clean_events(fixtures.raw_events(Tables(spark, sf_dir).events))
    a = clean.event_key(raw).select("event_id", "event_key")
    b = clean.event_key(raw.repartition(7, "channel")).select("event_id", "event_key")
    assert sorted(a.collect()) == sorted(b.collect())


def _skewed_times(spark, n=3000):
    random.seed(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        if i % 3 == 0:   # a third of all rows share one instant
            t = base + dt.timedelta(hours=5)
        else:
            t = base + dt.timedelta(seconds=random.randint(0, 3 * 86400))
        rows.append((i, t))
    return spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz")


def test_global_next_matches_plain_window_under_skew(spark):
    df = _skewed_times(spark)
    got = windows.event_gaps(df, num_partitions=6).select("event_id", "next_event_time").toPandas()
    w = Window.orderBy("event_time", "event_id")
    want = df.select("event_id", F.lead("event_time").over(w).alias("next_event_time")).toPandas()
    m = got.merge(want, on="event_id", suffixes=("_g", "_w"))
    assert len(m) == 3000
    assert (m.next_event_time_g.fillna(pd.Timestamp(0)) == m.next_event_time_w.fillna(pd.Timestamp(0))).all()


def test_gaps_over_matches_brute_force(spark):
    df = _skewed_times(spark, 400)
    got = sorted((r.gap_start, r.gap_end) for r in windows.gaps_over(df, 3600).collect())
    pts = sorted(r.event_time for r in df.collect())
    want = sorted((a, b) for a, b in zip(pts, pts[1:]) if (b - a).total_seconds() > 3600)
    assert got == want


def test_latest_by_hot_key(spark):
    rows = [(1 if i % 3 else i, i % 17, i) for i in range(3000)]  # key 1 holds two thirds
    df = spark.createDataFrame(rows, "k long, version long, payload long")
    got = {r.k: (r.version, r.payload) for r in maintain.latest_by(df, ["k"], ["version"]).collect()}
    best = max((v, p) for k, v, p in rows if k == 1)
    assert got[1] == best


def test_sketch_rollup_close_to_exact(spark, sf_dir):
    store = etl.stored_events(Tables(spark, sf_dir), AS_OF)
    parts = metrics.daily_metrics_partials(store)
    sk = metrics.daily_metrics_rollup(parts, with_sketches=True)
    exact = metrics.daily_aggregate_metrics(store)
    keys = metrics.DAILY_KEYS
    ex = exact.select(*[F.col(k).alias(f"x_{k}") for k in keys],
                      F.col("unique_users").alias("x_users"), F.col("total_events").alias("x_events"))
    j = sk.join(ex, [F.col(k).eqNullSafe(F.col(f"x_{k}")) for k in keys])
    tot = j.agg(F.sum("approx_unique_users"), F.sum("x_users"), F.sum("total_events"), F.sum("x_events")).first()
    assert j.count() == exact.count()
    assert abs(tot[0] - tot[1]) <= 0.03 * tot[1]
    assert tot[2] == tot[3]


def test_lineage_losses_add_up(spark, sf_dir):
    from eventide.plans.quality_run import Logs
    rows = Logs(Tables(spark, sf_dir), AS_OF).lineage_log().collect()
    for r in rows:
        assert r.source_records - r.target_records == r.record_loss_count


def test_rank_within_matches_row_number_under_a_hot_key(spark):
    random.seed(3)
    rows = []
    for i in range(4000):
        key = "hot" if i % 3 == 0 else f"k{random.randint(0, 60)}"
        rows.append((key, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=random.randint(0, 5000)), i))
    df = spark.createDataFrame(rows, "session_id string, event_time timestamp_ntz, event_id long")
    w = Window.partitionBy("session_id").orderBy("event_time", "event_id")
    want = sorted(df.withColumn("seq_no", F.row_number().over(w)).select("event_id", "seq_no").collect())
    for n in (7, 23):  # the hot key spans several partitions, then many
        got = windows.rank_within(df, "session_id", ["event_time", "event_id"], "seq_no", num_partitions=n)
        assert sorted(got.select("event_id", "seq_no").collect()) == want


def test_exact_percentiles_match_percentile_under_a_hot_group(spark):
    random.seed(5)
    rows = []
    for i in range(5000):
        g = "hot" if i % 3 == 0 else random.choice(["a", "b", None])
        v = None if i % 97 == 0 else float(random.randint(0, 400) if g != "b" else random.random())
        rows.append((g, v))
    rows.append(("single", 7.0))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"q1": 0.25, "p50": 0.5, "q3": 0.75, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    got = windows.exact_percentiles(df, "v", probs, ["g"], num_partitions=7)
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in probs.items()])
    cols = ["g", *probs]
    key = lambda r: (r[0] is None, r[0] or "")
    g_rows = sorted(got.select(*cols).collect(), key=key)
    w_rows = sorted(want.select(*cols).collect(), key=key)
    assert len(g_rows) == len(w_rows)
    for a, b in zip(g_rows, w_rows):
        assert a[0] == b[0]
        for x, y in zip(a[1:], b[1:]):
            assert abs(x - y) <= 1e-9 * max(1.0, abs(y)), (a, b)
    whole = windows.exact_percentiles(df, "v", {"p95": 0.95}).collect()[0].p95
    assert abs(whole - df.select(F.percentile("v", 0.95)).collect()[0][0]) < 1e-9


def test_partitioned_write_splits_a_hot_month_over_several_tasks(spark):
    """One month holding every row is still written by several tasks (REBALANCE + AQE)."""
    import glob
    from eventide.session import scratch_path
    from eventide.sources import layout
    df = spark.range(0, 40000).select(
        F.col("id").alias("event_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 28).cast("int")).alias("event_date"),
        (F.col("id") * 7 % 1000).alias("v"))
    path = scratch_path(spark, "hot-month")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        layout.write_partitioned(df, path, "event_date", (), ("event_date", "event_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = glob.glob(f"{path.removeprefix('file:')}/month=202401/*.parquet")
    assert len(files) > 1
    back = spark.read.parquet(path)
    assert back.count() == 40000
    assert back.select(F.sum("v")).collect()[0][0] == df.select(F.sum("v")).collect()[0][0]


def test_cluster_settings_scale_with_input_and_stay_bounded():
    from eventide.session import cluster_settings
    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # two waves of cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000        # capped
    assert int(cluster_settings(20 << 40, 4000)["spark.sql.shuffle.partitions"]) == 20 * 1024
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 << 20


def test_enrichment_broadcasts_by_bytes_only(spark):
    from eventide.operators import enrich
    from eventide.session import scratch_path
    path = scratch_path(spark, "dim")
    spark.range(0, 500).selectExpr("id AS user_id", "current_date() AS signup_date", "'c' AS city", "'d' AS device_type").write.parquet(path)
    events, users = spark.range(0, 1000).selectExpr("id AS user_id"), spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, join in (("64m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            plan = enrich.enrich_events(events, users)._jdf.queryExecution().executedPlan().toString()
            assert join in plan and "GlobalLimit" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("reuse,adaptive", [("true", "true"), ("false", "true"), ("false", "false")])
def test_stitching_does_not_depend_on_exchange_reuse(spark, reuse, adaptive):
    from eventide.operators import windows
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(0, 20000, 1, 8).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 7 % 20011) AS event_time", "CAST(id % 3 = 0 AS INT) AS g")
        gaps = windows.event_gaps(df, 7)
        want = sorted(r.event_time for r in df.collect())
        got = {r.event_time: r.next_event_time for r in gaps.collect()}
        assert got == dict(zip(want, [*want[1:], None]))
        ranks = windows.rank_within(df.withColumn("g", F.when(F.col("g") == 1, F.lit("a")).otherwise(F.lit("b"))), "g",
                                    ["event_time", "event_id"], "nth", 7)
        for key in "ab":
            assert [r.nth for r in ranks.filter(F.col("g") == key).orderBy("event_time").collect()] == list(
                range(1, ranks.filter(F.col("g") == key).count() + 1))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sessions_that_cross_midnight_over_several_batches(spark):
    import datetime as dt
    from eventide.operators import metrics
    from eventide.session import scratch_path
    from eventide.streaming import streams
    at = dt.datetime
    rows = [[("e1", "A", 1, at(2024, 1, 1, 23, 50)), ("e2", "A", 1, at(2024, 1, 2, 0, 10)), ("e3", "B", 2, at(2024, 1, 1, 9))],
            [("e4", "C", 1, at(2024, 1, 3, 8)), ("e5", "B", 2, at(2024, 1, 5, 1)), ("e5b", "A", 9, at(2024, 1, 3, 1))],
            [("e6", "A", 1, at(2023, 12, 30, 7)), ("e7", "C", 1, at(2024, 1, 4))]]
    path = scratch_path(spark, "midnight")
    frames = [spark.createDataFrame([(*r, r[3].date(), r[0], "web", "city", "phone", 0, 5) for r in part],
              "event_id string, session_id string, user_id long, event_time timestamp_ntz, event_date date, event_type string, "
              "channel string, city string, device_type string, is_purchase int, premium_amount long").coalesce(1) for part in rows]
    for f in frames:
        f.write.mode("append").parquet(path)
    stream = streams.read_stream(spark, path, frames[0].schema, 1)
    got = streams.current_sessions(spark, streams.stream_session_metrics(spark, stream, "midnight"))
    want = metrics.session_metrics(spark.read.parquet(path))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_stream_dedup_keeps_the_last_write(spark):
    import datetime as dt
    from eventide.session import scratch_path
    from eventide.streaming import streams
    day = dt.datetime(2024, 1, 1, 5)
    path = scratch_path(spark, "twice")
    schema = "event_id long, event_time timestamp_ntz, event_date date, ingestion_time timestamp_ntz, v string"
    for part in ([(1, 0, "old"), (2, 5, "only")], [(1, 60, "new"), (3, 9, "last")], [(3, 1, "late but older")]):
        spark.createDataFrame([(i, day, day.date(), day + dt.timedelta(seconds=s), v) for i, s, v in part], schema).coalesce(1).write.mode("append").parquet(path)
    out = streams.stream_dedup(spark, streams.read_stream(spark, path, spark.read.parquet(path).schema, 1), "twice")
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == ["last", "new", "only"]


def test_serving_tables_answer_like_the_end_to_end_queries(spark, sf_dir):
    from eventide.plans import serving
    from eventide.plans.registry import raw_queries
    tb = serving.open_tables(spark, serving.materialize(Tables(spark, sf_dir)))
    for s_name in serving.SERVING:
        got = serving.SERVING[s_name](tb)
        want = raw_queries()[s_name.removeprefix("serve_")](spark, sf_dir)
        cols = sorted(want.columns)
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect())), s_name


def test_csv_lines_keep_missing_and_quoted_fields(spark):
    import datetime as dt2
    from eventide.sources import csv_ingest
    rows = [(dt2.datetime(2024, 1, 1, 5), 7, "s_1_20240101", "page_view", None, 0),
            (dt2.datetime(2024, 1, 1, 5), 8, "s_2_20240101", "page_view", "a,b", 12)]
    raw = spark.createDataFrame(rows, "event_time timestamp_ntz, user_id int, session_id string, event_type string, channel string, premium_amount long")
    lines = [r.value for r in csv_ingest.events_to_csv_lines(raw).collect()]
    assert lines == ["2024-01-01 05:00:00,7,s_1_20240101,page_view,,", '2024-01-01 05:00:00,8,s_2_20240101,page_view,"a,b",12']
    parsed = csv_ingest.parse_event_lines(csv_ingest.events_to_csv_lines(raw)).collect()
    assert [r.channel for r in parsed if r.user_id == 8] == ["a,b"]
