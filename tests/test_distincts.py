"""Exact mergeable distinct counts: ids without gaps, both container forms, unions over blocks and batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import distincts, metrics
from eventide.session import scratch_path
from eventide.streaming import streams

SCHEMA = ("event_id long, event_date date, event_hour int, channel string, event_type string, city string, device_type string, "
          "user_id long, session_id string, premium_amount long, is_purchase int, event_time timestamp_ntz")


def events(n, seed=1, users=400, days=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day, hour = rng.randrange(days), rng.randrange(24)
        at = dt.datetime(2024, 1, 1 + day, hour)
        user = rng.randrange(users)
        out.append((i, at.date(), hour, rng.choice(["a", "b"]), rng.choice(["view", "purchase"]), rng.choice(["x", None]),
                    rng.choice(["m", None]), user if user else None, f"s{user}_{day}" if user % 7 else None, rng.choice([None, 5, 9]),
                    rng.randrange(2), at))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("few", [0, 5, 1024])
def test_partials_of_blocks_merge_to_exact_counts(spark, monkeypatch, few):
    monkeypatch.setattr(distincts, "FEW", few)      # all bitmaps, both, all arrays
    df = spark.createDataFrame(events(1500), SCHEMA)
    _, measures, sets = distincts.daily_partials(df.withColumnRenamed("event_date", "metric_date"), metrics.DAILY_KEYS, block="event_hour")
    sets = sets.persist()
    forms = {(r.few is None, r.many is None) for r in sets.select("few", "many").collect()}
    assert forms == {0: {(True, False)}, 5: {(False, True), (True, False)}, 1024: {(False, True)}}[few]
    got = distincts.daily_rollup(measures, sets, metrics.DAILY_KEYS)
    want = metrics.daily_aggregate_metrics(df)
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    sets.unpersist()


def test_ids_have_no_gaps_and_go_on(spark):
    def values(lo, hi):
        return spark.range(lo, hi).select(F.lit("d").alias("scope"), F.lit("k").alias("kind"), F.col("id").cast("string").alias("value"))
    first = distincts.new_ids(values(0, 100))
    more = distincts.new_ids(values(50, 180), first)
    ids = first.unionByName(more).collect()
    assert sorted(r.id for r in ids) == list(range(180)) and len({r.value for r in ids}) == 180


def test_many_buckets(spark):
    n = 70_000
    df = spark.range(n).select(F.lit(1).alias("k"), F.lit("u").alias("kind"), (F.col("id") % 50_000).alias("v"))
    rows = df.select(F.struct("k").alias("key"), "kind", F.expr("v div 32768").alias("bucket"), F.expr("int(v % 32768)").alias("pos"))
    a, b = distincts._containers(rows.filter("v < 40000")), distincts._containers(rows.filter("v >= 39000"))
    assert distincts.set_sizes(distincts.merged_sets(a.unionByName(b)), ["u"]).first().u == 50_000


def test_no_distinct_aggregate_expands_the_events(spark):
    df = spark.createDataFrame(events(50), SCHEMA).withColumnRenamed("event_date", "metric_date")
    _, measures, sets = distincts.daily_partials(df, metrics.DAILY_KEYS)
    plan = distincts.daily_rollup(measures, sets, metrics.DAILY_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_stream_merges_late_days_from_partials(spark):
    """Three batches over the same days; an epoch that is replayed counts once."""
    path, all_rows = scratch_path(spark, "t4"), events(900, 3)
    for i in range(3):
        spark.createDataFrame(all_rows[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    out = streams.stream_daily_partials(spark, streams.read_stream(spark, path, df.schema, 1), "t4-test")
    want = metrics.daily_event_metrics(df)
    assert rows_of(spark.read.parquet(out).select(*want.columns)) == rows_of(want)
