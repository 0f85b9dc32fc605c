"""T5's state is kept by bucket: Python is called once a bucket and batch, and sessions of a bucket end one by one."""

import datetime as dt

import pytest

from eventide.operators import metrics
from eventide.session import scratch_path
from eventide.streaming import stateful, streams
from tests.test_stateful_streams import EVENT, D, arrivals, event, rows_of

BIG = (1 << 60) + 1                             # not a double


def drained(spark, batches, name, keep, buckets):
    path = arrivals(spark, scratch_path(spark, name), batches, EVENT)
    stored = spark.read.schema(spark.createDataFrame([], EVENT).schema).parquet(path)
    out, checkpoint = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-cp")
    updates = stateful.sessions(streams.read_stream(spark, path, stored.schema, 1), "2 days", keep, buckets)
    progress = stateful.write_updates(updates, out, checkpoint, partitions=2)
    return stored, stateful.current(spark, out, ["session_id", "user_id"]), progress, checkpoint


def test_many_sessions_a_bucket_equal_the_batch_form(spark):
    def odd(i, time, user, session, premium=BIG, kind="view"):
        row = list(event(i, time, kind, session, user))
        row[EVENT.split(", ").index("premium_amount long")] = premium
        return tuple(row)

    first = [odd(i, D(2024, 1, 1, i % 24), i % 500, f"s{i % 500}") for i in range(1000)]
    second = [odd(2000 + i, D(2024, 1, 1, 23 - i % 24, 30), i, f"s{i}", None, "purchase") for i in range(0, 500, 3)]
    nulls = [odd(3000 + i, D(2024, 1, 2, 5), user, session, premium, kind)
             for i, (user, session, premium, kind) in enumerate([(None, "n", None, "view"), (7, None, -BIG, None), (None, None, 1, "view"),
                                                                 (None, "n", BIG, None), (BIG, "s1", None, "view"), (1, "s1", 0, "view")])]
    stored, got, progress, _ = drained(spark, [first, second + nulls, [odd(4000, D(2024, 1, 2, 4), None, "n")]], "buckets", dt.timedelta(days=10), 4)
    want = metrics.session_metrics(stored)
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    assert got.count() == 504
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 4             # 504 sessions


def test_sessions_of_a_bucket_end_one_by_one(spark):
    batches = [[event(1, D(2024, 1, 1, 9)), event(2, D(2024, 1, 9), session="s2", user=2)],
               [event(3, D(2024, 1, 9, 1), session="s2", user=2)],            # the watermark has passed s1, in the bucket of s2
               [event(4, D(2024, 1, 10, 1), session="s2", user=2), event(5, D(2024, 1, 11))]]
    _, got, progress, checkpoint = drained(spark, batches, "ends", dt.timedelta(days=3), 1)
    rows = {r.session_id: r for r in got.collect()}
    assert (rows["s2"].total_events, rows["s2"].session_duration_seconds) == (3, 90000)   # lives on
    assert (rows["s1"].total_events, rows["s1"].first_event_time) == (1, D(2024, 1, 11))  # begun anew
    with pytest.raises(Exception, match="1 buckets of sessions, not 3"):
        path = arrivals(spark, scratch_path(spark, "ends-other"), batches, EVENT)
        other = stateful.sessions(streams.read_stream(spark, path, spark.read.parquet(path).schema, 1), buckets=3)
        stateful.write_updates(other, scratch_path(spark, "ends-other-out"), checkpoint, partitions=2)


def test_buckets_follow_the_bytes(spark, monkeypatch):
    path = streams.stage(spark.range(6_000).withColumnRenamed("id", "offset"), "sized-sessions", "offset", files=4)
    assert streams.state_buckets(spark, path) == 16 * streams.state_partitions(spark, path)
    monkeypatch.setattr(streams, "STATE_BUCKET_BYTES", 10)
    staged = sum(f.getLen() for f in streams._parts(spark, path)[1])
    assert streams.state_buckets(spark, path) == -(-staged // 10)


def test_state_memory_is_shared_and_bounded(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
    with stateful.rocksdb_state(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, "false") == "false"
