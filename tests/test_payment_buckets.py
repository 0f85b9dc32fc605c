"""T6's second join keeps its state by bucket of orders and passes values on unread; heartbeats end the sources in the same run."""

import datetime as dt
import glob

import numpy as np
import pytest

from eventide.session import scratch_path
from eventide.streaming import stateful, streams
from tests.test_stateful_streams import D, arrivals, rows_of

BIG = (1 << 60) + 1                             # not a double
SCHEMAS = {"purchases": "event_id long, user_id long, event_date date, event_time timestamp, premium_amount long",
           "orders": "order_id long, user_id long, order_date date, order_ts timestamp, insurance_type string, policy_number string, premium_amount long",
           "payments": "order_id long, transaction_id long, payment_method string, payment_status string, total_amount long, "
                       "payment_date timestamp_ntz, payment_ts timestamp"}


def odd_sources(spark):
    """Three batches a source: orders and payments before and after their purchase, several of each, nulls and odd texts."""
    day = [D(2024, 1, 5) + dt.timedelta(days=i) for i in range(3)]

    def purchase(i, user, t, premium=BIG):
        return (i, user, t.date(), t + dt.timedelta(hours=9, microseconds=1), premium)

    def order(i, user, t, policy="P"):
        return (i, user, t.date(), t, 'fire "a", b\n', policy, BIG + i if i % 2 else None)

    def payment(i, k, t, method="card"):
        at = t + dt.timedelta(hours=12, microseconds=k)
        return (i, k, method, None if k % 3 else 'a\\"b,é', BIG + k, at, at)

    purchases = [[purchase(n * 100 + u, u, day[n], None if u % 5 == 0 else BIG + u) for u in range(40)] + [purchase(None, 1, day[n])]
                 for n in range(3)]
    orders = [[order(m * 1000 + u * 10 + k, u, day[m], None if k else "P") for u in range(0, 60, 2) for k in range(u % 3)] for m in (1, 0, 2)]
    payments = [[payment(m * 1000 + u * 10 + k, b * 7 + k, day[m]) for u in range(0, 60, 4) for k in range(2)] for b, m in enumerate((2, 0, 1))]
    payments[2] += [payment(1020, 99, day[0]), payment(1020, 98, day[2]), payment(None, 97, day[2])]
    paths = {k: arrivals(spark, scratch_path(spark, f"odd-{k}"), batches, SCHEMAS[k])
             for k, batches in (("purchases", purchases), ("orders", orders), ("payments", payments))}
    return {k: (p, spark.createDataFrame([], SCHEMAS[k]).schema) for k, p in paths.items()}


def drained_equal_the_batch_joins(spark, name):
    sources = odd_sources(spark)
    frame = {k: spark.read.schema(s).parquet(p) for k, (p, s) in sources.items()}
    e, o, f = frame["purchases"].alias("e"), frame["orders"].alias("o"), frame["payments"].alias("f")
    want = (e.join(o,
                   (frame["purchases"].user_id == frame["orders"].user_id) & (frame["purchases"].event_date == frame["orders"].order_date), "left")
            .join(f, frame["orders"].order_id == frame["payments"].order_id, "left")
            .selectExpr("e.event_id", "e.user_id", "e.event_date", "e.premium_amount", "o.order_id", "o.insurance_type", "o.policy_number",
                        "o.premium_amount as order_premium_amount", "f.transaction_id", "f.payment_method", "f.payment_status", "f.total_amount",
                        "f.payment_date"))
    want = rows_of(want)
    got = stateful.drain_purchase_payments(spark, sources, D(2024, 6, 1), name, max_files=1, delay="4 days", payment_bound="20 days", buckets=3)
    assert rows_of(got) == want
    folder = got.inputFiles()[0].rsplit(f"/{name}-sink-", 1)[0].removeprefix("file://")
    assert len(glob.glob(f"{folder}/{name}-checkpoint-*/commits/[0-9]*")) == 5      # three batches, the heartbeats, the closing


def test_odd_rows_equal_the_batch_joins_in_one_run(spark):
    drained_equal_the_batch_joins(spark, "odd")


def test_odd_rows_in_another_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        drained_equal_the_batch_joins(spark, "odd-zone")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_purchases_and_orders_wait_by_bucket_and_end(spark):
    sources = odd_sources(spark)
    late = spark.createDataFrame([(5000, 1, D(2024, 3, 1).date(), D(2024, 3, 1), 1)], SCHEMAS["purchases"])
    frames = {"purchases": late, "orders": late.selectExpr("-2L as order_id", "user_id", "event_date as order_date", "event_time as order_ts",
                                                           "'x' as insurance_type", "'P' as policy_number", "1L as premium_amount"),
              "payments": late.selectExpr("-3L as order_id", "1L as transaction_id", "'x' as payment_method", "'x' as payment_status",
                                          "1L as total_amount", "timestamp_ntz'2024-03-01' as payment_date", "event_time as payment_ts")}
    for k, (path, _) in sources.items():
        frames[k].coalesce(1).write.mode("append").parquet(path)
    read = {k: streams.read_stream(spark, p, s, 1) for k, (p, s) in sources.items()}
    joined = stateful.purchase_payments(read["purchases"], read["orders"], read["payments"], delay="4 days", buckets=4)
    progress = stateful.append_rows(joined, scratch_path(spark, "both"), scratch_path(spark, "both-cp"), 2)
    orders = [p["stateOperators"][1] for p in progress]
    assert max(s["numRowsUpdated"] for s in orders) <= 4 * 3                      # 123 purchases and 60 orders, their buckets and timers
    assert 0 < orders[-1]["numRowsTotal"] < max(s["numRowsTotal"] for s in orders)        # only those of March are held


def test_payments_wait_by_bucket(spark):
    sources = odd_sources(spark)
    read = {k: streams.read_stream(spark, p, s, 1) for k, (p, s) in sources.items()}
    joined = stateful.purchase_payments(read["purchases"], read["orders"], read["payments"], delay="4 days", buckets=3)
    progress = stateful.append_rows(joined, scratch_path(spark, "by-bucket"), scratch_path(spark, "by-bucket-cp"), 2)
    payments = [p["stateOperators"][0] for p in progress]
    assert {s["operatorName"] for s in payments} == {"applyInPandasWithState"}
    assert max(s["numRowsUpdated"] for s in payments) <= 3                        # 30 payments and more a batch


class State:
    """As Spark's group state."""

    def __init__(self):
        self.value, self.watermark, self.timeout = None, 0, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.watermark
        self.timeout = ms


def test_pairs_meet_once_within_the_bound_and_rows_end():
    import pandas as pd

    def met(state, *rows):
        chunk = pd.DataFrame(rows, columns=["side", "id", "at", "lo", "hi", "met", "payload"])
        return [tuple(r) for f in stateful.meet_payments(iter([chunk]), state, 4) for r in f.itertuples(index=False)]

    ms, state = 1000, State()
    assert met(state, (0, 7, 50 * ms, 40 * ms, 60 * ms, 0, "e1"), (2, 0, 0, 0, 0, 0, "e2")) == [("e2", None)]
    assert met(state, (1, 7, 60 * ms, 50 * ms, 70 * ms, 0, "f1"), (1, 7, 61 * ms, 51 * ms, 71 * ms, 0, "f2"),
               (1, 8, 50 * ms, 40 * ms, 60 * ms, 0, "f3")) == [("e1", "f1")]
    assert met(state, (0, 7, 65 * ms, 55 * ms, 75 * ms, 0, "e3"), (0, 9, 65 * ms, 55 * ms, 75 * ms, 0, "e4")) == [("e3", "f1"), ("e3", "f2")]
    assert state.timeout == 60
    state.watermark = 72
    assert met(state) == []
    assert state.timeout == 75 and np.array_equal(stateful.pa.ipc.open_stream(state.get[0]).read_all().column("payload").to_pylist(), ["e3", "e4"])
    state.watermark = 76
    assert met(state) == [("e4", None)] and not state.exists
    state.update((b"", 5))
    with pytest.raises(ValueError, match="5 buckets of orders, not 4"):
        met(state)


def test_pairs_come_in_slices(monkeypatch):
    monkeypatch.setattr(stateful, "_MOST_PAIRS", 10)
    left, right = np.array([5, 1, 5, 9, 2, 5]), np.array([5, 2, 5, 7, 5, 5, 5, 5])
    slices = list(stateful._pairs(left, right))
    assert [len(l) for l, _ in slices] == [6, 7, 6]
    assert sorted((int(a), int(b)) for l, r in slices for a, b in zip(l, r)) == [(a, b) for a in range(6) for b in range(8) if left[a] == right[b]]
    assert list(stateful._pairs(left[:0], right)) == [] and sum(len(l) for l, _ in stateful._pairs(left, right[:0])) == 0
