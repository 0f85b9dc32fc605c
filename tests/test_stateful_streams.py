"""Keyed state streams (T2, T5, T6): late arrivals over several batches, resumed runs, and state that ends."""

import datetime as dt

import pytest

from eventide.operators import maintain, metrics
from eventide.session import scratch_path
from eventide.streaming import stateful, streams

D = dt.datetime
EVENT = ("event_id long, event_time timestamp_ntz, event_date date, user_id long, session_id string, event_type string, channel string, "
         "city string, device_type string, premium_amount long, is_purchase int, ingestion_time timestamp_ntz")


def event(i, time, kind="view", session="s1", user=1, version=0, premium=10):
    return (i, time, time.date(), user, session, kind, f"c{i % 3}", "Oslo", "Mobile", premium + version, int(kind == "purchase"),
            D(2024, 3, 1) + dt.timedelta(minutes=version))


def arrivals(spark, path, batches, schema):
    """One file a batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def event_batches():
    far = [event(90, D(2024, 1, 20, 1), session="s9", user=9)]
    return [
        [event(1, D(2024, 1, 1, 23, 50)), event(2, D(2024, 1, 1, 9), "signup", "s2", 2)],
        [event(3, D(2024, 1, 2, 0, 10), "purchase"), event(1, D(2024, 1, 1, 23, 50), version=1)],    # over midnight; a second write
        [event(4, D(2024, 1, 1, 23, 40), "signup"), event(2, D(2024, 1, 1, 9), "signup", "s2", 2, version=2)],       # late, within the delay
        far, [event(91, D(2024, 1, 25, 1), session="s9", user=9)],
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_writes_equal_the_batch_dedup_and_leave_state(spark, event_batches):
    path = arrivals(spark, scratch_path(spark, "t2"), event_batches, EVENT)
    schema = spark.read.parquet(path).schema
    out, checkpoint = scratch_path(spark, "t2-out"), scratch_path(spark, "t2-cp")
    updates = stateful.last_writes(streams.read_stream(spark, path, schema, 1), "2 days")
    progress = stateful.write_updates(updates, out, checkpoint)
    got = stateful.current(spark, out, ["event_date", "event_id"]).select(*schema.names)
    assert rows_of(got) == rows_of(maintain.dedup_events(spark.read.schema(schema).parquet(path)).select(*schema.names))
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(totals) >= 4 and totals[-1] <= 1                     # only the newest day is still held
    # a write for a day that the watermark has passed is dropped, and counted
    arrivals(spark, path, [[event(1, D(2024, 1, 1, 23, 50), version=9)]], EVENT)
    progress = stateful.write_updates(updates, out, checkpoint)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1
    kept = stateful.current(spark, out, ["event_date", "event_id"]).filter("event_id = 1").first()
    assert kept.premium_amount == 11


def test_sessions_equal_the_batch_form_and_expire(spark, event_batches):
    batches = [[r for r in b if r[-1] == D(2024, 3, 1)] for b in event_batches]      # first writes only
    path = arrivals(spark, scratch_path(spark, "t5"), [b for b in batches if b], EVENT)
    schema = spark.read.parquet(path).schema
    out = scratch_path(spark, "t5-out")
    progress = stateful.write_updates(stateful.sessions(streams.read_stream(spark, path, schema, 1), "2 days", dt.timedelta(days=10)),
                                      out, scratch_path(spark, "t5-cp"))
    want = metrics.session_metrics(spark.read.schema(schema).parquet(path))
    got = stateful.current(spark, out, ["session_id", "user_id"]).select(*want.columns)
    assert rows_of(got) == rows_of(want)
    s1 = got.filter("session_id = 's1'").first()
    assert s1.event_sequence == ["signup", "view", "purchase"] and s1.session_duration_seconds == 1800
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert totals[-1] < max(totals)                                 # s1 and s2 were dropped by their timers


def test_purchases_meet_orders_and_payments_of_later_batches(spark):
    at = [D(2024, 1, 5, 10), D(2024, 1, 6, 11), D(2024, 1, 7, 12)]
    purchases = spark.createDataFrame([(i + 1, 1, t.date(), t, 100) for i, t in enumerate(at)] + [(9, 2, at[0].date(), at[0], 5)],
                                      "event_id long, user_id long, event_date date, event_time timestamp, premium_amount long").schema
    orders = spark.createDataFrame([], "order_id long, user_id long, order_date date, order_ts timestamp, insurance_type string, "
                                       "policy_number string, premium_amount long").schema
    payments = spark.createDataFrame([], "order_id long, transaction_id long, payment_method string, payment_status string, "
                                         "total_amount long, payment_date timestamp_ntz, payment_ts timestamp").schema
    paths = {k: scratch_path(spark, f"t6-{k}") for k in ("purchases", "orders", "payments")}

    def order(i, user, t, kind):
        return (i, user, t.date(), D(t.year, t.month, t.day), kind, f"P{i}", 7)

    def payment(i, t):
        return (i, 50 + i, "card", "completed", 70, t, t)

    arrivals(spark, paths["purchases"], [[(1, 1, at[0].date(), at[0], 100), (9, 2, at[0].date(), at[0], 5)],
                                         [(2, 1, at[1].date(), at[1], 100)], [(3, 1, at[2].date(), at[2], 100)]], purchases)
    arrivals(spark, paths["orders"], [[order(20, 1, at[1], "fire")], [order(10, 1, at[0], "medical"), order(11, 1, at[0], "fire")],
                                      [order(30, 7, at[2], "fire")]], orders)
    arrivals(spark, paths["payments"], [[payment(99, at[0])], [payment(98, at[1])], [payment(10, at[2]), payment(20, D(2024, 1, 9))]], payments)
    sources = {k: (paths[k], s) for k, s in (("purchases", purchases), ("orders", orders), ("payments", payments))}
    got = stateful.drain_purchase_payments(spark, sources, D(2024, 6, 1), "t6", max_files=1, delay="3 days", payment_bound="20 days")
    seen = {(r.event_id, r.order_id, r.insurance_type, r.transaction_id, r.total_amount) for r in got.collect()}
    assert seen == {(1, 10, "medical", 60, 70), (1, 11, "fire", None, None), (2, 20, "fire", 70, 70), (3, None, None, None, None),
                    (9, None, None, None, None)}
    assert got.count() == 5


def test_session_row_of_nulls_and_ties():
    t = D(2024, 1, 1)
    row = stateful.session_row("s", 1, [(t, 2, None, "b", None, None, None, None), (t, 1, "view", "a", None, None, None, 0)])
    assert (row.first_channel, row.event_sequence, row.unique_event_types, row.total_premium, row.has_purchase) == ("a", ["view", None], 1, None, 0)
