"""Planted edge rows for each decision on surprising semantics."""

import datetime as dt

from pyspark.sql import functions as F

from eventide import AS_OF
from eventide.operators import clean, enrich, maintain, metrics, orders, quality
from eventide.plans.etl import transform_enrich
from eventide.sources import csv_ingest, topic
from eventide.streaming import streams

HEADER = csv_ingest.EVENT_HEADER


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_csv_ingest_rules(spark):
    lines = _lines(spark, [
        HEADER,
        "2024-01-01 10:00:00,1,s_1_20240101,view,SEO,",        # blank premium -> 0
        "2024-01-01 10:00:01,1,s_1_20240101,view,SEO",         # five fields -> reject
        "2024-01-01 10:00:02,abc,s_1_20240101,view,SEO,5",     # non-numeric user -> reject
        "2024-01-01 10:00:03,2,s_2_20240101,purchase,SEO,x1",  # non-numeric premium -> reject
        '2024-01-01 10:00:04,3,"s_3,quoted",purchase,SEO,700',  # quoted comma kept in one field
        "2024-01-01 10:00:05,4,s_4_20240101,click,Email,12,extra",  # extra fields ignored
    ])
    parsed = csv_ingest.parse_event_lines(lines)
    reasons = {r.line: r.reject_reason for r in parsed.collect()}
    assert list(reasons.values()).count(None) == 3
    assert reasons["2024-01-01 10:00:01,1,s_1_20240101,view,SEO"] == "fewer_than_6_fields"
    assert reasons["2024-01-01 10:00:02,abc,s_1_20240101,view,SEO,5"] == "bad_user_id"
    assert reasons["2024-01-01 10:00:03,2,s_2_20240101,purchase,SEO,x1"] == "bad_premium_amount"
    good = {r.user_id: r for r in csv_ingest.good_rows(parsed).collect()}
    assert good[1].premium_amount == 0 and good[3].session_id == "s_3,quoted" and good[4].premium_amount == 12
    rep = csv_ingest.ingest_report(parsed).collect()[0]
    assert (rep.total_rows, rep.sent_rows, rep.failed_rows, rep.success_rate) == (6, 3, 3, 50.0)
    # blank premium becomes 0 and is then dropped by the validity filter
    raw = csv_ingest.good_rows(parsed).withColumn(
        "event_time", F.try_to_timestamp("event_time").cast("timestamp_ntz"))
    assert clean.clean_events(raw).filter("user_id = 1").count() == 0


def test_malformed_json_gives_nulls_not_errors(spark):
    df = spark.createDataFrame([(b'{"event_time": "2024-01-01 00:00:00", "user_id": 5}', 1),
                                (b'{not json', 2), (b'{"user_id": "seven"}', 3)],
                               "value binary, offset long")
    out = {r.event_id: r for r in topic.decode_events(df).collect()}
    assert out[1].user_id == 5 and out[1].event_time == dt.datetime(2024, 1, 1)
    assert out[2].user_id is None and out[2].event_time is None
    assert out[3].user_id is None


def test_best_effort_time_parsing_and_trim(spark):
    from eventide.schemas import PROCESSED_TEXT
    row = {f.name: None for f in PROCESSED_TEXT.fields}
    row.update(event_id=1, event_time="2024-01-02T03:04:05.000Z", signup_date="05/01/2023",
               event_date="2024-01-02", processing_time="2024/01/02 03:04:06", device_type=" Mobile ")
    text = spark.createDataFrame([row], PROCESSED_TEXT)
    r = clean.normalize_processed(text, AS_OF).collect()[0]
    assert r.event_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.signup_date == dt.date(2023, 1, 5)
    assert r.processing_time == dt.datetime(2024, 1, 2, 3, 4, 6)
    assert r.device_type == "Mobile"
    bad = text.withColumn("event_time", F.lit("not a time"))
    assert clean.normalize_processed(bad, AS_OF).collect()[0].event_time is None


def _raw(spark, rows):
    return spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, user_id int, session_id string, "
                                       "event_type string, channel string, premium_amount long")


def _users(spark, rows):
    return spark.createDataFrame(rows, "user_id int, signup_date date, city string, device_type string")


def test_event_before_signup_keeps_negative_tenure_and_is_reported(spark):
    t0 = dt.datetime(2024, 1, 1, 9)
    raw = _raw(spark, [(1, t0, 7, "s", "view", "SEO", 100), (2, t0, 8, "s2", "view", "SEO", 100)])
    users = _users(spark, [(7, dt.date(2024, 1, 10), "X", "Desktop")])
    p = transform_enrich(raw, users, AS_OF)
    rows = {r.event_id: r for r in p.collect()}
    assert rows[1].user_tenure_days == -9
    assert rows[2].city is None  # unknown user: left join keeps the event
    unified = spark.createDataFrame([(dt.date(2024, 1, 2), dt.date(2024, 1, 1))],
                                    "policy_start_date date, policy_end_date date")
    v = {r.rule: r.violations for r in quality.temporal_violations(p, unified).collect()}
    assert v == {"event_before_signup": 1, "policy_end_before_start": 1}
    assert [r.event_id for r in enrich.orphan_events(p, users).collect()] == [2]


def test_same_event_twice_is_deduplicated_keeping_last_write(spark):
    t0 = dt.datetime(2024, 1, 1, 9)
    rows = [(1, dt.date(2024, 1, 1), t0, "a"), (1, dt.date(2024, 1, 1), t0 + dt.timedelta(minutes=1), "b"),
            (2, dt.date(2024, 1, 1), t0, "c")]
    df = spark.createDataFrame(rows, "event_id long, event_date date, ingestion_time timestamp_ntz, v string")
    out = {r.event_id: r.v for r in maintain.dedup_events(df).collect()}
    assert out == {1: "b", 2: "c"}
    again = maintain.dedup_events(maintain.dedup_events(df))
    assert sorted(again.collect()) == sorted(maintain.dedup_events(df).collect())  # idempotent


def test_two_orders_one_day_fan_out_and_dedup_by_type(spark):
    t0 = dt.datetime(2024, 1, 5, 12)
    d = dt.date(2024, 1, 5)
    purchases = spark.createDataFrame(
        [(1, t0, 3, "s", "SEO", 500, None, None, None, None, d, 12, 6, t0, "spark_etl")],
        "event_id long, event_time timestamp_ntz, user_id int, session_id string, channel string, "
        "premium_amount long, signup_date date, city string, device_type string, user_tenure_days int, "
        "event_date date, event_hour int, event_day_of_week int, processing_time timestamp_ntz, data_source string")
    o_cols = {c: None for c in orders.UNIFIED_COLUMNS}
    mk = lambda oid, typ, day: {**o_cols, "order_id": oid, "user_id": 3, "insurance_type": typ, "order_date": day,
                                "premium_amount": 500}
    schema = ("order_id long, user_id int, policy_number string, insurance_type string, product_type string, "
              "coverage_type string, coverage_plan string, property_type string, coverage_amount long, "
              "premium_amount long, vehicle_age int, driver_age int, medical_limit long, property_limit long, "
              "individual int, family int, deductible int, co_payment int, property_value long, "
              "location_city string, construction_type string, order_date date, policy_start_date date, "
              "policy_end_date date, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    unified = spark.createDataFrame([mk(10, "fire", d), mk(11, "fire", d), mk(12, "medical", d),
                                     mk(13, "fire", dt.date(2024, 1, 6))],  # arrives for another day: no match
                                    schema)
    pays = spark.createDataFrame([(10, 99, "wallet", "completed", "USD", 0, 0, 0, 0, t0, t0)],  # total 0
                                 "order_id long, transaction_id long, payment_method string, payment_status string, "
                                 "currency string, total_amount long, tax_amount long, discount_amount long, "
                                 "commission_amount long, payment_date timestamp_ntz, settlement_date timestamp_ntz")
    den = orders.purchase_denormalized(purchases, unified, pays, AS_OF)
    assert den.count() == 3
    ded = {r.insurance_type: r.order_id for r in orders.dedup_denormalized(den).collect()}
    assert ded == {"fire": 11, "medical": 12}
    # reducing orders before the join gives the same table without the fan-out
    assert sorted(orders.denormalize(purchases, unified, pays, AS_OF).collect()) == \
        sorted(orders.dedup_denormalized(den).collect())
    j4 = orders.purchase_denormalized_by_order_id(
        purchases.withColumn("event_id", F.lit(10).cast("long")), unified, pays).collect()
    assert j4[0].commission_rate is None  # division by a zero total gives NULL, not an error
    miss = orders.purchase_denormalized(purchases.withColumn("user_id", F.lit(4)), unified, pays, AS_OF).collect()
    assert miss[0].order_id == 1 and miss[0].insurance_type is None  # falls back to the event id


def test_padded_device_type_is_trimmed_in_reports(spark):
    ev = spark.createDataFrame([("view", "SEO", "X", " Mobile "), ("view", "SEO", "X", "Mobile")],
                               "event_type string, channel string, city string, device_type string")
    rep = {r.category: (r["values"], r.unique_count) for r in metrics.category_values_report(ev).collect()}
    assert rep["Device Types:"] == (["Mobile"], 1)


def test_schema_drift_lists_added_and_removed_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "event_id long, surprise string, premium_amount double")
    got = {(r.column_name, r.change_type) for r in
           quality.schema_drift(df, ["event_id", "premium_amount", "ingestion_time"]).collect()}
    assert got == {("surprise", "column_added"), ("ingestion_time", "column_removed")}


def test_incremental_load_sees_only_new_keys(spark):
    from eventide.sources.incremental import incremental_load
    src = spark.createDataFrame([(i,) for i in range(10)], "user_id int")
    tgt = spark.createDataFrame([(i,) for i in range(6)], "user_id int")
    assert sorted(r.user_id for r in incremental_load(src, tgt).collect()) == [6, 7, 8, 9]
    empty = spark.createDataFrame([], "user_id int")
    assert incremental_load(src, empty).count() == 10


def test_hot_user_day_denormalizes_without_fan_out(spark):
    """Many purchases x many orders on one (user, day): same rows as fan-out + dedup."""
    d = dt.date(2024, 1, 5)
    t0 = dt.datetime(2024, 1, 5, 9)
    ev_schema = ("event_id long, event_time timestamp_ntz, user_id int, session_id string, channel string, "
                 "premium_amount long, signup_date date, city string, device_type string, user_tenure_days int, "
                 "event_date date, event_hour int, event_day_of_week int, processing_time timestamp_ntz, "
                 "data_source string")
    purchases = spark.createDataFrame(
        [(i, t0 + dt.timedelta(seconds=i), 3, "s", "SEO", 100 + i, None, None, None, None, d, 9, 6, t0, "spark_etl")
         for i in range(300)], ev_schema)
    types = ["third_party", "body_injury", "medical", "fire"]
    unified = spark.createDataFrame(
        [(1000 + k, 3, types[k % 4], d, 50 + k) for k in range(200)],
        "order_id long, user_id int, insurance_type string, order_date date, premium_amount long")
    for c in orders.UNIFIED_COLUMNS:
        if c not in unified.columns:
            unified = unified.withColumn(c, F.lit(None).cast("string"))
    unified = unified.select(*orders.UNIFIED_COLUMNS)
    pays = spark.createDataFrame([(1000 + k, k, "wallet", "completed", "USD", k, 0, 0, 0, t0, t0) for k in range(200)],
                                 "order_id long, transaction_id long, payment_method string, payment_status string, "
                                 "currency string, total_amount long, tax_amount long, discount_amount long, "
                                 "commission_amount long, payment_date timestamp_ntz, settlement_date timestamp_ntz")
    want = orders.dedup_denormalized(orders.purchase_denormalized(purchases, unified, pays, AS_OF))
    got = orders.denormalize(purchases, unified, pays, AS_OF)
    assert got.count() == 300 * 4
    assert sorted(got.collect()) == sorted(want.collect())


def test_premium_consistency_counts_pairs_without_forming_them(spark):
    import random
    random.seed(11)
    d = dt.date(2024, 1, 5)
    prem = lambda: None if random.random() < 0.1 else random.choice([100, 200, 300])
    purchases = spark.createDataFrame(
        [(i, 3 if i % 2 else random.randint(4, 9), d if i % 5 else dt.date(2024, 1, 6), prem()) for i in range(400)],
        "event_id long, user_id int, event_date date, premium_amount long")
    ords = spark.createDataFrame(
        [(k, 3 if k % 3 else random.randint(4, 9), d if k % 4 else dt.date(2024, 1, 6), prem()) for k in range(150)],
        "order_id long, user_id int, order_date date, premium_amount long")
    events = purchases.select("premium_amount", F.lit(1).alias("is_purchase"), F.lit("purchase").alias("event_type"))
    got = {r.rule: (r.violations, r.checked_rows)
           for r in quality.field_consistency(events, purchases, ords).collect()}
    p, o = purchases.collect(), ords.collect()
    pairs = [(a.premium_amount, b.premium_amount) for a in p for b in o
             if a.user_id == b.user_id and a.event_date == b.order_date and b.premium_amount is not None]
    bad = sum(1 for x, y in pairs if x is not None and x != y)
    assert got["event_premium_vs_order_premium"] == (bad, len(pairs))
    assert got["is_purchase_vs_event_type"] == (0, 400)


def test_stream_ingest_splits_rejects_by_validity_not_by_offset(spark):
    """Offsets are the topic's own numbers, unrelated to event ids; a broken record is a reject."""
    from eventide.streaming import streams
    good_json = ('{"event_id": %d, "event_time": "2024-01-05 10:00:0%d", "user_id": 3, "session_id": "s_3_20240105",'
                 ' "event_type": "view", "channel": "SEO", "premium_amount": 500}')
    recs = [(b"3", (good_json % (1, 1)).encode(), "t", 0, 100),
            (b"3", (good_json % (2, 2)).encode(), "t", 0, 101),
            (b"3", b"not json", "t", 0, 102),
            (b"3", b'{"event_id": 7, "event_time": "never"}', "t", 0, 103)]
    df = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset long")
    src = streams.stage(df, "ingest-edge", None, 2)
    good, bad = streams.stream_ingest(spark, src, AS_OF)
    assert sorted(r.event_id for r in spark.read.parquet(good).collect()) == [1, 2]
    assert sorted(r.offset for r in spark.read.parquet(bad).collect()) == [102, 103]


def test_decoded_event_ids_are_unique_across_topic_partitions(spark):
    payload = b'{"event_time": "2024-01-05 10:00:00", "user_id": 3, "session_id": "s", "event_type": "view"}'
    df = spark.createDataFrame([(b"3", payload, "t", p, 5) for p in (0, 1, 2)],
                               "key binary, value binary, topic string, partition int, offset long")
    ids = [r.event_id for r in topic.decode_events(df).collect()]
    assert sorted(ids) == [5, (1 << 48) + 5, (2 << 48) + 5]


def test_users_are_loaded_only_into_an_empty_target(spark):
    lines = _lines(spark, [csv_ingest.USER_HEADER, "1,2023-02-01,Harbor,Mobile", "2,2023-02-02,Lake,Desktop"])
    empty = spark.createDataFrame([], "user_id int")
    full = spark.createDataFrame([(9,)], "user_id int")
    assert csv_ingest.ingest_users(lines, empty, AS_OF).count() == 2
    assert csv_ingest.ingest_users(lines, full, AS_OF).count() == 0


def test_payload_drift_counts_added_missing_and_mistyped_fields(spark):
    contract = [("event_id", "bigint"), ("event_time", "timestamp"), ("user_id", "int")]
    recs = [b'{"event_id": 1, "event_time": "2024-01-05 10:00:00", "user_id": 3}',
            b'{"event_id": "x", "event_time": "2024-01-05 10:00:01", "user_id": 3, "extra": 1}',
            b'{"event_id": 3, "event_time": "soon"}']
    payloads = spark.createDataFrame([(r,) for r in recs], "value binary")
    got = {(r.column_name, r.change_type): r.rows_affected
           for r in quality.payload_drift(payloads, contract=contract).collect()}
    assert got == {("extra", "column_added"): 1, ("user_id", "column_removed"): 1,
                   ("event_id", "type_change"): 1, ("event_time", "type_change"): 1}


def test_gaps_of_all_events_and_of_each_type_in_one_pass(spark):
    """Type b has a gap that events of type a fill; every scope is judged on its own rows."""
    rows = [("1", "a", "2024-01-30 00:00:00"), ("2", "b", "2024-01-30 00:30:00"), ("3", "a", "2024-01-30 02:00:00"),
            ("4", "a", "2024-01-30 02:30:00"), ("5", "b", "2024-01-30 03:20:00")]
    ev = spark.createDataFrame(rows, "event_id string, event_type string, t string").selectExpr(
        "event_id", "event_type", "CAST(t AS TIMESTAMP_NTZ) AS event_time")
    got = {(r.expected_event_type, r.missing_duration_seconds) for r in
           quality.missing_event_gaps(ev, AS_OF, "30 DAYS", 3600, by_type=True).collect()}
    assert got == {("any", 5400), ("a", 7200), ("b", 10200)}
    short = quality.missing_event_gaps(ev, AS_OF, "30 DAYS", 1799).collect()
    assert sorted(r.missing_duration_seconds for r in short) == [1800, 1800, 3000, 5400]


def test_every_purchase_closes_once_the_source_ended(spark):
    bought = spark.createDataFrame([("1", 1, 5.0), ("2", 1, 6.0), ("3", 2, 7.0)], "event_id string, user_id int, premium_amount double")
    bought = bought.selectExpr("event_id", "user_id", "DATE'2024-01-01' AS event_date", "premium_amount")
    emitted = bought.filter("event_id <> '3'").selectExpr("*", "CASE event_id WHEN '1' THEN 'o1' END AS order_id")
    got = {(r.event_id, r.order_id) for r in streams.close_purchase_orders(emitted, bought).collect()}
    assert got == {("1", "o1"), ("2", None), ("3", None)}


def test_user_lines_are_rows_or_rejects(spark):
    lines = _lines(spark, [csv_ingest.USER_HEADER, "1,2023-02-01,Harbor,Mobile", "x,2023-02-01,Lake,Mobile", ",,,", None])
    assert [r.user_id for r in csv_ingest.parse_user_lines(lines, AS_OF).collect()] == [1]
    got = [(r.value, r.reject_reason) for r in csv_ingest.user_rejects(lines).collect()]
    assert got == [("x,2023-02-01,Lake,Mobile", "bad user_id"), (",,,", "missing user_id"), (None, "missing user_id")]


def test_outliers_of_rows_without_a_group(spark):
    df = spark.createDataFrame([(i, g, v) for g in (None, "a") for i, v in enumerate([1.0] * 5 + [2.0] * 5 + [90.0])],
                               "id int, g string, v double")
    got = quality.outliers_iqr(df, "v", ["g"]).collect()
    assert sorted((r.g or "", r.v) for r in got) == [("", 90.0), ("a", 90.0)]


def test_completeness_of_a_day_without_events(spark):
    ev = spark.createDataFrame([], "event_id bigint, user_id int, event_date date")
    row = quality.check_completeness(ev, AS_OF).first()
    assert (row.status, row.severity) == ("fail", "high")
