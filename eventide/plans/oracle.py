"""Independent DuckDB SQL for every registered query.

Each oracle is written from the operator's meaning, over the same parquet
tables (pre-registered as views).  Shared stand-in projections are CTEs; the
final projection renders dates as ISO text and arrays as '|'-joined text,
exactly like ``registry.present`` does on the Spark side.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("raw_events", """
SELECT event_id,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time,
       CAST(user_id AS BIGINT) AS user_id,
       concat('s_', CAST(user_id AS VARCHAR), '_', strftime(ts, '%Y%m%d')) AS session_id,
       event_type,
       (['Google Ads','SEO','Email','Referral','Direct'])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1] AS channel,
       CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT) ELSE CAST(round(value * 100) AS BIGINT) END AS premium_amount
FROM events""")

cte("users", """
SELECT CAST(c_custkey AS BIGINT) AS user_id,
       DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
       n_name AS city,
       CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Desktop'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN ' Mobile '
            WHEN c_mktsegment = 'FURNITURE' THEN 'Mobile' ELSE 'Tablet' END AS device_type
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 10 <> 7""")

cte("clean_events", """
SELECT * FROM raw_events
WHERE user_id IS NOT NULL AND event_time IS NOT NULL AND session_id IS NOT NULL
  AND premium_amount IS NOT NULL AND premium_amount > 0""", "raw_events")

cte("enriched", """
SELECT e.user_id, e.event_id, e.event_time, e.session_id, e.event_type, e.channel, e.premium_amount,
       u.signup_date, u.city, u.device_type
FROM clean_events e LEFT JOIN users u ON e.user_id = u.user_id""", "clean_events", "users")

cte("derived", """
SELECT *,
       CAST(event_time AS DATE) AS event_date,
       CAST(hour(event_time) AS INTEGER) AS event_hour,
       CAST(dayofweek(event_time) + 1 AS INTEGER) AS event_day_of_week,
       CAST(datediff('day', signup_date, CAST(event_time AS DATE)) AS INTEGER) AS user_tenure_days,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase
FROM enriched""", "enriched")

cte("processed", f"""
SELECT event_id, event_time, user_id, session_id, event_type, channel, premium_amount,
       signup_date, city, device_type, user_tenure_days, event_date, event_hour,
       event_day_of_week, is_purchase, {AS_OF} AS processing_time, 'spark_etl' AS data_source
FROM derived""", "derived")

cte("store", f"""
SELECT * REPLACE (trim(device_type) AS device_type), {AS_OF} AS ingestion_time
FROM processed""", "processed")


def _resolve(names: tuple[str, ...], seen: list[str]) -> None:
    for n in names:
        if n in seen:
            continue
        _resolve(CTES[n][1], seen)
        seen.append(n)


def sql(body: str, *uses: str, dates: tuple[str, ...] = (), arrays: tuple[str, ...] = ()) -> str:
    """Compose CTEs + body, then render dates / arrays as text."""
    order: list[str] = []
    _resolve(uses, order)
    parts = [f"{n} AS ({CTES[n][0].strip()})" for n in order]
    parts.append(f"__q AS ({body.strip()})")
    repl = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    repl += [f"array_to_string({c}, '|') AS {c}" for c in arrays]
    final = f"SELECT * REPLACE ({', '.join(repl)}) FROM __q" if repl else "SELECT * FROM __q"
    return "WITH " + ",\n".join(parts) + "\n" + final


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *uses: str, dates=(), arrays=()) -> None:
    ORACLE[name] = sql(body, *uses, dates=tuple(dates), arrays=tuple(arrays))


PROCESSED_DATES = ("signup_date", "event_date")

# ---- sources -------------------------------------------------------------
oracle("clean_events", "SELECT * FROM clean_events", "clean_events")
oracle("enrich_events", "SELECT * FROM enriched", "enriched", dates=("signup_date",))
oracle("derive_event_attributes", "SELECT * FROM derived", "derived", dates=PROCESSED_DATES)
oracle("run_etl", "SELECT * FROM processed", "processed", dates=PROCESSED_DATES)

# ---- aggregations --------------------------------------------------------
cte("daily_ev", """
SELECT event_date AS metric_date, channel, event_type, city, device_type,
       count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions,
       CAST(sum(premium_amount) AS BIGINT) AS total_premium,
       round(avg(premium_amount), 4) AS avg_premium
FROM store GROUP BY ALL""", "store")
oracle("daily_event_metrics", "SELECT * FROM daily_ev", "daily_ev", dates=("metric_date",))

# ---- order side: stand-in product tables and payments ----------------------
cte("product_orders", """
SELECT o_orderkey AS order_id, CAST(o_custkey AS BIGINT) AS user_id,
       concat('P', CAST(o_orderkey AS VARCHAR)) AS policy_number,
       (['third_party','body_injury','medical','fire'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS insurance_type,
       CAST(round(o_totalprice) AS BIGINT) AS coverage_amount,
       CAST(round(o_totalprice / 100) AS BIGINT) AS premium_amount,
       DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS order_date,
       DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS policy_start_date,
       DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) + CAST(180 + o_orderkey % 185 AS INTEGER) AS policy_end_date,
       CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
       CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS TIMESTAMP) AS created_at,
       o_orderkey, o_totalprice
FROM orders""")

cte("third_party_orders", """
SELECT order_id, user_id, policy_number,
       (['sedan','suv','truck'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS vehicle_type,
       CAST(o_orderkey % 20 AS INTEGER) AS vehicle_age, CAST(18 + o_orderkey % 60 AS INTEGER) AS driver_age,
       coverage_amount, premium_amount + (v - 1) * 10 AS premium_amount,
       order_date, policy_start_date, policy_end_date, status, created_at,
       created_at + v * INTERVAL 1 HOUR AS updated_at, CAST(v AS INTEGER) AS version
FROM product_orders, (VALUES (1), (2)) x(v) WHERE insurance_type = 'third_party'""", "product_orders")

cte("body_injury_orders", """
SELECT order_id, user_id, policy_number,
       (['basic','standard','premium'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS coverage_type,
       CAST(round(o_totalprice * 2) AS BIGINT) AS medical_limit, CAST(round(o_totalprice) AS BIGINT) AS property_limit,
       premium_amount, CAST(o_orderkey % 500 AS INTEGER) AS deductible,
       order_date, policy_start_date, policy_end_date, status, created_at, created_at AS updated_at, 1 AS version
FROM product_orders WHERE insurance_type = 'body_injury'""", "product_orders")

cte("medical_orders", """
SELECT order_id, user_id, policy_number,
       (['bronze','silver','gold'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS coverage_plan,
       CAST(o_orderkey % 2 AS INTEGER) AS individual, CAST(1 - o_orderkey % 2 AS INTEGER) AS family,
       coverage_amount, premium_amount, CAST(o_orderkey % 500 AS INTEGER) AS deductible,
       CAST(o_orderkey % 30 AS INTEGER) AS co_payment,
       order_date, policy_start_date, policy_end_date, status, created_at, created_at AS updated_at, 1 AS version
FROM product_orders WHERE insurance_type = 'medical'""", "product_orders")

cte("fire_orders", """
SELECT order_id, user_id, policy_number,
       (['apartment','house','commercial'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS property_type,
       coverage_amount * 3 AS property_value, coverage_amount, premium_amount,
       CAST(o_orderkey % 500 AS INTEGER) AS deductible,
       (['Harbor','Hill','Lake','Plain'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS location_city,
       (['concrete','steel','wood'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS construction_type,
       order_date, policy_start_date, policy_end_date, status, created_at, created_at AS updated_at, 1 AS version
FROM product_orders WHERE insurance_type = 'fire'""", "product_orders")

cte("payments", """
SELECT order_id, transaction_id,
       (['credit_card','bank_transfer','wallet'])[CAST(transaction_id % 3 AS INTEGER) + 1] AS payment_method,
       CASE returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'pending' ELSE 'completed' END AS payment_status,
       'USD' AS currency, total_amount, tax_amount, discount_amount,
       CAST(floor(total_amount / 20) AS BIGINT) AS commission_amount,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(order_id % 30 AS INTEGER)) + INTERVAL 12 HOUR AS payment_date,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(order_id % 30 AS INTEGER)) + INTERVAL 12 HOUR + INTERVAL 2 DAY AS settlement_date,
       1 AS version
FROM (SELECT l_orderkey AS order_id, min(l_suppkey) AS transaction_id,
             CAST(sum(round(l_extendedprice)) AS BIGINT) AS total_amount,
             CAST(sum(round(l_extendedprice * l_tax)) AS BIGINT) AS tax_amount,
             CAST(sum(round(l_extendedprice * l_discount)) AS BIGINT) AS discount_amount,
             max(l_returnflag) AS returnflag
      FROM lineitem GROUP BY l_orderkey)""")

UNIFIED_COLS = ("order_id, user_id, policy_number, insurance_type, product_type, coverage_type, coverage_plan, "
                "property_type, coverage_amount, premium_amount, vehicle_age, driver_age, medical_limit, "
                "property_limit, individual, family, deductible, co_payment, property_value, location_city, "
                "construction_type, order_date, policy_start_date, policy_end_date, status, created_at, updated_at")


def _latest(table: str) -> str:
    return (f"SELECT * EXCLUDE (version) FROM {table} "
            f"QUALIFY row_number() OVER (PARTITION BY order_id, user_id ORDER BY version DESC, updated_at DESC) = 1")


cte("unified", f"""
SELECT {UNIFIED_COLS} FROM (
  SELECT * EXCLUDE (vehicle_type), vehicle_type AS product_type, 'third_party' AS insurance_type FROM ({_latest('third_party_orders')})
  UNION ALL BY NAME SELECT *, 'body_injury' AS insurance_type FROM ({_latest('body_injury_orders')})
  UNION ALL BY NAME SELECT *, 'medical' AS insurance_type FROM ({_latest('medical_orders')})
  UNION ALL BY NAME SELECT *, 'fire' AS insurance_type FROM ({_latest('fire_orders')}))""",
    "third_party_orders", "body_injury_orders", "medical_orders", "fire_orders")

cte("purchases", "SELECT * FROM store WHERE event_type = 'purchase'", "store")

cte("denorm_raw", f"""
SELECT e.event_id, e.event_time, e.user_id, e.session_id, e.channel, e.premium_amount, e.signup_date,
       e.city, e.device_type, e.user_tenure_days, e.event_date, e.event_hour, e.event_day_of_week,
       e.processing_time, e.data_source,
       coalesce(o.order_id, e.event_id) AS order_id, o.policy_number, o.insurance_type, o.product_type,
       o.coverage_type, o.coverage_plan, o.property_type, o.coverage_amount AS order_coverage_amount,
       o.premium_amount AS order_premium_amount, o.vehicle_age, o.driver_age, o.medical_limit,
       o.property_limit, o.individual, o.family, o.deductible, o.co_payment, o.property_value,
       o.location_city, o.construction_type, o.order_date, o.policy_start_date, o.policy_end_date,
       o.status AS order_status, f.transaction_id, f.payment_method, f.payment_status, f.currency,
       f.total_amount, f.tax_amount, f.discount_amount, f.commission_amount, f.payment_date,
       f.settlement_date, {AS_OF} AS ingestion_time
FROM purchases e
LEFT JOIN unified o ON e.user_id = o.user_id AND e.event_date = o.order_date
LEFT JOIN payments f ON o.order_id = f.order_id""", "purchases", "unified", "payments")

cte("denorm", """
SELECT * FROM denorm_raw
QUALIFY row_number() OVER (PARTITION BY event_date, event_id, user_id, insurance_type
                           ORDER BY order_id DESC, transaction_id DESC) = 1""", "denorm_raw")

cte("sessions", """
SELECT session_id, user_id, min(event_time) AS first_event_time, max(event_time) AS last_event_time,
       count(*) AS total_events, count(DISTINCT event_type) AS unique_event_types,
       max(is_purchase) AS has_purchase, CAST(sum(premium_amount) AS BIGINT) AS total_premium,
       first(channel ORDER BY event_time, event_id) AS first_channel,
       first(city ORDER BY event_time, event_id) AS first_city,
       first(device_type ORDER BY event_time, event_id) AS first_device_type,
       list(event_type ORDER BY event_time, event_id) AS event_sequence,
       datediff('second', min(event_time), max(event_time)) AS session_duration_seconds
FROM store GROUP BY session_id, user_id""", "store")

DENORM_DATES = ("signup_date", "event_date", "order_date", "policy_start_date", "policy_end_date")
ORDER_DATES = ("order_date", "policy_start_date", "policy_end_date")

oracle("unified_orders", "SELECT * FROM unified", "unified", dates=ORDER_DATES)
oracle("latest_version", """
SELECT * REPLACE (CASE WHEN insurance_type <> 'third_party' AND order_id % 5 = 0 THEN premium_amount + 7 ELSE premium_amount END AS premium_amount,
         CASE WHEN insurance_type <> 'third_party' AND order_id % 5 = 0 THEN updated_at + INTERVAL 1 HOUR ELSE updated_at END AS updated_at),
       CASE WHEN insurance_type = 'third_party' OR order_id % 5 = 0 THEN 2 ELSE 1 END AS version
FROM unified""", "unified", dates=ORDER_DATES)
oracle("purchase_order_join", """
SELECT e.event_id, e.user_id, e.event_date, e.premium_amount, o.order_id, o.insurance_type,
       o.policy_number, o.premium_amount AS order_premium_amount
FROM purchases e LEFT JOIN unified o ON e.user_id = o.user_id AND e.event_date = o.order_date""",
       "purchases", "unified", dates=("event_date",))
oracle("purchase_denormalized", "SELECT * FROM denorm_raw", "denorm_raw", dates=DENORM_DATES)
oracle("dedup_denormalized", "SELECT * FROM denorm", "denorm", dates=DENORM_DATES)
oracle("purchase_denormalized_by_order_id", """
SELECT e.event_id, e.user_id, e.session_id, e.channel, e.premium_amount, o.insurance_type,
       o.policy_number, o.coverage_amount, f.payment_method, f.payment_status, f.total_amount,
       round(CAST(e.premium_amount AS DOUBLE) / nullif(f.total_amount, 0), 6) AS commission_rate
FROM purchases e
LEFT JOIN unified o ON e.user_id = o.user_id AND e.event_id = o.order_id
LEFT JOIN payments f ON o.order_id = f.order_id""", "purchases", "unified", "payments")
oracle("product_inner_join", f"""
SELECT e.event_id, e.user_id, e.premium_amount, 'third_party' AS insurance_type, o.policy_number,
       f.payment_method, f.payment_status
FROM purchases e
JOIN ({_latest('third_party_orders')}) o ON e.user_id = o.user_id AND e.event_date = o.order_date
JOIN payments f ON o.order_id = f.order_id
WHERE e.event_date >= DATE '2024-01-01'""", "purchases", "third_party_orders", "payments")
oracle("type_date_lookup", """
SELECT event_id, user_id, premium_amount, insurance_type, policy_number, payment_method, payment_status
FROM denorm WHERE event_date >= DATE '2024-01-01' AND insurance_type = 'third_party'""", "denorm")
oracle("insurance_type_summary", """
SELECT insurance_type, event_date, count(*) AS purchase_count, CAST(sum(premium_amount) AS BIGINT) AS total_premium,
       CAST(sum(total_amount) AS BIGINT) AS total_revenue, round(avg(premium_amount), 4) AS avg_premium
FROM denorm GROUP BY ALL""", "denorm", dates=("event_date",))
oracle("user_daily_summary", """
SELECT user_id, event_date, count(*) AS daily_purchases, CAST(sum(premium_amount) AS BIGINT) AS daily_premium,
       coalesce(list_sort(list(insurance_type) FILTER (WHERE insurance_type IS NOT NULL)), []) AS insurance_types
FROM denorm GROUP BY ALL""", "denorm", dates=("event_date",), arrays=("insurance_types",))
oracle("insurance_type_last_days", f"""
SELECT insurance_type, event_date, CAST(sum(premium_amount) AS BIGINT) AS daily_premium, count(*) AS purchase_count,
       round(avg(total_amount), 4) AS avg_transaction_value
FROM denorm WHERE event_date >= CAST({AS_OF} AS DATE) - 30 GROUP BY ALL""", "denorm", dates=("event_date",))
oracle("user_product_mix", f"""
SELECT d.user_id, count(*) AS total_purchases, CAST(sum(d.premium_amount) AS BIGINT) AS total_premium,
       coalesce(list_sort(list(DISTINCT d.insurance_type) FILTER (WHERE d.insurance_type IS NOT NULL)), []) AS product_mix,
       max(s.session_duration_seconds) AS longest_session
FROM denorm d LEFT JOIN sessions s ON d.session_id = s.session_id AND d.user_id = s.user_id
WHERE d.event_date >= CAST({AS_OF} AS DATE) - 90
GROUP BY d.user_id HAVING count(*) > 1
ORDER BY total_premium DESC, d.user_id LIMIT 100""", "denorm", "sessions", arrays=("product_mix",))
oracle("channel_product_performance", f"""
SELECT channel, insurance_type, count(*) AS purchase_count, CAST(sum(premium_amount) AS BIGINT) AS revenue,
       CAST(sum(commission_amount) AS BIGINT) AS commission,
       round(avg(datediff('day', policy_start_date, policy_end_date)), 4) AS avg_policy_duration
FROM denorm WHERE event_date >= CAST({AS_OF} AS DATE) - 7 AND payment_status = 'completed'
GROUP BY ALL""", "denorm")
oracle("insurance_type_last_week", f"""
SELECT insurance_type, count(*) AS purchase_count, CAST(sum(premium_amount) AS BIGINT) AS total_premium,
       round(avg(premium_amount), 4) AS avg_premium
FROM denorm WHERE event_date >= CAST({AS_OF} AS DATE) - 7 GROUP BY ALL""", "denorm")
oracle("denormalized_overview", """
SELECT count(*) AS total_records, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT insurance_type) AS insurance_types, CAST(sum(premium_amount) AS BIGINT) AS total_premium,
       round(avg(premium_amount), 4) AS avg_premium
FROM denorm""", "denorm")

oracle("event_gaps", """
SELECT event_id, event_time, lead(event_time) OVER (ORDER BY event_time, event_id) AS next_event_time,
       datediff('second', event_time, lead(event_time) OVER (ORDER BY event_time, event_id)) AS gap_seconds
FROM processed""", "processed")

# ---- sources, sinks, projections ------------------------------------------------
STORE_DATES = ("signup_date", "event_date")
oracle("decode_events", "SELECT * FROM raw_events", "raw_events")
cte("spoiled", """
SELECT event_id, event_type, channel, premium_amount, user_id,
       CASE WHEN event_id % 79 = 11 THEN 'soon' ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS written_time,
       CASE WHEN event_id % 79 = 11 THEN NULL ELSE event_time END AS event_time,
       CASE WHEN event_id % 73 = 13 THEN 'x' ELSE '' END || session_id AS session_id,
       CASE WHEN event_id % 89 = 5 THEN 'u' ELSE '' END || user_id AS written_user,
       CASE WHEN event_id % 97 = 3 THEN 'fewer_than_6_fields' WHEN event_id % 89 = 5 THEN 'bad_user_id'
            WHEN event_id % 83 = 7 THEN 'bad_premium_amount' END AS reject_reason
FROM raw_events""", "raw_events")
oracle("ingest_events_csv", """
SELECT written_time AS event_time, user_id, session_id, event_type, channel, premium_amount FROM spoiled WHERE reject_reason IS NULL""",
       "spoiled")
oracle("event_rejects", """
SELECT concat_ws(',', written_time, written_user, session_id) || CASE WHEN reject_reason = 'fewer_than_6_fields' THEN ''
         ELSE ',' || event_type || ',' || channel || ',' || CASE WHEN event_id % 83 = 7 THEN 'n/a' WHEN premium_amount = 0 THEN ''
              ELSE CAST(premium_amount AS VARCHAR) END END AS line, reject_reason
FROM spoiled WHERE reject_reason IS NOT NULL""", "spoiled")
oracle("ingest_report", """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE reject_reason IS NULL) AS sent_rows, count(reject_reason) AS failed_rows,
       round(100.0 * count(*) FILTER (WHERE reject_reason IS NULL) / count(*), 2) AS success_rate FROM spoiled""", "spoiled")
oracle("user_rejects", """
SELECT CASE WHEN user_id % 50 = 1 THEN 'u' || user_id ELSE '' END AS written_id,
       CASE WHEN user_id % 50 = 1 THEN 'bad user_id' ELSE 'missing user_id' END AS reject_reason
FROM users WHERE user_id % 50 IN (1, 2)""", "users")
oracle("ingest_users_csv", f"""
SELECT CASE WHEN user_id % 50 = 3 THEN user_id + 3000000000 ELSE user_id END AS user_id, signup_date, city, device_type,
       {AS_OF} AS created_at, {AS_OF} AS updated_at FROM users WHERE user_id % 50 NOT IN (1, 2)""",
       "users", dates=("signup_date",))
oracle("users_profile", """
SELECT count(*) AS total_users, min(signup_date) AS min_signup_date, max(signup_date) AS max_signup_date,
       count(DISTINCT city) AS cities, count(DISTINCT device_type) AS devices FROM users""", "users",
       dates=("min_signup_date", "max_signup_date"))
oracle("encode_processed", "SELECT * FROM store", "store", dates=STORE_DATES)
oracle("normalize_processed", "SELECT * FROM store", "store", dates=STORE_DATES)
oracle("incremental_load", """
SELECT * FROM users WHERE user_id > (SELECT max(user_id) FROM users WHERE user_id IN (SELECT user_id FROM raw_events))""",
       "users", "raw_events", dates=("signup_date",))
oracle("write_partitioned", """
SELECT * REPLACE (coalesce(insurance_type, 'none') AS insurance_type), strftime(event_date, '%Y%m') AS month
FROM denorm""", "denorm", dates=DENORM_DATES)
oracle("event_key", """
SELECT min(event_id) AS class_id, CAST(2 * count(*) AS BIGINT) AS deliveries
FROM store GROUP BY event_time, user_id, session_id, event_type, channel, premium_amount""", "store")
oracle("scalar_functions", f"""
SELECT event_id,
       strptime(strftime(event_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_time,
       CAST(event_time AS DATE) AS event_day,
       CAST(hour(event_time) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
       CAST(datediff('day', signup_date, event_date) AS INTEGER) AS days_since_signup,
       datediff('second', event_time, {AS_OF}) AS seconds_to_as_of,
       date_trunc('hour', event_time) AS hour_bucket,
       strftime(event_time, '%Y%m') AS month_key,
       trim(device_type) AS device_trimmed,
       concat(event_type, '/', channel) AS label,
       CAST(user_id AS VARCHAR) AS user_text,
       coalesce(city, 'unknown') AS city_or_unknown,
       round(premium_amount / 100.0, 2) AS premium_units,
       round(CAST(premium_amount AS DOUBLE) / nullif(event_hour, 0), 4) AS premium_per_hour,
       CASE WHEN premium_amount > 5000 THEN 1 ELSE 0 END AS is_big,
       channel AS json_channel,
       len(string_split(session_id, '_')) AS session_parts,
       CASE WHEN list_bool_and(list_transform(string_split(session_id, '_'), lambda x: x <> '')) THEN 1 ELSE 0 END AS all_parts_nonempty,
       len(list_filter(string_split(session_id, '_'), lambda x: regexp_full_match(x, '[0-9]+'))) AS numeric_parts,
       array_to_string(list_transform(string_split(session_id, '_'), lambda x: upper(x)), '-') AS upper_parts
FROM store""", "store", dates=("event_day",))

# ---- event roll-ups ---------------------------------------------------------------------
cte("daily_agg", """
SELECT event_date AS metric_date, channel, city, device_type, count(*) AS total_events,
       count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
       CAST(sum(premium_amount) AS BIGINT) AS total_premium, CAST(sum(is_purchase) AS BIGINT) AS purchase_events,
       count(*) FILTER (WHERE premium_amount > 0) AS total_users_with_premium
FROM store GROUP BY ALL""", "store")
oracle("daily_aggregate_metrics", "SELECT * FROM daily_agg", "daily_agg", dates=("metric_date",))
oracle("daily_metrics_exact_rollup", "SELECT * FROM daily_agg", "daily_agg", dates=("metric_date",))
oracle("daily_metrics_rollup", """
SELECT metric_date, channel, city, device_type, total_events, total_premium, purchase_events,
       total_users_with_premium, round(CAST(total_premium AS DOUBLE) / total_events, 4) AS avg_premium
FROM daily_agg""", "daily_agg", dates=("metric_date",))
oracle("daily_metrics_rollup_sketch", """
SELECT metric_date, channel, city, device_type, total_events, total_premium, purchase_events,
       total_users_with_premium, round(CAST(total_premium AS DOUBLE) / total_events, 4) AS avg_premium,
       unique_users, unique_sessions, TRUE AS users_within, TRUE AS sessions_within
FROM daily_agg""", "daily_agg", dates=("metric_date",))
oracle("session_metrics", "SELECT * FROM sessions", "sessions", arrays=("event_sequence",))
oracle("session_kpis", """
SELECT round(avg(session_duration_seconds), 4) AS avg_session_duration,
       round(quantile_cont(session_duration_seconds, 0.95), 4) AS p95_duration,
       round(CAST(sum(has_purchase) AS DOUBLE) / count(*), 6) AS conversion_rate FROM sessions""", "sessions")
oracle("clustered_lookup", """
SELECT 'user_id' AS looked_up, event_id, user_id, event_date, premium_amount, TRUE AS few_files
FROM store WHERE user_id = (SELECT max(user_id) FROM store)
UNION ALL
SELECT 'event_date', event_id, user_id, event_date, premium_amount, TRUE FROM store
WHERE event_date = (SELECT max(event_date) FROM store)""", "store", dates=("event_date",))
oracle("session_kpis_sketch", """
SELECT 'day' AS period_kind, strftime(first_event_time, '%Y-%m-%d') AS period, count(*) AS sessions,
       round(avg(session_duration_seconds), 4) AS avg_session_duration,
       round(CAST(sum(has_purchase) AS DOUBLE) / count(*), 6) AS conversion_rate,
       round(quantile_cont(session_duration_seconds, 0.95), 4) AS p95_exact, TRUE AS p95_within
FROM sessions GROUP BY ALL
UNION ALL
SELECT 'month', strftime(first_event_time, '%Y-%m'), count(*), round(avg(session_duration_seconds), 4),
       round(CAST(sum(has_purchase) AS DOUBLE) / count(*), 6), round(quantile_cont(session_duration_seconds, 0.95), 4), TRUE
FROM sessions GROUP BY ALL""", "sessions")
oracle("category_values_report", """
SELECT category, list_sort(list(DISTINCT value) FILTER (WHERE value IS NOT NULL)) AS "values",
       count(DISTINCT value) AS unique_count
FROM (SELECT 'Event Types:' AS category, event_type AS value FROM store
      UNION ALL SELECT 'Channels:', channel FROM store
      UNION ALL SELECT 'Cities:', city FROM store
      UNION ALL SELECT 'Device Types:', trim(device_type) FROM store)
GROUP BY category""", "store", arrays=('"values"',))
_PROCESSED = ["event_id", "event_time", "user_id", "session_id", "event_type", "channel", "premium_amount",
              "signup_date", "city", "device_type", "user_tenure_days", "event_date", "event_hour",
              "event_day_of_week", "is_purchase", "processing_time", "data_source"]
oracle("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM processed"
    for c in _PROCESSED), "processed")
oracle("table_row_counts", """
SELECT 'processed_events_storage' AS table_name, (SELECT count(*) FROM store) AS row_count
UNION ALL SELECT 'daily_event_metrics', (SELECT count(*) FROM (SELECT DISTINCT event_date, channel, event_type, city, device_type FROM store))
UNION ALL SELECT 'daily_aggregate_metrics', (SELECT count(*) FROM daily_agg)
UNION ALL SELECT 'session_metrics', (SELECT count(*) FROM sessions)
UNION ALL SELECT 'purchase_events_denormalized', (SELECT count(*) FROM denorm)""",
       "store", "daily_agg", "sessions", "denorm")
oracle("signup_to_purchase_journey", """
SELECT f.user_id, f.first_signup_time, min(p.event_time) AS first_purchase_time,
       datediff('second', f.first_signup_time, min(p.event_time)) AS seconds_to_purchase
FROM (SELECT user_id, min(event_time) AS first_signup_time FROM store WHERE event_type = 'signup' GROUP BY user_id) f
LEFT JOIN store p ON p.user_id = f.user_id AND p.event_type = 'purchase' AND p.event_time >= f.first_signup_time
GROUP BY f.user_id, f.first_signup_time""", "store")
oracle("channel_attribution", """
SELECT s.first_channel, count(*) AS purchases, CAST(sum(e.premium_amount) AS BIGINT) AS total_premium,
       count(DISTINCT e.session_id) AS converting_sessions
FROM store e JOIN sessions s ON e.session_id = s.session_id WHERE e.event_type = 'purchase'
GROUP BY s.first_channel""", "store", "sessions")
oracle("orphan_events", "SELECT * FROM clean_events WHERE user_id NOT IN (SELECT user_id FROM users)",
       "clean_events", "users")
oracle("known_user_events", "SELECT * FROM clean_events WHERE user_id IN (SELECT user_id FROM users)",
       "clean_events", "users")

# ---- maintenance ------------------------------------------------------------------------
oracle("dedup_events", """
SELECT * FROM (SELECT * FROM store
               UNION ALL SELECT * REPLACE (ingestion_time + INTERVAL 1 MINUTE AS ingestion_time) FROM store)
QUALIFY row_number() OVER (PARTITION BY event_date, event_id ORDER BY ingestion_time DESC) = 1""",
       "store", dates=STORE_DATES)
oracle("retained_tables", f"""
SELECT 'processed_events_storage' AS table_name, 365 AS days, count(*) AS rows_before,
       count(*) FILTER (WHERE event_time > TIMESTAMP '2025-01-15 00:00:00' - INTERVAL 365 DAY) AS rows_kept FROM store
UNION ALL SELECT 'session_metrics', 365, count(*),
       count(*) FILTER (WHERE first_event_time > TIMESTAMP '2025-01-15 00:00:00' - INTERVAL 365 DAY) FROM sessions
UNION ALL SELECT 'purchase_events_denormalized', 365, count(*),
       count(*) FILTER (WHERE event_time > TIMESTAMP '2025-01-15 00:00:00' - INTERVAL 365 DAY) FROM denorm""",
       "store", "sessions", "denorm")
oracle("layout_lookup", """
SELECT 'session' AS lookup, event_id, user_id, event_time, CAST(NULL AS VARCHAR) AS policy_number
FROM store WHERE session_id = (SELECT session_id FROM store ORDER BY event_time, event_id LIMIT 1)
UNION ALL
SELECT 'policy', event_id, user_id, event_time, policy_number
FROM denorm WHERE policy_number = (SELECT policy_number FROM denorm WHERE policy_number IS NOT NULL
                                   ORDER BY event_time, event_id, policy_number LIMIT 1)""", "store", "denorm")
oracle("retain_recent", f"SELECT * FROM store WHERE event_time > {AS_OF} - INTERVAL 7 DAY", "store",
       dates=STORE_DATES)
oracle("point_lookup", """
SELECT * FROM store WHERE session_id = (SELECT session_id FROM store ORDER BY event_time, event_id LIMIT 1)""",
       "store", dates=STORE_DATES)
oracle("upsert_users", f"""
SELECT u.user_id, u.signup_date, u.city,
       CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Mobile' ELSE u.device_type END AS device_type,
       CAST(u.signup_date AS TIMESTAMP) AS created_at,
       CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN {AS_OF} ELSE CAST(u.signup_date AS TIMESTAMP) END AS updated_at,
       CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 2 ELSE 1 END AS version
FROM users u JOIN customer c ON u.user_id = c.c_custkey""", "users", dates=("signup_date",))

# ---- data quality: check rows ------------------------------------------------------------------
EV_TABLE = "processed_events_storage"


def _check(check_type, name, expected, actual, deviation, status, severity, errors, total, details,
           affected="[]::BIGINT[]", source="") -> str:
    return (f"SELECT concat_ws(':', '{EV_TABLE}', '{name}', '20240131000000') AS check_id, {AS_OF} AS check_time, "
            f"'{EV_TABLE}' AS table_name, '{check_type}' AS check_type, '{name}' AS check_name, "
            f"CAST({expected} AS DOUBLE) AS expected_value, CAST({actual} AS DOUBLE) AS actual_value, "
            f"CAST({deviation} AS DOUBLE) AS deviation_percent, {status} AS status, {severity} AS severity, "
            f"CAST({errors} AS BIGINT) AS error_count, CAST({total} AS BIGINT) AS total_records, "
            f"{details} AS details, {affected} AS affected_rows {source}")


cte("recent", f"SELECT * FROM store WHERE event_date >= CAST({AS_OF} AS DATE) - 1", "store")
cte("chk_completeness", _check(
    "completeness", "user_id_completeness", "100.0", "round(p, 2)", "round(100.0 - p, 2)",
    "CASE WHEN p >= 99.5 THEN 'pass' WHEN p >= 95.0 THEN 'warning' ELSE 'fail' END",
    "CASE WHEN p < 95.0 THEN 'high' ELSE 'low' END", "n - ok", "n",
    "concat('Missing user_id count: ', CAST(n - ok AS VARCHAR))",
    "coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT event_id FROM recent WHERE NOT coalesce(user_id > 0, false) ORDER BY event_id LIMIT 10)), [])",
    "FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_id > 0) AS ok, "
    "100.0 * count(*) FILTER (WHERE user_id > 0) / count(*) AS p FROM recent)"), "recent")
cte("chk_duplicates", _check(
    "accuracy", "duplicate_events", "0.0", "round(n - d, 2)", "0.0",
    "CASE WHEN n = d THEN 'pass' ELSE 'fail' END", "'medium'", "n - d", "n",
    "concat('Duplicate event count: ', CAST(n - d AS VARCHAR))",
    "coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT DISTINCT event_id FROM recent ORDER BY event_id LIMIT 10)), [])",
    "FROM (SELECT 2 * count(*) AS n, count(DISTINCT event_id) AS d FROM recent) WHERE n <> d"), "recent")
cte("chk_duplicates_run", _check(
    "accuracy", "duplicate_events", "0.0", "round(n - d, 2)", "0.0",
    "CASE WHEN n = d THEN 'pass' ELSE 'fail' END", "'medium'", "n - d", "n",
    "concat('Duplicate event count: ', CAST(n - d AS VARCHAR))",
    "coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT DISTINCT event_id FROM recent ORDER BY event_id LIMIT 10)), [])",
    "FROM (SELECT count(*) AS n, count(DISTINCT event_id) AS d FROM recent) WHERE n <> d"), "recent")
cte("orph", "SELECT * FROM store WHERE user_id NOT IN (SELECT user_id FROM users)", "store", "users")
cte("chk_orphans", _check(
    "consistency", "orphan_user_events", "0.0", "p", "p",
    "CASE WHEN bad = 0 THEN 'pass' WHEN p < 5.0 THEN 'warning' ELSE 'fail' END",
    "CASE WHEN p >= 5.0 THEN 'critical' ELSE 'medium' END", "bad", "n",
    "concat('Events with unknown user: ', CAST(bad AS VARCHAR))",
    "coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT event_id FROM orph ORDER BY event_id LIMIT 10)), [])",
    "FROM (SELECT n, bad, round(100.0 * bad / n, 2) AS p FROM "
    "(SELECT (SELECT count(*) FROM store) AS n, (SELECT count(*) FROM orph) AS bad))"), "store", "orph")

RANGE_RULES = [("user_id", 0, 9223372036854775807), ("premium_amount", 0, 4294967295), ("event_hour", 0, 23),
               ("event_day_of_week", 1, 7), ("is_purchase", 0, 1), ("user_tenure_days", 0, 65535)]
cte("range_rules", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({lo} AS BIGINT) AS min_value, CAST({hi} AS BIGINT) AS max_value, "
    f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS violations, count({c}) AS checked_values FROM store"
    for c, lo, hi in RANGE_RULES), "store")
cte("lines", """
SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, session_id FROM raw_events""", "raw_events")
cte("format_rules", """
SELECT 'event_time' AS column_name, count(*) FILTER (WHERE event_time IS NOT NULL AND try_strptime(event_time, '%Y-%m-%d %H:%M:%S') IS NULL) AS violations, count(*) AS checked_rows FROM lines
UNION ALL SELECT 'user_id', CAST(0 AS BIGINT), count(*) FROM lines
UNION ALL SELECT 'premium_amount', CAST(0 AS BIGINT), count(*) FROM lines
UNION ALL SELECT 'session_id', count(*) FILTER (WHERE NOT regexp_matches(coalesce(session_id, ''), '^s_[0-9]+_[0-9]{8}$')), count(*) FROM lines""",
    "lines")
cte("temporal_rules", """
SELECT 'event_before_signup' AS rule, count(*) FILTER (WHERE event_date < signup_date) AS violations, count(*) AS checked_rows FROM store
UNION ALL SELECT 'policy_end_before_start', count(*) FILTER (WHERE policy_end_date < policy_start_date), count(*) FROM unified""",
    "store", "unified")
cte("consistency_rules", """
SELECT 'is_purchase_vs_event_type' AS rule,
       count(*) FILTER (WHERE (is_purchase = 1) <> (event_type = 'purchase')) AS violations, count(*) AS checked_rows FROM store
UNION ALL SELECT 'event_premium_vs_order_premium', count(*) FILTER (WHERE e.premium_amount <> o.premium_amount), count(*)
FROM purchases e JOIN unified o ON e.user_id = o.user_id AND e.event_date = o.order_date""",
    "store", "purchases", "unified")


def _rules_check(rules: str, check_type: str, name: str, severity: str, checked: str = "checked_rows") -> str:
    return _check(check_type, name, "0.0", "bad", "coalesce(round(100.0 * bad / n, 2), 0.0)",
                  "CASE WHEN bad = 0 THEN 'pass' ELSE 'fail' END", f"'{severity}'", "bad", "n",
                  f"concat('{name} violations: ', CAST(bad AS VARCHAR))", "[]::BIGINT[]",
                  f"FROM (SELECT sum(violations) AS bad, max({checked}) AS n FROM {rules})")


cte("chk_range", _rules_check("range_rules", "validity", "range_violations", "critical", "checked_values"),
    "range_rules")
cte("chk_format", _rules_check("format_rules", "validity", "format_violations", "high"), "format_rules")
cte("chk_temporal", _rules_check("temporal_rules", "validity", "temporal_violations", "high"), "temporal_rules")
cte("chk_consistency", _rules_check("consistency_rules", "consistency", "field_consistency", "high"),
    "consistency_rules")
cte("outlier_rules", """
SELECT 'premium_amount' AS column_name, count(*) FILTER (WHERE premium_amount < q1 - 1.5 * (q3 - q1) OR premium_amount > q3 + 1.5 * (q3 - q1)) AS violations,
       count(*) AS checked_rows
FROM store JOIN (SELECT event_type, quantile_cont(premium_amount, 0.25) AS q1, quantile_cont(premium_amount, 0.75) AS q3 FROM store GROUP BY 1) USING (event_type)""",
    "store")
cte("complete_rules", """
SELECT 'all' AS column_name, count(*) FILTER (WHERE user_id IS NULL OR coalesce(session_id, '') = '' OR coalesce(city, '') = ''
       OR coalesce(device_type, '') = '') AS violations, count(*) AS checked_rows FROM store""", "store")
cte("chk_outliers", _rules_check("outlier_rules", "validity", "outliers_iqr", "medium"), "outlier_rules")
cte("chk_columns", _rules_check("complete_rules", "completeness", "completeness_by_column", "medium"), "complete_rules")
cte("check_log", """
SELECT * FROM chk_completeness UNION ALL SELECT * FROM chk_duplicates_run UNION ALL SELECT * FROM chk_orphans
UNION ALL SELECT * FROM chk_range UNION ALL SELECT * FROM chk_format UNION ALL SELECT * FROM chk_temporal
UNION ALL SELECT * FROM chk_consistency UNION ALL SELECT * FROM chk_outliers UNION ALL SELECT * FROM chk_columns""",
    "chk_outliers", "chk_columns", "chk_completeness", "chk_duplicates_run", "chk_orphans", "chk_range", "chk_format", "chk_temporal",
    "chk_consistency")

oracle("check_completeness", "SELECT * FROM chk_completeness", "chk_completeness", arrays=("affected_rows",))
oracle("check_duplicates", "SELECT * FROM chk_duplicates", "chk_duplicates", arrays=("affected_rows",))
oracle("range_violations", "SELECT * FROM range_rules", "range_rules")
oracle("format_violations", """
SELECT 'event_time' AS column_name, count(*) FILTER (WHERE event_id % 79 = 11) AS violations, count(*) AS checked_rows FROM spoiled
UNION ALL SELECT 'user_id', count(*) FILTER (WHERE reject_reason = 'bad_user_id'), count(*) FROM spoiled
UNION ALL SELECT 'premium_amount', count(*) FILTER (WHERE reject_reason = 'bad_premium_amount'), count(*) FROM spoiled
UNION ALL SELECT 'session_id', count(*) FILTER (WHERE event_id % 73 = 13), count(*) FROM spoiled""", "spoiled")
oracle("temporal_violations", "SELECT * FROM temporal_rules", "temporal_rules")
oracle("field_consistency", "SELECT * FROM consistency_rules", "consistency_rules")
oracle("quality_check_log", "SELECT * FROM check_log", "check_log", arrays=("affected_rows",))
oracle("quality_run", "SELECT * FROM check_log", "check_log", arrays=("affected_rows",))

# ---- sync lag and health --------------------------------------------------------------------
cte("sync_log", f"""
SELECT {AS_OF} AS metric_time, 'etl_pipeline' AS source_system, '{EV_TABLE}' AS target_table,
       datediff('second', max(event_time), {AS_OF}) AS lag_seconds, max(event_time) AS source_timestamp,
       {AS_OF} AS target_timestamp, count(*) FILTER (WHERE event_time < {AS_OF} - INTERVAL 1 HOUR) AS records_behind,
       CASE WHEN datediff('second', max(event_time), {AS_OF}) <= 300 THEN 'synced'
            WHEN datediff('second', max(event_time), {AS_OF}) <= 3600 THEN 'lagging' ELSE 'critical_lag' END AS status,
       CAST(300 AS BIGINT) AS alert_threshold
FROM store
UNION ALL
SELECT {AS_OF}, 'kafka_consumer', '{EV_TABLE}', datediff('second', max(processing_time), max(ingestion_time)),
       max(processing_time), max(ingestion_time),
       count(*) FILTER (WHERE processing_time < ingestion_time - INTERVAL 1 HOUR),
       CASE WHEN datediff('second', max(processing_time), max(ingestion_time)) <= 300 THEN 'synced'
            WHEN datediff('second', max(processing_time), max(ingestion_time)) <= 1800 THEN 'lagging' ELSE 'critical_lag' END,
       CAST(300 AS BIGINT)
FROM store
UNION ALL
SELECT {AS_OF}, 'mysql_cdc', 'users', datediff('second', max(CAST(signup_date AS TIMESTAMP)), {AS_OF}),
       max(CAST(signup_date AS TIMESTAMP)), {AS_OF},
       count(*) FILTER (WHERE CAST(signup_date AS TIMESTAMP) < {AS_OF} - INTERVAL 1 HOUR),
       CASE WHEN datediff('second', max(CAST(signup_date AS TIMESTAMP)), {AS_OF}) <= 60 THEN 'synced'
            WHEN datediff('second', max(CAST(signup_date AS TIMESTAMP)), {AS_OF}) <= 300 THEN 'lagging' ELSE 'critical_lag' END,
       CAST(60 AS BIGINT)
FROM users""", "store", "users")
cte("lag_health", """
SELECT l.metric_time AS check_time, l.source_system AS component, t.metric_name,
       CAST(l.lag_seconds AS DOUBLE) AS metric_value,
       CASE WHEN l.lag_seconds <= t.warn_s THEN 'healthy' WHEN l.lag_seconds <= t.crit_s THEN 'warning' ELSE 'critical' END AS status,
       CAST(t.warn_s AS DOUBLE) AS threshold_value,
       concat(l.source_system, ' lag: ', CAST(l.lag_seconds AS VARCHAR), ' seconds') AS details,
       CASE WHEN l.lag_seconds > t.crit_s THEN 2 WHEN l.lag_seconds > t.warn_s THEN 1 ELSE 0 END AS alert_level,
       l.lag_seconds, l.records_behind
FROM sync_log l JOIN (VALUES ('mysql_cdc', 'sync_delay', 60, 300), ('kafka_consumer', 'consumer_lag', 300, 1800),
                             ('etl_pipeline', 'etl_delay', 600, 1800)) t(source_system, metric_name, warn_s, crit_s)
  ON l.source_system = t.source_system""", "sync_log")
cte("hourly", """
SELECT g.hour, coalesce(c.events, 0) AS events
FROM (SELECT unnest(generate_series(date_trunc('hour', min(event_time)), date_trunc('hour', max(event_time)), INTERVAL 1 HOUR)) AS hour FROM store) g
LEFT JOIN (SELECT date_trunc('hour', event_time) AS hour, count(*) AS events FROM store GROUP BY 1) c ON g.hour = c.hour""",
    "store")
cte("volume", """
SELECT hour AS check_time, 'processed_events' AS component, 'hourly_volume' AS metric_name,
       CAST(events AS DOUBLE) AS metric_value,
       CASE WHEN events >= 50 THEN 'healthy' WHEN events >= 20 THEN 'warning' ELSE 'critical' END AS status,
       50.0 AS threshold_value, concat('Events in hour: ', CAST(events AS VARCHAR)) AS details,
       CASE WHEN events < 20 THEN 2 WHEN events < 50 THEN 1 ELSE 0 END AS alert_level
FROM hourly""", "hourly")
cte("crit_alerts", f"""
SELECT {AS_OF} AS check_time, table_name AS component, 'critical_alert' AS metric_name,
       CAST(count(*) AS DOUBLE) AS metric_value, 'critical' AS status, 0.0 AS threshold_value,
       concat('Critical alert count: ', CAST(count(*) AS VARCHAR)) AS details, 2 AS alert_level
FROM check_log WHERE severity = 'critical' AND status = 'fail' AND check_time >= {AS_OF} - INTERVAL 1 HOUR
GROUP BY table_name""", "check_log")
cte("health_log", """
SELECT * EXCLUDE (lag_seconds, records_behind) FROM lag_health
UNION ALL SELECT * FROM volume UNION ALL SELECT * FROM crit_alerts""", "lag_health", "volume", "crit_alerts")

oracle("check_freshness", "SELECT * FROM sync_log WHERE source_system = 'etl_pipeline'", "sync_log")
oracle("sync_lag_status", "SELECT * FROM lag_health", "lag_health")
oracle("volume_health", "SELECT * FROM volume", "volume")
oracle("critical_alerts", "SELECT * FROM crit_alerts", "crit_alerts")
oracle("health_dashboard", f"""
SELECT component,
       list_sort(list(concat_ws(':', metric_name, CAST(CAST(metric_value AS BIGINT) AS VARCHAR), status,
                                CAST(alert_level AS VARCHAR)))) AS metrics,
       max(alert_level) AS max_severity
FROM health_log WHERE check_time >= {AS_OF} - INTERVAL 1 HOUR GROUP BY component""",
       "health_log", arrays=("metrics",))
oracle("quality_issues", f"""
SELECT table_name, check_type, check_name, status, severity, deviation_percent, check_time, details
FROM check_log WHERE status <> 'pass' AND check_time >= {AS_OF} - INTERVAL 24 HOUR""", "check_log")
oracle("quality_issue_counts", f"""
SELECT table_name, check_type, count(*) AS issues FROM check_log
WHERE status <> 'pass' AND check_time >= {AS_OF} - INTERVAL 24 HOUR GROUP BY ALL""", "check_log")
oracle("sync_lag_report", f"""
SELECT source_system, target_table, lag_seconds, status, records_behind, metric_time FROM sync_log
WHERE lag_seconds > alert_threshold AND metric_time >= {AS_OF} - INTERVAL 6 HOUR""", "sync_log")
oracle("alert_counts", f"""
SELECT count(*) FILTER (WHERE alert_level = 2) AS critical_count, count(*) FILTER (WHERE alert_level = 1) AS warning_count,
       CASE WHEN count(*) FILTER (WHERE alert_level = 2) > 0 THEN 'critical'
            WHEN count(*) FILTER (WHERE alert_level = 1) > 0 THEN 'warning' ELSE 'healthy' END AS verdict
FROM health_log WHERE check_time >= {AS_OF} - INTERVAL 5 MINUTE""", "health_log")
oracle("top_alerts", f"""
SELECT component, metric_name, status, details, check_time, alert_level FROM health_log
WHERE alert_level > 0 AND check_time >= {AS_OF} - INTERVAL 30 MINUTE
ORDER BY alert_level DESC, check_time DESC, component, metric_name LIMIT 10""", "health_log")

# ---- gaps, drift, loads, lineage ----------------------------------------------------------------
cte("gap_log", f"""
SELECT {AS_OF} AS alert_time, 'gap_detection' AS alert_type, '{EV_TABLE}' AS table_name,
       event_time AS time_gap_start, nxt AS time_gap_end, datediff('second', event_time, nxt) AS missing_duration_seconds,
       scope AS expected_event_type, CAST(floor(datediff('second', event_time, nxt) / 60) AS BIGINT) AS estimated_missing_count,
       'active' AS status
FROM (SELECT scope, event_time, lead(event_time) OVER (PARTITION BY scope ORDER BY event_time, event_id) AS nxt
      FROM (SELECT 'any' AS scope, * FROM store UNION ALL SELECT event_type, * FROM store)
      WHERE event_time >= {AS_OF} - INTERVAL 30 DAY)
WHERE datediff('second', event_time, nxt) > 3600""", "store")
oracle("missing_event_gaps", "SELECT * FROM gap_log", "gap_log")
oracle("gap_severity", """
SELECT *, CASE WHEN missing_duration_seconds > 86400 THEN 'critical' WHEN missing_duration_seconds > 14400 THEN 'major'
               WHEN missing_duration_seconds > 3600 THEN 'minor' ELSE 'none' END AS gap_severity FROM gap_log""",
       "gap_log")
oracle("active_gaps", f"""
SELECT alert_type, table_name, time_gap_start, time_gap_end, missing_duration_seconds, estimated_missing_count, status
FROM gap_log WHERE status = 'active' AND alert_time >= {AS_OF} - INTERVAL 24 HOUR""", "gap_log")
cte("drift", " UNION ALL ".join(
    f"SELECT '{EV_TABLE}' AS table_name, '{c}' AS column_name, 'column_removed' AS change_type, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS rows_affected, "
    f"'{'high' if c in ('event_id', 'user_id', 'event_time') else 'low'}' AS impact_level, "
    f"'automated_check' AS detected_by FROM processed" for c in _PROCESSED), "processed")
oracle("payload_drift", "SELECT * FROM drift WHERE rows_affected > 0", "drift")
oracle("drift_summary", f"""
SELECT table_name, count(*) AS changes_count, list_sort(list(DISTINCT change_type)) AS change_types,
       arg_max(impact_level, CASE impact_level WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3
                                               WHEN 'critical' THEN 4 ELSE 0 END) AS max_impact,
       {AS_OF} AS latest_change
FROM drift WHERE rows_affected > 0 GROUP BY table_name""", "drift", arrays=("change_types",))
_STORED = {"event_id": "bigint", "event_time": "timestamp_ntz", "user_id": "bigint", "session_id": "string", "event_type": "string",
           "channel": "string", "premium_amount": "bigint", "signup_date": "date", "city": "string", "device_type": "string",
           "user_tenure_days": "int", "event_date": "date", "event_hour": "int", "event_day_of_week": "int", "is_purchase": "int",
           "processing_time": "timestamp_ntz", "data_source": "string", "ingestion_time": "timestamp_ntz"}
_plain = {c: (t, f"{c} IS NULL") for c, t in _STORED.items()}
_device = {"device": ("struct", "FALSE"), "device.type": ("string", "device_type IS NULL")}
_tags = {"tags": ("array", "FALSE"), "tags[]": ("struct", None), "tags[].name": ("string", None)}
_DELIVERED = {      # version -> column -> (type, its null test; None where only the schema tells)
    1: _plain,
    2: _plain | _device | {"device.city": ("string", "city IS NULL")},
    3: _plain | _device | {"premium_amount": ("double", "premium_amount IS NULL"),
                           "session_id": ("string", "session_id IS NULL OR is_purchase <> 0")},
    4: {c: v for c, v in _plain.items() if c != "city"} | _device | _tags | {"user_id": ("string", "user_id IS NULL")}}
cte("delivered", " UNION ALL ".join(
    f"SELECT {v} AS version, '{c}' AS column_name, '{t}' AS type, count(*) AS n, "
    + (f"count(*) FILTER (WHERE {null}) AS nulls, count(*) FILTER (WHERE {null}) > 0 AS optional" if null
       else "CAST(NULL AS BIGINT) AS nulls, TRUE AS optional")
    + f" FROM store WHERE event_hour // 6 = {v - 1}" for v, cols in _DELIVERED.items() for c, (t, null) in cols.items()), "store")
cte("compared", """
SELECT coalesce(n.version, o.version + 1) AS version, coalesce(n.column_name, o.column_name) AS column_name,
       o.type AS old_type, n.type AS new_type, o.optional AS was, n.optional AS now, n.nulls AS nulls,
       (SELECT any_value(d.n) FROM delivered d WHERE d.version = coalesce(n.version, o.version + 1)) AS total
FROM delivered n FULL JOIN delivered o ON n.version = o.version + 1 AND n.column_name = o.column_name
WHERE coalesce(n.version, o.version + 1) BETWEEN 2 AND 4""", "delivered")
oracle("schema_drift_versions", f"""
SELECT '{EV_TABLE}' AS table_name, CAST(version AS INTEGER) AS version, {AS_OF} + to_hours(version - 1) AS change_time,
       column_name, change_type, old_type, new_type, rows_affected,
       CASE WHEN column_name IN ('event_id', 'user_id', 'event_time') THEN 'critical' ELSE level END AS impact_level
FROM (SELECT *, 'column_added' AS change_type, total - coalesce(nulls, 0) AS rows_affected, 'low' AS level
      FROM compared WHERE old_type IS NULL
      UNION ALL SELECT *, 'column_removed', total, CASE WHEN was THEN 'medium' ELSE 'high' END FROM compared WHERE new_type IS NULL
      UNION ALL SELECT *, 'type_change', total, 'high' FROM compared WHERE old_type <> new_type
      UNION ALL SELECT *, 'nullability_change', nulls, 'medium' FROM compared WHERE was <> now)""", "compared")
cte("load_log", f"""
SELECT date_trunc('hour', event_time) AS load_time, '{EV_TABLE}' AS table_name, 'kafka_consumer' AS source_system,
       strftime(date_trunc('hour', event_time), '%-H_%Y-%m-%d') AS batch_id, count(*) AS records_processed,
       CAST(0 AS BIGINT) AS records_failed, 3600.0 AS processing_time_seconds,
       round(count(*) / 3600.0, 2) AS throughput_records_per_second, 0.0 AS error_rate_percent, 'success' AS status
FROM raw_events GROUP BY 1""", "raw_events")
oracle("load_performance", f"""
SELECT load_time, '{EV_TABLE}' AS table_name, 'kafka_consumer' AS source_system, strftime(load_time, '%-H_%Y-%m-%d') AS batch_id,
       good AS records_processed, bad AS records_failed, 3600.0 AS processing_time_seconds,
       round(good / 3600.0, 2) AS throughput_records_per_second, round(100.0 * bad / (good + bad), 2) AS error_rate_percent,
       CASE WHEN bad = 0 THEN 'success' WHEN good = 0 THEN 'complete_failure' ELSE 'partial_failure' END AS status
FROM (SELECT date_trunc('hour', event_time) AS load_time, count(*) FILTER (WHERE reject_reason IS NULL) AS good, count(reject_reason) AS bad
      FROM spoiled GROUP BY 1)""", "spoiled")
oracle("load_trends", f"""
SELECT table_name, date_trunc('hour', load_time) AS hour, CAST(sum(records_processed) AS BIGINT) AS total_records,
       round(avg(throughput_records_per_second), 4) AS avg_throughput, max(error_rate_percent) AS max_error_rate,
       count(*) AS batch_count
FROM load_log WHERE load_time >= {AS_OF} - INTERVAL 30 DAY GROUP BY ALL""", "load_log")


def _lineage(src_table, src_q, step, tgt_table, tgt_q, kind) -> str:
    return (f"SELECT {AS_OF} AS lineage_time, '{src_table}' AS source_table, s AS source_records, "
            f"'{step}' AS transformation_step, '{tgt_table}' AS target_table, t AS target_records, "
            f"s - t AS record_loss_count, coalesce(round(100.0 * (s - t) / s, 2), 0.0) AS record_loss_percent, "
            f"'{kind}' AS transformation_type, CASE WHEN s > 0 THEN 'success' ELSE 'critical' END AS status, "
            f"concat('Source: ', CAST(s AS VARCHAR), ', Target: ', CAST(t AS VARCHAR)) AS details "
            f"FROM (SELECT ({src_q}) AS s, ({tgt_q}) AS t)")


cte("lineage_log", " UNION ALL ".join([
    _lineage("raw_events", "SELECT count(*) FROM raw_events", "validity_filter", "clean_events",
             "SELECT count(*) FROM clean_events", "filter"),
    _lineage("clean_events", "SELECT count(*) FROM clean_events", "user_enrichment", "processed_events",
             "SELECT count(*) FROM processed", "enrichment"),
    _lineage(EV_TABLE, "SELECT count(*) FROM store", "daily_aggregation", "daily_aggregate_metrics",
             "SELECT count(*) FROM daily_agg", "aggregation"),
    _lineage("purchase_events", "SELECT count(*) FROM purchases", "order_denormalization",
             "purchase_events_denormalized", "SELECT count(*) FROM denorm", "join"),
]), "raw_events", "clean_events", "processed", "store", "daily_agg", "purchases", "denorm")
oracle("record_lineage", "SELECT * FROM lineage_log", "lineage_log")
oracle("lineage_report", f"""
SELECT source_table, transformation_step, target_table, CAST(sum(source_records) AS BIGINT) AS total_source_records,
       CAST(sum(target_records) AS BIGINT) AS total_target_records, round(avg(record_loss_percent), 4) AS avg_loss_percent,
       count(*) AS transformation_count
FROM lineage_log WHERE lineage_time >= {AS_OF} - INTERVAL 24 HOUR GROUP BY ALL""", "lineage_log")

# ---- remaining checks ------------------------------------------------------------------------------
oracle("outliers_iqr", """
SELECT s.event_id, s.event_type, s.premium_amount, q.q1, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lower_bound,
       q.q3 + 1.5 * (q.q3 - q.q1) AS upper_bound
FROM store s JOIN (SELECT event_type, quantile_cont(premium_amount, 0.25) AS q1, quantile_cont(premium_amount, 0.75) AS q3
                   FROM store GROUP BY event_type) q ON s.event_type = q.event_type
WHERE s.premium_amount < q.q1 - 1.5 * (q.q3 - q.q1) OR s.premium_amount > q.q3 + 1.5 * (q.q3 - q.q1)""", "store")
oracle("completeness_by_column", f"""
SELECT '{EV_TABLE}' AS table_name, 'user_id,session_id,city,device_type' AS column_list, count(*) AS total_records,
       CAST(sum(f) AS BIGINT) AS complete_records, round(avg(f) * 100.0, 2) AS completeness_percent
FROM (SELECT CASE WHEN coalesce(CAST(user_id AS VARCHAR), '') <> '' AND coalesce(session_id, '') <> ''
                       AND coalesce(city, '') <> '' AND coalesce(device_type, '') <> '' THEN 1 ELSE 0 END AS f FROM store)""",
       "store")
oracle("volume_anomalies", """
SELECT hour, events, round(a, 4) AS trailing_avg, round(events / a, 4) AS ratio,
       CASE WHEN round(events / a, 4) < 0.5 THEN 1 ELSE 0 END AS is_drop
FROM (SELECT hour, events, avg(events) OVER (ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS a FROM hourly)""",
       "hourly")
oracle("arrival_frequency", """
SELECT date_trunc('hour', event_time) AS hour, count(*) AS events,
       round(avg(gap), 4) AS avg_gap_seconds,
       round(avg(datediff('second', event_time, processing_time)), 4) AS avg_processing_delay_seconds
FROM (SELECT *, datediff('second', event_time, lead(event_time) OVER (ORDER BY event_time, event_id)) AS gap FROM store)
GROUP BY 1""", "store")
oracle("record_count_check", """
SELECT e AS expected_rows, a AS actual_rows, d AS distinct_source_ids,
       coalesce(round(100.0 * (a - e) / e, 2), 0.0) AS deviation_percent
FROM (SELECT (SELECT count(*) FROM purchases) AS e, (SELECT count(*) FROM denorm) AS a,
             (SELECT count(DISTINCT event_id) FROM denorm) AS d)""", "purchases", "denorm")
cte("breaks", """
SELECT p.event_id, p.event_time, p.session_id, p.user_id FROM store p
WHERE p.event_type = 'purchase' AND NOT EXISTS (
  SELECT 1 FROM store v WHERE v.session_id = p.session_id AND v.event_type IN ('view', 'signup')
    AND (v.event_time < p.event_time OR (v.event_time = p.event_time AND v.event_id < p.event_id)))""", "store")
oracle("sequence_breaks", "SELECT * FROM breaks", "breaks")
oracle("affected_rows_sample", """
SELECT 'sequence_breaks' AS check_name, (SELECT count(*) FROM breaks) AS error_count,
       coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT event_id FROM breaks ORDER BY event_id LIMIT 10)), []) AS affected_rows
UNION ALL
SELECT 'orphan_user_events', (SELECT count(*) FROM orph),
       coalesce((SELECT list(event_id ORDER BY event_id) FROM (SELECT event_id FROM orph ORDER BY event_id LIMIT 10)), [])""",
       "breaks", "orph", arrays=("affected_rows",))

# ---- streams: equal to their batch forms -----------------------------------------------
oracle("stream_ingest", "SELECT * FROM store", "store", dates=STORE_DATES)
oracle("stream_dedup", "SELECT * REPLACE (ingestion_time + INTERVAL 1 MINUTE AS ingestion_time) FROM store", "store",
       dates=STORE_DATES)
oracle("stream_enrich", "SELECT * FROM processed", "processed", dates=PROCESSED_DATES)
oracle("stream_daily_metrics", "SELECT * FROM daily_ev", "daily_ev", dates=("metric_date",))
oracle("stream_session_metrics", "SELECT * FROM sessions", "sessions", arrays=("event_sequence",))
oracle("stream_purchase_orders", """
SELECT e.event_id, e.user_id, e.event_date, e.premium_amount, o.order_id, o.insurance_type,
       o.policy_number, o.premium_amount AS order_premium_amount
FROM purchases e LEFT JOIN unified o ON e.user_id = o.user_id AND e.event_date = o.order_date""",
       "purchases", "unified", dates=("event_date",))
oracle("stream_purchase_payments", """
SELECT e.event_id, e.user_id, e.event_date, e.premium_amount, o.order_id, o.insurance_type,
       o.policy_number, o.premium_amount AS order_premium_amount,
       f.transaction_id, f.payment_method, f.payment_status, f.total_amount, f.payment_date
FROM purchases e LEFT JOIN unified o ON e.user_id = o.user_id AND e.event_date = o.order_date
LEFT JOIN payments f ON o.order_id = f.order_id""",
       "purchases", "unified", "payments", dates=("event_date",))
ORACLE["stream_upsert_users"] = ORACLE["upsert_users"]
oracle("stream_freshness", """
SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
       count(*) AS events, max(event_time) AS last_event_time,
       datediff('second', max(event_time), date_trunc('hour', event_time) + INTERVAL 1 HOUR) AS staleness_seconds
FROM store GROUP BY 1""", "store")
oracle("order_denormalization", "SELECT * FROM denorm", "denorm", dates=DENORM_DATES)
oracle("session_event_sequence", """
SELECT session_id, event_time, event_id, event_type,
       row_number() OVER (PARTITION BY session_id ORDER BY event_time, event_id) AS seq_no
FROM store""", "store")
oracle("stream_poll_users", "SELECT user_id, city FROM users", "users")

# the same checks, called by SQL text through functions of the session
for _name in ("outliers_iqr", "completeness_by_column", "check_freshness"):
    ORACLE[f"sql_{_name}"] = ORACLE[_name]
