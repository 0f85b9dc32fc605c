"""Stand-in inputs projected from the given tables.

The original job reads a raw-events topic, a users dimension, four product
order tables and a payments table.  Here each is a lazy projection of the
driver's parquet tables, so work grows with them and Catalyst prunes the scan.
The same projections are written in DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must match the oracle projections exactly).
CHANNELS = ["Google Ads", "SEO", "Email", "Referral", "Direct"]
INSURANCE_TYPES = ["third_party", "body_injury", "medical", "fire"]
VEHICLE_TYPES = ["sedan", "suv", "truck"]
COVERAGE_TYPES = ["basic", "standard", "premium"]
COVERAGE_PLANS = ["bronze", "silver", "gold"]
PROPERTY_TYPES = ["apartment", "house", "commercial"]
CONSTRUCTION_TYPES = ["concrete", "steel", "wood"]
LOCATION_CITIES = ["Harbor", "Hill", "Lake", "Plain"]
PAYMENT_METHODS = ["credit_card", "bank_transfer", "wallet"]
SIGNUP_BASE = "2023-01-01"
ORDER_BASE = "2024-01-01"


def _pick(values: list[str], index: Column) -> Column:
    """1-based pick from a fixed list (``index`` is 0-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def raw_events(events: DataFrame) -> DataFrame:
    """Raw event records: event time at 1 s, session = user + day, channel from props."""
    ts = F.col("ts")
    return events.select(
        F.col("event_id"),
        F.date_trunc("second", ts).cast("timestamp_ntz").alias("event_time"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.concat(F.lit("s_"), F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.col("event_type"),
        _pick(CHANNELS, F.get_json_object("props", "$.k").cast("int") % 5).alias("channel"),
        F.when(F.col("event_type") == "error", F.lit(0).cast("bigint"))
         .otherwise(F.round(F.col("value") * 100).cast("bigint")).alias("premium_amount"),
    )


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """User dimension: one row per customer, except every tenth (so joins miss)."""
    # nation is a fixed 25-row reference table: a proven broadcast bound.
    n = F.broadcast(nation.select("n_nationkey", "n_name"))
    c = customer.filter(F.col("c_custkey") % 10 != 7)
    seg = F.col("c_mktsegment")
    device = (F.when(seg.isin("MACHINERY", "BUILDING"), "Desktop")
              .when(seg == "AUTOMOBILE", " Mobile ")
              .when(seg == "FURNITURE", "Mobile")
              .otherwise("Tablet"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        F.col("n_name").alias("city"),
        device.alias("device_type"),
    )


def users_versioned(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Users with the dimension's bookkeeping columns (version 1)."""
    u = users(customer, nation)
    created = F.col("signup_date").cast("timestamp_ntz")
    return u.select("*", created.alias("created_at"), created.alias("updated_at"),
                    F.lit(1).cast("int").alias("version"))


def product_orders(orders: DataFrame) -> DataFrame:
    """Common columns of all four product tables, with the product assigned by key."""
    k = F.col("o_orderkey")
    order_date = F.date_add(F.lit(ORDER_BASE).cast("date"), (k % 30).cast("int"))
    status = (F.when(F.col("o_orderstatus") == "F", "active")
              .when(F.col("o_orderstatus") == "O", "pending").otherwise("cancelled"))
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.concat(F.lit("P"), k.cast("string")).alias("policy_number"),
        _pick(INSURANCE_TYPES, k % 4).alias("insurance_type"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("coverage_amount"),
        F.round(F.col("o_totalprice") / 100).cast("bigint").alias("premium_amount"),
        order_date.alias("order_date"),
        order_date.alias("policy_start_date"),
        F.date_add(order_date, (180 + k % 185).cast("int")).alias("policy_end_date"),
        status.alias("status"),
        order_date.cast("timestamp_ntz").alias("created_at"),
        k, F.col("o_totalprice"),
    )


def _product(orders: DataFrame, kind: str, base: DataFrame | None = None) -> DataFrame:
    base = base if base is not None else product_orders(orders)
    return base.filter(F.col("insurance_type") == kind)


COMMON_TAIL = ["order_date", "policy_start_date", "policy_end_date", "status", "created_at"]


def third_party_orders(orders: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Vehicle policies; every order is stored twice (versions 1 and 2)."""
    k = F.col("o_orderkey")
    p = _product(orders, "third_party", base).withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    return p.select(
        "order_id", "user_id", "policy_number",
        _pick(VEHICLE_TYPES, k % 3).alias("vehicle_type"),
        (k % 20).cast("int").alias("vehicle_age"),
        (18 + k % 60).cast("int").alias("driver_age"),
        "coverage_amount",
        (F.col("premium_amount") + (F.col("v") - 1) * 10).alias("premium_amount"),
        *COMMON_TAIL,
        (F.col("created_at") + F.make_interval(hours=F.col("v"))).alias("updated_at"),
        F.col("v").cast("int").alias("version"),
    )


def body_injury_orders(orders: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Liability policies: limits and deductible, no coverage_amount column."""
    k = F.col("o_orderkey")
    return _product(orders, "body_injury", base).select(
        "order_id", "user_id", "policy_number",
        _pick(COVERAGE_TYPES, k % 3).alias("coverage_type"),
        F.round(F.col("o_totalprice") * 2).cast("bigint").alias("medical_limit"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("property_limit"),
        "premium_amount",
        (k % 500).cast("int").alias("deductible"),
        *COMMON_TAIL,
        F.col("created_at").alias("updated_at"),
        F.lit(1).cast("int").alias("version"),
    )


def medical_orders(orders: DataFrame, base: DataFrame | None = None) -> DataFrame:
    k = F.col("o_orderkey")
    return _product(orders, "medical", base).select(
        "order_id", "user_id", "policy_number",
        _pick(COVERAGE_PLANS, k % 3).alias("coverage_plan"),
        (k % 2).cast("int").alias("individual"),
        (1 - k % 2).cast("int").alias("family"),
        "coverage_amount", "premium_amount",
        (k % 500).cast("int").alias("deductible"),
        (k % 30).cast("int").alias("co_payment"),
        *COMMON_TAIL,
        F.col("created_at").alias("updated_at"),
        F.lit(1).cast("int").alias("version"),
    )


def fire_orders(orders: DataFrame, base: DataFrame | None = None) -> DataFrame:
    k = F.col("o_orderkey")
    return _product(orders, "fire", base).select(
        "order_id", "user_id", "policy_number",
        _pick(PROPERTY_TYPES, k % 3).alias("property_type"),
        (F.col("coverage_amount") * 3).alias("property_value"),
        "coverage_amount", "premium_amount",
        (k % 500).cast("int").alias("deductible"),
        _pick(LOCATION_CITIES, k % 4).alias("location_city"),
        _pick(CONSTRUCTION_TYPES, k % 3).alias("construction_type"),
        *COMMON_TAIL,
        F.col("created_at").alias("updated_at"),
        F.lit(1).cast("int").alias("version"),
    )


def financial_orders(lineitem: DataFrame) -> DataFrame:
    """Payments: one per order, amounts summed from its line items (partial aggregation).

    The order's flag is the greatest line flag.  Flags are single characters,
    so the maximum of their code points orders exactly like the strings and
    keeps every buffer fixed-width: a hash aggregate instead of a sort-based
    one over the largest table.
    """
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_suppkey").alias("transaction_id"),
        F.sum(F.round(F.col("l_extendedprice"))).cast("bigint").alias("total_amount"),
        F.sum(F.round(F.col("l_extendedprice") * F.col("l_tax"))).cast("bigint").alias("tax_amount"),
        F.sum(F.round(F.col("l_extendedprice") * F.col("l_discount"))).cast("bigint").alias("discount_amount"),
        F.max(F.ascii("l_returnflag")).alias("returnflag_code"),
    ).withColumn("returnflag", F.chr("returnflag_code"))
    pay_date = (F.lit(ORDER_BASE).cast("timestamp_ntz")
                + F.make_interval(days=(F.col("order_id") % 30).cast("int"), hours=F.lit(12)))
    status = (F.when(F.col("returnflag") == "R", "failed")
              .when(F.col("returnflag") == "A", "pending").otherwise("completed"))
    return per_order.select(
        "order_id", "transaction_id",
        _pick(PAYMENT_METHODS, F.col("transaction_id") % 3).alias("payment_method"),
        status.alias("payment_status"),
        F.lit("USD").alias("currency"),
        "total_amount", "tax_amount", "discount_amount",
        F.floor(F.col("total_amount") / 20).cast("bigint").alias("commission_amount"),
        pay_date.alias("payment_date"),
        (pay_date + F.make_interval(days=F.lit(2))).alias("settlement_date"),
        F.lit(1).cast("int").alias("version"),
    )


def spoiled_events(raw: DataFrame) -> DataFrame:
    """CSV lines of the raw events, some of them bad: chosen by event_id, so that an oracle can count them.

    Of every 97 one is cut after three fields; of every 89 one has a user id
    that is no number, of 83 a premium that is none, of 79 a time that is none,
    of 73 a malformed session.
    """
    k = F.col("event_id")
    time = F.when(k % 79 == 11, "soon").otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    user = F.concat(F.when(k % 89 == 5, "u").otherwise(""), F.col("user_id").cast("string"))
    session = F.concat(F.when(k % 73 == 13, "x").otherwise(""), F.col("session_id"))
    premium = (F.when(k % 83 == 7, "n/a").when(F.col("premium_amount") == 0, "").otherwise(F.col("premium_amount").cast("string")))
    head = F.concat_ws(",", time, user, session)
    return raw.select(F.when(k % 97 == 3, head).otherwise(F.concat_ws(",", head, "event_type", "channel", premium)).alias("value"))


def spoiled_users(users: DataFrame) -> DataFrame:
    """CSV lines of the users: of every 50 ids one is no number, one is blank, and one is above 2**31 (and good)."""
    k = F.col("user_id")
    user = (F.when(k % 50 == 1, F.concat(F.lit("u"), k)).when(k % 50 == 2, "").when(k % 50 == 3, (k + 3_000_000_000).cast("string"))
            .otherwise(k.cast("string")))
    return users.select(F.concat_ws(",", user, F.date_format("signup_date", "yyyy-MM-dd"), "city", "device_type").alias("value"))
