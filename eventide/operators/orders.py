"""Order unification, purchase denormalisation and the order roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import as_of_ts, safe_ratio
from eventide.operators.maintain import latest_by, latest_version
from eventide.operators.split_join import HOT_ROWS, split_join

# Column lists of the order tables.
UNIFIED_COLUMNS = [
    "order_id", "user_id", "policy_number", "insurance_type", "product_type",
    "coverage_type", "coverage_plan", "property_type", "coverage_amount",
    "premium_amount", "vehicle_age", "driver_age", "medical_limit",
    "property_limit", "individual", "family", "deductible", "co_payment",
    "property_value", "location_city", "construction_type", "order_date",
    "policy_start_date", "policy_end_date", "status", "created_at", "updated_at",
]

ORDER_KEYS = ["order_id", "user_id"]


def unified_orders(third_party: DataFrame, body_injury: DataFrame,
                   medical: DataFrame, fire: DataFrame, dedup: bool = True,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The four product tables as one 27-column table with insurance_type.

    Absent columns become typed NULLs through
    ``unionByName(allowMissingColumns=True)``; columns keep their real widths.
    Each table keeps only its latest version per (order_id, user_id) (U1):
    since the product type is part of the key, the four tables are unioned
    first and reduced in one aggregation (one shuffle instead of four).
    With ``columns``, only those (and the key) are kept: the whole-row
    maximum of the dedup cannot be pruned by Catalyst afterwards.
    """
    def tag(df: DataFrame, kind: str) -> DataFrame:
        return df.withColumn("insurance_type", F.lit(kind))

    parts = [tag(third_party.withColumnRenamed("vehicle_type", "product_type"), "third_party"),
             tag(body_injury, "body_injury"), tag(medical, "medical"), tag(fire, "fire")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    keep = UNIFIED_COLUMNS if columns is None else [
        c for c in UNIFIED_COLUMNS if c in set(columns) | {"insurance_type", *ORDER_KEYS}]
    out = out.select(*dict.fromkeys([*keep, "updated_at", "version"]))
    if dedup:
        out = latest_version(out, ["insurance_type", *ORDER_KEYS])
    return out.select(*keep)


EVENT_SIDE = ["event_id", "event_time", "user_id", "session_id", "channel", "premium_amount",
              "signup_date", "city", "device_type", "user_tenure_days", "event_date",
              "event_hour", "event_day_of_week", "processing_time", "data_source"]

ORDER_SIDE = [("policy_number", "policy_number"), ("insurance_type", "insurance_type"),
              ("product_type", "product_type"), ("coverage_type", "coverage_type"),
              ("coverage_plan", "coverage_plan"), ("property_type", "property_type"),
              ("coverage_amount", "order_coverage_amount"), ("premium_amount", "order_premium_amount"),
              ("vehicle_age", "vehicle_age"), ("driver_age", "driver_age"),
              ("medical_limit", "medical_limit"), ("property_limit", "property_limit"),
              ("individual", "individual"), ("family", "family"), ("deductible", "deductible"),
              ("co_payment", "co_payment"), ("property_value", "property_value"),
              ("location_city", "location_city"), ("construction_type", "construction_type"),
              ("order_date", "order_date"), ("policy_start_date", "policy_start_date"),
              ("policy_end_date", "policy_end_date"), ("status", "order_status")]

PAYMENT_SIDE = ["transaction_id", "payment_method", "payment_status", "currency", "total_amount",
                "tax_amount", "discount_amount", "commission_amount", "payment_date", "settlement_date"]


USER_DAY = [("user_id", "user_id"), ("event_date", "order_date")]


def purchase_order_join(purchases: DataFrame, orders: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Purchases left-joined to orders of the same user on the event's day.

    Purchases are filtered before the join; the join is an equi-join on
    (user_id, day), shuffled on both keys (or broadcast by AQE when small).
    A user with several orders that day yields several rows (fan-out); the
    purchases of a hot (user, day) are dealt over many tasks.
    """
    return split_join(purchases, orders, USER_DAY, "left", "event_id", hot_rows)


def purchase_denormalized(purchases: DataFrame, orders: DataFrame, payments: DataFrame,
                          as_of: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """J2 then payments by order_id; the 50-column denormalised purchase row.

    A miss keeps NULL order fields; ``order_id`` falls back to the event id.
    """
    j = purchase_order_join(purchases, orders, hot_rows)
    f = payments.alias("f")
    j = j.join(f, F.col("o.order_id") == F.col("f.order_id"), "left")
    cols = [F.col(f"e.{c}").alias(c) for c in EVENT_SIDE]
    cols.append(F.coalesce(F.col("o.order_id"), F.col("e.event_id")).alias("order_id"))
    cols += [F.col(f"o.{src}").alias(dst) for src, dst in ORDER_SIDE if src in orders.columns]
    cols += [F.col(f"f.{c}").alias(c) for c in PAYMENT_SIDE]
    cols.append(as_of_ts(as_of).alias("ingestion_time"))
    return j.select(*cols)


DENORM_KEY = ["event_date", "event_id", "user_id", "insurance_type"]
DENORM_ORDER = ["order_id", "transaction_id"]

# Columns each roll-up reads from the denormalised table.  Built from the raw
# tables, the table is projected to these before the joins and the dedup.
READS = {
    "type_date_lookup": ["event_id", "user_id", "premium_amount", "insurance_type", "policy_number",
                         "payment_method", "payment_status", "event_date"],
    "insurance_type_summary": ["insurance_type", "event_date", "premium_amount", "total_amount"],
    "user_daily_summary": ["user_id", "event_date", "premium_amount", "insurance_type"],
    "insurance_type_last_days": ["insurance_type", "event_date", "premium_amount", "total_amount"],
    "user_product_mix": ["user_id", "session_id", "premium_amount", "insurance_type", "event_date"],
    "channel_product_performance": ["channel", "insurance_type", "premium_amount", "commission_amount",
                                    "policy_end_date", "policy_start_date", "payment_status", "event_date"],
    "insurance_type_last_week": ["insurance_type", "premium_amount", "event_date"],
    "denormalized_overview": ["user_id", "insurance_type", "premium_amount"],
}


def order_columns_for(denorm_columns: Sequence[str]) -> list[str]:
    """Unified-order columns that feed the given denormalised columns (plus join keys)."""
    src = {dst: s for s, dst in ORDER_SIDE}
    need = {"order_id", "user_id", "order_date", "insurance_type"}
    need |= {src[c] for c in denorm_columns if c in src}
    return [c for c in UNIFIED_COLUMNS if c in need]


def orders_met(orders: DataFrame, purchases: DataFrame) -> DataFrame:
    """Orders of a (user, day) that has purchases; no other meets one (J2), so the others need not be reduced and joined."""
    days = purchases.select("user_id", F.col("event_date").alias("order_date")).distinct()
    return orders.join(days, ["user_id", "order_date"], "left_semi").select(*orders.columns)


def latest_order_per_type_day(orders: DataFrame) -> DataFrame:
    """Per (user, day, type) only the order U3 keeps: the greatest order_id.

    U3 keeps, per purchase and type, the row with the greatest (order_id,
    transaction_id); payments are one row per order, so that row belongs to
    the greatest order_id among the user's orders of that type on that day.
    Reducing the orders first (partial aggregation) lets a purchase meet at
    most one order per type: a (user, day) with many purchases and many
    orders is never expanded into all its purchase x order pairs.
    """
    return latest_by(orders, ["user_id", "order_date", "insurance_type"], ["order_id"])


def denormalize(purchases: DataFrame, orders: DataFrame, payments: DataFrame, as_of: str,
                columns: Sequence[str] | None = None) -> DataFrame:
    """J3 + U3 without the fan-out: the deduplicated denormalised purchases.

    Equal to ``dedup_denormalized(purchase_denormalized(...))``; with
    ``columns`` only those (plus the dedup key and order) are carried.
    """
    j = purchase_denormalized(purchases, latest_order_per_type_day(orders), payments, as_of, hot_rows=None)
    if columns is not None:
        j = j.select(*dict.fromkeys([*DENORM_KEY, *DENORM_ORDER, *columns]))
    return dedup_denormalized(j)


def dedup_denormalized(denorm: DataFrame) -> DataFrame:
    """One row per (event_date, event_id, user_id, insurance_type).

    The original keeps an arbitrary last insert; here the greatest
    (order_id, transaction_id) wins, deterministically.
    """
    return latest_by(denorm, DENORM_KEY, DENORM_ORDER)


def purchase_denormalized_by_order_id(purchases: DataFrame, orders: DataFrame,
                                      payments: DataFrame) -> DataFrame:
    """Variant keyed by event_id = order_id, with commission_rate."""
    e, o, f = purchases.alias("e"), orders.alias("o"), payments.alias("f")
    j = (e.join(o, (F.col("e.user_id") == F.col("o.user_id")) & (F.col("e.event_id") == F.col("o.order_id")), "left")
          .join(f, F.col("o.order_id") == F.col("f.order_id"), "left"))
    return j.select(
        "e.event_id", "e.user_id", "e.session_id", "e.channel", "e.premium_amount",
        "o.insurance_type", "o.policy_number", "o.coverage_amount",
        "f.payment_method", "f.payment_status", "f.total_amount",
        F.round(safe_ratio(F.col("e.premium_amount"), F.col("f.total_amount")), 6).alias("commission_rate"))


def product_inner_join(events: DataFrame, product: DataFrame, payments: DataFrame,
                       since: str, insurance_type: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The normalised query the denormalised table replaces.

    Inner joins of purchases with one product table and payments.  The
    product join uses the same (user, day) condition as J3 rather than
    user alone, which would pair every purchase with every order of a user.
    """
    e = events.filter((F.col("event_type") == "purchase")
                      & (F.col("event_date") >= F.lit(since).cast("date")))
    # only what the query reads goes into the whole-row maximum of the dedup
    needed = product.select("order_id", "user_id", "order_date", "policy_number", "version", "updated_at")
    o = latest_version(needed, ["order_id", "user_id"]).withColumn(
        "insurance_type", F.lit(insurance_type))
    f = payments.alias("f")
    j = (split_join(e, o, USER_DAY, "inner", "event_id", hot_rows)
         .join(f, F.col("o.order_id") == F.col("f.order_id"), "inner"))
    return j.select("e.event_id", "e.user_id", "e.premium_amount", "o.insurance_type",
                    "o.policy_number", "f.payment_method", "f.payment_status")


def type_date_lookup(denorm: DataFrame, since: str, insurance_type: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The single-table form of J5 (date and type filters prune partitions)."""
    return (denorm.filter((F.col("event_date") >= F.lit(since).cast("date"))
                          & (F.col("insurance_type") == insurance_type))
            .select("event_id", "user_id", "premium_amount", "insurance_type",
                    "policy_number", "payment_method", "payment_status"))


# ---- roll-ups over the denormalised table ---------------------------------
def _since(as_of: str, days: int):
    return F.col("event_date") >= F.date_sub(as_of_ts(as_of).cast("date"), days)


def _window(df: DataFrame, as_of: str, days: int) -> DataFrame:
    """Look-back filter; on a month-partitioned table also prune whole months,
    because Catalyst cannot derive month bounds from an event_date predicate."""
    if "month" in df.columns:
        start = F.date_format(F.date_sub(as_of_ts(as_of).cast("date"), days), "yyyyMM")
        df = df.filter(F.col("month") >= start)
    return df.filter(_since(as_of, days))


def insurance_type_summary(denorm: DataFrame) -> DataFrame:
    """A5: (type, date) -> purchases, premium, revenue, average premium."""
    return denorm.groupBy("insurance_type", "event_date").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum("premium_amount").alias("total_premium"),
        F.sum("total_amount").alias("total_revenue"),
        F.round(F.avg("premium_amount"), 4).alias("avg_premium"))


def user_daily_summary(denorm: DataFrame) -> DataFrame:
    """(user, date) -> purchases, premium, sorted list of types bought."""
    return denorm.groupBy("user_id", "event_date").agg(
        F.count(F.lit(1)).alias("daily_purchases"),
        F.sum("premium_amount").alias("daily_premium"),
        F.sort_array(F.collect_list("insurance_type")).alias("insurance_types"))


def insurance_type_last_days(denorm: DataFrame, as_of: str, days: int = 30,
                             types: list[str] | None = None) -> DataFrame:
    """Per type and day over the last N days, sorted by day then premium."""
    d = _window(denorm, as_of, days)
    if types:
        d = d.filter(F.col("insurance_type").isin(types))
    return (d.groupBy("insurance_type", "event_date")
            .agg(F.sum("premium_amount").alias("daily_premium"),
                 F.count(F.lit(1)).alias("purchase_count"),
                 F.round(F.avg("total_amount"), 4).alias("avg_transaction_value"))
            .orderBy("event_date", F.desc("daily_premium"), "insurance_type"))


def user_product_mix(denorm: DataFrame, sessions: DataFrame, as_of: str,
                     days: int = 90, top: int = 100) -> DataFrame:
    """Users with more than one purchase, top N by premium (ties by user_id).

    The longest session comes from the session roll-up (many-to-one join on
    session_id and user_id, the roll-up's key); the top-N is a ``TakeOrderedAndProject``: each task keeps
    its own N best rows, so only N rows per task move.
    """
    d = _window(denorm, as_of, days)
    s = sessions.select("session_id", "user_id", "session_duration_seconds")
    return (d.join(s, ["session_id", "user_id"], "left")
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_purchases"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.sort_array(F.collect_set("insurance_type")).alias("product_mix"),
                 F.max("session_duration_seconds").alias("longest_session"))
            .filter(F.col("total_purchases") > 1)
            .orderBy(F.desc("total_premium"), "user_id")
            .limit(top))


def channel_product_performance(denorm: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Completed payments in the last N days by channel and type."""
    return (_window(denorm, as_of, days).filter(F.col("payment_status") == "completed")
            .groupBy("channel", "insurance_type")
            .agg(F.count(F.lit(1)).alias("purchase_count"),
                 F.sum("premium_amount").alias("revenue"),
                 F.sum("commission_amount").alias("commission"),
                 F.round(F.avg(F.datediff("policy_end_date", "policy_start_date")), 4)
                  .alias("avg_policy_duration"))
            .orderBy(F.desc("revenue"), "channel", "insurance_type"))


def insurance_type_last_week(denorm: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """A10: per type over the last week, most purchases first."""
    return (_window(denorm, as_of, days).groupBy("insurance_type")
            .agg(F.count(F.lit(1)).alias("purchase_count"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.round(F.avg("premium_amount"), 4).alias("avg_premium"))
            .orderBy(F.desc("purchase_count"), "insurance_type"))


def denormalized_overview(denorm: DataFrame) -> DataFrame:
    """One-row overview of the denormalised table."""
    return denorm.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("insurance_type").alias("insurance_types"),
        F.sum("premium_amount").alias("total_premium"),
        F.round(F.avg("premium_amount"), 4).alias("avg_premium"))
