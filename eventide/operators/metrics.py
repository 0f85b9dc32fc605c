"""Event roll-ups: daily, session, KPI, report and journey aggregations.

All are single ``groupBy`` aggregations (partial aggregation before the
shuffle), recomputed exactly rather than summed block by block, which fixes
the additive-distinct and partial-session defects of insert-time views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import safe_ratio, seconds_between

DAILY_KEYS = ["metric_date", "channel", "city", "device_type"]


def daily_event_metrics(events: DataFrame) -> DataFrame:
    """A1: (date, channel, type, city, device) -> count, distincts, sum, avg premium."""
    return (events.withColumnRenamed("event_date", "metric_date")
            .groupBy("metric_date", "channel", "event_type", "city", "device_type")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("session_id").alias("unique_sessions"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.round(F.avg("premium_amount"), 4).alias("avg_premium")))


def daily_aggregate_metrics(events: DataFrame) -> DataFrame:
    """A2: (date, channel, city, device) -> counts, distincts, premium, purchases.

    ``total_users_with_premium`` keeps its original name but counts events.
    """
    return (events.withColumnRenamed("event_date", "metric_date")
            .groupBy(*DAILY_KEYS)
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("session_id").alias("unique_sessions"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.sum("is_purchase").cast("bigint").alias("purchase_events"),
                 F.count_if(F.col("premium_amount") > 0).alias("total_users_with_premium")))


def session_metrics(events: DataFrame) -> DataFrame:
    """A3: one row per whole session, 'first' taken by (event_time, event_id).

    ``event_sequence`` is the session's event types in time order; it is built
    from a partially aggregated list, sorted once per session.  The distinct
    event types are counted from that list, so the aggregate needs no
    distinct-aggregation rewrite (an Expand of every row and a second phase).
    """
    order = F.struct("event_time", "event_id")
    seq = F.transform(F.array_sort(F.collect_list(F.struct("event_time", "event_id", "event_type"))),
                      lambda x: x["event_type"])
    return (events.groupBy("session_id", "user_id")
            .agg(F.min("event_time").alias("first_event_time"),
                 F.max("event_time").alias("last_event_time"),
                 F.count(F.lit(1)).alias("total_events"),
                 F.max("is_purchase").alias("has_purchase"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.min_by("channel", order).alias("first_channel"),
                 F.min_by("city", order).alias("first_city"),
                 F.min_by("device_type", order).alias("first_device_type"),
                 seq.alias("event_sequence"))
            .select("session_id", "user_id", "first_event_time", "last_event_time", "total_events",
                    F.size(F.array_distinct(F.filter("event_sequence", lambda x: x.isNotNull())))
                    .cast("bigint").alias("unique_event_types"),
                    "has_purchase", "total_premium", "first_channel", "first_city", "first_device_type",
                    "event_sequence",
                    seconds_between(F.col("first_event_time"), F.col("last_event_time"))
                    .alias("session_duration_seconds")))


def session_kpis(sessions: DataFrame) -> DataFrame:
    """A4: average and exact p95 session duration, conversion rate.

    ``percentile`` keeps one count per distinct duration and merges them in
    one task; a session is one user's day, so durations are whole seconds in
    [0, 86400] and that map has at most 86,401 entries at any data size.
    Unbounded value domains use ``windows.exact_percentiles`` instead (D11).
    """
    d = F.col("session_duration_seconds")
    return sessions.agg(
        F.round(F.avg(d), 4).alias("avg_session_duration"),
        F.round(F.percentile(d, 0.95), 4).alias("p95_duration"),
        F.round(safe_ratio(F.sum("has_purchase"), F.count(F.lit(1))), 6).alias("conversion_rate"))


# Report category labels.
CATEGORY_LABELS = ["Event Types:", "Channels:", "Cities:", "Device Types:"]


def category_values_report(events: DataFrame) -> DataFrame:
    """Distinct values and their count for four categories, in one pass.

    The four columns are unpivoted and grouped once instead of four scans and
    a union; each category's set is partially aggregated before the shuffle.
    """
    long = events.select(F.explode(F.array(
        F.struct(F.lit(CATEGORY_LABELS[0]).alias("category"), F.col("event_type").alias("value")),
        F.struct(F.lit(CATEGORY_LABELS[1]).alias("category"), F.col("channel").alias("value")),
        F.struct(F.lit(CATEGORY_LABELS[2]).alias("category"), F.col("city").alias("value")),
        F.struct(F.lit(CATEGORY_LABELS[3]).alias("category"), F.trim("device_type").alias("value")),
    )).alias("kv")).select("kv.*")
    values = long.groupBy("category").agg(F.sort_array(F.collect_set("value")).alias("values"))
    # the set already holds the distinct non-NULL values: no distinct-aggregate rewrite
    return values.select("category", "values", F.size("values").cast("bigint").alias("unique_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one aggregate, as (column_name, null_count) rows."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def daily_metrics_partials(events: DataFrame, block_col: str = "event_hour") -> DataFrame:
    """Partial daily rows per delivery block, as insert-time views would emit."""
    return (events.withColumnRenamed("event_date", "metric_date")
            .groupBy(*DAILY_KEYS, block_col)
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.sum("premium_amount").alias("total_premium"),
                 F.sum("is_purchase").cast("bigint").alias("purchase_events"),
                 F.count_if(F.col("premium_amount") > 0).alias("total_users_with_premium"),
                 F.hll_sketch_agg(F.col("user_id")).alias("users_sketch"),
                 F.hll_sketch_agg(F.col("session_id")).alias("sessions_sketch")))


def daily_metrics_rollup(partials: DataFrame, with_sketches: bool = False) -> DataFrame:
    """Merge partial rows by key.

    Counts and sums add up exactly; distinct counts cannot be added, so they
    merge as HLL sketches (union) and are estimated, with averages rebuilt
    from sum and count instead of being summed.
    """
    aggs = [F.sum("total_events").alias("total_events"),
            F.sum("total_premium").alias("total_premium"),
            F.sum("purchase_events").alias("purchase_events"),
            F.sum("total_users_with_premium").alias("total_users_with_premium")]
    if with_sketches:
        aggs += [F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("approx_unique_users"),
                 F.hll_sketch_estimate(F.hll_union_agg("sessions_sketch")).alias("approx_unique_sessions")]
    out = partials.groupBy(*DAILY_KEYS).agg(*aggs)
    return out.withColumn("avg_premium", F.round(safe_ratio(F.col("total_premium"), F.col("total_events")), 4))


SKETCH_ERROR = 0.1   # relative error allowed: six standard errors of a sketch of 2^12 buckets


def sketch_accuracy(events: DataFrame) -> DataFrame:
    """A15 with its distinct counts checked: exact counts, and whether each estimate lies within ``SKETCH_ERROR``."""
    merged = daily_metrics_rollup(daily_metrics_partials(events), with_sketches=True).alias("m")
    exact = daily_aggregate_metrics(events).select(*DAILY_KEYS, "unique_users", "unique_sessions").alias("x")
    same = F.lit(True)
    for c in DAILY_KEYS:
        same = same & F.col(f"m.{c}").eqNullSafe(F.col(f"x.{c}"))

    def within(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= F.col(count) * SKETCH_ERROR

    return merged.join(exact, same).select(
        "m.*", "unique_users", "unique_sessions",
        within("approx_unique_users", "unique_users").alias("users_within"),
        within("approx_unique_sessions", "unique_sessions").alias("sessions_within"),
    ).drop("approx_unique_users", "approx_unique_sessions")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table (one small aggregate each, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def signup_to_purchase_journey(events: DataFrame) -> DataFrame:
    """Per user with a signup: first signup, first purchase at or after it, seconds between.

    Purchases (the large side, where one user may hold a third of the rows)
    meet the one-row-per-user signup table in an inner join as the streamed
    side, so AQE can split a hot user's partition; the per-user minimum is
    partially aggregated before its shuffle, and the one-row-per-user result
    joins back to keep users without a purchase.
    """
    firsts = (events.filter(F.col("event_type") == "signup")
              .groupBy("user_id").agg(F.min("event_time").alias("first_signup_time")))
    buys = events.filter(F.col("event_type") == "purchase").select("user_id", F.col("event_time").alias("t"))
    hit = (buys.join(firsts, "user_id")
           .filter(F.col("t") >= F.col("first_signup_time"))
           .groupBy("user_id").agg(F.min("t").alias("first_purchase_time")))
    return (firsts.join(hit, "user_id", "left")
            .select("user_id", "first_signup_time", "first_purchase_time",
                    seconds_between(F.col("first_signup_time"), F.col("first_purchase_time"))
                    .alias("seconds_to_purchase")))


def channel_attribution(events: DataFrame) -> DataFrame:
    """Purchases and premium credited to the session's first-touch channel.

    The first-touch channel (A3's ``first_channel``) and the session's
    purchase totals come out of one aggregation per session (a session id is
    built from one user and one day), then a small aggregate per channel: no
    join of the purchases back to the session roll-up, so the events are
    shuffled once instead of three times.
    """
    order = F.struct("event_time", "event_id")
    buy = F.col("event_type") == "purchase"
    per_session = (events.groupBy("session_id", "user_id")
                   .agg(F.min_by("channel", order).alias("first_channel"),
                        F.count_if(buy).alias("n"),
                        F.sum(F.when(buy, F.col("premium_amount"))).alias("premium")))
    return (per_session.filter(F.col("n") > 0)
            .groupBy("first_channel")
            .agg(F.sum("n").alias("purchases"),
                 F.sum("premium").alias("total_premium"),
                 F.count_distinct("session_id").alias("converting_sessions")))


def session_event_sequence(events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A3 in long form: each event with its 1-based position in its session.

    The skew-safe companion of ``event_sequence``: no session is gathered into
    one task or one row, however many events it has (see ``rank_within``).
    """
    from eventide.operators.windows import rank_within
    base = events.select("session_id", "event_time", "event_id", "event_type")
    return rank_within(base, "session_id", ["event_time", "event_id"], "seq_no", num_partitions)
