"""Quantiles that merge (A4): one KLL sketch of session durations per day, stored, and merged into longer periods.

A day's row holds its counts, its sums and a sketch of a few kilobytes, so a
month's p95 reads thirty rows instead of the month's sessions.  Partial
aggregation merges sketches on every mapper; no day's values meet in one task.
A sketch of parameter ``K`` answers a quantile within a rank error of about
0.7 % (99 % of the time); ``rank_errors`` measures the error on the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import safe_ratio

K = 400
RANK_ERROR = 0.02       # rank error allowed: about three times the 99 % bound of a sketch of K

#: Formats of the periods that day rows merge into.
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def daily_session_sketches(sessions: DataFrame, k: int = K) -> DataFrame:
    """(session_date, sessions, duration_seconds, purchases, durations) with one row a day; null durations count as sessions only."""
    d = F.col("session_duration_seconds").cast("bigint")
    return (sessions.groupBy(F.to_date("first_event_time").alias("session_date"))
            .agg(F.count(F.lit(1)).alias("sessions"), F.count(d).alias("timed"), F.sum(d).alias("duration_seconds"),
                 F.sum("has_purchase").cast("bigint").alias("purchases"),
                 F.kll_sketch_agg_bigint(d, F.lit(k)).alias("durations")))


def merged_periods(daily: DataFrame, kind: str, quantile: float = 0.95) -> DataFrame:
    """KPIs of a period from its days' rows: counts add up, sketches merge."""
    period = F.date_format("session_date", PERIODS[kind])
    merged = daily.groupBy(period.alias("period")).agg(
        F.sum("sessions").alias("sessions"), F.sum("timed").alias("timed"), F.sum("duration_seconds").alias("seconds"),
        F.sum("purchases").alias("purchases"), F.kll_merge_agg_bigint("durations").alias("durations"))
    return merged.select(
        F.lit(kind).alias("period_kind"), "period", "sessions",
        F.round(safe_ratio(F.col("seconds"), F.col("timed")), 4).alias("avg_session_duration"),
        F.round(safe_ratio(F.col("purchases"), F.col("sessions")), 6).alias("conversion_rate"),
        F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_bigint("durations", F.lit(quantile))).alias("p95_estimate"))


def rank_errors(sessions: DataFrame, periods: DataFrame, kind: str, quantile: float = 0.95) -> DataFrame:
    """One kind's periods with p95_exact and rank_error, measured on the sessions' own durations.

    The estimate covers the ranks from the share of smaller values to the share
    of values not greater; the error is that range's distance from the quantile.
    Durations are whole seconds of one day, so the exact percentile keeps at
    most 86,401 counts per period.  Merging sketches is random, so the estimate
    runs through the join with its error instead of being evaluated again.
    """
    d = F.col("session_duration_seconds").cast("bigint")
    rows = sessions.select(F.date_format("first_event_time", PERIODS[kind]).alias("period"), d.alias("d"))
    ranked = rows.join(periods, "period").groupBy(*periods.columns).agg(
        F.count("d").alias("n"), F.count_if(F.col("d") < F.col("p95_estimate")).alias("below"),
        F.count_if(F.col("d") <= F.col("p95_estimate")).alias("upto"),
        F.round(F.percentile("d", quantile), 4).alias("p95_exact"))
    error = F.greatest(F.lit(0.0), safe_ratio(F.col("below"), F.col("n")) - quantile,
                       quantile - safe_ratio(F.col("upto"), F.col("n")))
    return ranked.select(*periods.columns, "p95_exact", F.when(F.col("n") > 0, error).alias("rank_error"))


def period_report(sessions: DataFrame, daily: DataFrame, quantile: float = 0.95) -> DataFrame:
    """KPIs per day and per month from stored day rows, each with its exact percentile and measured rank error."""
    days, months = (rank_errors(sessions, merged_periods(daily, kind, quantile), kind, quantile) for kind in PERIODS)
    return days.unionByName(months)
