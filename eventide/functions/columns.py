"""Reusable Column expressions.

These replace the SQL lambda functions of the original (completeness,
outlier bounds, freshness) and the CASE ladders of its checks.  All of them
are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_of_ts", "parse_time_best_effort", "seconds_between", "safe_ratio",
    "ladder", "severity_rank", "impact_rank", "completeness_flag", "month_key",
    "pct", "lookback", "ntz_to_instant", "instant_to_ntz",
]

# Ordinal ranks for severities and impact levels.
SEVERITY_ORDER = ["low", "medium", "high", "critical"]


def as_of_ts(as_of: str) -> Column:
    """The explicit 'now' of a job, as a TIMESTAMP_NTZ literal."""
    return F.lit(as_of).cast("timestamp_ntz")


def ntz_to_instant(c: Column) -> Column:
    """Wall-clock time (UTC convention) to the TIMESTAMP instant it names.

    Independent of the session time zone; watermarks and ``window`` need
    instants, and hour windows then align with the wall-clock hours.
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c.cast("timestamp_ntz")).cast("timestamp")


def instant_to_ntz(c: Column) -> Column:
    """A TIMESTAMP instant as its UTC wall-clock TIMESTAMP_NTZ (session-zone independent)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


_ZONED = r"(Z|z|[+-][0-9]{2}:?[0-9]{2})$"


def parse_time_best_effort(c: Column) -> Column:
    """Text to TIMESTAMP_NTZ by best effort; NULL when nothing fits (never raises).

    Accepts ISO forms with 'T', fractions and zone ('2024-01-01T00:00:07.000Z'),
    'yyyy-MM-dd HH:mm:ss', bare dates and a few day-first/slashed layouts.
    Text with a zone names an instant and becomes its UTC wall clock; text
    without one is taken as written.
    """
    plain = F.coalesce(
        F.try_to_timestamp(c),
        F.try_to_timestamp(c, F.lit("yyyy/MM/dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy/MM/dd")),
        F.try_to_timestamp(c, F.lit("dd/MM/yyyy")),
    )
    return F.when(F.trim(c).rlike(_ZONED), instant_to_ntz(F.try_to_timestamp(F.trim(c)))) \
            .otherwise(plain.cast("timestamp_ntz"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end (end - start)."""
    return F.timestamp_diff("SECOND", start, end)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL on a zero denominator (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(safe_ratio(num * 100.0, den), digits)


def ladder(value: Column, steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """CASE ladder: first (predicate, label) that holds wins."""
    out = None
    for pred, label in steps:
        out = F.when(pred, F.lit(label)) if out is None else out.when(pred, F.lit(label))
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)


def severity_rank(c: Column) -> Column:
    """Ordinal rank of a severity/impact label (unknown -> 0)."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), c),
                      F.lit(0)).cast("int")


impact_rank = severity_rank


def completeness_flag(cols: Iterable[str]) -> Column:
    """1 when every listed column is present and non-empty as text, else 0."""
    arr = F.array(*[F.col(c).cast("string") for c in cols])
    return F.when(F.forall(arr, lambda x: x.isNotNull() & (x != "")), 1).otherwise(0)


def month_key(c: Column) -> Column:
    """yyyyMM partition key of a date or timestamp."""
    return F.date_format(c, "yyyyMM")


def lookback(c: Column, as_of: str, interval: str) -> Column:
    """Predicate: c >= as_of - INTERVAL <interval>."""
    return c >= (as_of_ts(as_of) - F.expr(f"INTERVAL {interval}"))
