"""CSV ingest of users and events, with reject accounting.

Lines are parsed JVM-side with ``from_csv`` on a text column, so the same code
serves ``spark.read.text`` of files, a stream of lines, or lines rendered from
the given tables.  Rows are never dropped silently: every line is either a
good row or a reject with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.columns import as_of_ts, pct
from eventide.schemas import EVENT_CSV_TEXT, USER_CSV_TEXT

EVENT_HEADER = "event_time,user_id,session_id,event_type,channel,premium_amount"
USER_HEADER = "user_id,signup_date,city,device_type"
_CSV_OPTS = {"mode": "PERMISSIVE"}
# The CSV reader yields NULL both for a blank last field and for a missing
# one.  A sentinel field is appended to every line before parsing into one
# extra column: that column is non-NULL exactly when the line had >= 6 fields.
_BLANKS = {"nullValue": "", "emptyValue": "",    # a missing field keeps its place, blanks stay as they are
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_SENTINEL = "\u0002"
_EVENT_CSV_PLUS = EVENT_CSV_TEXT.simpleString()[:-1] + ",tail:string>"


def events_to_csv_lines(raw: DataFrame) -> DataFrame:
    """Render raw events as CSV text lines; a zero premium is written blank."""
    premium = F.when(F.col("premium_amount") == 0, F.lit("")).otherwise(F.col("premium_amount").cast("string"))
    return raw.select(F.to_csv(F.struct(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("t"), F.col("user_id").cast("string"),
        "session_id", "event_type", "channel", premium.alias("p")), _BLANKS).alias("value"))


def users_to_csv_lines(users: DataFrame) -> DataFrame:
    return users.select(F.to_csv(F.struct(
        F.col("user_id").cast("string"), F.date_format("signup_date", "yyyy-MM-dd").alias("d"),
        "city", "device_type"), _BLANKS).alias("value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_event_lines(lines: DataFrame) -> DataFrame:
    """Parse event lines; adds ``reject_reason`` (NULL for good rows).

    Rules: at least six fields; user_id must be an integer; a blank premium
    becomes 0; a non-numeric premium rejects the row.  Header lines are skipped.
    """
    p = F.from_csv(F.concat(F.col("value"), F.lit("," + _SENTINEL)), _EVENT_CSV_PLUS, _CSV_OPTS)
    parsed = (lines.filter(F.col("value") != EVENT_HEADER)
              .select(F.col("value").alias("line"), p.alias("f")))
    uid = F.col("f.user_id").try_cast("bigint")
    prem_txt = F.trim(F.col("f.premium_amount"))
    prem = (F.when(prem_txt.isNull() | (prem_txt == ""), F.lit(0).cast("bigint"))
            .otherwise(prem_txt.try_cast("bigint")))
    reason = (F.when(F.col("f.tail").isNull(), "fewer_than_6_fields")
              .when(uid.isNull(), "bad_user_id")
              .when(prem.isNull(), "bad_premium_amount"))
    return parsed.select(
        F.col("f.event_time").alias("event_time"),
        uid.alias("user_id"),
        F.col("f.session_id").alias("session_id"),
        F.col("f.event_type").alias("event_type"),
        F.col("f.channel").alias("channel"),
        prem.alias("premium_amount"),
        reason.alias("reject_reason"),
        "line",
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "line")


def reject_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("line", "reject_reason")


def ingest_report(parsed: DataFrame) -> DataFrame:
    """One row: lines read, sent (good), failed (rejected), success rate %."""
    return parsed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("sent_rows"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("failed_rows"),
    ).withColumn("success_rate", pct(F.col("sent_rows"), F.col("total_rows")))


def _user_fields(lines: DataFrame) -> DataFrame:
    p = F.from_csv(F.col("value"), USER_CSV_TEXT.simpleString(), _CSV_OPTS)
    return lines.filter(~F.col("value").eqNullSafe(USER_HEADER)).select("value", p.alias("f"))


def user_rejects(lines: DataFrame) -> DataFrame:
    """S3: the lines that give no user, with the reason; with ``parse_user_lines`` they make up all lines."""
    user = F.col("f.user_id")
    return (_user_fields(lines).filter(user.try_cast("bigint").isNull())
            .select("value", F.when(user.isNull(), "missing user_id").otherwise("bad user_id").alias("reject_reason")))


def parse_user_lines(lines: DataFrame, as_of: str) -> DataFrame:
    """S3: users CSV to typed rows stamped with created_at/updated_at; ``user_rejects`` has the other lines."""
    return _user_fields(lines).select(
        F.col("f.user_id").try_cast("bigint").alias("user_id"),
        F.try_to_date(F.col("f.signup_date"), "yyyy-MM-dd").alias("signup_date"),
        F.col("f.city").alias("city"),
        F.col("f.device_type").alias("device_type"),
        as_of_ts(as_of).alias("created_at"),
        as_of_ts(as_of).alias("updated_at"),
    ).filter(F.col("user_id").isNotNull())


def ingest_users(lines: DataFrame, target: DataFrame, as_of: str) -> DataFrame:
    """S3 with the empty-target guard: rows to append, none if the target has data.

    The guard is a lazy scalar subquery that reads at most one row of the target.
    """
    target_rows = target.limit(1).select(F.count(F.lit(1))).scalar()
    return parse_user_lines(lines, as_of).filter(target_rows == 0)


def users_profile(users: DataFrame) -> DataFrame:
    """Load verification statistics of the users dimension."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.min("signup_date").alias("min_signup_date"),
        F.max("signup_date").alias("max_signup_date"),
        F.count_distinct("city").alias("cities"),
        F.count_distinct("device_type").alias("devices"),
    )
