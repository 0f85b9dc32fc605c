"""Joins of hot (user, day) pairs: the same rows as the plain join, dealt over many tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.operators.split_join import split_join

ON = [("user_id", "user_id"), ("event_date", "order_date")]


@pytest.fixture(scope="module")
def sides(spark):
    """One (user, day) holds a third of both sides; some users are null or without orders."""
    n = 900
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40 + 10).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-01-0"), F.col("id") % 4 + 1)).alias("event_date"),
        F.concat(F.lit("e"), "id").alias("event_id"))
    right = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 30 + 10).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-01-0"), F.col("id") % 4 + 1)).alias("order_date"),
        F.concat(F.lit("o"), "id").alias("order_id"))
    return left, right


def _rows(j):
    return Counter(tuple(r) for r in j.select("e.event_id", "e.user_id", "o.order_id", "o.user_id").collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equal_to_plain_join(sides, how):
    left, right = sides
    plain = left.alias("e").join(right.alias("o"), [F.col(f"e.{a}") == F.col(f"o.{b}") for a, b in ON], how)
    got = split_join(left, right, ON, how, "event_id", hot_rows=10)
    assert _rows(got) == _rows(plain) and not [c for c in got.columns if c.startswith("__")]
    assert _rows(split_join(left, right, ON, how, "event_id")) == _rows(plain)
    assert split_join(left.limit(0), right, ON, how, "event_id", hot_rows=10).count() == 0


def test_hot_pair_meets_in_many_tasks(spark, sides):
    left, right = sides
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "-1")):
            spark.conf.set(k, v)
        def tasks(j):
            hot = j.filter(F.col("e.user_id") == 7).groupBy(F.spark_partition_id()).count().collect()
            return [r["count"] for r in hot]
        wide, plain = (tasks(split_join(left, right, ON, "left", "event_id", n)) for n in (10, 1000))
        assert sum(wide) == sum(plain) == 300 * 100
        assert len(plain) == 1 and len(wide) > 4 and max(wide) < sum(wide) / 2
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
