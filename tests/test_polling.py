"""Polling by key: resumed runs lose and repeat nothing."""

from collections import Counter

from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources import polling


def test_resumed_polls(spark):
    path, sink, mark = (scratch_path(spark, n) for n in ("poll-in", "poll-out", "poll-mark"))
    rows = spark.range(200).select(F.col("id").alias("user_id"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("extra"))
    schema = rows.select("user_id", "name").schema

    def run(low, high):
        part = rows.filter(F.col("user_id").between(low, high))
        part.unionByName(part.limit(1).withColumn("user_id", F.lit(None).cast("long"))).write.mode("append").parquet(path)
        polling.poll(spark, path, schema, "user_id", sink, mark)
        return Counter(r.user_id for r in spark.read.schema(schema).parquet(sink).collect())

    assert run(0, 49) == Counter(range(50))
    assert run(50, 120) == Counter(range(121))
    polling.poll(spark, path, schema, "user_id", sink, mark)        # nothing new
    assert run(121, 199) == Counter(range(200))
