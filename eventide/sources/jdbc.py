"""The users dimension from a relational database over JDBC.

The original reads the table in one partition; here the read is split on the
numeric key into ``num_partitions`` ranges between the key's least and greatest
value in the database, so executors read in parallel.
Needs the database's JDBC driver on the classpath (not present in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_users_jdbc(spark: SparkSession, url: str, table: str = "users", user: str | None = None,
                    password: str | None = None, driver: str | None = None, key: str = "user_id",
                    lower: int | None = None, upper: int | None = None, num_partitions: int = 16,
                    fetch_size: int = 10_000) -> DataFrame:
    props = {k: v for k, v in {"user": user, "password": password, "driver": driver,
                               "fetchsize": str(fetch_size)}.items() if v is not None}
    if lower is None or upper is None:
        ends = spark.read.jdbc(url=url, table=f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) bounds",
                               properties=props).first()
        lower = ends["lo"] or 0 if lower is None else lower
        upper = ends["hi"] or 0 if upper is None else upper
        upper = max(upper, lower + 1)
    df = spark.read.jdbc(url=url, table=table, column=key, lowerBound=lower, upperBound=upper,
                         numPartitions=num_partitions, properties=props)
    return df.withColumn("signup_date", F.to_date("signup_date"))


def write_users_jdbc(df: DataFrame, url: str, table: str = "users", batch_size: int = 1000,
                     **props: str) -> None:
    """S3 sink: append rows to the database table in batches of ``batch_size``."""
    (df.write.mode("append").option("batchsize", batch_size)
       .jdbc(url=url, table=table, properties=props))
