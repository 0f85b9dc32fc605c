"""Connected components of a link table by alternating large and small stars.

Defined results: an empty link table, or one of self links only, has no
components; repeated links and both directions of a link count once; links with
a null end are ignored; columns other than a and b are not read.  The rounds
grow with the logarithm of the largest component; ``components`` raises if 100
rounds do not suffice, and never returns a partial result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.session import scratch_path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read again (cuts lineage; lost executors reread it)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v.  Every node u points its larger (or its smaller) neighbours to the least of all."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hit = near.join(least, "u")
    if large:
        out = hit.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hit.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): the least node reachable, for every node with a link.  links: (a, b) longs."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = written(spark, edges, "cc")
    before = None
    for _ in range(max_rounds):
        sign = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before or sign[0] == 0:
            break
        before = sign
        edges = written(spark, _star(_star(edges, True), False), "cc")
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends; for steps whose results are written or collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written_lean(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """As ``written``; the shuffle files of the job are deleted when it ends, since only its written table is read later."""
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the folder of a ``written_lean`` table that no later step reads."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
