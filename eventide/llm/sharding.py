"""Contiguous shards of nearly equal bytes from global byte-size prefix sums.

Documents are ordered by doc_id.  A range partitioning puts each into one of
many ordered partitions; per-partition totals (one small row each) give every
partition its global byte and row offset, and running sums inside a partition
give each document its global byte interval.  The intervals are cut at equal
byte targets: a document goes to the shard that holds its midpoint, so a shard
misses its target by at most half a document at either end.

Defined results: a null text has size 1 (as an empty one); null doc_ids come
first; repeated rows are each placed; ties in doc_id are ordered by text
checksum and size (rows equal in all of them are interchangeable); an empty
table gives an empty result; other columns are not read.  Shards are cut by
bytes alone, so equal texts share a shard only where the order puts them there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.components import written


def assign_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, start_byte, shard, slot) of every document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "text_crc32", "size", "tie"]
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (F.octet_length(text).cast("long") + 1).alias("size"),
                        F.crc32(text).alias("text_crc32"), F.rand(17).alias("tie"))
    # written once: the partitions and their totals must come from one partitioning
    ranged = written(spark, sized.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shards")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (ranged.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("nth", F.row_number().over(inside) - 1)
              .join(F.broadcast(offsets), "part")       # as many rows as partitions
              .withColumn("start_byte", F.col("byte0") + F.col("run") - F.col("size"))
              .withColumn("row", F.col("row0") + F.col("nth"))
              .withColumn("shard", F.expr(f"int((2 * start_byte + size) * {n_shards} div (2 * total))"))
              .select("doc_id", "size", "text_crc32", "start_byte", "row", "shard"))
    placed = written(spark, placed, "shards")
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))            # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "start_byte", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
