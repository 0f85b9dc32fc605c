"""Exact distinct counts that merge (A15, T4): sets of dense ids in array and bitmap containers.

A value (user, session) gets a dense id in its scope (the day that is counted),
so a set of values is a set of small numbers.  Numbers are cut into buckets of
32,768; a bucket's members are an array of positions while they are few, and a
bitmap of 4 KB (Spark's bitmap functions) beyond that.  Sets of the same key
merge by union of arrays and OR of bitmaps, so partial rows of any blocks,
hours or micro-batches add up to exact counts, and a container never exceeds
one bucket however many rows a key has.

All steps are DataFrame aggregations with partial aggregation; there is no
distinct aggregate and so no Expand of the input rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.session import scratch_path

BUCKET = 32_768         # positions of Spark's bitmaps
FEW = 1_024             # beyond this many 4-byte positions a bitmap is smaller
ID_COLUMNS = ["scope", "kind", "value", "id"]
MEASURES = ["total_events", "total_premium", "priced_events", "purchase_events", "total_users_with_premium"]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def members(events: DataFrame, scope: str, columns: dict[str, str]) -> DataFrame:
    """(scope, kind, value): the different values to be numbered, of each kind (name -> column)."""
    long = events.select(F.col(scope).alias("scope"), F.explode(F.array(*(
        F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in columns.items()))).alias("m"))
    return long.select("scope", "m.*").filter("scope is not null and value is not null").distinct()


def new_ids(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(scope, kind, value, id) of the values that ``known`` lacks; ids go on, without gaps, in each scope and kind.

    Values are range-partitioned and written once; per-partition totals and
    their prefix sums give every partition its first id.
    """
    spark = values.sparkSession
    if known is not None:
        values = values.join(known, ["scope", "kind", "value"], "left_anti")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _written(values.repartitionByRange(n, "scope", "kind", "value").withColumn("part", F.spark_partition_id()), "new-values")
    sizes = ranged.groupBy("scope", "kind", "part").agg(F.count("*").alias("size"))    # at most partitions + scopes rows
    before = F.sum("size").over(Window.partitionBy("scope", "kind").orderBy("part")) - F.col("size")
    starts = sizes.select("scope", "kind", "part", before.alias("start"))
    if known is not None:
        top = known.groupBy("scope", "kind").agg((F.max("id") + 1).alias("top"))
        starts = starts.join(top, ["scope", "kind"], "left").withColumn("start", F.col("start") + F.coalesce("top", F.lit(0)))
    inside = Window.partitionBy("scope", "kind", "part").orderBy("value")
    return (ranged.withColumn("nth", F.row_number().over(inside) - 1).join(starts, ["scope", "kind", "part"])
            .select("scope", "kind", "value", (F.col("start") + F.col("nth")).cast("long").alias("id")))


def _containers(rows: DataFrame) -> DataFrame:
    """rows (key, kind, bucket, pos) -> (key, kind, bucket, few, many)."""
    sets = rows.groupBy("key", "kind", "bucket").agg(F.collect_set("pos").alias("few"))     # at most one bucket
    small = sets.filter(F.size("few") <= FEW).withColumn("many", F.lit(None).cast("binary"))
    return small.unionByName(_bitmaps(sets.filter(F.size("few") > FEW)))


def _bitmaps(sets: DataFrame) -> DataFrame:
    dense = sets.select("key", "kind", "bucket", F.explode("few").alias("pos"))
    return (dense.groupBy("key", "kind", "bucket").agg(F.bitmap_construct_agg("pos").alias("many"))
            .select("key", "kind", "bucket", F.lit(None).cast("array<int>").alias("few"), "many"))


def partial_sets(events: DataFrame, keys: Sequence[str], scope: str, columns: dict[str, str], ids: DataFrame) -> DataFrame:
    """(key, kind, bucket, few, many): the sets of every key (a struct of the key columns)."""
    rows = None
    for kind, c in columns.items():
        own = ids.filter(F.col("kind") == kind).select(F.col("scope").alias("_scope"), F.col("value").alias("_value"), "id")
        cells = events.select(F.struct(*keys).alias("key"), F.col(scope).alias("_scope"), F.col(c).cast("string").alias("_value")).distinct()
        found = cells.join(own, ["_scope", "_value"]).select(
            "key", F.lit(kind).alias("kind"), F.expr(f"id div {BUCKET}").alias("bucket"), F.expr(f"int(id % {BUCKET})").alias("pos"))
        rows = found if rows is None else rows.unionByName(found)
    return _containers(rows)


def merged_sets(parts: DataFrame) -> DataFrame:
    """The unions of the sets of equal (key, kind, bucket)."""
    place = ["key", "kind", "bucket"]
    dense = parts.filter("many is not null").select(*place, "few", "many")
    sparse = _containers(parts.filter("few is not null").select(*place, F.explode("few").alias("pos")))
    meets = dense.select(*place).distinct()
    few = sparse.filter("few is not null")
    maps = (dense.unionByName(sparse.filter("many is not null")).unionByName(_bitmaps(few.join(meets, place, "left_semi").select(*place, "few")))
            .groupBy(*place).agg(F.bitmap_or_agg("many").alias("many"))
            .select(*place, F.lit(None).cast("array<int>").alias("few"), "many"))
    return few.join(meets, place, "left_anti").select(*place, "few", "many").unionByName(maps)


def set_sizes(sets: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(key, one column per kind): exact numbers of members."""
    n = F.when(F.col("few").isNotNull(), F.size("few").cast("long")).otherwise(F.bitmap_count("many"))
    return sets.withColumn("n", n).groupBy("key").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds))


# ---- daily metrics from partials -----------------------------------------------------
KINDS = {"unique_users": "user_id", "unique_sessions": "session_id"}


def partial_measures(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, additive measures): what sums merge."""
    return events.groupBy(F.struct(*keys).alias("key")).agg(
        F.count(F.lit(1)).alias("total_events"), F.sum("premium_amount").alias("total_premium"),
        F.count("premium_amount").alias("priced_events"), F.sum("is_purchase").cast("bigint").alias("purchase_events"),
        F.count_if(F.col("premium_amount") > 0).alias("total_users_with_premium"))


def daily_partials(events: DataFrame, keys: Sequence[str], block: str | None = None, known: DataFrame | None = None
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, measures, sets) of events with ``metric_date`` among their keys; per block where one is named.

    ``ids`` are the new ones only; ``known`` holds those given before.
    """
    per = [*keys, block] if block else list(keys)
    ids = _written(new_ids(members(events, "metric_date", KINDS), known), "ids")
    every = ids if known is None else known.select(*ID_COLUMNS).unionByName(ids)
    return ids, partial_measures(events, per), partial_sets(events, per, "metric_date", KINDS, every)


def daily_rollup(measures: DataFrame, sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial rows of any blocks merged by ``keys``: sums, and exact distinct users and sessions."""
    to_key = F.struct(*(F.col(f"key.{k}").alias(k) for k in keys)).alias("key")
    sums = measures.select(to_key, *MEASURES).groupBy("key").agg(*(F.sum(m).alias(m) for m in MEASURES))
    sizes = set_sizes(merged_sets(sets.select(to_key, "kind", "bucket", "few", "many")), list(KINDS))
    return sums.join(sizes, "key", "left").select(
        "key.*", *MEASURES, *(F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in KINDS))
