"""Structured Streaming jobs.

Every stream reads a directory of parquet with a declared schema, writes
exactly-once (checkpoint under the shared checkpoint folder; ``foreachBatch``
writes are idempotent per epoch), and ends in a batch table.  ``availableNow``
drains what is there and stops, so each job also runs as a bounded backfill.

Exact distinct counts cannot be kept in a streaming aggregate, so the daily
and session roll-ups recompute only what a micro-batch touched, from the
stored events, and replace those partitions (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import instant_to_ntz, ntz_to_instant
from eventide.operators import clean, distincts, maintain, metrics
from eventide.operators.enrich import enrich_events
from eventide.plans.etl import transform_enrich
from eventide.session import scratch_path
from eventide.sources import topic


def stage(df: DataFrame, name: str, time_col: str | None = None, files: int | None = None) -> str:
    """Write a DataFrame as a stream source directory (files cover time ranges); unless
    given, as many files as the session has shuffle partitions, whose number follows the input."""
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(df.sparkSession, f"{name}-source")
    out = df.repartitionByRange(files, time_col) if time_col else df.repartition(files)
    out.write.parquet(path)
    return path


def _parts(spark: SparkSession, path: str) -> tuple:
    """The file system and the data files of a folder, by name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, sorted((f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())


BATCH_BYTES = 128 << 20     # staged bytes of a micro-batch
BATCHES = 4                 # of a source below that
BATCH_FILES = 2             # at least


def batch_files(spark: SparkSession, path: str) -> int:
    """Files of a staged source that a micro-batch takes.

    A batch costs its planning, its logs and a commit of every state partition
    besides its rows, so the number of batches follows the bytes of the source
    and not the number of its files, and a batch has a file for every core; a
    small source still takes several.
    """
    sizes = [f.getLen() for f in _parts(spark, path)[1]]
    batches = max(BATCHES, min(-(-sum(sizes) // BATCH_BYTES), len(sizes) // spark.sparkContext.defaultParallelism))
    return max(BATCH_FILES, -(-len(sizes) // batches))


STATE_BYTES = 32 << 20      # staged bytes of a state partition


def state_partitions(spark: SparkSession, *paths: str) -> int:
    """State partitions of a query over staged sources: each is opened and committed in every batch, so their number
    follows the bytes and the cores.  A query keeps the number of its first batch."""
    staged = sum(f.getLen() for path in paths for f in _parts(spark, path)[1])
    enough = max(2 * spark.sparkContext.defaultParallelism, -(-staged // STATE_BYTES))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), enough)


STATE_BUCKET_BYTES = 1 << 20     # staged bytes of a bucket of keys


def state_buckets(spark: SparkSession, *paths: str) -> int:
    """Buckets of keys of a query over staged sources (T5, T6): by their bytes, and several for each state partition."""
    staged = sum(f.getLen() for path in paths for f in _parts(spark, path)[1])
    return max(16 * state_partitions(spark, *paths), -(-staged // STATE_BUCKET_BYTES))


def in_arrival_order(spark: SparkSession, path: str) -> str:
    """Date the files of a staged folder by their part number, so that a file stream takes them in that order."""
    fs, parts = _parts(spark, path)
    if parts:
        first = min(f.getModificationTime() for f in parts) - 1000 * len(parts)
        for i, f in enumerate(parts):
            fs.setTimes(f.getPath(), first + 1000 * i, -1)
    return path


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _drain(writer, name: str, spark: SparkSession) -> None:
    q = (writer.option("checkpointLocation", scratch_path(spark, f"{name}-checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def to_stream_time(df: DataFrame, col: str = "event_time") -> DataFrame:
    """NTZ wall-clock time to the TIMESTAMP instant that watermarks need."""
    return df.withColumn(col, ntz_to_instant(F.col(col)))


# ---- T1 -----------------------------------------------------------------------
def stream_ingest(spark: SparkSession, source: str, as_of: str, max_files: int | None = None) -> tuple[str, str]:
    """Consume processed-event records continuously; broken records go to a
    reject table and never stop the query.  Returns (good_path, reject_path)."""
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
                           T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType())])
    good, bad = scratch_path(spark, "ingest-good"), scratch_path(spark, "ingest-reject")

    def write(batch: DataFrame, epoch: int) -> None:
        # each record keeps its offset and raw value, so good and rejected rows
        # are split by the validity test alone (no join back to the batch)
        rows = topic.decode_processed(batch, as_of, carry=("offset", "value")).persist()
        valid = F.col("event_id").isNotNull() & F.col("event_time").isNotNull()
        rows.filter(valid).drop("offset", "value").write.mode("overwrite").parquet(f"{good}/epoch={epoch}")
        (rows.filter(~valid).select(F.col("value").cast("string").alias("payload"), "offset")
         .write.mode("overwrite").parquet(f"{bad}/epoch={epoch}"))
        rows.unpersist()

    _drain(read_stream(spark, source, schema, max_files).writeStream.foreachBatch(write), "ingest", spark)
    return good, bad


# ---- T2 -----------------------------------------------------------------------
def stream_dedup(spark: SparkSession, events_stream: DataFrame, name: str = "dedup") -> str:
    """Stored days with the last write of each event, by ingestion time.

    Arrivals are appended per epoch (overwritten on replay); the days a batch
    touches are reduced to the last write (U2) and replace their partitions.
    """
    store, out = scratch_path(spark, f"{name}-arrivals"), scratch_path(spark, f"{name}-days")

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        batch.write.mode("overwrite").partitionBy("event_date").parquet(f"{store}/epoch={epoch}")
        recent = _touched_days(spark, store, batch)
        if recent is not None:
            (maintain.dedup_events(recent).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("event_date").parquet(out))
        batch.unpersist()

    _drain(events_stream.writeStream.foreachBatch(write), name, spark)
    return out


def _touched_days(spark: SparkSession, store: str, batch: DataFrame) -> DataFrame | None:
    """All stored events of the days that a batch holds events of; None for an empty batch."""
    bounds = batch.agg(F.min("event_date").alias("d0"), F.max("event_date").alias("d1")).first()
    if bounds.d0 is None:
        return None
    # distinct days of one micro-batch: bounded by the days it spans
    touched = batch.select("event_date").distinct()
    stored = spark.read.option("basePath", store).parquet(store).drop("epoch")
    # the day range prunes partitions statically; the semi join keeps exactly the touched days
    return (stored.filter(F.col("event_date").between(F.lit(bounds.d0), F.lit(bounds.d1)))
            .join(F.broadcast(touched), "event_date", "left_semi"))


# ---- T3 -----------------------------------------------------------------------
def stream_enrich(raw_stream: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """The ETL on arriving events; stream-static left join to the dimension."""
    raw = raw_stream.withColumn("event_time", instant_to_ntz(F.col("event_time")))
    return transform_enrich(raw, users, as_of)


# ---- T4 / T5: recompute what a micro-batch touched ------------------------------
def stream_daily_metrics(spark: SparkSession, events_stream: DataFrame, name: str = "daily") -> str:
    """T4: append events by day; recompute A1 for touched days; overwrite those days."""
    store, out = scratch_path(spark, f"{name}-events"), scratch_path(spark, f"{name}-metrics")

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        # one folder per epoch, overwritten on replay: a retried batch never doubles events
        batch.write.mode("overwrite").partitionBy("event_date").parquet(f"{store}/epoch={epoch}")
        recent = _touched_days(spark, store, batch)
        if recent is not None:
            (metrics.daily_event_metrics(recent).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("metric_date").parquet(out))
        batch.unpersist()

    _drain(events_stream.writeStream.foreachBatch(write), name, spark)
    return out


def stream_daily_partials(spark: SparkSession, events_stream: DataFrame, name: str = "daily-partials") -> str:
    """T4 from partials: each batch adds its own sums and sets; a touched day's metrics merge that day's partials.

    Events are not stored or read again.  Ids, sums and sets lie in day-first
    folders (day, then epoch; an epoch is overwritten on replay), so a batch
    opens only the days it touches.  Returns the folder of the metrics, by day.
    """
    root, out = scratch_path(spark, name), scratch_path(spark, f"{name}-metrics")
    keys = ["metric_date", "channel", "event_type", "city", "device_type"]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def days_of(table: str, days: list) -> list[str]:
        """Folders of the days that hold something."""
        paths = [jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/day={d}") for d in days]
        return [p.toString() for p in paths if p.getFileSystem(conf).exists(p)]

    def read(table: str, days: list, before: int | None = None) -> DataFrame | None:
        paths = days_of(table, days)
        if not paths:
            return None
        rows = spark.read.option("basePath", f"{root}/{table}").parquet(*paths)
        return rows if before is None else rows.filter(F.col("epoch") < before)

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.withColumnRenamed("event_date", "metric_date").persist()
        days = [r[0] for r in batch.select("metric_date").distinct().collect()]     # days of one batch
        if days:
            known = read("ids", days, before=epoch)
            ids, measures, sets = distincts.daily_partials(batch, keys, known=known)
            for table, rows, day in (("ids", ids, F.col("scope")), ("measures", measures, F.col("key.metric_date")),
                                     ("sets", sets, F.col("key.metric_date"))):
                (rows.withColumn("day", day).withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("day", "epoch").parquet(f"{root}/{table}"))
            merged = distincts.daily_rollup(read("measures", days), read("sets", days), keys)
            (merged.select(*keys, "total_events", "unique_users", "unique_sessions", "total_premium",
                           F.round(F.col("total_premium") / F.col("priced_events"), 4).alias("avg_premium"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("metric_date").parquet(out))
        batch.unpersist()

    _drain(events_stream.writeStream.foreachBatch(write), name, spark)
    return out


def stream_session_metrics(spark: SparkSession, events_stream: DataFrame, name: str = "sessions") -> str:
    """T5: sessions rebuilt whole whenever a batch brings events of them, however long they last.

    A narrow log holds each batch's sessions with the days of their events; it
    gives the day range that holds every event of the sessions at hand.  Only
    those days are read, semi-joined to the sessions, and the rebuilt rows are
    written under the epoch (overwritten on replay).  ``current_sessions``
    reads each session's newest row.
    """
    store, out = scratch_path(spark, f"{name}-events"), scratch_path(spark, f"{name}-table")
    days = scratch_path(spark, f"{name}-days")

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        batch.write.mode("overwrite").partitionBy("event_date").parquet(f"{store}/epoch={epoch}")
        here = batch.groupBy("session_id", "user_id").agg(F.min("event_date").alias("d0"), F.max("event_date").alias("d1"))
        here.write.mode("overwrite").parquet(f"{days}/epoch={epoch}")
        touched = here.select(F.col("session_id").alias("s"), F.col("user_id").alias("u"))
        same = F.col("session_id").eqNullSafe(F.col("s")) & F.col("user_id").eqNullSafe(F.col("u"))
        span = (spark.read.option("basePath", days).parquet(days).join(touched, same, "left_semi")
                .agg(F.min("d0").alias("d0"), F.max("d1").alias("d1")).first())
        if span.d0 is not None:
            events = (spark.read.option("basePath", store).parquet(store).drop("epoch")
                      .filter(F.col("event_date").between(F.lit(span.d0), F.lit(span.d1))).join(touched, same, "left_semi"))
            metrics.session_metrics(events).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        batch.unpersist()

    _drain(events_stream.writeStream.foreachBatch(write), name, spark)
    return out


def current_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every session that T5 wrote."""
    rows = spark.read.option("basePath", path).parquet(path)
    return maintain.latest_by(rows, ["session_id", "user_id"], ["epoch"]).drop("epoch")


# ---- T6 -----------------------------------------------------------------------
def stream_purchase_orders(purchases: DataFrame, orders: DataFrame, delay: str = "1 day",
                           bound: str = "1 day") -> DataFrame:
    """Purchases left-joined to orders as both arrive.

    Equality on user and day plus an event-time bound, with watermarks on
    both sides, lets Spark drop state; a purchase without an order is
    emitted (with NULLs) once the watermark passes its bound.
    """
    e = purchases.withWatermark("event_time", delay).alias("e")
    o = orders.withWatermark("order_ts", delay).alias("o")
    cond = ((F.col("e.user_id") == F.col("o.user_id")) & (F.col("e.event_date") == F.col("o.order_date"))
            & (F.col("o.order_ts") >= F.col("e.event_time") - F.expr(f"INTERVAL {bound}"))
            & (F.col("o.order_ts") <= F.col("e.event_time") + F.expr(f"INTERVAL {bound}")))
    return e.join(o, cond, "leftOuter").select(
        "e.event_id", "e.user_id", "e.event_date", "e.premium_amount", "o.order_id", "o.insurance_type",
        "o.policy_number", F.col("o.premium_amount").alias("order_premium_amount"))


def close_purchase_orders(emitted: DataFrame, purchases: DataFrame) -> DataFrame:
    """All purchases of a drained backfill: the emitted rows, and those still waiting when the source ended.

    The last purchases never see a watermark pass their bound; as no order can
    follow the end of the source, they close without one.
    """
    keys = ["event_id", "user_id", "event_date", "premium_amount"]
    done = emitted.select(F.col("event_id").alias("done_id"))
    waiting = purchases.select(*keys).join(done, F.col("event_id").eqNullSafe(F.col("done_id")), "left_anti")
    return emitted.unionByName(waiting, allowMissingColumns=True)


# ---- T7 -----------------------------------------------------------------------
def stream_upsert_users(spark: SparkSession, changes_stream: DataFrame, name: str = "users") -> str:
    """Dimension changes appended per epoch (idempotent); readers apply U7."""
    log = scratch_path(spark, f"{name}-changes")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/epoch={epoch}")

    _drain(changes_stream.writeStream.foreachBatch(write), name, spark)
    return log


def current_users(base: DataFrame, change_log: DataFrame) -> DataFrame:
    return maintain.upsert_users(base, change_log.select(*base.columns))


# ---- T8 -----------------------------------------------------------------------
def stream_freshness(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Per hour window: arrivals, newest event, staleness at the window's end."""
    w = (events.withWatermark("event_time", delay)
         .groupBy(F.window("event_time", "1 hour").alias("w"))
         .agg(F.count(F.lit(1)).alias("events"), F.max("event_time").alias("last_event_time")))
    return w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "events", "last_event_time",
                    F.timestamp_diff("SECOND", F.col("last_event_time"), F.col("w.end")).alias("staleness_seconds"))


def drain_updates(spark: SparkSession, agg: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Run an update-mode aggregate into per-epoch folders; latest row per key wins."""
    out = scratch_path(spark, f"{name}-updates")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _drain(agg.writeStream.outputMode("update").foreachBatch(write), name, spark)
    rows = spark.read.parquet(out)
    return maintain.latest_by(rows, keys, ["epoch"]).drop("epoch")


def drain_append(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream into a parquet sink and read the result back."""
    out = scratch_path(spark, f"{name}-sink")
    _drain(df.writeStream.format("parquet").option("path", out), name, spark)
    return spark.read.schema(df.schema).parquet(out)
