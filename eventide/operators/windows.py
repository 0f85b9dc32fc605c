"""Window operators that must not collapse into one task.

``global_next`` is a ``lead`` over a total order of the whole table.  A plain
``Window.orderBy`` moves every row into one partition; instead rows are
range-partitioned on the order (sampling balances the ranges, so a burst of
rows at one instant is still split), sorted within partitions, and a single
Arrow-batched pass per partition computes the next value.  Only the first row
of each partition crosses partition borders: a table with one row per
partition (bounded by the partition count) supplies the successor of each
partition's last row through a broadcast join.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import seconds_between
from eventide.session import scratch_path


def written_once(df: DataFrame) -> DataFrame:
    """The frame, written to the shared scratch folder and read again, so that every use sees the same rows."""
    path = scratch_path(df.sparkSession, "ranged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _local_next(value_col: str, out_col: str):
    """Per sorted partition: next value within the partition; mark edge rows.

    Batches stream through with one row held back, so a partition is never
    materialised whole in Python.
    """
    def run(batches):
        held = None
        first = True
        for pdf in batches:
            if pdf.empty:
                continue
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            pdf[out_col] = pdf[value_col].shift(-1)
            pdf["_edge"] = False
            if first:
                pdf.loc[0, "_edge"] = True
                first = False
            held = pdf.iloc[[-1]].drop(columns=[out_col, "_edge"])
            yield pdf.iloc[:-1]
        if held is not None:
            last = held.copy()
            last[out_col] = pd.NaT if pd.api.types.is_datetime64_any_dtype(last[value_col]) else None
            last["_edge"] = True
            yield last
    return run


def global_next(df: DataFrame, order: Sequence[str], value_col: str, out_col: str,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the next row in the total ``order``.

    ``order`` must be unique (e.g. (event_time, event_id)).  The last row of
    the whole table gets NULL.  The ranged rows are written once and read for
    both uses: range bounds are sampled per exchange, so edge rows are only
    those of the rows they are joined to if both come from one exchange.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    vtype = df.schema[value_col].dataType
    schema = T.StructType(list(df.schema.fields) + [
        T.StructField(out_col, vtype, True), T.StructField("_edge", T.BooleanType(), False)])
    local = written_once(ranged.mapInPandas(_local_next(value_col, out_col), schema))
    # at most two rows per partition: one task and a broadcast are bounded by n
    edges = local.filter("_edge").select(*order, F.col(value_col).alias("_v"))
    stitch = (edges.withColumn("_carry", F.lead("_v").over(Window.orderBy(*order)))
              .select(*[F.col(c).alias(f"_k_{c}") for c in order], "_carry"))
    cond = [F.col(c) == F.col(f"_k_{c}") for c in order]
    out = local.join(F.broadcast(stitch), cond, "left")
    return (out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_carry")))
            .drop("_edge", "_carry", *[f"_k_{c}" for c in order]))


def event_gaps(events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Every event with the next event time (global order) and the gap in seconds."""
    base = events.select("event_id", "event_time")
    nxt = global_next(base, ["event_time", "event_id"], "event_time", "next_event_time", num_partitions)
    return nxt.withColumn("gap_seconds", seconds_between(F.col("event_time"), F.col("next_event_time")))


def bucket_bounds(events: DataFrame, ts_col: str = "event_time", unit: str = "hour", by: str | None = None) -> DataFrame:
    """First and last event time per time bucket, or per value of ``by`` and bucket (partial aggregation)."""
    keys = [by] if by else []
    return (events.groupBy(*keys, F.date_trunc(unit, ts_col).cast("timestamp_ntz").alias("bucket"))
            .agg(F.min(ts_col).alias("first_time"), F.max(ts_col).alias("last_time")))


def gaps_over(events: DataFrame, min_gap_seconds: int, ts_col: str = "event_time",
              by: str | None = None) -> DataFrame:
    """Gaps between consecutive events longer than ``min_gap_seconds`` (>= 3600).

    With ``by``, also the gaps inside each value of that column: ``scope`` is
    'any' for all events together, else the value.  All scopes come from one
    pass, since the hours of all events follow from the hours of the values.

    A gap longer than an hour cannot lie inside one hour bucket, so it always
    runs from the last event of one non-empty hour to the first event of the
    next non-empty hour.  Events are reduced to one row per hour first; the
    ordered window then runs over that table, whose size is bounded by the
    time span (hours), not by the data volume.
    """
    if min_gap_seconds < 3600:
        raise ValueError("use event_gaps for thresholds under one hour")
    if by is None:
        b = bucket_bounds(events, ts_col).withColumn("scope", F.lit("any"))
    else:
        hours = bucket_bounds(events, ts_col, by=by)
        b = (hours.select(F.explode(F.array(F.lit("any"), F.col(by))).alias("scope"), "bucket", "first_time", "last_time")
             .groupBy("scope", "bucket").agg(F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")))
    w = Window.partitionBy("scope").orderBy("bucket")
    return (b.withColumn("gap_end", F.lead("first_time").over(w))
            .select("scope", F.col("last_time").alias("gap_start"), "gap_end")
            .withColumn("gap_seconds", seconds_between(F.col("gap_start"), F.col("gap_end")))
            .filter(F.col("gap_seconds") > min_gap_seconds))


def _local_running(key_col: str, order: Sequence[str], weight_col: str | None):
    """Per sorted partition: running sum of ``weight_col`` (1 per row when None)
    within ``key_col`` runs, carried across batches; every row also carries its
    partition's first (key, order...) as a tag."""
    tag_cols = [f"_pf_{c}" for c in (key_col, *order)]

    def run(batches):
        prev_key, prev_total, tag = None, 0, None
        for pdf in batches:
            if pdf.empty:
                continue
            if tag is None:
                tag = [pdf[c].iloc[0] for c in (key_col, *order)]
            keys = pdf[key_col]
            new_run = keys.ne(keys.shift(1))
            if prev_key is not None:
                new_run.iloc[0] = keys.iloc[0] != prev_key
            run_id = new_run.cumsum()
            w = pdf[weight_col].astype("int64") if weight_col else pd.Series(1, index=pdf.index, dtype="int64")
            total = w.groupby(run_id).cumsum()
            if prev_key is not None and not new_run.iloc[0]:
                total = total.where(run_id != run_id.iloc[0], total + prev_total)
            pdf["_local_total"] = total.astype("int64")
            for c, v in zip(tag_cols, tag):
                pdf[c] = v
            prev_key, prev_total = keys.iloc[-1], int(pdf["_local_total"].iloc[-1])
            yield pdf
    return run, tag_cols


def running_sum_within(df: DataFrame, key_col: str, order: Sequence[str], out_col: str,
                       weight_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """``sum(weight) OVER (PARTITION BY key ORDER BY order ROWS UNBOUNDED PRECEDING)``
    (a running count when ``weight_col`` is None) without one task per key.

    ``(key, order)`` must be unique and ``key_col`` non-NULL; weights are
    non-negative integers.  Rows are range-partitioned on (key, order), so a
    key holding a third of the table is spread over many tasks.  Each
    partition sums its rows; a key that crosses partition borders gets, in
    each later partition, an offset equal to its total in the earlier
    partitions.  The offsets come from running sums over a summary with one
    row per partition (first key, last key, total of the last key), bounded
    by the partition count.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [key_col, *order]
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    fn, tag_cols = _local_running(key_col, order, weight_col)
    schema = T.StructType(list(df.schema.fields)
                          + [T.StructField("_local_total", T.LongType(), False)]
                          + [T.StructField(t, df.schema[c].dataType, True) for t, c in zip(tag_cols, cols)])
    local = written_once(ranged.mapInPandas(fn, schema))    # one exchange for the rows and their summary
    # summary per partition (identified by its first row): the last key and its total there
    last = F.max(F.struct(*[F.col(c) for c in cols], F.col("_local_total").alias("r")))
    summary = (local.groupBy(*tag_cols).agg(last.alias("_last"))
               .select(*tag_cols, F.col(f"_last.{key_col}").alias("_last_key"), F.col("_last.r").alias("_last_n")))
    # Offset of a partition's first key = its total in earlier partitions.  Those
    # are the partitions ending with that key, and they form a chain right
    # before it (everything between two rows of a key is that key), so a running
    # sum over chains of equal last keys gives it; no pairs of partitions are
    # formed.  The summary has one row per partition: one task and a broadcast
    # are bounded by the partition count.
    by_tag = Window.orderBy(*tag_cols)
    chains = (summary
              .withColumn("_new", F.coalesce(F.col("_last_key") != F.lag("_last_key").over(by_tag), F.lit(True)))
              .withColumn("_chain", F.sum(F.col("_new").cast("long")).over(by_tag)))
    in_chain = Window.partitionBy("_chain").orderBy(*tag_cols)
    carried = (chains.withColumn("_chain_total", F.sum("_last_n").over(in_chain))
               .withColumn("_prev_key", F.lag("_last_key").over(by_tag))
               .withColumn("_prev_total", F.lag("_chain_total").over(by_tag))
               .select(*tag_cols, F.when(F.col("_prev_key") == F.col(tag_cols[0]), F.col("_prev_total"))
                       .alias("_offset")))
    j = local.join(F.broadcast(carried), tag_cols, "left")
    first_run = F.col(key_col) == F.col(tag_cols[0])
    return (j.withColumn(out_col, F.col("_local_total")
                         + F.when(first_run, F.coalesce(F.col("_offset"), F.lit(0))).otherwise(0))
             .drop("_local_total", "_offset", *tag_cols))


def rank_within(df: DataFrame, key_col: str, order: Sequence[str], out_col: str = "seq_no",
                num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order)`` without one task per key
    (a running count, see ``running_sum_within``)."""
    return running_sum_within(df, key_col, order, out_col, None, num_partitions)


def exact_percentiles(df: DataFrame, value_col: str, probs: dict[str, float],
                      group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Exact percentiles per group, interpolated like ``percentile``/``percentile_cont``.

    For n non-NULL values sorted v[0..n-1], p sits at position (n - 1) * p
    between v[floor] and v[ceil].  Values are first counted per (group,
    value) (partial aggregation; the shuffle key includes the value, so a hot
    group spreads over many tasks).  A skew-safe running sum of the counts
    gives every distinct value the positions it covers; the two values at
    floor and ceil are picked by an aggregate.  No group's values are ever
    gathered into one task, unlike the per-group count map of ``percentile``.
    Returns one row per group: the group columns and one column per name in ``probs``.
    """
    v = F.col(value_col)
    gkey = F.to_json(F.struct(*[F.col(c) for c in group_cols])) if group_cols else F.lit("{}")
    counts = (df.filter(v.isNotNull())
              .groupBy(*group_cols, v.cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_g", gkey))  # one text key per (group, value) row, not per input row
    cum = running_sum_within(counts, "_g", ["_v"], "_cum", "_c", num_partitions)
    totals = counts.groupBy("_g").agg(F.sum("_c").alias("_n"))
    j = cum.join(totals, "_g")
    first, last = F.col("_cum") - F.col("_c"), F.col("_cum") - 1
    aggs, outs = [], []
    for i, (name, p) in enumerate(probs.items()):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((first <= lo) & (lo <= last), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when((first <= hi) & (hi <= last), F.col("_v"))).alias(f"_hi{i}")]
        vlo, vhi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.when(hi == lo, vlo).otherwise((hi - pos) * vlo + (pos - lo) * vhi).alias(name))
    picked = j.groupBy(*group_cols, "_g", "_n").agg(*aggs)
    return picked.select(*group_cols, *outs)
