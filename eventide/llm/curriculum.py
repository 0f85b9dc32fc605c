"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Targets.  Sources in code-point order (null last) take the weights of a cycle
and share the words of the whole corpus by weight; a source stops at
``max_repeat`` times its own words and the excess is shared again, which the
sorted prefix sums of the caps solve in closed form.

Order inside a source.  Documents of a source follow each other in the order of
an MD5 of id, source and text; the words before a document come from two-level
prefix sums (totals of MD5 buckets, then inside a bucket; at least 4,096 buckets
a source, more where the table is large), so that one source may hold any share
of the rows.  Copy e of a document occupies words
``e * source_size + prefix`` onward; the mix takes the words below the target,
so the last document of a source may be taken in part.

Positions.  Each source has a schedule, a piecewise-linear weight over training
time 0..1.  Its integral, scaled to the target, is the words the source must
have delivered by then; inverting it at a copy's first word gives the copy's
training position.  ``training_order`` range-sorts the copies by position.

Defined results: null and empty texts have size 0 and are never taken; rows
with a null source form one source; rows equal in id, source and text follow
each other in the order of a hash of all their columns in ``training_order``, and
are interchangeable elsewhere; rows equal in all columns are each taken; an
empty table gives an empty result; other columns, whatever their names, are
carried by ``training_order`` and not read by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.components import written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 1 << 20       # rows of a bucket aimed at where one source holds everything
#: (time, weight) knots of each weight's schedule: heavy sources fade, light ones rise at the end.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0)))


def _segments(schedules) -> Column:
    """Array of schedules, each an array of segments with the normalised integral before and after."""
    out = []
    for knots in schedules:
        area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        done, segs = 0.0, []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            end = done + (t1 - t0) * (w0 + w1) / 2 / area
            segs.append(F.struct(*(F.lit(float(v)).alias(k) for k, v in (
                ("t0", t0), ("t1", t1), ("w0", w0 / area), ("slope", (w1 - w0) / area / (t1 - t0)),
                ("a0", done), ("a1", end)))))
            done = end
        out.append(F.array(*segs))
    return F.array(*out)


def _time_at(share: Column, segments: Column) -> Column:
    """Time at which a schedule has delivered this share of its demand."""
    inside = F.filter(segments, lambda s: share < s["a1"])
    seg = F.coalesce(F.get(inside, F.lit(0)), F.element_at(segments, -1))
    rest = share - seg["a0"]
    under = seg["w0"] + F.sqrt(F.greatest(seg["w0"] * seg["w0"] + 2 * seg["slope"] * rest, F.lit(0.0)))
    return F.when(under > 0, seg["t0"] + 2 * rest / under).otherwise(seg["t0"])


def _targets(sources: DataFrame, weights, max_repeat: int) -> DataFrame:
    """sources (source, source_size) -> with rank, weight, target.  One row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = (sources.withColumn("rank", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                 (F.col("rank") % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * max_repeat))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    level = (ranked
             .withColumn("room", F.sum("source_size").over(everything) - F.coalesce(
                 F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("share", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("full", F.col("cap") * F.col("share") <= F.col("weight") * F.col("room"))
             .withColumn("level", F.max(F.when(~F.col("full"), F.col("room") / F.col("share"))).over(everything)))
    return level.select("source", "source_size", "rank", F.when(F.col("full"), F.col("cap").cast("double"))
                        .otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT,
        tie: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target, taken, and its copies.

    ``copies`` lists (copy, words, position) of every copy that the mix takes;
    ``key`` is the MD5 of id, source and text.  ``tie`` orders rows of equal key
    and is returned with the row.
    """
    spark = docs.sparkSession
    text, source = F.coalesce("text", F.lit("")), F.col("source").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                       F.coalesce(source, F.lit("")), F.lit(":"), text)).alias("key"),
        *([] if tie is None else [tie.alias("tie")]))
    ties = [] if tie is None else ["tie"]
    sized = written(spark, sized, "mix")
    digits = max(3, math.ceil(math.log(max(1, sized.count() / BUCKET_ROWS), 16)))
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    buckets = buckets.withColumn("bucket0", F.coalesce(F.sum("bucket_size").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sources = _targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeat)
    starts = written(spark, buckets.alias("b").join(sources.alias("s"), F.expr("b.source <=> s.source")).select(
        "b.source", "bucket", "bucket0", "source_size", "rank", "target"), "mix")
    inside = Window.partitionBy("source", "bucket").orderBy("key", *ties).rowsBetween(Window.unboundedPreceding, 0)
    rows = (sized.withColumn("run", F.sum("size").over(inside)).alias("d")
            .join(starts.alias("s"), F.expr("d.source <=> s.source and d.bucket = s.bucket"))
            .select("doc_id", "d.source", "key", *ties, "size", "source_size", "target", "rank",
                    (F.col("bucket0") + F.col("run") - F.col("size")).alias("before")))
    want = F.floor(F.col("target") + 0.5)
    segments = F.element_at(_segments(schedules), (F.col("rank") % len(schedules) + 1).cast("int"))

    def copy(e):
        at = F.col("before") + e * F.col("source_size")
        words = F.greatest(F.lit(0), F.least("size", want - at))
        return F.struct(F.lit(e).alias("copy"), words.cast("long").alias("words"),
                        _time_at(at / want, segments).alias("position"))

    copies = F.filter(F.array(*(copy(e) for e in range(max_repeat))), lambda c: c["words"] > 0)
    return rows.withColumn("copies", copies).select(
        "doc_id", "source", "key", *ties, "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"), "copies")


def range_sorted(df: DataFrame, *order: str) -> DataFrame:
    """Rows in global order, range-partitioned by it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The columns of docs, one row per copy in training order.

    A copy that the mix takes in part stays, whole, if at least half of its
    words are taken.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    row = F.md5(F.to_json(F.struct(*columns), {     # equal only where every column is
        "ignoreNullFields": "false", "timestampFormat": stamp + "XXX", "timestampNTZFormat": stamp}))
    # rows equal in all columns are interchangeable: their copies meet one of them
    copies = (mix(docs, tie=row, **options).select("tie", "key", "size", F.explode("copies").alias("c"))
              .filter("2 * c.words >= size").select("tie", "key", "c.position"))
    rows = docs.select(row.alias("tie"), F.struct(*columns).alias("row")).dropDuplicates(["tie"])
    return range_sorted(copies.join(rows, "tie"), "position", "key", "tie").select("row.*")
