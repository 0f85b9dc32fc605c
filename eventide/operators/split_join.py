"""Equi-joins whose hot left keys are dealt over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import written_once

HOT_ROWS = 1024     # left rows of one key that are joined in one piece


def split_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str, spread_by: str,
               hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``left`` (alias e) joined to ``right`` (alias o) on pairs of columns; ``how`` is "inner" or "left".

    Keys with more than ``hot_rows`` left rows are found by one aggregation of
    the left keys.  Their left rows are dealt into pieces by a hash of
    ``spread_by``, and their right rows are repeated for every piece, so a
    left row still meets all right rows of its key, exactly once.  Without
    such keys, or with ``hot_rows`` None (for a right side of few rows a key),
    this is the plain join.  Null keys match nothing, as in any equi-join.
    """
    cond = [F.col(f"e.{a}") == F.col(f"o.{b}") for a, b in on]
    plain = left.alias("e").join(right.alias("o"), cond, how)
    if hot_rows is None:
        return plain
    keys = [f"__hot{i}" for i in range(len(on))]
    hot = (left.groupBy(*(F.col(a).alias(k) for (a, _), k in zip(on, keys)))
           .agg(F.ceil(F.count("*") / hot_rows).cast("int").alias("__pieces"))
           .filter("__pieces > 1").dropna())
    if hot.isEmpty():
        return plain
    hot = written_once(hot)
    none = F.col("__pieces").isNull()
    dealt = F.pmod(F.xxhash64(spread_by), F.col("__pieces")).cast("int")
    e = (left.join(hot, [F.col(a) == F.col(k) for (a, _), k in zip(on, keys)], "left")
         .withColumn("__piece", F.when(none, F.lit(0)).otherwise(dealt)).drop("__pieces", *keys))
    o = (right.join(hot, [F.col(b) == F.col(k) for (_, b), k in zip(on, keys)], "left")
         .withColumn("__piece", F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)))
         .drop("__pieces", *keys))
    cond.append(F.col("e.__piece") == F.col("o.__piece"))
    return e.alias("e").join(o.alias("o"), cond, how).drop(F.col("e.__piece"), F.col("o.__piece"))
