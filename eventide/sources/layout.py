"""Month-partitioned, prune-friendly table layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import month_key


def with_month(df: DataFrame, date_col: str, name: str = "month") -> DataFrame:
    return df.withColumn(name, month_key(F.col(date_col)))


def write_partitioned(df: DataFrame, path: str, date_col: str,
                      extra_partitions: tuple[str, ...] = (),
                      sort_cols: tuple[str, ...] = (),
                      bloom_cols: tuple[str, ...] = (),
                      mode: str = "overwrite") -> None:
    """Write by (month, extra...) with sorted files and bloom filters.

    Rows are clustered by the partition columns with a REBALANCE (not a
    plain ``repartition``, which would send a whole month to one task): AQE
    splits an oversized partition value over several tasks and merges small
    ones, so each task writes few files of the advisory size.  Inside a task
    rows are sorted by the partition columns, then ``sort_cols``, so the
    writer adds no sort of its own and row-group min/max statistics prune
    range filters.  Bloom filters serve point lookups.  Partition overwrite is
    dynamic: only the partitions present are replaced.
    """
    parts = ["month", *extra_partitions]
    out = (with_month(df, date_col).hint("rebalance", *parts)
           .sortWithinPartitions(*parts, *sort_cols))
    w = out.write.mode(mode).partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
    for c in bloom_cols:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def space_key(df: DataFrame, columns: tuple[str, ...], bits: int = 6) -> Column:
    """Position of a row on a bit-interleaved (Z) curve over the value ranks of some columns.

    A column's values are cut at 2^bits - 1 approximate quantiles (one aggregate;
    only these borders reach the driver), so skewed values still spread over the
    curve; a value that fills several of these ranges stands in their middle, apart
    from its neighbours; nulls rank first.  Columns: numbers, dates or timestamps.
    """
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    borders = df.agg(*[F.percentile_approx(_ranked(df, c), shares, 10_000) for c in columns]).first()
    key = F.lit(0).cast("bigint")
    for j, (c, cuts) in enumerate(zip(columns, borders)):
        cuts, value = cuts or [], _ranked(df, c)
        rank = F.shiftright(_count(cuts, lambda b: b < value) + _count(cuts, lambda b: b <= value), 1)
        for bit in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + j))
    return key


def _count(borders: list[float], test: Callable[[Column], Column]) -> Column:
    known = F.array(*map(F.lit, borders)).cast("array<double>")
    return F.coalesce(F.size(F.filter(known, test)), F.lit(0))


def _ranked(df: DataFrame, column: str) -> Column:
    """A number that orders the values of a column."""
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def write_clustered(df: DataFrame, path: str, columns: tuple[str, ...], files: int, ties: tuple[str, ...] = ()) -> None:
    """Files of near-equal size along the curve, so that a lookup on any of the columns skips most of them.

    ``ties`` splits a cell that holds many rows of equal values over several files.
    """
    name = "__curve"
    while name in df.columns:
        name += "_"
    out = df.withColumn(name, space_key(df, columns))
    out = out.repartitionByRange(files, name, *columns, *ties).sortWithinPartitions(name, *columns, *ties)
    out.drop(name).write.parquet(path)


def file_ranges(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows and least and greatest value of some columns in every file of a written table (reads those columns only)."""
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def touched_share(ranges: DataFrame, column: str, value: Column) -> Column:
    """Scalar: share of the files whose range of a column holds a value; the reader skips the others."""
    return ranges.agg(F.count_if(value.between(F.col(f"min_{column}"), F.col(f"max_{column}"))) / F.count(F.lit(1))).scalar()
