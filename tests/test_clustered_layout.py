"""The clustered layout (U5, U6): rows kept, files skipped on both columns, row groups checked in the footers."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources import layout


@pytest.fixture(scope="module")
def rows(spark):
    """Users and days are independent; a third of the rows belong to one user, some columns are null."""
    n = 40_000
    user = F.when(F.col("id") % 3 == 0, 17).otherwise(F.xxhash64("id") % 5000)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).cast("int"))
    return spark.range(n).select("id", F.when(F.col("id") % 501 != 0, user).alias("user"),
                                 F.when(F.col("id") % 777 != 0, day).alias("day"), F.lit("x").alias("__curve"))


@pytest.fixture(scope="module")
def written(spark, rows):
    path = scratch_path(spark, "test-clustered")
    layout.write_clustered(rows, path, ("user", "day"), 64, ("id",))
    return path


def test_rows_are_kept(spark, rows, written):
    back = spark.read.parquet(written)
    assert back.columns == rows.columns
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0


@pytest.mark.parametrize("column,value", [("user", 4001), ("user", -3), ("day", "2024-05-05"), ("day", "2024-10-01")])
def test_most_row_groups_are_skipped(spark, written, column, value):
    table = spark.read.parquet(written)
    want = F.lit(value).cast(table.schema[column].dataType)
    share = layout.touched_share(layout.file_ranges(table, ("user", "day")), column, want)
    share = spark.range(1).select(share).first()[0]
    assert 0 < share <= 0.4
    groups = held = 0
    literal = spark.range(1).select(want).first()[0]
    for file in glob.glob(f"{written.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            held += stats.has_min_max and stats.min <= literal <= stats.max
    assert held / groups == pytest.approx(share)


def test_a_hot_value_is_split(spark, written):
    sizes = [r.rows for r in layout.file_ranges(spark.read.parquet(written), ("user",)).collect()]
    assert max(sizes) <= 3 * sum(sizes) / len(sizes)


def test_empty_table(spark, rows):
    path = scratch_path(spark, "test-clustered")
    layout.write_clustered(rows.limit(0), path, ("user", "day"), 8)
    assert spark.read.schema(rows.schema).parquet(path).count() == 0
