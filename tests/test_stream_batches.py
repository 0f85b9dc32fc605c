"""Streams pay a batch's fixed cost a bounded number of times, however many files and shuffle partitions there are."""

import glob

import pytest

from eventide.plans.registry import raw_queries
from eventide.session import checkpoint_root
from eventide.streaming import stateful, streams


def _conf(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    return before


@pytest.mark.parametrize("query, batches", [("stream_dedup", 6), ("stream_daily_metrics", 4), ("stream_purchase_payments", 9),
                                            ("stream_session_metrics", 6), ("stream_ingest", 4)])
def test_batches_do_not_follow_the_shuffle_partitions(spark, sf_dir, query, batches):
    logs = f"{checkpoint_root(spark)}/eventide/*-checkpoint-*/commits/[0-9]*".removeprefix("file:")
    before, partitions = set(glob.glob(logs)), _conf(spark, "spark.sql.shuffle.partitions", "30")
    try:
        rows = raw_queries()[query](spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert rows > 0
    assert 4 <= len(set(glob.glob(logs)) - before) <= batches


def test_batch_and_state_sizes_follow_the_bytes(spark, monkeypatch):
    path = streams.stage(spark.range(6_000).withColumnRenamed("id", "offset"), "sized", "offset", files=60)
    assert streams.batch_files(spark, path) == 15                   # a small source: four batches
    size = sum(f.getLen() for f in streams._parts(spark, path)[1])
    monkeypatch.setattr(streams, "BATCH_BYTES", size // 10)
    assert streams.batch_files(spark, path) in (5, 6)               # a larger one: by its bytes
    before = _conf(spark, "spark.sql.shuffle.partitions", "64")
    try:
        assert streams.state_partitions(spark, path) == 2 * spark.sparkContext.defaultParallelism
        monkeypatch.setattr(streams, "STATE_BYTES", size // 20)
        assert streams.state_partitions(spark, path) in (20, 21)
        monkeypatch.setattr(streams, "STATE_BYTES", 1)
        assert streams.state_partitions(spark, path) == 64
        with stateful.rocksdb_state(spark, 5):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
