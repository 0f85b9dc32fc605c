"""The sort aggregate of latest_by gets partitions of a fixed size, and filters on its keys still reach the scan."""

from eventide.operators import maintain


def test_rows_are_dealt_before_the_sort_aggregate(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = [("hot", i % 7, i) for i in range(3_000)] + [(f"k{i}", 1, i) for i in range(50)] + [(None, 2, 5), (None, 1, 6), ("n", None, 1)]
    spark.createDataFrame(rows, "k string, v int, w int").repartition(4).write.parquet(path)
    last = maintain.latest_by(spark.read.parquet(path), ["k"], ["v"])
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RebalancePartitions")
    got = {r.k: (r.v, r.w) for r in last.collect()}
    assert got == {"hot": (6, 2995), None: (2, 5), "n": (None, 1)} | {f"k{i}": (1, i) for i in range(50)}
    assert "EqualTo(k,hot)" in last.filter("k = 'hot'")._jdf.queryExecution().executedPlan().toString()
