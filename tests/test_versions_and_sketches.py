"""Schema registry (D6) and mergeable quantiles (A4) on planted rows."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import quantile_sketches, schema_versions
from eventide.session import scratch_path

NESTED = "id long, a struct<x:int, y:array<struct<z:string>>>, m map<string, struct<v:double>>"


def test_fields_follow_structs_arrays_and_maps(spark):
    schema = spark.createDataFrame([], NESTED).schema
    assert [(p, t) for p, t, *_ in schema_versions.fields(schema)] == [
        ("id", "bigint"), ("a", "struct"), ("a.x", "int"), ("a.y", "array"), ("a.y[]", "struct"), ("a.y[].z", "string"),
        ("m", "map"), ("m{key}", "string"), ("m{value}", "struct"), ("m{value}.v", "double")]
    strict = T.StructType([T.StructField("l", T.ArrayType(T.LongType(), containsNull=False))])
    assert [n for _, _, n, _ in schema_versions.fields(strict)] == [True, False]


def test_versions_and_their_changes(spark):
    path = scratch_path(spark, "test-registry")
    at = datetime(2024, 1, 1)

    def deliver(rows, schema, table="t"):
        return schema_versions.register_delivery(spark.createDataFrame(rows, schema), path, table, at)

    assert schema_versions.registry(spark, path).count() == 0
    assert deliver([(1, (1, None), None)], NESTED) == 1
    assert deliver([(2, (5, None), None), (3, (6, None), None)], NESTED) == 1        # looks the same
    assert deliver([(1,)], "id int", "other") == 1                                    # tables are apart
    assert deliver([(2, (None, None), {"k": ("v",)}), (None, None, None)],
                   "id long, a struct<x:int, y:array<struct<z:string, `w.w`:int>>>, m map<string, struct<v:string>>") == 2
    assert deliver([(2,)], "id string") == 3
    assert deliver([(2, None)], "id string, `a.b` int") == 4                          # a dot in a name is no struct
    got = {(r.version, r.column_name, r.change_type, r.old_type, r.new_type, r.rows_affected, r.impact_level)
           for r in schema_versions.drift(schema_versions.registry(spark, path), essential=("id",)).collect()}
    lost = {("a", "struct", "medium"), ("a.x", "int", "medium"), ("a.y", "array", "medium"), ("a.y[]", "struct", "medium"),
            ("a.y[].z", "string", "medium"), ("a.y[].w.w", "int", "medium"), ("m", "map", "medium"), ("m{key}", "string", "high"),
            ("m{value}", "struct", "medium"), ("m{value}.v", "string", "medium")}
    assert got == {
        (2, "a.y[].w.w", "column_added", None, "int", 2, "low"), (2, "m{value}.v", "type_change", "double", "string", 2, "high"),
        (2, "id", "nullability_change", "bigint", "bigint", 1, "critical"), (2, "a", "nullability_change", "struct", "struct", 1, "medium"),
        (2, "a.x", "nullability_change", "int", "int", 2, "medium"),
        (3, "id", "type_change", "bigint", "string", 1, "critical"), (3, "id", "nullability_change", "bigint", "string", 0, "critical"),
        (4, "a.b", "column_added", None, "int", 0, "low")} | {
        (3, c, "column_removed", t, None, 1, level) for c, t, level in lost}


def test_empty_delivery(spark):
    path = scratch_path(spark, "test-registry")
    empty = spark.createDataFrame([], "id long, s struct<x:int>")
    assert schema_versions.register_delivery(empty, path, "t", datetime(2024, 1, 1)) == 1
    assert [(r.rows, r.null_rows, r.optional) for r in schema_versions.registry(spark, path).collect()] == [(0, 0, False)] * 3
    assert schema_versions.drift(schema_versions.registry(spark, path)).count() == 0


@pytest.fixture(scope="module")
def sessions(spark):
    """Two months; one day holds most sessions, one holds a null duration, one a single session."""
    rows = spark.range(60_000).select(
        F.expr("timestamp_ntz'2024-01-05 10:00:00' + make_interval(0, 0, 0, if(id % 3 = 0, id % 50, 0))").alias("first_event_time"),
        F.expr("if(id % 997 = 0, null, (id * id) % 86400)").alias("session_duration_seconds"),
        F.expr("cast(id % 7 = 0 as int)").alias("has_purchase"))
    lone = spark.sql("select timestamp_ntz'2024-05-01 00:00:00' as first_event_time, 7L as session_duration_seconds, 1 as has_purchase "
                     "union all select timestamp_ntz'2024-06-01 00:00:00', cast(null as bigint), 0")
    return rows.unionByName(lone)


def test_stored_sketches_merge_to_months(spark, sessions):
    path = scratch_path(spark, "test-sketches")
    quantile_sketches.daily_session_sketches(sessions.repartition(7)).write.parquet(path)
    got = quantile_sketches.period_report(sessions, spark.read.parquet(path)).collect()
    values = {}
    for r in sessions.collect():
        for kind, form in (("day", "%Y-%m-%d"), ("month", "%Y-%m")):
            values.setdefault((kind, r.first_event_time.strftime(form)), []).append(r)
    assert {(r.period_kind, r.period) for r in got} == set(values)
    for r in got:
        rows = values[r.period_kind, r.period]
        d = sorted(x.session_duration_seconds for x in rows if x.session_duration_seconds is not None)
        assert r.sessions == len(rows)
        assert math.isclose(r.conversion_rate, sum(x.has_purchase for x in rows) / len(rows), abs_tol=1e-6)
        if not d:
            assert (r.avg_session_duration, r.p95_estimate, r.p95_exact, r.rank_error) == (None, None, None, None)
            continue
        assert math.isclose(r.avg_session_duration, sum(d) / len(d), abs_tol=1e-4)
        below, upto = (sum(x < r.p95_estimate for x in d) / len(d), sum(x <= r.p95_estimate for x in d) / len(d))
        assert math.isclose(r.rank_error, max(0, below - 0.95, 0.95 - upto), abs_tol=1e-9)
        assert r.rank_error <= quantile_sketches.RANK_ERROR
        at = 0.95 * (len(d) - 1)
        lo, hi = d[math.floor(at)], d[math.ceil(at)]
        assert math.isclose(r.p95_exact, lo + (hi - lo) * (at - math.floor(at)), abs_tol=1e-3)


def test_day_rows_are_the_only_input_of_a_month(spark, sessions):
    path = scratch_path(spark, "test-sketches")
    quantile_sketches.daily_session_sketches(sessions).write.parquet(path)
    month = quantile_sketches.merged_periods(spark.read.parquet(path), "month")
    plan = month._jdf.queryExecution().optimizedPlan().toString()
    assert "session_duration_seconds" not in plan and "Expand" not in plan
