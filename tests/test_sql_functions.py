"""SQL-defined checks: nulls, empty tables and repeated registration."""

from eventide import AS_OF
from eventide.functions import sql_functions


def test_functions_on_awkward_values(spark):
    sql_functions.register(spark)
    sql_functions.register(spark)
    row = spark.sql("""
        SELECT complete_record(array('a', 'b')) AS both, complete_record(array('a', '')) AS blank,
               complete_record(array('a', NULL)) AS gone, complete_record(NULL) AS none,
               outside_fences(10, 1, 2, 1.5) AS far, outside_fences(3, 1, 2, 1.5) AS near, outside_fences(NULL, 1, 2, 1.5) AS unknown,
               sync_status(300, 300, 3600) AS a, sync_status(3600, 300, 3600) AS b, sync_status(NULL, 300, 3600) AS c""").first()
    assert tuple(row) == (1, 0, 0, 0, True, False, False, "synced", "lagging", "critical_lag")


def test_empty_events(spark):
    events = spark.createDataFrame([], "event_id string, event_type string, event_time timestamp_ntz, premium_amount double, "
                                       "user_id long, session_id string, city string, device_type string")
    assert sql_functions.outliers(events).count() == 0
    assert sql_functions.completeness(events, "t").first().total_records == 0
    row = sql_functions.freshness(events, AS_OF, "s", "t").first()
    assert row.lag_seconds is None and row.records_behind == 0 and row.status == "critical_lag"
