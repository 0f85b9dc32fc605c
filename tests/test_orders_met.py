"""Stored purchases: only orders that can meet one are reduced and joined, with the same rows."""

from eventide import AS_OF
from eventide.operators import orders
from eventide.plans import etl, orders_flow
from eventide.sources.tables import Tables


def test_denormalised_rows_are_those_of_all_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p, o, f = etl.purchases(t, AS_OF), orders_flow.unified(t), orders_flow.payments(t)
    met = orders.orders_met(o, p)
    assert met.columns == o.columns and 0 < met.count() < o.count()
    got, want = orders.denormalize(p, met, f, AS_OF), orders.denormalize(p, o, f, AS_OF)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_null_keys_meet_nothing(spark):
    o = spark.createDataFrame([(1, None, "2024-01-01"), (2, 5, None), (3, 5, "2024-01-01"), (4, 5, "2024-01-02")],
                              "order_id long, user_id long, order_date string")
    p = spark.createDataFrame([(None, "2024-01-01"), (5, None), (5, "2024-01-01"), (5, "2024-01-01")], "user_id long, event_date string")
    assert [r.order_id for r in orders.orders_met(o, p).collect()] == [3]
