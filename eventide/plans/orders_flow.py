"""Product tables -> latest versions -> unified orders -> denormalised purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from eventide import AS_OF
from eventide.operators import orders as ops
from eventide.plans import etl
from eventide.sources import fixtures
from eventide.sources.tables import Tables


def unified(t: Tables, dedup: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    cols = tuple(columns) if columns is not None else None

    def build():
        o = t.orders
        base = fixtures.product_orders(o)
        return ops.unified_orders(fixtures.third_party_orders(o, base), fixtures.body_injury_orders(o, base),
                                  fixtures.medical_orders(o, base), fixtures.fire_orders(o, base), dedup=dedup,
                                  columns=cols)
    return t.memo(("unified", dedup, cols), build)


def payments(t: Tables) -> DataFrame:
    return t.memo(("payments",), lambda: fixtures.financial_orders(t.lineitem))


def denormalized_raw(t: Tables, as_of: str = AS_OF) -> DataFrame:
    """J3 output before the per-type dedup."""
    return ops.purchase_denormalized(etl.purchases(t, as_of), unified(t), payments(t), as_of)


def denormalized(t: Tables, as_of: str = AS_OF, columns: Sequence[str] | None = None) -> DataFrame:
    """U3 over J3: the denormalised purchase table the roll-ups read.

    Orders are first reduced to the one U3 keeps per (user, day, type), so
    the join never fans out (``orders.denormalize``).  With ``columns`` (see
    ``orders.READS``) only those, the dedup key and its order are carried
    through the joins and the dedups (U1, U3): a roll-up over four columns
    does not shuffle the 50-column row.
    """
    if columns is None:
        return t.memo(("denorm", as_of), lambda: ops.denormalize(
            etl.purchases(t, as_of), unified(t), payments(t), as_of))
    need = tuple(dict.fromkeys([*ops.DENORM_KEY, *ops.DENORM_ORDER, *columns]))
    return t.memo(("denorm", as_of, need), lambda: ops.denormalize(
        etl.purchases(t, as_of), unified(t, columns=ops.order_columns_for(need)), payments(t), as_of, need))


def run(t: Tables, as_of: str = AS_OF, root: str | None = None) -> dict[str, str]:
    """Write the denormalised purchases and their summary tables.

    The denormalised table is partitioned by (month, insurance_type), sorted
    by (event_date, event_id) inside files, with a bloom filter on
    policy_number; the two summaries (A5, A6) are written by month.
    """
    from eventide.session import scratch_path
    from eventide.sources.layout import write_partitioned
    root = root or scratch_path(t.spark, "order-denormalization")
    d = denormalized(t, as_of)
    paths = {"purchase_events_denormalized": f"{root}/purchase_events_denormalized",
             "insurance_type_summary": f"{root}/insurance_type_summary",
             "user_daily_summary": f"{root}/user_daily_summary"}
    write_partitioned(d, paths["purchase_events_denormalized"], "event_date", ("insurance_type",),
                      ("event_date", "event_id"), ("policy_number",))
    stored = t.spark.read.parquet(paths["purchase_events_denormalized"])
    write_partitioned(ops.insurance_type_summary(stored), paths["insurance_type_summary"], "event_date")
    write_partitioned(ops.user_daily_summary(stored), paths["user_daily_summary"], "event_date")
    return paths
