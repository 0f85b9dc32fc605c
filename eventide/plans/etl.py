"""Raw events -> cleaned, enriched, derived processed events.

One lazy plan: decode -> clean (P1) -> enrich (J1) -> derive (P2) -> final
select (P4/P5).  The caller runs one action to write it and one for the null
profile (A14), instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventide import AS_OF
from eventide.operators.clean import (clean_events, derive_event_attributes,
                                      finalize_processed, warehouse_events)
from eventide.operators.enrich import enrich_events
from eventide.sources import fixtures
from eventide.sources.tables import Tables


def transform_enrich(raw: DataFrame, users: DataFrame, as_of: str = AS_OF) -> DataFrame:
    cleaned = clean_events(raw)
    enriched = enrich_events(cleaned, users)
    return finalize_processed(derive_event_attributes(enriched), as_of)


def processed_events(t: Tables, as_of: str = AS_OF) -> DataFrame:
    """Processed events from the given tables (the ETL output)."""
    def build():
        raw = fixtures.raw_events(t.events)
        users = fixtures.users(t.customer, t.nation)
        return transform_enrich(raw, users, as_of)
    return t.memo(("processed", as_of), build)


def stored_events(t: Tables, as_of: str = AS_OF) -> DataFrame:
    """Warehouse events: processed events after consumer normalisation."""
    return t.memo(("stored", as_of), lambda: warehouse_events(processed_events(t, as_of), as_of))


def purchases(t: Tables, as_of: str = AS_OF) -> DataFrame:
    """Purchase events only (pushed below the order joins)."""
    from pyspark.sql import functions as F
    return stored_events(t, as_of).filter(F.col("event_type") == "purchase")
