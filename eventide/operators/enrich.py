"""Dimension joins: enrichment, orphan and known-user checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def enrich_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Left join events to the user dimension on user_id (misses keep NULLs).

    No hint and no probe: Spark broadcasts the dimension when its size in bytes
    is below the session's threshold (statically or, by AQE, from the real
    shuffle size) and otherwise runs a shuffle join whose skew AQE splits.
    """
    return events.join(users.select("user_id", "signup_date", "city", "device_type"), on="user_id", how="left")


def orphan_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events whose user is absent from the dimension (left anti join)."""
    return events.join(users.select("user_id"), on="user_id", how="left_anti")


def known_user_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events whose user exists (left semi join)."""
    return events.join(users.select("user_id"), on="user_id", how="left_semi")
