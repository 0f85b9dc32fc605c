"""Reading the given parquet tables.

Scans stay lazy so Catalyst prunes columns and pushes filters into the
parquet reader (``ReadSchema`` / ``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).events``.

    Each table is opened once (file listing and footer read) and the same
    DataFrame is reused by every plan built from this accessor.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._opened: dict[str, DataFrame] = {}
        self._built: dict[tuple, DataFrame] = {}

    def memo(self, key: tuple, build):
        """Build a derived plan once per accessor and reuse the same DataFrame."""
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._opened:
                self._opened[name] = table(self.spark, self.sf_dir, name)
            return self._opened[name]
        raise AttributeError(name)
