"""Schema drift over versions (D6): a registry of what each delivery of a table looked like, and its changes.

A delivery is described by its fields, nested ones included, and by what its
rows hold: structs are followed as ``a.b``, array elements as ``a[]``, map keys
and values as ``a{key}`` and ``a{value}``; a parent's type is only its kind, so that
a change inside it is reported where it happens.  A field is optional in a
version if a row holds null there (inside arrays and maps: if the schema allows
it), since files of most formats declare every column nullable.  A delivery
that looks like the last version adds none.

Only field lists, bounded by the width of the table, reach the driver; a
delivery costs one aggregate over its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.quality import HIGH_IMPACT

REGISTRY = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("registered_at", T.TimestampNTZType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("optional", T.BooleanType()),
    T.StructField("null_rows", T.LongType()),
    T.StructField("rows", T.LongType()),
])


def fields(typ: T.DataType, path: str = "", at: Column | None = None,
           nullable: bool = True) -> Iterator[tuple[str, str, bool, Column | None]]:
    """(path, type, nullable, column) of a type and of everything inside it; no column inside arrays and maps."""
    if path:
        yield path, typ.typeName() if isinstance(typ, (T.StructType, T.ArrayType, T.MapType)) else typ.simpleString(), nullable, at
    if isinstance(typ, T.StructType):
        for f in typ.fields:
            if not path:
                inner = F.col(f"`{f.name}`")
            else:
                inner = None if at is None else at[f.name]
            yield from fields(f.dataType, f"{path}.{f.name}" if path else f.name, inner, f.nullable)
    elif isinstance(typ, T.ArrayType):
        yield from fields(typ.elementType, f"{path}[]", None, typ.containsNull)
    elif isinstance(typ, T.MapType):
        yield from fields(typ.keyType, f"{path}{{key}}", None, False)
        yield from fields(typ.valueType, f"{path}{{value}}", None, typ.valueContainsNull)


def describe(df: DataFrame) -> list[tuple[str, str, bool, int | None, int]]:
    """(column_name, type, optional, null_rows, rows) of every field of a delivery."""
    found = list(fields(df.schema))
    counted = [c for *_, c in found if c is not None]
    seen = df.agg(F.count(F.lit(1)), *[F.count_if(c.isNull()) for c in counted]).first()
    rows, nulls = seen[0], iter(seen[1:])
    out = []
    for path, typ, nullable, column in found:
        n = None if column is None else next(nulls)
        out.append((path, typ, nullable if n is None else n > 0, n, rows))
    return out


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table; empty before the first delivery."""
    try:
        return spark.read.schema(REGISTRY).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY)


def register_delivery(df: DataFrame, path: str, table: str, at) -> int:
    """Describe a delivery and append a version unless it looks like the last one; returns its version.

    One writer a table at a time.  ``at`` is the time of the delivery (a datetime).
    """
    spark = df.sparkSession
    now = describe(df)
    known = registry(spark, path).filter(F.col("table_name") == table)
    last = known.agg(F.max("version")).first()[0] or 0
    before = known.filter(F.col("version") == last).select("column_name", "type", "optional").collect()
    if last and {tuple(r) for r in before} == {(c, t, o) for c, t, o, _, _ in now}:
        return last
    rows = [(table, last + 1, at, c, t, o, n, total) for c, t, o, n, total in now]
    spark.createDataFrame(rows, REGISTRY).coalesce(1).write.mode("append").parquet(path)
    return last + 1


def drift(versions: DataFrame, essential: Sequence[str] = HIGH_IMPACT) -> DataFrame:
    """Changes of each version against the one before it, a row per field and kind of change.

    rows_affected: rows with a value (added), rows of the delivery (removed,
    type), null rows (nullability; unknown inside arrays and maps).  Impact:
    critical for essential fields; high for a new type or the loss of a field
    that always had a value; medium for nullability and the loss of an optional
    field; low for additions.
    """
    new = versions.alias("n")
    old = versions.select("table_name", (F.col("version") + 1).alias("version"), "column_name", "type", "optional").alias("o")
    heads = versions.groupBy("table_name", "version").agg(
        F.first("registered_at").alias("change_time"), F.first("rows").alias("delivered")).filter("version > 1")
    both = (new.join(old, ["table_name", "version", "column_name"], "full")
            .select("table_name", "version", "column_name", F.col("n.type").alias("new_type"), F.col("o.type").alias("old_type"),
                    F.col("n.optional").alias("now_optional"), F.col("o.optional").alias("was_optional"), "null_rows")
            .join(heads, ["table_name", "version"]))      # drops the first version and what follows the last
    gone, came = F.col("new_type").isNull(), F.col("old_type").isNull()
    kept = ~gone & ~came

    def change(when: Column, kind: str, rows: Column, impact: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("change_type"), rows.cast("bigint").alias("rows_affected"), impact.alias("impact")))

    kinds = F.array_compact(F.array(
        change(came, "column_added", F.col("delivered") - F.coalesce("null_rows", F.lit(0)), F.lit("low")),
        change(gone, "column_removed", F.col("delivered"), F.when(F.col("was_optional"), "medium").otherwise("high")),
        change(kept & (F.col("new_type") != F.col("old_type")), "type_change", F.col("delivered"), F.lit("high")),
        change(kept & (F.col("now_optional") != F.col("was_optional")), "nullability_change", F.col("null_rows"), F.lit("medium"))))
    out = both.withColumn("c", F.explode(kinds))
    return out.select(
        "table_name", "version", "change_time", "column_name", "c.change_type", "old_type", "new_type", "c.rows_affected",
        F.when(F.col("column_name").isin(*essential), "critical").otherwise(F.col("c.impact")).alias("impact_level"))
