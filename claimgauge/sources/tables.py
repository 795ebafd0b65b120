"""Tables named by events: qualification, optional scans, and many tables as one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def qualified_name(table: str, default_namespace: str) -> str:
    """The default namespace is put before names without a dot."""
    return table if "." in table else f"{default_namespace}.{table}"


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or ``None`` if the catalog has none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def conform(frame: DataFrame, schema: T.StructType,
            names: Mapping[str, str] | None = None) -> DataFrame:
    """Bring a table to a declared shape: rename columns (``{theirs: ours}``), cast,
    and fill columns it lacks with NULL. Only a projection, so scans stay pruned."""
    source = {ours: theirs for theirs, ours in (names or {}).items()}
    have = set(frame.columns)
    columns = []
    for column in schema.fields:
        theirs = source.get(column.name, column.name)
        value = F.col(f"`{theirs}`") if theirs in have else F.lit(None)
        columns.append(value.cast(column.dataType).alias(column.name))
    return frame.select(*columns)


def gather(spark: SparkSession, tables: Iterable[str], schema: T.StructType,
           names: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Existing catalog tables as one frame with ``table_ref``, and their manifest.

    For a few tables of a run. Where runs are many, keep the rows in one table
    partitioned by ``table_ref`` instead: a reference then prunes partitions.
    """
    found = [name for name in tables if spark.catalog.tableExists(name)]
    rows = spark.createDataFrame([], schema)
    for name in found:
        tagged = conform(spark.table(name), schema, names).withColumn("table_ref", F.lit(name))
        rows = rows.unionByName(tagged)
    manifest = spark.createDataFrame([(name,) for name in found], "table_ref string")
    return rows, manifest


def manifest_of_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The ``table_ref`` values of a catalog table partitioned by ``table_ref`` first: read
    from its partition list, not its rows."""
    entry = F.split_part(F.split_part("partition", F.lit("/"), F.lit(1)), F.lit("="), F.lit(2))
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.url_decode(entry).alias("table_ref")).distinct()


def manifest_of(*tables: DataFrame) -> DataFrame:
    """The ``table_ref`` values that have rows, for stores without empty tables."""
    refs = None
    for frame in tables:
        own = frame.select("table_ref").distinct()
        refs = own if refs is None else refs.unionByName(own)
    return refs.distinct()
