"""Source tables kept by the names that events give, and the manifest of those names.

The rows of all tables of a shape lie in one folder. What is published at a time is
partitioned into parts by the hash of the table's name, so that many small tables are not
many small files. The manifest says which part a table lies in; a scan joined to the tables
that a batch of events names is pruned to their parts at run time. So no table is opened
by the driver and no union is built, however many tables the events name.

Whether a table exists is asked of the manifest, never of rows: a table published without
rows is there and empty, a retired one is missing. A name is bound to a version by the
manifest only, and the manifest is written after the rows, so a reader sees a table as it
was published last, or as before, never half of it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge import schemas
from claimgauge.session import shuffles_dropped
from claimgauge.sources.tables import conform

SHAPES = {"claims": schemas.CLAIMS, "savings": schemas.SAVINGS,
          "validation": schemas.VALIDATION, "submitted": schemas.SUBMITTED}
MANIFEST = "table_ref string, shape string, version long, present boolean, rows long"
#: Parts that the tables of one publication are dealt to.
PARTS = 32


@dataclass(frozen=True)
class TableStore:
    """A store in a folder all executors reach. ``shapes`` may widen the declared ones."""

    spark: SparkSession
    root: str
    shapes: dict[str, T.StructType] | None = None

    @staticmethod
    def _part(table_ref: Column, version: Column) -> Column:
        return F.concat_ws("-", version.cast("string"), F.pmod(F.crc32(
            table_ref.cast("binary")), F.lit(PARTS)).cast("string"))

    def _schema(self, shape: str) -> T.StructType:
        return (self.shapes or SHAPES)[shape]

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def publish(self, shape: str, rows: DataFrame, names: DataFrame | None = None) -> int:
        """Store ``rows`` (of one or many tables, told apart by ``table_ref``) under their
        names, in place of what the names stood for. ``names`` lists all tables that
        there are now; those without rows are empty. By default they are those with rows.
        """
        version = time.time_ns()
        kept = conform(rows, self._schema(shape)).where(F.col("table_ref").isNotNull())
        # each task writes its own file of a part, so rows are not shuffled; those of a table lie
        # together, so that row groups of others are skipped
        with shuffles_dropped(self.spark):
            (kept.withColumn("part", self._part(F.col("table_ref"), F.lit(version)))
             .sortWithinPartitions("part", "table_ref")
             .write.mode("append").partitionBy("part").parquet(f"{self.root}/{shape}"))
        filled = (self.rows(shape).where(F.col("part").startswith(f"{version}-"))
                  .groupBy("table_ref").agg(F.count(F.lit(1)).alias("rows")))
        listed = filled if names is None else names.select("table_ref").distinct().join(
            filled, "table_ref", "full")
        self._note(shape, listed, version, True)
        return version

    def retire(self, shape: str, names: DataFrame) -> int:
        """The tables of these names are there no longer."""
        version = time.time_ns()
        listed = names.select("table_ref").distinct().withColumn("rows", F.lit(0).cast("long"))
        self._note(shape, listed, version, False)
        return version

    def _note(self, shape: str, listed: DataFrame, version: int, present: bool) -> None:
        entries = listed.where(F.col("table_ref").isNotNull()).select(
            "table_ref", F.lit(shape).alias("shape"), F.lit(version).alias("version"),
            F.lit(present).alias("present"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
        with shuffles_dropped(self.spark):
            entries.write.mode("append").parquet(f"{self.root}/manifest")

    def manifest(self, *shapes: str) -> DataFrame:
        """The tables there are: ``table_ref``, ``shape``, ``part`` (that of their rows) and
        ``rows``. Of several entries of a name the latest counts. Read anew, so that a
        stream asks it once per batch."""
        log = self._read("manifest", MANIFEST)
        if shapes:
            log = log.where(F.col("shape").isin(*shapes))
        last = log.groupBy("table_ref").agg(F.max(F.struct(
            "version", "shape", "present", "rows")).alias("last"))
        return last.where(F.col("last.present")).select(
            "table_ref", "last.shape",
            self._part(F.col("table_ref"), F.col("last.version")).alias("part"), "last.rows")

    def rows(self, shape: str) -> DataFrame:
        """The stored rows of all tables of a shape, in all their versions, with ``part``."""
        return self._read(shape, T.StructType([*self._schema(shape).fields,
                                               T.StructField("part", T.StringType())]))
