"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Scratch folders of this process, for ``scratch_scope``.
_made: list[str] = []

# Instants are compared and floored to days in UTC; everything else is a default
# worth stating, because plans below lean on it (skewed join sides are split at
# run time, small shuffles are merged).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # of repeated keys of an event's JSON the last counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # checkpoint files go once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Day floors and zone-less casts are only right in a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates and stream checkpoints.

    It lies in the folder the session names in ``spark.checkpoint.dir``, or else in the
    one given to ``SparkContext.setCheckpointDir``. Only a local session, where driver
    and tasks share one disk, may go without either.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        base = os.path.join(tempfile.gettempdir(), f"claimgauge-{spark.sparkContext.applicationId}")
    _made.append(f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside leave no shuffle files behind. For frames written whole: else the files
    lie on disk until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settled(frame: DataFrame, purpose: str, *partitions: str) -> DataFrame:
    """The frame written once to the scratch folder and read again: its lineage ends there,
    and what reads it gets columns and sizes. For what several plans share."""
    path = scratch_dir(frame.sparkSession, purpose)
    with shuffles_dropped(frame.sparkSession):
        frame.write.partitionBy(*partitions).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are removed at the end, whatever happens. Frames that
    read them must have been written by then."""
    before = len(_made)
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in _made[before:]:
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
        del _made[before:]
