"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, one long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x" for i in range(30_000))
    return documents(spark, [
        (1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"),
        (2, "one two three four five six", "de", None), (3, None, "en", "a"), (4, "", None, "a"),
        (5, " \n\t ", "en", "b"), (None, "a text without id", None, None), (None, None, None, None),
        (6, long, "en", "a"), (7, "ünïcödé ✓ 漢字 text", "fr", "b"), (1, "same id other text", "en", "a")])


def clashing(frame: DataFrame, *names: str) -> DataFrame:
    """The frame with extra columns of names that an operator may use itself."""
    from pyspark.sql import functions as F
    return frame.withColumns({name: F.lit("taken") for name in names})


def fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*columns or frame.columns).collect()), key=repr)
