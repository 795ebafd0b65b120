"""Small tests on VARIANT values (parsed JSON of unknown shape)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON values that count as "not given"
FALSY_JSON = ["null", '""', "0", "0.0", "-0", "-0.0", "false", "[]", "{}"]


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once per row however often ``body`` names it:
    parsing must not be repeated by each of its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def get(value: Column, path: str) -> Column:
    """The value at ``path``: SQL NULL if absent, a variant null if it is JSON null."""
    return F.try_variant_get(value, path, "variant")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def is_object(value: Column) -> Column:
    """Whether the value is a JSON object, however its text was laid out."""
    return F.try_variant_get(value, "$", "struct<x:variant>").isNotNull()


def is_missing(value: Column) -> Column:
    """Absent, null, or empty/zero/false."""
    return value.isNull() | F.to_json(value).isin(FALSY_JSON)


# Texts that may or may not count as given: the string "0" does, the number 0 does not.
DOUBTFUL_TEXT = [t for t in FALSY_JSON if t != '""'] + [""]


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def given_text(value: Column, path: str) -> Column:
    """The value at ``path`` as text, NULL if missing: decided by its JSON type."""
    return F.when(~is_missing(get(value, path)), text_at(value, path))
