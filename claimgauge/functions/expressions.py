"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | datetime | str) -> Column:
    """An event time given as a column, an aware ``datetime`` or an ISO string."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is None:
            raise ValueError("give event times with a zone")
        return F.lit(value)
    return F.to_timestamp(F.lit(value))


def money(column: Column | str, scale: int = 2) -> Column:
    """A fixed-point amount: sums of it do not depend on the order of the rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal(18,{scale})")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two sums as a double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_zero(column: Column) -> Column:
    return F.coalesce(column.cast("double"), F.lit(0.0))


def days_before(as_of: Column, days: int) -> Column:
    """The day ``days`` before ``as_of``, a date or an instant (whose day is that of the UTC
    session). Give the local date of an event to count in the event's own offset."""
    return F.date_sub(F.to_date(as_of), days)


# An instant as written by most systems: no need to take it apart.
_COMMON = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})$"
# Calendar or week date, extended or basic; then any separator, time and offset likewise.
_DATE = r"([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|([0-9]{2})([0-9]{2})|-W([0-9]{2})-([1-7])|W([0-9]{2})([1-7]))"
_TIME = r"([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
_OFFSET = r"(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?"
_ISO = rf"^{_DATE}(?:(?s:.){_TIME}{_OFFSET})?$"


def parse_day(text: Column) -> Column:
    """The date an ISO-8601 text states, in its own offset; NULL if there is none."""
    part = lambda *groups: F.coalesce(*[F.nullif(F.regexp_extract(text, _ISO, g), F.lit(""))
                                        for g in groups])
    calendar = F.try_to_date(F.concat_ws("-", part(1), part(2, 4), part(3, 5)))
    week, day = part(6, 8).cast("int"), part(7, 9).cast("int")
    fourth = F.try_to_date(F.concat(part(1), F.lit("-01-04")))
    monday = F.date_sub(fourth, F.weekday(fourth))
    of_week = F.date_add(monday, (week - 1) * 7 + day - 1)
    fits = (week >= 1) & (F.weekofyear(of_week) == week)
    return F.when(text.rlike(_COMMON), F.try_to_date(F.substring(text, 1, 10))).otherwise(
        F.when(week.isNotNull(), F.when(fits, of_week)).otherwise(calendar))


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to an instant, extended or basic, with calendar or week date; UTC
    where no offset is given, NULL for anything else (zone names among it)."""
    part = lambda group: F.regexp_extract(text, _ISO, group)
    filled = lambda group: F.when(part(group) == "", "00").otherwise(part(group))
    offset = F.regexp_replace(part(14), ":", "")
    zone = F.when(offset.isin("", "Z"), "Z").otherwise(F.concat(
        F.substring(offset, 1, 3), F.lit(":"), F.rpad(F.substring(offset, 4, 2), 2, "0")))
    fraction = F.when(part(13) == "", "").otherwise(F.concat(F.lit("."), F.substring(part(13), 1, 6)))
    whole = F.concat(parse_day(text).cast("string"), F.lit("T"), filled(10), F.lit(":"), filled(11),
                     F.lit(":"), filled(12), fraction, zone)
    return F.when(text.rlike(_COMMON), F.try_to_timestamp(text)).when(
        text.rlike(_ISO), F.try_to_timestamp(whole))


def iso_instant(instant: Column) -> Column:
    """An instant as ISO-8601 text in UTC, fraction only when there is one."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(whole, fraction, F.lit("+00:00"))


def label_text(column: Column) -> Column:
    """A label value; a missing one reads ``None``."""
    return F.coalesce(column.cast("string"), F.lit("None"))


def labels(**values: Column | str) -> Column:
    """A label map. Pairs whose value is NULL are left out."""
    pairs = []
    for name, value in values.items():
        column = F.lit(value) if isinstance(value, str) else value.cast("string")
        pairs.append(F.struct(F.lit(name).alias("key"), column.alias("value")))
    present = F.filter(F.array(*pairs), lambda pair: pair["value"].isNotNull())
    return F.map_from_entries(present)
