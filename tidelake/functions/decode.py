"""Typed values from the text of a JSON field.

A field that does not fit its type becomes NULL instead of stopping the job, and no result
depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The first and last microsecond / day of the years 0001 to 9999.
MICROS_RANGE = (-62_135_596_800_000_000, 253_402_300_799_999_999)
DAYS_RANGE = (-719_162, 2_932_896)


def json_fields(text: Column, schema: T.StructType) -> Column:
    """The fields of a JSON text as columns, for use in ``select``.

    The generator keeps Spark from moving a later filter on a field below the parse, which would
    parse every text a second time.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def from_epoch_micros(micros: Column) -> Column:
    """Microseconds since 1970 as a timestamp without zone; NULL outside the calendar's range."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.when(micros.between(*MICROS_RANGE), F.timestamp_add("MICROSECOND", micros, start))


def from_epoch_days(days: Column) -> Column:
    """Days since 1970 as a date; NULL outside the calendar's range."""
    return F.when(days.between(*DAYS_RANGE), F.date_from_unix_date(days.cast("int")))


def is_iso(text: Column) -> Column:
    """Whether a time is written out: a dash after the first character tells it from a number.

    Deciding first is cheap, while every failed ``try_cast`` costs an exception inside the engine.
    """
    return F.locate("-", text, 2) > 0


def as_type(text: Column, kind: T.DataType) -> Column:
    """Decode one field. Times come as epoch numbers from the log and as ISO text from bulk loads."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampNTZType):
        return F.when(is_iso(text), text.try_cast("timestamp_ntz")).otherwise(from_epoch_micros(text.try_cast("bigint")))
    if isinstance(kind, T.DateType):
        return F.when(is_iso(text), text.try_cast("date")).otherwise(from_epoch_days(text.try_cast("bigint")))
    return text.try_cast(kind)
