"""Time conversions used by message fields.

As everywhere in this package, the session zone (``spark.sql.session.timeZone``) is UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def string_to_time(text: Column) -> Column:
    """Text -> TIMESTAMP.

    A ``GMT`` marker is removed.  Text without ``T`` is a SQL date or timestamp in the
    session zone; ISO text is read as UTC and its offset is ignored.
    """
    plain = F.replace(text, F.lit("GMT"), F.lit(""))
    local = F.regexp_replace(plain, r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?(\[[^\]]*\])?$", "")
    seconds = F.regexp_replace(local, r"T(\d{2}:\d{2})$", "T$1:00")
    iso = F.concat(seconds, F.lit("Z")).cast("timestamp")
    return F.when(F.contains(plain, F.lit("T")), iso).otherwise(plain.cast("timestamp"))


def micros_to_ts(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def ts_to_micros(ts: Column) -> Column:
    """Micros since the epoch; an unset time counts as 0."""
    return F.coalesce(F.unix_micros(ts), F.lit(0).cast("bigint"))


def millis_to_days(millis: Column, zone: str = "UTC") -> Column:
    """Epoch millis -> epoch day in ``zone``, rounding down for times before the epoch."""
    return F.unix_date(F.to_date(F.from_utc_timestamp(F.timestamp_millis(millis), zone)))


def days_to_millis(days: Column, zone: str = "UTC") -> Column:
    """Epoch day -> epoch millis of its midnight in ``zone``."""
    return F.unix_millis(F.to_utc_timestamp(F.date_from_unix_date(days).cast("timestamp"), zone))


def ts_to_string(ts: Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` and the fraction when there is one."""
    return F.from_utc_timestamp(ts, zone).cast("string")
