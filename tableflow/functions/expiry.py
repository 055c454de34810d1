"""Expiry times of key/value rows: parse a base time, add an interval, give epoch millis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableflow.spec import SpecError

# The interval units and their length in milliseconds. Days are added on the
# calendar, so their length may differ at a clock change.
UNIT_MILLIS = {"day": None, "hour": 3_600_000, "minute": 60_000, "second": 1_000}

_PLAIN = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"

# Fixed formats: a date alone, or a date and a time whose trailing text is ignored.
_READABLE = (r"^\s*\d{4}-\d{2}-\d{2}\s*$"
             r"|^[ \t]*\d{1,4}-[ \t]*\d{1,6}-[ \t]*\d{1,6}"
             r" [ \t]*\d{1,6}:[ \t]*\d{1,6}:[ \t]*\d{1,6}")


def expire_at_ms(base: Column, interval: int, unit: str, zone: str | None = None) -> Column:
    """Epoch milliseconds of ``base + interval``; null where the base is null or unreadable.

    ``base`` is text, ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``, read leniently: fields out
    of range roll over (February 30th is March 1st or 2nd). Without ``zone`` the session's
    time zone holds.
    """
    if unit not in UNIT_MILLIS:
        raise SpecError(f"interval unit must be one of {list(UNIT_MILLIS)}, got {unit!r}")
    local = _local_seconds(base)
    if unit == "day":
        local = local + F.lit(interval * 86_400)
    moment = F.to_utc_timestamp(F.timestamp_seconds(local),
                                F.lit(zone) if zone else F.current_timezone())
    millis = F.unix_millis(moment)
    return millis if unit == "day" else millis + F.lit(interval * UNIT_MILLIS[unit])


def _local_seconds(base: Column) -> Column:
    """Seconds from 1970 to the base time on the local clock; null when unreadable."""
    # Full-width fields, the usual case, are read by Spark's own parser; what it refuses, such as
    # February 30th, and all other text goes the lenient way.
    moment = F.when(base.rlike(_PLAIN), base.try_cast("timestamp_ntz"))
    plain = (F.unix_date(moment.cast("date")).cast("bigint") * 86_400 + F.hour(moment) * 3_600
             + F.minute(moment) * 60 + F.second(moment))
    numbers = F.regexp_extract_all(F.regexp_extract(base, _READABLE, 0), F.lit(r"\d+"), F.lit(0))
    return F.coalesce(plain, _seconds([F.get(numbers, F.lit(i)) for i in range(6)]))


def _seconds(fields: list[Column]) -> Column:
    """Seconds out of year, month, day, hour, minute and second as text; no time is midnight."""
    year, month, day, *time = (field.try_cast("int") for field in fields)
    # Year, then months, days and time added one after another: this is what rolls over.
    months = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    days = F.unix_date(F.date_add(months, day - 1)).cast("bigint")
    hour, minute, second = (F.coalesce(part, F.lit(0)).cast("bigint") for part in time)
    return days * 86_400 + hour * 3_600 + minute * 60 + second
