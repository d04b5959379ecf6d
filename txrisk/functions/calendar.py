"""Timestamp parsing and calendar features.

Timestamps carry no zone, so expressions work on ``TIMESTAMP_NTZ`` and give the same
answer whatever the session time zone is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Year first with slashes or nothing between; day first where the first number cannot be a month; month first. The groups
# are years, months and days, of which those of one form match and the others are empty.
_NUMERIC = (
    r"^(?:(\d{4})/(\d{1,2})/(\d{1,2})|(\d{4})(\d{2})(\d{2})(?=$|[T ])"
    r"|(1[3-9]|2\d|3[01])[/-](\d{1,2})[/-](\d{4})|(\d{1,2})[/-](\d{1,2})[/-](\d{4}))"
)
_NUMERIC_ISO = "$1$4$9$12-$2$5$8$10-$3$6$7$11"
_NAMED = r"^(?i)(?:(\d{1,2})[ -])?(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?[ -](?:(\d{1,2}),? )?(\d{4})"
_HALF_DAY = r"^(.*[ T])(\d{1,2})(:\d{2}(?::\d{2}(?:\.\d+)?)?) ?([AaPp])[Mm]$"


def _wall_clock(text: Column) -> Column:
    """The first reading that succeeds: ISO as it is, numeric dates, then what has letters (months by name, AM and PM).

    Each step is one replacement and one parse, and a later step is only taken where the earlier ones gave nothing.
    """
    numeric = F.regexp_replace(text, _NUMERIC, _NUMERIC_ISO)
    named = F.regexp_replace(text, _NAMED, "$4-$2-$1$3")
    month = ((F.instr(F.lit(_MONTHS), F.lower(F.substring(named, 6, 3))) + 2) / 3).cast("int").cast("string")
    named = F.concat(F.substring(named, 1, 5), month, F.substring(named, 9, 1 << 30))
    date_first = F.when(text.rlike(_NAMED), named).otherwise(numeric)
    hour = F.regexp_extract(text, _HALF_DAY, 2).try_cast("int")
    moved = F.when(hour == 12, -12).otherwise(0) + F.when(F.lower(F.regexp_extract(text, _HALF_DAY, 4)) == "p", 12).otherwise(0)
    clock = F.regexp_replace(date_first, _HALF_DAY, "$1$2$3").try_cast("timestamp_ntz") + F.make_dt_interval(hours=moved)
    lettered = F.when(~text.rlike(_HALF_DAY), date_first.try_cast("timestamp_ntz")).when(hour.between(1, 12), clock)
    return F.coalesce(text.try_cast("timestamp_ntz"), numeric.try_cast("timestamp_ntz"), F.when(text.rlike("[A-Za-z]"), lettered))


def _by_pattern(text: Column, pattern: str) -> Column:
    """Wall-clock time by a Spark pattern. It is read as UTC and counted from the epoch, so that no zone can move it."""
    instant = F.try_to_timestamp(F.concat(text, F.lit(" UTC")), F.lit(f"{pattern} VV"))
    seconds = F.unix_micros(instant.cast("timestamp")).cast("decimal(24,6)") / 1_000_000
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def parse_timestamp(
    text: Column, *, strict: bool = True, extra_formats: Sequence[str] = ()
) -> Column:
    """Parse text whose format varies from row to row.

    Understood without configuration: ISO dates and date-times with ``T`` or a blank, with or without fraction;
    year first with slashes or without separators; month first with slashes or hyphens, or day first
    where the first number cannot be a month (``05/06`` is the sixth of May); months by their English names; times with AM or PM.
    ``extra_formats`` (Spark patterns of wall-clock time) are tried afterwards, in order. Null and
    blank text give null. Other text that fits no format fails the job when ``strict``, else gives null.
    """
    text = F.trim(text)
    readings = [_wall_clock(text), *[_by_pattern(text, pattern) for pattern in extra_formats]]
    if strict:
        failure = F.raise_error(F.concat(F.lit("unparseable timestamp: "), text))
        readings.append(F.when(text != "", failure.cast("timestamp_ntz")))
    return F.coalesce(*readings)


def hour_of_day(ts: Column) -> Column:
    """Hour 0-23, null for a missing timestamp."""
    return F.hour(ts).cast("int")


def day_of_week(ts: Column) -> Column:
    """ISO day, Monday = 1 to Sunday = 7, null for a missing timestamp."""
    return (F.weekday(ts) + 1).cast("int")


def is_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday, else 0; a missing timestamp also gives 0."""
    return F.coalesce(day_of_week(ts).isin(6, 7).cast("int"), F.lit(0))
