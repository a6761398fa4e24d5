"""Date and time expressions.  `as_of` is always an argument: a naive UTC timestamp."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_ZONE = "Europe/Paris"
MARKET_CLOSE_HOUR = 18

# Month names and zone names of feed dates, and their offset from UTC in minutes.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
ZONE_MINUTES = {"GMT": 0, "UTC": 0, "UT": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
                "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}

FEED_DATE = (
    r"^\s*(?:[A-Za-z]{3},\s+)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{2}:\d{2}:\d{2})\s+"
    r"([A-Za-z]+|[+-]\d{4})\s*$"
)


def at(as_of: dt.datetime) -> Column:
    """A naive timestamp literal."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def local(as_of: dt.datetime) -> Column:
    """The same instant on the market's clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(MARKET_ZONE), at(as_of))


def local_date(as_of: dt.datetime) -> Column:
    return local(as_of).cast("date")


def last_closed_session(as_of: dt.datetime) -> Column:
    """Today once the market has closed, else yesterday."""
    today = local_date(as_of)
    return F.when(F.hour(local(as_of)) >= MARKET_CLOSE_HOUR, today).otherwise(F.date_sub(today, 1))


def days_before(as_of: dt.datetime, days: int) -> Column:
    return at(as_of) - F.make_dt_interval(F.lit(days))


def feed_timestamp(text: Column) -> Column:
    """'Thu, 02 Apr 2026 15:30:00 GMT' or '... +0200' -> UTC; NULL where it does not parse."""
    part = [F.regexp_extract(text, FEED_DATE, i) for i in range(1, 6)]
    day, month_name, year, clock, zone = part
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.initcap(month_name))
    iso = F.format_string("%s-%02d-%s %s", year, month, F.lpad(day, 2, "0"), clock)
    named = F.lit(None).cast("int")
    for name, minutes in ZONE_MINUTES.items():
        named = F.when(F.upper(zone) == name, F.lit(minutes)).otherwise(named)
    digits = F.substring(zone, 2, 4)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    numeric = sign * (
        F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    )
    minutes = F.when(zone.rlike(r"^[+-]\d{4}$"), numeric).otherwise(named)
    return iso.try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)


def iso_timestamp(text: Column) -> Column:
    """ISO date or date-time, with or without an offset -> UTC; blank or broken -> NULL."""
    pattern = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?))?(Z|[+-]\d{2}:?\d{2})?$"
    bare = F.trim(text)
    day, clock, zone = (F.regexp_extract(bare, pattern, i) for i in (1, 2, 3))
    whole = F.when(F.length(day) > 0, F.concat(day, F.lit(" "), F.when(clock == "", "00:00:00").otherwise(clock)))
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    shift = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    minutes = F.when(zone.isin("", "Z"), 0).when(zone.startswith("-"), -shift).otherwise(shift)
    return whole.try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)


def instant(ts: Column) -> Column:
    """A naive UTC timestamp as an instant: event time of a stream must be one."""
    fields = [F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.extract(F.lit("SECOND"), ts)]
    return F.make_timestamp_ltz(*fields, F.lit("UTC"))


def utc_date(moment: Column) -> Column:
    """The UTC day of an instant, whatever the session zone."""
    return F.to_utc_timestamp(moment, F.current_timezone()).cast("date")


def strict_date(text: Column) -> Column:
    """Exactly YYYY-MM-DD and a real day, else NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
