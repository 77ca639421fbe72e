"""Time arithmetic on zone-less (NTZ) timestamps that hold UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"
SECOND, HOUR, DAY = 1_000_000, 3_600_000_000, 86_400_000_000  # in microseconds


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; exact, so gaps never round to whole seconds."""
    return F.unix_micros(ts.cast("timestamp"))


def as_ts(value) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def ago(as_of, n: int, unit: str) -> Column:
    """`as_of` minus n days, weeks or months (calendar months)."""
    part = {"days": {"days": F.lit(n)}, "weeks": {"weeks": F.lit(n)}, "months": {"months": F.lit(n)}}[unit]
    return as_ts(as_of) - F.make_interval(**part)


def partial_date(text: Column) -> Column:
    """`YYYY`, `YYYY-MM` or `YYYY-MM-DD` to a date; any other length or bad text is null."""
    full = (
        F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01")))
        .when(F.length(text) == 7, F.concat(text, F.lit("-01")))
        .when(F.length(text) == 10, text)
    )
    return F.try_to_date(full, "yyyy-MM-dd")


def iso_ts(text: Column) -> Column:
    """ISO-8601 text, with or without a zone, to UTC (a missing zone means UTC)."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def span_text(ms: Column) -> Column:
    """`1y 2d 3h 4m 5s`; a year is 365 days; years and days go when they lead with zero."""
    secs = _div(ms, 1000)
    year, day = 365 * 86400, 86400
    y, d = _div(secs, year), _div(F.pmod(secs, F.lit(year)), day)
    rest = F.pmod(secs, F.lit(day))
    text = F.concat_ws(
        " ",
        F.when(y > 0, F.concat(y.cast("string"), F.lit("y"))),
        F.when((y > 0) | (d > 0), F.concat(d.cast("string"), F.lit("d"))),
        F.concat(
            _div(rest, 3600).cast("string"), F.lit("h "),
            _div(F.pmod(rest, F.lit(3600)), 60).cast("string"), F.lit("m "),
            F.pmod(rest, F.lit(60)).cast("string"), F.lit("s"),
        ),
    )
    return F.when(ms.isNotNull(), text)


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a.cast("bigint"), F.lit(n).cast("bigint"))
