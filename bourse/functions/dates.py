"""Date and time expressions that give the same answer in every session zone.

Epoch milliseconds are turned into wall-clock times with TIMESTAMP_NTZ
arithmetic and an explicit zone, never through the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Zone of the market whose daily bars start at local midnight; the default
# wherever bar times meet epoch milliseconds (fixed value).
MARKET_ZONE = "America/New_York"


def _epoch() -> Column:
    return F.expr(_EPOCH_NTZ)


def parse_range(dates) -> tuple[dt.date, dt.date] | None:
    """Normalise an inclusive (start, end) pair of ISO strings or dates.

    ``None`` means the whole series. Start after end is rejected.
    """
    if dates is None:
        return None
    lo, hi = (d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))
              for d in dates)
    if isinstance(lo, dt.datetime):
        lo = lo.date()
    if isinstance(hi, dt.datetime):
        hi = hi.date()
    if lo > hi:
        raise ValueError(f"date range starts after it ends: {lo} > {hi}")
    return lo, hi


def iso_week(date: Column) -> Column:
    """ISO-8601 week number (weeks start Monday; week 1 holds the first Thursday)."""
    return F.weekofyear(date)


def iso_year(date: Column) -> Column:
    """ISO-8601 week-numbering year (2024-12-30 belongs to 2025)."""
    return F.date_part(F.lit("YEAROFWEEK"), date)


def epoch_ms_to_local(ms: Column, zone: str) -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in ``zone``."""
    utc = F.timestamp_add("MILLISECOND", ms, _epoch())
    if zone.upper() in ("UTC", "Z", "ETC/UTC"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_ms_to_date(ms: Column, zone: str) -> Column:
    """Epoch milliseconds -> calendar date in ``zone``."""
    return F.to_date(epoch_ms_to_local(ms, zone))


def local_to_epoch_ms(local: Column, zone: str) -> Column:
    """Wall-clock TIMESTAMP_NTZ in ``zone`` -> epoch milliseconds."""
    if zone.upper() not in ("UTC", "Z", "ETC/UTC"):
        local = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.timestamp_diff("MILLISECOND", _epoch(), local)


def ingest_epoch_from_path(path: Column) -> Column:
    """Ingest time (epoch seconds) of a bronze file, from its path.

    Accepts both layouts: ``{ticker}_{epoch}.json`` file names and
    ``.../ingest={epoch}/part-*.json`` folders. NULL when neither matches.
    """
    by_name = F.regexp_extract(path, r"_(\d+)\.json$", 1)
    by_folder = F.regexp_extract(path, r"/ingest=(\d+)/", 1)
    digits = F.coalesce(F.nullif(by_name, F.lit("")), F.nullif(by_folder, F.lit("")))
    return digits.try_cast("bigint")


# Fixed-width spans in seconds (fixed values).
FIXED_SPAN_SECONDS = {
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 7 * 86400,
}
# 1970-01-05 was a Monday: weeks are aligned on it (fixed value).
MONDAY_OFFSET_SECONDS = 4 * 86400
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
TIMESPANS = tuple(FIXED_SPAN_SECONDS) + tuple(_MONTHS)


def wall_clock(ts: Column, dtype, zone: str | None = None) -> Column:
    """Wall-clock TIMESTAMP_NTZ of a tick time.

    TIMESTAMP_NTZ is already a wall clock and is returned as is. A TIMESTAMP
    (an instant) is read in ``zone``, or in the session zone when ``zone``
    is None. A DATE becomes its midnight.
    """
    if isinstance(dtype, TimestampNTZType):
        return ts
    if isinstance(dtype, TimestampType) and zone is not None:
        utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())
        return utc if zone.upper() in ("UTC", "Z", "ETC/UTC") else \
            F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    return ts.cast(TimestampNTZType())


def normalise_span(timespan: str, multiplier: int = 1) -> str:
    """'Minutes' -> 'minute'; rejects unknown spans and multipliers < 1."""
    if multiplier < 1:
        raise ValueError("multiplier must be >= 1")
    span = timespan.lower().rstrip("s")
    if span not in TIMESPANS:
        raise ValueError(f"unknown timespan {timespan!r}; expected one of {TIMESPANS}")
    return span


def bucket_key(ts: Column, multiplier: int = 1, timespan: str = "day",
               dtype=TimestampNTZType(), zone: str | None = None) -> Column:
    """Integer key of the ``multiplier`` x ``timespan`` bucket holding ``ts``.

    For second .. week spans: the bucket start in seconds since the epoch of
    the wall clock; for month, quarter and year: the bucket's first month
    counted from year 0. Cheap integer arithmetic, meant for grouping; turn
    keys into timestamps after aggregating (``bucket_key_start``).
    """
    span = normalise_span(timespan, multiplier)
    local = wall_clock(ts, dtype, zone)
    if span in FIXED_SPAN_SECONDS:
        # unix_timestamp of a TIMESTAMP_NTZ ignores the session zone
        secs = F.unix_timestamp(local)
        width = F.lit(FIXED_SPAN_SECONDS[span] * multiplier)
        if span == "week":
            return secs - F.pmod(secs - F.lit(MONDAY_OFFSET_SECONDS), width)
        return secs - F.pmod(secs, width)
    d = F.to_date(local)
    idx = F.year(d) * 12 + F.month(d) - 1
    return idx - F.pmod(idx, F.lit(_MONTHS[span] * multiplier))


def bucket_key_start(key: Column, timespan: str = "day") -> Column:
    """TIMESTAMP_NTZ start of a bucket from its ``bucket_key``."""
    span = normalise_span(timespan)
    if span in FIXED_SPAN_SECONDS:
        return F.timestamp_add("SECOND", key, _epoch())
    return F.make_date((key / 12).cast("int"), (key % 12 + 1).cast("int"),
                       F.lit(1)).cast(TimestampNTZType())


def bucket_start(ts: Column, multiplier: int = 1, timespan: str = "day",
                 dtype=TimestampNTZType(), zone: str | None = None) -> Column:
    """Start of the ``multiplier`` x ``timespan`` bar that holds ``ts``.

    second .. day buckets are aligned on the Unix epoch; weeks start on
    Monday (aligned on 1970-01-05); months, quarters and years on January 1st
    of year 0. Returns TIMESTAMP_NTZ.
    """
    return bucket_key_start(bucket_key(ts, multiplier, timespan, dtype, zone), timespan)


def _zone_midnight(day: dt.date, zone: str) -> Column:
    """The instant (TIMESTAMP) of midnight of ``day`` in ``zone``, built
    without the session zone; constant-folded to a literal."""
    local = F.lit(day).cast(TimestampNTZType())
    utc = local if zone.upper() in ("UTC", "Z", "ETC/UTC") else \
        F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.timestamp_seconds(F.unix_timestamp(utc))


def in_time_range(ts: Column, dtype, dates, zone: str | None = None) -> Column | None:
    """Predicate keeping tick times from ``start`` 00:00 up to, not including,
    the day after ``end``, written on the raw column so that it reaches the
    Parquet scan (``PushedFilters``). TIMESTAMP bounds are midnights in
    ``zone`` (session zone if None). None when ``dates`` is None."""
    rng = parse_range(dates)
    if rng is None:
        return None
    lo, hi = rng[0], rng[1] + dt.timedelta(days=1)
    if isinstance(dtype, DateType):
        return ts.between(F.lit(rng[0]), F.lit(rng[1]))
    if isinstance(dtype, TimestampNTZType):
        a, b = F.lit(lo).cast(TimestampNTZType()), F.lit(hi).cast(TimestampNTZType())
    elif zone is not None:
        a, b = _zone_midnight(lo, zone), _zone_midnight(hi, zone)
    else:
        a, b = F.lit(lo).cast(TimestampType()), F.lit(hi).cast(TimestampType())
    return (ts >= a) & (ts < b)
