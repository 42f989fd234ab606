"""String to UTC timestamp, strict or lenient.

Text with an offset (``Z``, ``+05:30``, ``+0530``) names an instant; naive text
is read as UTC. The result is the UTC wall clock as ``timestamp_ntz``, so it does
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    # A string cast to timestamp_ntz: no time zone is involved (a Python
    # datetime literal would be read in the Python process's local zone).
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def to_utc_ntz(ts: Column) -> Column:
    """A ``timestamp`` (instant) as its UTC wall clock, independent of session tz."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())


def _normalise(text: Column) -> Column:
    # "+0530" -> "+05:30" so the ISO-8601 parser accepts both offset styles.
    return F.regexp_replace(F.trim(text), r"([+-]\d{2})(\d{2})$", "$1:$2")


def _has_offset(text: Column) -> Column:
    return text.rlike(r"(Z|z|[+-]\d{2}:?\d{2})$")


def parse_utc(text: str | Column, strict: bool = True) -> Column:
    """Parse ISO-8601 text into a UTC ``timestamp_ntz``.

    strict: malformed text fails the query (ANSI cast); lenient: NULL.
    """
    t = _normalise(F.col(text) if isinstance(text, str) else text)
    if strict:
        with_offset = to_utc_ntz(t.cast("timestamp"))
        naive = t.cast("timestamp_ntz")
    else:
        with_offset = to_utc_ntz(F.try_to_timestamp(t))
        naive = F.try_to_timestamp(t).cast("timestamp_ntz")
    return F.when(t.isNull(), F.lit(None).cast("timestamp_ntz")).when(
        _has_offset(t), with_offset).otherwise(naive)


def utc_instant(ntz: Column) -> Column:
    """A ``timestamp_ntz`` read as UTC wall clock, as a ``timestamp`` instant
    (what ``withWatermark`` needs), independent of the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", _epoch(), ntz)
    return F.timestamp_micros(micros)


def micros_to_ntz(micros: Column) -> Column:
    """Microseconds since the epoch to a UTC ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", micros, _epoch())
