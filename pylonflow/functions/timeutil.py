"""Duration strings ("90 seconds", "1 day") as exact microsecond counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {
    "microsecond": 1, "us": 1,
    "millisecond": 1_000, "ms": 1_000,
    "second": 1_000_000, "sec": 1_000_000, "s": 1_000_000,
    "minute": 60_000_000, "min": 60_000_000, "m": 60_000_000,
    "hour": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "d": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"(\d+)\s*([a-z]+)")


def duration_us(text: str, allow_zero: bool = False) -> int:
    """Parse ``"<n> <unit>"`` parts (plural allowed) into microseconds.
    Zero is rejected unless ``allow_zero`` (a watermark may be zero; a
    window, ttl, bucket or retention may not)."""
    total, pos = 0, 0
    s = text.strip().lower()
    for m in _PART.finditer(s):
        if s[pos:m.start()].strip():
            raise ValueError(f"bad duration {text!r}")
        unit = m.group(2)
        if unit not in _UNITS and unit.endswith("s") and unit[:-1] in _UNITS:
            unit = unit[:-1]  # plural ("seconds"); never strips a unit that is itself known ("ms")
        if unit not in _UNITS:
            raise ValueError(f"bad duration unit in {text!r}")
        total += int(m.group(1)) * _UNITS[unit]
        pos = m.end()
    if pos == 0 or s[pos:].strip() or (total == 0 and not allow_zero):
        raise ValueError(f"bad duration {text!r}")
    return total


_DAY_US = 86_400_000_000


def _long(c: Column) -> Column:
    return c.cast("long")


def to_epoch_us(ts: Column, ntz: bool = False) -> Column:
    """Microseconds since 1970-01-01 00:00. Instants (TIMESTAMP) use the exact
    epoch value; wall-clock values (TIMESTAMP_NTZ) are read from their date
    and time fields, so no session time zone (or DST gap) is involved."""
    if not ntz:
        return F.unix_micros(ts)
    day = _long(F.unix_date(F.to_date(ts)))
    secs = F.date_part(F.lit("SECOND"), ts)  # seconds with the fraction
    return (day * F.lit(_DAY_US) + _long(F.hour(ts)) * F.lit(3_600_000_000)
            + _long(F.minute(ts)) * F.lit(60_000_000) + _long(secs * F.lit(1_000_000)))


def from_epoch_us(us: Column, ntz: bool = False) -> Column:
    """Inverse of ``to_epoch_us`` (TIMESTAMP, or zone-free TIMESTAMP_NTZ)."""
    if not ntz:
        return F.timestamp_micros(us)
    rem = F.pmod(us, F.lit(_DAY_US))
    day = F.date_from_unix_date(((us - rem) / F.lit(_DAY_US)).cast("int"))
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                (rem / F.lit(3_600_000_000)).cast("int"),
                                F.pmod((rem / F.lit(60_000_000)).cast("long"), F.lit(60)).cast("int"),
                                (F.pmod(rem, F.lit(60_000_000)) / F.lit(1_000_000)).cast("decimal(8,6)"))


def time_type(df, col: str) -> T.DataType:
    """Type of a (possibly nested, e.g. ``"w.end"``) time column."""
    return df.select(F.col(col)).schema.fields[0].dataType


def is_ntz(df, col: str) -> bool:
    return isinstance(time_type(df, col), T.TimestampNTZType)


def as_time(df, col: str) -> tuple[Column, bool]:
    """The time column as TIMESTAMP or TIMESTAMP_NTZ (strings and dates are
    cast to TIMESTAMP) and whether it is wall clock (NTZ)."""
    t = time_type(df, col)
    if isinstance(t, T.TimestampNTZType):
        return F.col(col), True
    if isinstance(t, T.TimestampType):
        return F.col(col), False
    return F.col(col).cast("timestamp"), False


def require_instant(df, col: str) -> None:
    """Streams need TIMESTAMP event time (a watermark on TIMESTAMP_NTZ is
    rejected by Spark); fail early with a clear message."""
    if is_ntz(df, col):
        raise ValueError(f"event time column {col!r} is TIMESTAMP_NTZ; cast it to TIMESTAMP for streaming "
                         "(the table readers do this for test data)")


def interval_us(us: int) -> Column:
    """An exact day-time interval of ``us`` microseconds."""
    sign = "-" if us < 0 else ""
    secs, micros = divmod(abs(int(us)), 1_000_000)
    return F.expr(f"make_dt_interval(0, 0, 0, {sign}{secs}.{micros:06d})")


def shift_time(ts: Column, duration: str | int, ntz: bool = False) -> Column:
    """``ts`` moved by a duration (string or microseconds; negative = back),
    exactly. Instants move by epoch microseconds (interval arithmetic on
    TIMESTAMP adds whole days as calendar days in the session zone, which is
    not a fixed duration across DST); wall-clock values (NTZ) move by a plain
    interval, which Spark applies without any zone. Literals constant-fold,
    so filters stay pushable."""
    us = duration_us(duration) if isinstance(duration, str) else int(duration)
    if ntz:
        return ts + interval_us(us)
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(us))


def time_literal(value, ntz: bool = False) -> Column:
    """A point in time as a column of the right type. ``datetime`` values
    follow PySpark's convention for TIMESTAMP (naive = driver-local time, so
    values collected from Spark round-trip; aware = that instant); for NTZ
    columns the datetime's own wall clock is used. Strings are cast as Spark
    casts them."""
    from datetime import datetime
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if ntz:
            return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        return F.lit(value)
    return F.lit(value).cast("timestamp_ntz" if ntz else "timestamp")


def spark_duration(text: str, allow_zero: bool = False) -> str:
    """The same duration as a string Spark's window functions parse
    exactly (``"<n> microseconds"``), so every operator reads a duration
    the same way."""
    return f"{duration_us(text, allow_zero)} microseconds"
