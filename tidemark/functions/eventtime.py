"""

The reference carries time as a Long whose unit differs per feed (seconds in
files, milliseconds from generators).  Here the unit is explicit at the one
place a raw number becomes a TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_UNITS = {
    "s": F.timestamp_seconds,
    "ms": F.timestamp_millis,
    "us": F.timestamp_micros,
}


def interval(text: str) -> Column:
    """``interval('1 hour')`` -> an interval literal column."""
    return F.expr(f"INTERVAL {text}")


def to_event_time(c: Column | str, unit: str) -> Column:
    """A raw epoch number in ``unit`` ('s', 'ms', 'us') -> TIMESTAMP."""
    if unit not in _UNITS:
        raise ValueError(f"unknown time unit {unit!r}; use one of {sorted(_UNITS)}")
    col = F.col(c) if isinstance(c, str) else c
    return _UNITS[unit](col.cast("long"))


def ntz_as_utc(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, reading the wall time as UTC in any session zone.

    A plain cast would read it in the session zone; the micro-second distance
    from the NTZ epoch does not depend on any zone."""
    col = F.col(c) if isinstance(c, str) else c
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    return F.timestamp_micros(micros)


def as_watermarkable(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Streams need TIMESTAMP (not TIMESTAMP_NTZ) for ``withWatermark`` (7.5.1).

    The NTZ wall time is read as UTC (D19), whatever the session zone.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, ntz_as_utc(ts))
    return df


# Ascending time: the watermark stays just behind the newest row, so rows that tie with
# it are on time (Spark counts a row at the watermark itself as late).
ASCENDING = "1 millisecond"


# Column that marks the closing row of a bounded stream (tidemark.streaming.ending).
END = "_end"


def watermark(df: DataFrame, ts: str = "ts", delay: str = ASCENDING) -> DataFrame:
    """Ascending time is a delay of 1 ms; bounded disorder a longer one.

    Allowed lateness (T4) has no separate knob in Spark: pass delay =
    out-of-orderness + lateness and run the query in ``update`` mode.
    A closing row (column ``_end``, T6) moves the watermark and goes no further.
    """
    w = as_watermarkable(df, ts).withWatermark(ts, delay)
    if END not in df.columns:
        return w
    # names the time column, so it stays above the watermark (D23); rows without a time are not the closing one
    return w.where(F.when(F.col(ts).isNull(), F.lit(True)).otherwise(~F.col(END))).drop(END)


def keep_for_watermark(predicate: Column, ts: str = "ts") -> Column:
    """A filter that still lets dropped rows advance the watermark.

    Catalyst pushes a predicate that does not mention the event-time column
    below the watermark node, so rows it drops would no longer move the
    watermark.  Naming the time column inside the predicate keeps the filter
    above it; the result is the same set of rows.
    """
    return F.when(F.col(ts).isNull(), F.lit(False)).otherwise(predicate)
