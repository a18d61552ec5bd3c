"""Text forms for sinks (K4, S7, time formatting).

Results stay typed; text is produced only where a sink needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed text formats of the reference's outputs.
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"      # formatted times in warnings and UV rows
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.S"     # default timestamp text of window bounds


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_time(c: Column | str) -> Column:
    return F.date_format(_c(c), SECONDS_FORMAT)


def text_time_millis(c: Column | str) -> Column:
    return F.date_format(_c(c), MILLIS_FORMAT)


def encode_line(*cols: Column | str, sep: str = ",") -> Column:
    """Record -> one delimited line (the topic message value)."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def encode_json(*cols: Column | str) -> Column:
    """S7, JSON form: record -> one JSON object per line."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))
