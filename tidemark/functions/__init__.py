"""Column-level helpers: event time, hashing, text formats."""

from tidemark.functions.eventtime import (  # noqa: F401
    interval, to_event_time, watermark, as_watermarkable, keep_for_watermark,
)
from tidemark.functions.hashing import poly_hash  # noqa: F401
from tidemark.functions.formatting import (  # noqa: F401
    text_time, text_time_millis, encode_line, encode_json,
)
