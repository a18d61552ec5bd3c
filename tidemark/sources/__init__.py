"""Sources (S1, S2) and line parsers (P1-P6), plus the driver-table mappings."""

from tidemark.sources.lines import (  # noqa: F401
    parse_delimited, parse_behaviour, parse_login, parse_order, parse_receipt,
    parse_access_log, split_rejects, Field,
)
from tidemark.sources.readers import read_lines, read_numbered_lines, read_kafka  # noqa: F401
