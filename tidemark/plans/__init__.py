"""The query catalog over the driver tables and its SQL oracle."""

from tidemark.plans.catalog import QUERIES, flagship  # noqa: F401
from tidemark.plans.oracle import ORACLE_SQL  # noqa: F401
