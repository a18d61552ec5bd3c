"""tidemark: user-behaviour event analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrame(s) to DataFrame.  Batch
forms live in :mod:`tidemark.operators`; Structured Streaming forms in
:mod:`tidemark.streaming`; the query catalog over the driver tables in
:mod:`tidemark.plans`.
"""

__version__ = "0.1.0"
