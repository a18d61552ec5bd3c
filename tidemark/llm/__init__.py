"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Nothing outside this subpackage imports it.  Each module holds one operator with its own
interface; :mod:`tidemark.llm.queries` applies them to the whole tables.
"""
