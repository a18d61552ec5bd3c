"""Structured Streaming forms of the operators.

Each streaming form is checked against its batch form: on windows the
watermark has closed, the streamed rows equal the batch rows.  Spark does
not flush open windows at the end of a bounded input (T6); the batch form
gives the complete answer for a finished input.
"""
