"""Run a streaming DataFrame over the input available now (tests, backfills)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from tidemark.session import checkpoint_location


def start(df: DataFrame, name: str, mode: str = "append", sink: str = "memory", foreach_batch=None, path: str | None = None,
          checkpoint: str | None = None, available_now: bool = False):
    """Start a query on a named sink or a ``foreachBatch`` function; its checkpoint is in the shared folder."""
    w = (df.writeStream.outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.start()


def run_available(df: DataFrame, name: str, mode: str = "append", sink: str = "memory",
                  foreach_batch=None, path: str | None = None, checkpoint: str | None = None,
                  available_now: bool = True, until=None, poll_seconds: float = 1.0,
                  max_seconds: float | None = None) -> None:
    """Process everything available, then stop.

    ``availableNow`` by default.  A query with pending processing-time timers
    (ST8) never becomes idle, under ``availableNow`` or ``processAllAvailable``;
    pass ``available_now=False`` and ``until``, a callable that says when the
    output is complete (polled every ``poll_seconds``).  With ``max_seconds`` a
    ``TimeoutError`` is raised if that does not happen in time: an incomplete
    output is never returned as if it were whole.
    The checkpoint lives under the shared checkpoint folder, so a restarted
    query resumes from the last committed micro-batch.
    """
    q = start(df, name, mode, sink, foreach_batch, path, checkpoint, available_now)
    if available_now:
        q.awaitTermination()
    else:
        if until is None:
            raise ValueError("without available_now, until must say when the output is complete")
        deadline = None if max_seconds is None else time.monotonic() + max_seconds
        try:
            while q.isActive and not until():
                if deadline is not None and time.monotonic() > deadline:
                    raise TimeoutError(f"{name}: the output was not complete after {max_seconds} s")
                time.sleep(poll_seconds)
        finally:
            q.stop()
    if q.exception() is not None:
        raise q.exception()
