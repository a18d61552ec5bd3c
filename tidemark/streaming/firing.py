"""Window counts that fire once at the close and once per late row (T4, T7), and top N from map state (ST11).

Spark's own aggregation emits a changed count at every micro-batch (update mode) or once, without
corrections (append mode).  Here two event-time timers per window, at its end and at end + lateness, give the
reference's firings: nothing before the close, the count at the close, the corrected count after
each row within the lateness, and rows later still tagged ``late``.  The watermarked column does not go to
the processor, so Spark drops no row unseen.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.eventtime import ASCENDING, keep_for_watermark, watermark
from tidemark.operators.windows import seconds

CLOSE, CORRECTION, LATE = "close", "correction", "late"


class _Fired(StatefulProcessor):
    """Both timers of a window: subclasses keep the counts."""

    def __init__(self, lateness_ms: int):
        self.lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fired = handle.getValueState("fired", "f BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm, end = timerValues.getCurrentWatermarkInMs(), int(key[0])
        if end + self.lateness_ms <= wm:
            for pdf in rows:
                yield self.out([(end, u, None, LATE) for u in pdf["key"].tolist()])
            return
        got = self.fired.get()
        if end > wm:
            for pdf in rows:
                self.add(pdf["key"])
            if got is None:
                self.fired.update((False,))
                self.handle.registerTimer(end)
            return
        # The window has closed.  What it held fires first, then every late row for itself.
        if got is not None and not got[0]:
            yield self.out([(end, u, n, CLOSE) for u, n in self.closing()])
            self.handle.deleteTimer(end)
        for pdf in rows:
            yield self.out([(end, u, self.add_one(u), CORRECTION) for u in pdf["key"].tolist()])
        if got is None or not got[0]:
            self.fired.update((True,))
            self.handle.registerTimer(end + self.lateness_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, wm = int(key[0]), timerValues.getCurrentWatermarkInMs()
        got = self.fired.get()
        if got is not None and not got[0]:
            yield self.out([(end, u, n, CLOSE) for u, n in self.closing()])
            if end + self.lateness_ms > wm:
                self.fired.update((True,))
                self.handle.registerTimer(end + self.lateness_ms)
                return
        self.fired.clear()
        self.clear()

    def out(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["window_end_ms", "key", "n", "firing"]).astype({"n": "Int64"})

    def close(self) -> None:
        """Nothing is held outside the state store."""


class WindowFiring(_Fired):
    """One count per (window, key)."""

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("count", "key STRING, n LONG")

    def _n(self):
        got = self.state.get()
        return got[1] if got is not None else 0

    def add(self, keys: pd.Series) -> None:
        if len(keys):
            self.state.update((keys.iloc[0], self._n() + len(keys)))

    def add_one(self, key):
        n = self._n() + 1
        self.state.update((key, n))
        return n

    def closing(self):
        return [tuple(self.state.get())]

    def clear(self):
        self.state.clear()


class BucketTop(_Fired):
    """ST11: a map key -> count per (window, bucket of keys); at the close the bucket's first ``n`` come out.

    A window's top N is among its buckets' top N, so no window is one key of the stream.  A late row
    brings its key with the corrected count, whether it was among the first or not."""

    def __init__(self, lateness_ms: int, n: int):
        super().__init__(lateness_ms)
        self.n = n

    def init(self, handle):
        super().init(handle)
        self.counts = handle.getMapState("counts", "key STRING", "n LONG")

    def _n(self, key):
        return self.counts.getValue((key,))[0] if self.counts.containsKey((key,)) else 0

    def add(self, keys: pd.Series) -> None:
        for key, n in keys.value_counts(sort=False).items():
            self.counts.updateValue((key,), (self._n(key) + int(n),))

    def add_one(self, key):
        n = self._n(key) + 1
        self.counts.updateValue((key,), (n,))
        return n

    def closing(self):
        best = heapq.nsmallest(self.n, ((-v[0], k[0].encode()) for k, v in self.counts.iterator()))
        return [(k.decode(), -n) for n, k in best]

    def clear(self):
        self.counts.clear()


OUT = "window_end_ms LONG, key STRING, n LONG, firing STRING"


def _keyed(stream: DataFrame, key: str, size: str, slide: str | None, ts: str, delay: str) -> DataFrame:
    # a row without a key, the closing one too, still moves the watermark
    s = watermark(stream, ts, delay).where(keep_for_watermark(F.col(key).isNotNull(), ts))
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return s.select(F.unix_millis(w.end).alias("window_end_ms"), F.col(key).cast("string").alias("key"))


def _typed(out: DataFrame, key: str, count: str, size: str) -> DataFrame:
    end = F.timestamp_millis("window_end_ms")
    return out.select((end - F.expr(f"INTERVAL {seconds(size)} seconds")).alias("window_start"), end.alias("window_end"),
                      F.col("key").alias(key), F.col("n").alias(count), "firing")


def window_firings(stream: DataFrame, key: str, size: str, slide: str | None = None, lateness: str = "60 seconds",
                   ts: str = "ts", delay: str = ASCENDING, count: str = "cnt") -> DataFrame:
    """T4: (window_start, window_end, key, count, firing): ``close`` once per (window, key), then ``correction``
    once per row within ``lateness``; rows after that come out ``late`` with a null count.

    Rows without a key are left out (F3).  ``delay`` is the disorder alone: the lateness is on top of it."""
    s = _keyed(stream, key, size, slide, ts, delay)
    out = s.select("window_end_ms", F.col("key").alias("k"), "key").groupBy("window_end_ms", "k").transformWithStateInPandas(
        statefulProcessor=WindowFiring(seconds(lateness) * 1000), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    return _typed(out, key, count, size)


def bucket_tops(stream: DataFrame, key: str, n: int, size: str, slide: str | None = None, lateness: str = "60 seconds",
                buckets: int = 64, ts: str = "ts", delay: str = ASCENDING, count: str = "cnt") -> DataFrame:
    """ST11: candidates of every window's top ``n`` (columns as :func:`window_firings`), from a map per (window, bucket)."""
    s = _keyed(stream, key, size, slide, ts, delay)
    s = s.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    out = s.groupBy("window_end_ms", "bucket").transformWithStateInPandas(
        statefulProcessor=BucketTop(seconds(lateness) * 1000, n), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    return _typed(out, key, count, size)
