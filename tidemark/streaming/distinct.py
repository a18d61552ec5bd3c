"""Streaming unique visitors.

``count_distinct`` is refused on streams; the equivalent is a deduplication
on (window, user) followed by a count per window.  The dedup state of a
window is dropped once the watermark passes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.eventtime import ASCENDING, watermark
from tidemark.operators.distinct import bitmap_offset


def unique_visitors(stream: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                    delay: str = ASCENDING, out: str = "uv", bitmap: bool = False,
                    upstream_watermark: bool = False) -> DataFrame:
    s = (stream if upstream_watermark else watermark(stream, ts, delay)).withColumn("_w", F.window(ts, size))
    u = bitmap_offset(user) if bitmap else F.col(user)
    d = s.withColumn("_u", u).dropDuplicates(["_w", "_u"])
    return (d.groupBy("_w").agg(F.count(F.lit(1)).alias(out))
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), out))


def approx_unique_visitors(stream: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                           delay: str = ASCENDING, out: str = "uv", lg_k: int = 12) -> DataFrame:
    """A7 estimate on a stream: an HLL sketch per window, a mergeable aggregate, so
    state per window is one small sketch instead of a set of users."""
    s = watermark(stream, ts, delay)
    return (s.groupBy(F.window(ts, size).alias("_w"))
            .agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(user), lg_k)).alias(out))
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), out))


# ---------------------------------------------------------------- A9 / T8 running count per event
import pandas as pd  # noqa: E402
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle  # noqa: E402

from tidemark.operators.distinct import RUNNING_BUCKET  # noqa: E402
from tidemark.operators.ordered import running_sum  # noqa: E402
from tidemark.streaming import folders  # noqa: E402

_FIRST = ["window_end_ms", "user", "ts_ms", "seq", "is_first", "late", "watermark_ms"]
FIRST_OUT = ("window_end_ms LONG, user STRING, ts_ms LONG, seq LONG, is_first BOOLEAN, late BOOLEAN, "
             "watermark_ms LONG")


class FirstSighting(StatefulProcessor):
    """Per (window, user): flag the first event, pass repeats through (A6 state, S6).

    Keyed by (window, user), so the seen-set of a window is spread over all
    tasks instead of living in one bitmap; an event-time timer at the window
    end drops the key's state.  Rows of a window the watermark has closed come
    out flagged ``late``.  Arrow batches are passed on one by one: only the
    candidate for the first sighting is held back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "s BOOLEAN")

    def handleInputRows(self, key, rows, timerValues):
        wm, end = timerValues.getCurrentWatermarkInMs(), int(key[0])
        late = end <= wm
        first = None if late or self.seen.get() is not None else pd.DataFrame()

        def out(pdf, is_first):
            return pd.DataFrame({"window_end_ms": end, "user": str(key[1]), "ts_ms": pdf["ts_ms"].astype("int64").values,
                                 "seq": pdf["seq"].astype("int64").values, "is_first": is_first, "late": late, "watermark_ms": wm})[_FIRST]

        for pdf in rows:
            if first is not None:
                pdf = pd.concat([first, pdf]).sort_values(["ts_ms", "seq"], kind="stable")
                first, pdf = pdf.head(1), pdf.iloc[1:]
            if len(pdf):
                yield out(pdf, False)
        if first is not None and len(first):
            self.seen.update((True,))
            self.handle.registerTimer(end)
            yield out(first, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        """Nothing is held outside the state store."""


def first_sightings(stream: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                    delay: str = ASCENDING, bitmap: bool = False, upstream_watermark: bool = False) -> DataFrame:
    """Stage 1 of the streaming running count: every event with its first-sighting flag."""
    s = stream if upstream_watermark else watermark(stream, ts, delay)
    u = bitmap_offset(user) if bitmap else F.col(user)
    # The watermarked column is not passed on, so Spark drops no late row before the processor sees it.
    s = s.select(F.unix_millis(F.window(ts, size).end).alias("window_end_ms"), u.cast("string").alias("user"),
                 F.unix_millis(F.col(ts)).alias("ts_ms"), "seq")
    return s.groupBy("window_end_ms", "user").transformWithStateInPandas(
        statefulProcessor=FirstSighting(), outputStructType=FIRST_OUT, outputMode="Append", timeMode="EventTime")


def running_unique_writer(totals_path: str, write, repeats_only: bool = True, bucket: str = RUNNING_BUCKET, write_late=None):
    """Stage 2 (``foreachBatch``): running distinct count at every event of the micro-batch.

    count = distinct users of the window before this micro-batch (a totals
    table, one row per open window, written per epoch) + first sightings of this
    micro-batch up to the event (bucketed running sum, no single-task
    window).  Windows the watermark has closed leave the table: they receive
    no more rows (late ones go to ``write_late``).  Two epochs of the table are
    kept, the last committed one and this one, so replaying an epoch rewrites
    the same files (exactly once)."""
    def _batch(df: DataFrame, epoch_id: int) -> None:
        # Several actions below read this micro-batch; keep it for the callback's duration.
        df = df.persist()
        try:
            _write_batch(df, epoch_id)
        finally:
            df.unpersist()

    def _write_batch(df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        before = f"{totals_path.rstrip('/')}/epoch={epoch_id - 1}"
        prev = (spark.read.parquet(before) if epoch_id and folders.exists(spark, before)
                else spark.createDataFrame([], "window_end_ms LONG, total LONG"))
        on_time = df.where(~F.col("late"))
        ev = on_time.withColumn("ts", F.timestamp_millis("ts_ms"))
        run = running_sum(ev, ["window_end_ms"], [F.col("ts"), F.col("seq"), F.col("is_first").desc()],
                          F.col("is_first").cast("long"), "_run", bucket, ts="ts")
        res = (run.join(prev, "window_end_ms", "left")
               .withColumn("uv", F.coalesce(F.col("total"), F.lit(0)) + F.col("_run"))
               .drop("total", "_run", "late", "watermark_ms"))
        if repeats_only:
            res = res.where(~F.col("is_first"))
        write(res, epoch_id)
        if write_late is not None:
            write_late(df.where("late"), epoch_id)
        batch_tot = on_time.groupBy("window_end_ms").agg(F.sum(F.col("is_first").cast("long")).alias("_add"))
        new = (prev.join(batch_tot, "window_end_ms", "full")
               .select("window_end_ms", (F.coalesce(F.col("total"), F.lit(0))
                                         + F.coalesce(F.col("_add"), F.lit(0))).alias("total")))
        passed = df.agg(F.max("watermark_ms")).first()[0]
        if passed is not None:
            new = new.where(F.col("window_end_ms") > F.lit(int(passed)))
        new.write.mode("overwrite").parquet(f"{totals_path.rstrip('/')}/epoch={epoch_id}")
        folders.delete(spark, f"{totals_path.rstrip('/')}/epoch={epoch_id - 2}")
    return _batch
