"""Restart: stop a stream between files, resume from its checkpoint,
and the final rows equal one uninterrupted run."""

import tempfile

from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_watermarkable
from tidemark.sources import tables
from tidemark.streaming import processors, windows as swindows
from tidemark.streaming.runner import run_available

SF = "/root/testdata/sf0.001"


def _write_parts(spark, ev, target, parts):
    bounds = ev.select(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    span = (bounds["b"] - bounds["a"]) / 4
    for i in parts:
        lo, hi = bounds["a"] + span * i, bounds["a"] + span * (i + 1)
        ev.where((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < 3 else F.lit(True))) \
          .coalesce(1).write.parquet(f"{target}/part={i:02d}")


def _query(spark, src, ev):
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")
    views = tables.behaviour(s).where(F.col("behavior") == "view")
    return swindows.windowed_counts(views, "1 day", "1 hour", keys=["item_id"], panes=True)


def test_resume_from_checkpoint_gives_same_rows(spark):
    ev = as_watermarkable(tables.table(spark, SF, "events"))
    once_src, once_out = tempfile.mkdtemp(), tempfile.mkdtemp() + "/out"
    _write_parts(spark, ev, once_src, range(4))
    run_available(_query(spark, once_src, ev), "once", sink="parquet", path=once_out, checkpoint=tempfile.mkdtemp())

    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp() + "/out", tempfile.mkdtemp()
    _write_parts(spark, ev, src, range(2))
    run_available(_query(spark, src, ev), "first_half", sink="parquet", path=out, checkpoint=ck)
    first = spark.read.parquet(out).count()
    _write_parts(spark, ev, src, range(2, 4))
    run_available(_query(spark, src, ev), "second_half", sink="parquet", path=out, checkpoint=ck)

    a = sorted(spark.read.parquet(once_out).collect())
    b = sorted(spark.read.parquet(out).collect())
    assert first > 0 and len(b) > first
    assert a == b


def test_order_machine_resumes(spark):
    from helpers import frame
    ev = [(1, "create", 0), (2, "create", 10), (1, "pay", 100),      # file a
          (3, "pay", 200), (9, "create", 5000),                      # file b: watermark passes 910
          (2, "pay", 2000)]                                          # file c: pay after the timeout
    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp() + "/out", tempfile.mkdtemp()
    rows = frame(spark, ev, ["order_id", "event_type", "t"])
    schema = rows.schema
    q = lambda: processors.order_outcomes_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), "900 seconds")
    for name, lo, hi in (("a", 0, 3), ("b", 3, 5), ("c", 5, 6)):
        rows.where(f"seq >= {lo} AND seq < {hi}").coalesce(1).write.parquet(f"{src}/{name}")
        run_available(q(), f"orders_{name}", sink="parquet", path=out, checkpoint=ck)
    got = set((r["order_id"], r["result"]) for r in spark.read.parquet(out).collect())
    # the pay of order 2 is behind the watermark: tagged late
    assert got == {(1, "payed successfully"), (2, "order timeout"), (3, "already pay but not found create"), (2, "late")}
