"""Streaming forms against batch forms.

The driver's sf0.001 ``events`` are cut into four time-ordered files and
fed one file per micro-batch with ``availableNow``.  Streamed rows must equal
the batch rows, with a closing row (T6) all of them, else on every window the final watermark has closed.
"""

import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import frame
from tidemark.functions.eventtime import as_watermarkable
from tidemark.operators import matching, patterns, topn, windows
from tidemark.operators.distinct import distinct_count
from tidemark.sources import tables
from tidemark.streaming import distinct as sdistinct, matching as smatching, processors, windows as swindows
from tidemark.streaming.ending import Ending, run_to_end
from tidemark.streaming.runner import run_available

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events_dir(spark):
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    ev = as_watermarkable(tables.table(spark, SF, "events"))
    bounds = ev.select(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    span = (bounds["b"] - bounds["a"]) / 4
    for i in range(4):
        lo, hi = bounds["a"] + span * i, bounds["a"] + span * (i + 1)
        part = ev.where((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < 3 else F.lit(True)))
        part.coalesce(1).write.parquet(f"{d}/part={i:02d}")
    return d, ev


def _ck():
    return tempfile.mkdtemp(prefix="tidemark-ck-")


def _stream(spark, events_dir):
    d, ev = events_dir
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/part=*")


def _closed_ms(ev):
    """The final watermark of a run over all of ``ev``: 1 ms behind its newest row."""
    return ev.agg(F.unix_millis(F.max("ts"))).first()[0] - 1


def _last_ts(ev):
    return ev.agg(F.max("ts")).first()[0]


def test_pane_counts_stream_equals_batch(spark, events_dir):
    views = tables.behaviour(_stream(spark, events_dir)).where(F.col("behavior") == "view")
    s = swindows.windowed_counts(views, "1 day", "1 hour", keys=[], panes=True)
    run_available(s, "pv_sliding", checkpoint=_ck())
    got = spark.table("pv_sliding")
    batch = windows.window_counts(tables.behaviour(events_dir[1]).where(F.col("behavior") == "view"),
                                  "1 day", "1 hour", keys=[])
    closed = batch.where(F.col("window_end") <= F.lit(_last_ts(events_dir[1])))
    g = sorted(got.collect())
    assert g and set(g) <= set(batch.collect())
    assert set(closed.where(F.col("window_end") <= F.lit(max(r["window_end"] for r in g))).collect()) == set(g)


def test_top_n_stream_equals_batch(spark, events_dir):
    views = tables.behaviour(_stream(spark, events_dir)).where(F.col("behavior") == "view")
    counts = swindows.windowed_counts(views, "6 hours", "1 hour", keys=["item_id"])
    out = tempfile.mkdtemp(prefix="tidemark-top-")
    run_available(counts, "top_items", checkpoint=_ck(), foreach_batch=swindows.top_n_writer(
        3, "item_id", "cnt", swindows.parquet_epoch_writer(out)))
    got = set(spark.read.parquet(out).drop("epoch").collect())
    bcounts = windows.window_counts(tables.behaviour(events_dir[1]).where(F.col("behavior") == "view"),
                                    "6 hours", "1 hour", keys=["item_id"])
    batch = topn.top_n_by_count(bcounts, 3, "item_id", "cnt")
    last_end = max(r["window_end"] for r in got)
    assert got == set(batch.where(F.col("window_end") <= F.lit(last_end)).collect())


def test_unique_visitors_stream_equals_batch(spark, events_dir):
    end = Ending(spark, _ck())
    views = end.attach(_stream(spark, events_dir).where(F.col("event_type") == "view"))
    run_to_end(sdistinct.unique_visitors(views, "1 day"), "uv_stream", end, _ck())
    got = set(spark.table("uv_stream").collect())
    batch = set(distinct_count(events_dir[1].where(F.col("event_type") == "view"), "1 day").collect())
    assert got == batch


def test_interval_match_stream_equals_batch(spark, events_dir):
    # pays = purchases, receipts = views of the same user within +-1 hour
    s = _stream(spark, events_dir)
    pays = s.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    recs = s.where(F.col("event_type") == "view").select("user_id", "ts", "event_id")
    run_available(smatching.match_streams(pays, recs, "user_id", "-1 hour", "1 hour"), "tx_stream", checkpoint=_ck())
    got = spark.table("tx_stream")
    ev = events_dir[1]
    bp = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    br = ev.where(F.col("event_type") == "view").select("user_id", "ts", "event_id")
    pairs = matching.interval_join(bp, br, "user_id", "-1 hour", "1 hour")
    m = {(r["p_event_id"], r["r_event_id"]) for r in got.where("tag = 'matched'").collect()}
    assert m == {(r["p_event_id"], r["r_event_id"]) for r in pairs.collect()}
    un = {r["p_event_id"] for r in got.where("tag = 'unmatched_pay'").collect()}
    batch_un = {r["event_id"] for r in matching.unmatched_left(bp, br, "user_id", "-1 hour", "1 hour").collect()}
    wm = min(_closed_ms(bp), _closed_ms(br))
    over = bp.where(F.unix_millis("ts") + 3_600_000 < wm)
    assert un <= batch_un and un >= batch_un & {r["event_id"] for r in over.collect()}


def test_order_machine_stream(spark):
    ev = [(1, "create", 0), (1, "pay", 899), (2, "create", 0), (2, "pay", 900), (3, "create", 0),
          (4, "pay", 0), (5, "pay", 0), (5, "create", 5), (6, "create", 0), (6, "create", 600),
          (6, "pay", 1000), (8, "create", 0), (8, "pay", 10), (8, "pay", 20), (7, "create", 5000)]
    d = tempfile.mkdtemp(prefix="tidemark-orders-") + "/data"
    frame(spark, ev, ["order_id", "event_type", "t"]).coalesce(1).write.parquet(d)
    src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    run_available(processors.order_outcomes_stream(src, "900 seconds"), "orders_stream", checkpoint=_ck())
    rows = [(r["order_id"], r["result"]) for r in spark.table("orders_stream").collect()]
    assert sorted(rows) == sorted({1: "payed successfully", 2: "payed but already timeout", 3: "order timeout",
                                   4: "already pay but not found create", 5: "payed", 6: "payed successfully",
                                   8: "payed successfully"}.items())


def test_click_cap_stream(spark):
    rows = [(10, 1, 5, "p"), (20, 1, 5, "p"), (30, 1, 5, "q"), (40, 1, 5, "p"), (50, 1, 6, "q"), (86400, 1, 5, "p"), (90000, 2, 5, "p")]
    d = tempfile.mkdtemp(prefix="tidemark-ads-") + "/data"
    frame(spark, rows, ["t", "user_id", "ad_id", "province"]).coalesce(1).write.parquet(d)
    src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    run_available(processors.click_cap_stream(src, 2), "cap_stream", checkpoint=_ck())
    out = spark.table("cap_stream")
    assert sorted(r["seq"] for r in out.where("tag = 'pass'").collect()) == [0, 1, 4, 5]
    assert [(r["user_id"], r["ad_id"], r["msg"]) for r in out.where("tag = 'warning'").collect()] == [
        (1, 5, "Click over 2 times today.")]


def test_login_stream_equals_batch(spark, events_dir):
    logins = tables.logins(_stream(spark, events_dir))
    run_available(processors.login_fail_stream(logins, "6 hours", message="login fail"), "login_stream", checkpoint=_ck())
    got = {(r["user_id"], r["first_fail_ms"], r["last_fail_ms"]) for r in spark.table("login_stream").collect()}
    batch = patterns.login_fail_pairs(tables.logins(events_dir[1]), "6 hours")
    b = {(r["user_id"], r["f"], r["l"]) for r in batch.select(
        "user_id", F.unix_millis(F.col("first_fail_time").cast("timestamp")).alias("f"),
        F.unix_millis(F.col("last_fail_time").cast("timestamp")).alias("l")).collect()}
    wm = _closed_ms(events_dir[1])
    assert got and got == {p for p in b if p[2] <= wm}


def test_late_rows_correct_hot_urls(spark):
    """F-LATE: window 60 s, watermark 1 s disorder + 60 s lateness, update mode."""
    from helpers import frame
    arrivals = [(5, "/a"), (8, "/b"), (70, "/a"), (9, "/b"), (190, "/a")]
    src = tempfile.mkdtemp(prefix="tidemark-late-")
    rows = frame(spark, arrivals, ["t", "url"])
    for i in range(len(arrivals)):
        rows.where(f"seq = {i}").coalesce(1).write.parquet(f"{src}/f{i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/f*")
    counts = swindows.windowed_counts(stream, "60 seconds", keys=["url"], delay="61 seconds", out="hits")
    log = tempfile.mkdtemp(prefix="tidemark-log-")
    run_available(counts, "late_urls", mode="update", checkpoint=_ck(),
                  foreach_batch=swindows.change_log_writer(log, "url", "hits"))
    top = swindows.corrected_top_n(spark.read.parquet(log).drop("level", "upto"), 5, "url", "hits")
    from helpers import secs
    got = sorted((int(r["e"]), r["rank"], r["url"], r["hits"]) for r in top.select(
        secs("window_end").alias("e"), "rank", "url", "hits").collect())
    assert got == [(60, 1, "/b", 2), (60, 2, "/a", 1), (120, 1, "/a", 1), (240, 1, "/a", 1)]
    # the first emission of window [0, 60) had /a ahead of /b (a,b -> b,a after the late row)
    first = spark.read.parquet(log).where("url = '/b'").orderBy("epoch").first()
    assert first["hits"] == 1


def test_pattern_stream_equals_batch(spark, events_dir):
    s = tables.behaviour(_stream(spark, events_dir)).withColumnRenamed("behavior", "event_type")
    run_available(processors.pattern_stream(s, "user_id", "click", "purchase", "1 day"), "pattern_stream",
                  checkpoint=_ck())
    got = {(r["key"], r["start_ms"], r["end_ms"], r["outcome"]) for r in spark.table("pattern_stream").collect()}
    b = tables.behaviour(events_dir[1]).withColumnRenamed("behavior", "event_type")
    batch = patterns.order_pattern(b, "1 day", key="user_id", create=F.col("event_type") == "click",
                                   pay=F.col("event_type") == "purchase")
    bset = {(r["user_id"], r["s"], r["e"], r["outcome"]) for r in batch.select(
        "user_id", F.unix_millis(F.col("start_ts").cast("timestamp")).alias("s"),
        F.unix_millis(F.col("end_ts").cast("timestamp")).alias("e"), "outcome").collect()}
    wm = _closed_ms(events_dir[1])
    assert got and got == {r for r in bset if (r[2] if r[3] == "match" else r[1] + 86_400_000) <= wm}


def test_pattern_stream_fixture(spark):
    from helpers import frame
    ev = [(1, "create", 0), (1, "other", 1000), (1, "pay", 1500),
          (2, "create", 0), (2, "pay", 2000),
          (3, "create", 0), (3, "create", 1000), (3, "pay", 1500),
          (4, "create", 0), (4, "pay", 1000), (4, "pay", 1500),
          (5, "pay", 0), (6, "create", 0), (99, "other", 60000)]
    d = tempfile.mkdtemp(prefix="tidemark-pat-") + "/data"
    frame(spark, ev, ["order_id", "event_type", "t"], millis=True).coalesce(1).write.parquet(d)
    for strict, expected in ((False, {(1, "match"): 1, (2, "timeout"): 1, (3, "match"): 2, (4, "match"): 1,
                                      (6, "timeout"): 1}),
                             (True, {(2, "timeout"): 1, (3, "match"): 1, (4, "match"): 1, (6, "timeout"): 1})):
        src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
        name = f"pat_fixture_{int(strict)}"
        run_available(processors.pattern_stream(src, "order_id", "create", "pay", "2 seconds", strict=strict),
                      name, checkpoint=_ck())
        got = {}
        for r in spark.table(name).collect():
            got[(r["key"], r["outcome"])] = got.get((r["key"], r["outcome"]), 0) + 1
        assert got == expected, strict
        batch = patterns.two_step(frame(spark, ev, ["order_id", "event_type", "t"], millis=True), ["order_id"],
                                  F.col("event_type") == "create", F.col("event_type") == "pay", "2 seconds",
                                  "strict" if strict else "relaxed")
        bgot = {}
        for r in batch.collect():
            bgot[(r["order_id"], r["outcome"])] = bgot.get((r["order_id"], r["outcome"]), 0) + 1
        assert bgot == expected, strict


def test_one_to_one_stream_fixture(spark):
    """F-TX: +-5 s, k-th pairing, with a trailing row that closes every range."""
    from helpers import frame
    pays = frame(spark, [("a", 10), ("b", 20), ("c", 30), ("d", 40), ("d", 41), ("", 50), ("z", 500)], ["tx_id", "t"])
    recs = frame(spark, [("a", 15), ("b", 26), ("d", 42), ("e", 60), ("z", 500)], ["tx_id", "t"])
    dp, dr = (tempfile.mkdtemp(prefix="tidemark-tx-") + "/d" for _ in range(2))
    pays.coalesce(1).write.parquet(dp)
    recs.coalesce(1).write.parquet(dr)
    sp = spark.readStream.schema(pays.schema).parquet(dp).where(F.col("tx_id") != "")
    sr = spark.readStream.schema(recs.schema).parquet(dr)
    run_available(processors.one_to_one_stream(sp, sr, "tx_id", "-5 seconds", "5 seconds"), "tx_one",
                  checkpoint=_ck())
    base = 1704067200000
    got = sorted((r["tag"], r["tx_id"], None if r["pay_ms"] is None else (r["pay_ms"] - base) // 1000,
                  None if r["receipt_ms"] is None else (r["receipt_ms"] - base) // 1000)
                 for r in spark.table("tx_one").where("tx_id <> 'z'").collect())
    assert got == sorted([("matched", "a", 10, 15), ("matched", "d", 40, 42),
                          ("unmatched_pay", "b", 20, None), ("unmatched_pay", "c", 30, None),
                          ("unmatched_pay", "d", 41, None),
                          ("unmatched_receipt", "b", None, 26), ("unmatched_receipt", "e", None, 60)])


def test_click_cap_stream_processing_reset(spark):
    """ST8: wall-clock reset; within one run every click of the input is the same 'day'."""
    from helpers import frame
    rows = [(10, 1, 5, "p"), (20, 1, 5, "p"), (30, 1, 5, "q"), (40, 1, 5, "p"), (50, 1, 6, "q"), (86400, 1, 5, "p")]
    d = tempfile.mkdtemp(prefix="tidemark-ads-p-") + "/data"
    frame(spark, rows, ["t", "user_id", "ad_id", "province"]).coalesce(1).write.parquet(d)
    src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    run_available(processors.click_cap_stream(src, 2, reset="processing"), "cap_stream_p", checkpoint=_ck(),
                  available_now=False, until=lambda: spark.table("cap_stream_p").count() >= 4, max_seconds=90)
    out = spark.table("cap_stream_p")
    assert sorted(r["seq"] for r in out.where("tag = 'pass'").collect()) == [0, 1, 4]
    assert out.where("tag = 'warning'").count() == 1


def test_running_unique_stream_equals_batch(spark, events_dir):
    from tidemark.operators.distinct import running_distinct
    views = _stream(spark, events_dir).where(F.col("event_type") == "view").withColumnRenamed("event_id", "seq")
    totals, out = tempfile.mkdtemp(prefix="tidemark-tot-"), tempfile.mkdtemp(prefix="tidemark-ru-")
    from tidemark.streaming.windows import parquet_epoch_writer
    run_available(sdistinct.first_sightings(views, "1 day"), "ru_stream", checkpoint=_ck(),
                  foreach_batch=sdistinct.running_unique_writer(totals, parquet_epoch_writer(out)))
    got = {(r["seq"], r["uv"]) for r in spark.read.parquet(out).collect()}
    bv = events_dir[1].where(F.col("event_type") == "view").withColumnRenamed("event_id", "seq")
    batch = {(r["seq"], r["uv"]) for r in running_distinct(bv, "1 day").collect()}
    assert got and got == batch


def test_ad_clicks_job_counts_per_province(spark):
    """Q10 end to end: click cap, then passing clicks per province in the same query."""
    from helpers import frame
    from tidemark.streaming import jobs
    rows = [(10, 1, 5, "p"), (20, 1, 5, "p"), (30, 1, 5, "q"), (40, 1, 5, "p"), (50, 1, 6, "q"),
            (86400, 1, 5, "p"), (200000, 9, 9, "z")]
    d = tempfile.mkdtemp(prefix="tidemark-adjob-") + "/data"
    frame(spark, rows, ["t", "user_id", "ad_id", "province"]).coalesce(1).write.parquet(d)
    src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    _, counts = jobs.ad_clicks(src, cap=2, size="1 day", slide="1 day")
    run_available(counts, "ad_prov", checkpoint=_ck())
    got = sorted((r["province"], r["cnt"]) for r in spark.table("ad_prov").collect())
    assert got == [("p", 1), ("p", 2), ("q", 1)]


def test_order_machine_stream_on_driver_tables(spark):
    """ST5 at data scale: create = order date, pay = each ship date (first decides), 365 days.

    A stream may report ``order timeout`` before a late pay (D14); everything
    else equals the batch answer on orders the watermark has decided."""
    from tidemark.operators.patterns import order_outcomes
    ev = tables.order_events(tables.table(spark, SF, "orders"), tables.table(spark, SF, "lineitem"))
    ev = as_watermarkable(ev.withColumn("seq", F.xxhash64("order_id", "event_type", "ts")))
    d = tempfile.mkdtemp(prefix="tidemark-ordev-")
    b = ev.select(F.min("ts").alias("a"), F.max("ts").alias("z")).first()
    step = (b["z"] - b["a"]) / 6
    for i in range(6):
        hi = (F.col("ts") < b["a"] + step * (i + 1)) if i < 5 else F.lit(True)
        ev.where((F.col("ts") >= b["a"] + step * i) & hi).coalesce(1).write.parquet(f"{d}/part={i}")
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/part=*")
    # In this data the line items of an order ship up to ~2,500 days apart, and a first
    # ship date can precede the order date by years.  A retention and a pay wait above
    # that keep one result per order and let a pay wait for its create, as in batch.
    run_available(processors.order_outcomes_stream(src, "365 days", pay_wait="3650 days",
                                                   retention="3650 days"), "orders_big", checkpoint=_ck())
    streamed = {}
    for r in spark.table("orders_big").collect():
        streamed.setdefault(r["order_id"], []).append(r["result"])
    wm, day = _closed_ms(ev), 86_400_000
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    want = {}
    for r in order_outcomes(ev, "365 days").select("order_id", "result", ms("create_ts").alias("c"), ms("pay_ts").alias("p")).collect():
        c, p, late = r["c"], r["p"], r["result"] == "payed but already timeout"
        due = None if c is None else c + 365 * day
        timed_out = r["result"] == "order timeout" or (late and p > due)      # D14: reported first, then the late pay
        res = ["order timeout"] if timed_out and due <= wm else []
        if late or r["result"] == "payed successfully":
            res += [r["result"]] if p <= wm else []
        elif r["result"] == "already pay but not found create":
            res += [r["result"]] if p + 3650 * day <= wm else []
        elif r["result"] == "payed":
            res += [r["result"]]                          # the later create decides; all creates are behind the end
        if res:
            want[r["order_id"]] = res
    assert streamed and {o: sorted(v) for o, v in streamed.items()} == {o: sorted(v) for o, v in want.items()}


def test_click_cap_stream_equals_batch_on_events(spark, events_dir):
    from tidemark.operators import limits
    ads = tables.ad_clicks(_stream(spark, events_dir))
    run_available(processors.click_cap_stream(ads, 2), "cap_big", checkpoint=_ck())
    out = spark.table("cap_big")
    passed = {r["seq"] for r in out.where("tag = 'pass'").collect()}
    warned = {r["seq"] for r in out.where("tag = 'warning'").collect()}
    wm = _closed_ms(events_dir[1])
    b_ads = tables.ad_clicks(events_dir[1]).where(F.unix_millis("ts") <= wm)
    assert passed == {r["seq"] for r in limits.capped_clicks(b_ads, 2).collect()}
    b_warn = limits.blacklist_warnings(b_ads, 2).select("user_id", "ad_id", "ts")
    assert len(warned) == b_warn.count()


def test_one_to_one_stream_equals_batch_on_tables(spark):
    """J2-J4 at data scale: pays = orders, receipts = line items, +-60 days, k-th pairing."""
    from tidemark.operators import matching
    orders = tables.table(spark, SF, "orders")
    lines = tables.table(spark, SF, "lineitem")
    pays = as_watermarkable(orders.select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("ts"))
                            .withColumn("seq", F.col("tx_id")))
    recs = as_watermarkable(lines.select(F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("ts"),
                                         "l_linenumber", "l_partkey", "l_suppkey")
                            .withColumn("seq", F.xxhash64("tx_id", "l_linenumber", "l_partkey", "l_suppkey", "ts")))
    dp, dr = tempfile.mkdtemp(prefix="tidemark-p-"), tempfile.mkdtemp(prefix="tidemark-r-")
    for df, d in ((pays, dp), (recs, dr)):
        b = df.select(F.min("ts").alias("a"), F.max("ts").alias("z")).first()
        step = (b["z"] - b["a"]) / 4
        for i in range(4):
            hi = (F.col("ts") < b["a"] + step * (i + 1)) if i < 3 else F.lit(True)
            df.where((F.col("ts") >= b["a"] + step * i) & hi).coalesce(1).write.parquet(f"{d}/part={i}")
    sp = spark.readStream.schema(pays.schema).option("maxFilesPerTrigger", 1).parquet(f"{dp}/part=*")
    sr = spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", 1).parquet(f"{dr}/part=*")
    run_available(processors.one_to_one_stream(sp, sr, "tx_id", "-60 days", "60 days"), "tx_big", checkpoint=_ck())
    got = spark.table("tx_big")
    out = matching.one_to_one(pays, recs, "tx_id", "-60 days", "60 days", right_order=["ts", "seq"])
    ms = lambda c: F.unix_millis(F.col(c))
    b_matched = {(str(r[0]), r[1], r[2]) for r in out["matched"].select("p_tx_id", ms("p_ts"), ms("r_ts")).collect()}
    s_matched = {(str(r["tx_id"]), r["pay_ms"], r["receipt_ms"]) for r in got.where("tag = 'matched'").collect()}
    assert s_matched == b_matched
    s_unpaid = {(str(r["tx_id"]), r["pay_ms"]) for r in got.where("tag = 'unmatched_pay'").collect()}
    b_unpaid = {(str(r[0]), r[1]) for r in out["unmatched_left"].select("tx_id", ms("ts")).collect()}
    wm, span = min(_closed_ms(pays), _closed_ms(recs)), 60 * 86_400_000
    known = {(str(r[0]), r[1]) for r in recs.select("tx_id", ms("ts")).collect() if r[1] <= wm}
    assert s_unpaid <= b_unpaid and s_unpaid >= {p for p in b_unpaid if p[1] + span + 1 <= wm}
    assert known


def test_login_stream_hot_user_equals_batch(spark, events_dir):
    """A user with a third of the events: same pairs as batch."""
    def hot(df):
        return df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") + 1))
    logins = tables.logins(hot(_stream(spark, events_dir)))
    run_available(processors.login_fail_stream(logins, "6 hours", message="x"), "login_hot", checkpoint=_ck())
    got = {(r["user_id"], r["first_fail_ms"], r["last_fail_ms"]) for r in spark.table("login_hot").collect()}
    batch = patterns.login_fail_pairs(tables.logins(hot(events_dir[1])), "6 hours")
    b = {(r["user_id"], r["f"], r["l"]) for r in batch.select(
        "user_id", F.unix_millis(F.col("first_fail_time").cast("timestamp")).alias("f"),
        F.unix_millis(F.col("last_fail_time").cast("timestamp")).alias("l")).collect()}
    assert any(u == 0 for u, _, _ in got)
    wm = _closed_ms(events_dir[1])
    assert got == {p for p in b if p[2] <= wm}


def test_approx_unique_visitors_stream_equals_batch(spark, events_dir):
    from tidemark.operators.distinct import approx_distinct_count
    end = Ending(spark, _ck())
    views = end.attach(_stream(spark, events_dir).where(F.col("event_type") == "view"))
    run_to_end(sdistinct.approx_unique_visitors(views, "1 day"), "hll_stream", end, _ck())
    got = {(r["window_end"], r["uv"]) for r in spark.table("hll_stream").collect()}
    batch = {(r["window_end"], r["uv"]) for r in approx_distinct_count(
        as_watermarkable(events_dir[1]).where(F.col("event_type") == "view"), "1 day").collect()}
    assert got == batch


def test_bucketed_interval_match_stream_equals_batch(spark, events_dir):
    s, end = _stream(spark, events_dir), Ending(spark, _ck())
    pays = end.attach(s.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id"))
    recs = end.attach(s.where(F.col("event_type") == "view").select("user_id", "ts", "event_id"))
    run_to_end(smatching.match_streams_bucketed(pays, recs, "user_id", "-1 hour", "1 hour", width="30 minutes"),
               "tx_bucketed", end, _ck())
    got = spark.table("tx_bucketed")
    ev = events_dir[1]
    bp = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    br = ev.where(F.col("event_type") == "view").select("user_id", "ts", "event_id")
    pairs = matching.interval_join(bp, br, "user_id", "-1 hour", "1 hour")
    m = [(r["p_event_id"], r["r_event_id"]) for r in got.where("tag = 'matched'").collect()]
    assert len(m) == len(set(m)) and set(m) == {(r["p_event_id"], r["r_event_id"]) for r in pairs.collect()}
    up = [r["p_event_id"] for r in got.where("tag = 'unmatched_pay'").collect()]
    ur = [r["r_event_id"] for r in got.where("tag = 'unmatched_receipt'").collect()]
    assert len(up) == len(set(up)) and len(ur) == len(set(ur))
    assert set(up) == {r["event_id"] for r in matching.unmatched_left(bp, br, "user_id", "-1 hour", "1 hour").collect()}
    assert ur and set(ur) == {r["event_id"] for r in matching.unmatched_right(bp, br, "user_id", "-1 hour", "1 hour").collect()}

