"""Streams decide by event time and lose no row: ties with the watermark, trailing rows,
lagging inputs, arrival order, key types; processors driven directly for state and cost."""

import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import BASE, frame
from tidemark.streaming import distinct as sdistinct, folders, processors as P
from tidemark.streaming.runner import run_available


def _ck():
    return tempfile.mkdtemp(prefix="tidemark-ck-")


def files(spark, rows, cols, cuts):
    """One file per group of row numbers in ``cuts``, read one per micro-batch in that order."""
    df = frame(spark, rows, cols)
    d = tempfile.mkdtemp(prefix="tidemark-et-")
    for i, seqs in enumerate(cuts):
        df.where(F.col("seq").isin(seqs)).coalesce(1).write.parquet(f"{d}/f{i:02d}")
        time.sleep(0.01)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/f*")


def sec(ms):
    return None if ms is None or ms != ms else (int(ms) - BASE * 1000) / 1000


def test_click_cap_keeps_ties_and_tags_trailing_rows(spark):
    rows = [(10, 1, 7, "p", "x"), (20, 2, 7, "p", "x"), (20, 3, 7, "q", "y"), (20, 4, 7, "p", "x"), (18, 5, 7, "p", "late"),
            (30, 6, 7, "p", "x"), (30, 8, 7, "q", "x"), (30, 9, 7, "p", "x"), (40, 10, 7, "p", "x"), (99, 0, 0, "z", "z")]
    src = files(spark, rows, ["t", "user_id", "ad_id", "province", "city"], [[0, 1], [2, 3, 4], [5, 6], [7, 8], [9]])
    run_available(P.click_cap_stream(src, 5), "et_cap", checkpoint=_ck())
    got = {r["user_id"]: r["tag"] for r in spark.table("et_cap").collect()}
    assert got == {1: "pass", 2: "pass", 3: "pass", 4: "pass", 5: "late", 6: "pass", 8: "pass", 9: "pass", 10: "pass"}
    assert {r["city"] for r in spark.table("et_cap").where("user_id = 5").collect()} == {"late"}


def test_click_cap_is_decided_by_event_time_with_string_users(spark):
    rows = [(50, "bob", 7, "p"), (60, "bob", 7, "p"), (10, "bob", 7, "p"), (20, "bob", 7, "p"), (999, "z", 0, "p")]
    src = files(spark, rows, ["t", "user_id", "ad_id", "province"], [[0, 1], [2, 3], [4]])
    run_available(P.click_cap_stream(src, 2, delay="100 seconds"), "et_cap2", checkpoint=_ck())
    got = {(r["user_id"], sec(r["ts_ms"])): r["tag"] for r in spark.table("et_cap2").collect()}
    assert got == {("bob", 10): "pass", ("bob", 20): "pass", ("bob", 50): "warning"}


def test_orders_and_patterns_tied_with_the_watermark(spark):
    rows = [(1, "create", 5), (2, "create", 10), (1, "pay", 10), (2, "pay", 10), (9, "create", 5000)]
    cuts = [[0], [1], [2], [3], [4]]
    cols = ["order_id", "event_type", "t"]
    run_available(P.order_outcomes_stream(files(spark, rows, cols, cuts), "900 seconds"), "et_orders", checkpoint=_ck())
    assert sorted((r["order_id"], r["result"]) for r in spark.table("et_orders").collect()) == [
        (1, "payed successfully"), (2, "payed successfully")]
    run_available(P.pattern_stream(files(spark, rows, cols, cuts), "order_id", "create", "pay", "900 seconds"), "et_pat", checkpoint=_ck())
    assert sorted((r["key"], r["outcome"], sec(r["end_ms"])) for r in spark.table("et_pat").collect()) == [(1, "match", 10), (2, "match", 10)]
    logins = [("u", "fail", 5), ("v", "fail", 10), ("u", "fail", 10), ("v", "fail", 10), ("w", "success", 5000), ("u", "fail", 7)]
    src = files(spark, logins, ["user_id", "event_type", "t"], [[0], [1], [2], [3], [5], [4]])
    run_available(P.login_fail_stream(src, "100 seconds", message="x"), "et_login", checkpoint=_ck())
    got = sorted((r["user_id"], sec(r["first_fail_ms"]), sec(r["last_fail_ms"]), r["warning"]) for r in spark.table("et_login").collect())
    assert got == [("u", 5, 10, "x"), ("u", 7, None, "late"), ("v", 10, 10, "x")]


def test_order_machine_does_not_depend_on_arrival(spark):
    rows = [("a", "pay", 5), ("a", "create", 1), ("z", "create", 5000)]
    src = files(spark, rows, ["order_id", "event_type", "t"], [[0], [1], [2]])
    run_available(P.order_outcomes_stream(src, "900 seconds", delay="60 seconds"), "et_arrival", checkpoint=_ck())
    assert [(r["order_id"], r["result"]) for r in spark.table("et_arrival").collect()] == [("a", "payed successfully")]


def test_first_sightings_returns_every_row(spark):
    rows = [(1, 10), (2, 20), (1, 20), (3, 20), (1, 30), (2, 30), (3, 30)]
    src = files(spark, rows, ["user_id", "t"], [[0, 1], [2, 3], [4], [5], [6]])
    run_available(sdistinct.first_sightings(src, "1 hour"), "et_first", checkpoint=_ck())
    got = sorted((r["seq"], r["is_first"], r["late"]) for r in spark.table("et_first").collect())
    assert got == [(0, True, False), (1, True, False), (2, False, False), (3, True, False), (4, False, False), (5, False, False), (6, False, False)]


def test_one_to_one_waits_for_the_lagging_input_and_keeps_records(spark):
    pays = files(spark, [("A", 100, 7), ("B", 1000, 8), ("C", 2000, 9), ("D", 3000, 1)], ["tx_id", "t", "amount"], [[0], [1], [2], [3]])
    recs = files(spark, [("x", 10, "c"), ("x", 20, "c"), ("A", 101, "card"), ("E", 3000, "c")], ["tx_id", "t", "channel"], [[0], [1], [2], [3]])
    run_available(P.one_to_one_stream(pays, recs, "tx_id", "-5 seconds", "5 seconds"), "et_tx", checkpoint=_ck())
    got = {r["tx_id"] + r["tag"]: r for r in spark.table("et_tx").collect()}
    a = got["Amatched"]
    assert (sec(a["pay_ms"]), sec(a["receipt_ms"]), a["p_amount"], a["r_channel"]) == (100, 101, 7, "card")
    assert "Bunmatched_pay" in got and not [k for k in got if k.startswith("A") and k != "Amatched"]
    assert got["Bunmatched_pay"]["p_ts"].timestamp() % 1000 == (BASE + 1000) % 1000 and got["Bunmatched_pay"]["r_channel"] is None


# ---- processors driven by stub state -------------------------------------------------------

class Value:
    def __init__(self):
        self.v, self.writes = None, 0

    def get(self):
        return self.v

    def update(self, v):
        self.v, self.writes = v, self.writes + 1

    def clear(self):
        self.v = None


class Rows(Value):
    def get(self):
        return iter(self.v or [])

    def put(self, v):
        self.v = list(v)

    def appendList(self, v):
        self.v = (self.v or []) + list(v)


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getListState(self, name, schema):
        return self.states.setdefault(name, Rows())

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


class Times:
    def __init__(self, wm):
        self.wm = wm

    def getCurrentWatermarkInMs(self):
        return self.wm

    def getExpiryTimeInMs(self):
        return self.wm


def drive(proc, key, batches, wms):
    """Feed frames, then fire what is due at each watermark; returns (rows, handle, seconds)."""
    h, out, t0 = Handle(), [], time.perf_counter()
    proc.init(h)
    for pdf, wm in zip(batches, wms):
        if pdf is not None:
            out += [r for f in proc.handleInputRows((key,), iter([pdf]), Times(0)) for r in f.itertuples(index=False)]
        while h.timers and min(h.timers) <= wm:
            h.timers.discard(min(h.timers))
            out += [r for f in proc.handleExpiredTimer((key,), Times(wm), Times(wm)) for r in f.itertuples(index=False)]
    return out, h, time.perf_counter() - t0


def events(kinds, step=1000):
    return pd.DataFrame({"ts_ms": [1000 + step * i for i in range(len(kinds))], "seq": range(len(kinds)), "event_type": kinds})


@pytest.mark.parametrize("proc, kinds", [(P.TwoStepPattern("fail", "fail", 2000, strict=True), ["success"] * 5000),
                                         (P.TwoStepPattern("create", "pay", 2000), ["pay"] * 5000),
                                         (P.LoginFailPairs(2000, "x"), ["success"] * 5000)])
def test_keys_without_starts_end_with_empty_state(proc, kinds):
    out, h, _ = drive(proc, 1, [events(kinds), None], [2_000_000, 10_000_000])
    assert out == [] and not h.timers and all(not s.v for s in h.states.values())


def test_open_starts_cost_linear_time():
    def cost(n):
        return min(drive(P.TwoStepPattern("create", "pay", 10**9), 1, [events(["create"] * n)] + [None] * 3, [500_000, 10**8, 10**8, 10**10])[2] for _ in range(5))
    cost(500)
    assert cost(16_000) < 8 * cost(4_000)                       # quadratic would be 16
    out, h, _ = drive(P.TwoStepPattern("create", "pay", 10**9), 1, [events(["create"] * 3000 + ["pay"])], [10**9])
    assert len(out) == 3000 and {r.outcome for r in out} == {"match"} and not h.timers


def test_one_to_one_state_is_a_count_after_the_range():
    proc = P.OneToOneMatch(-1000, 1000, {"pay": {"p_x": "bigint"}, "receipt": {"r_x": "bigint"}}, "")
    pdf = pd.DataFrame({"ts_ms": [1000 * i for i in range(1, 401)], "seq": range(400), "side": ["pay"] * 400, "p_x": range(400), "r_x": [None] * 400})
    late = pd.DataFrame({"ts_ms": [10**7], "seq": [0], "side": ["receipt"], "p_x": [None], "r_x": [5]})
    out, h, _ = drive(proc, "t", [pdf, late], [10**6, 10**8])
    assert [r.tag for r in out] == ["unmatched_pay"] * 400 + ["unmatched_receipt"]
    assert not h.timers and not h.states["queue"].v and not h.states["held"].v and h.states["packed"].v[1] == 399


def test_click_cap_holds_no_more_than_it_can_use():
    proc = P.ClickCap(3, {"user_id": "bigint", "ts_ms": "bigint"}, "", 0)
    h = Handle()
    proc.init(h)
    pdf = pd.DataFrame({"user_id": 1, "ts_ms": range(10, 5010), "seq": range(5000)})
    key = (1, 7, 0)
    assert not list(proc.handleInputRows(key, iter([pdf.iloc[2500:], pdf.iloc[:2500]]), Times(0)))
    assert len(h.states["held"].v) == 4
    out = pd.concat(list(proc.handleExpiredTimer(key, Times(9000), Times(9000))))
    assert list(out["tag"]) == ["pass"] * 3 + ["warning"] and list(out["ts_ms"]) == [10, 11, 12, 13]


# ---- folders -------------------------------------------------------------------------------

def test_fifty_epochs_leave_few_folders(spark):
    from tidemark.streaming.windows import change_log_writer, corrected_top_n
    log, totals = tempfile.mkdtemp(), tempfile.mkdtemp()
    write = change_log_writer(log, "url", "hits")
    last = {}
    for n in range(50):
        rows = [(f"/{k}", n * 10 + k, 60 * (n // 10)) for k in range(3) if (n + k) % 2]
        last.update({(u, w): c for u, c, w in rows})
        df = frame(spark, rows, ["url", "hits", "t"]).select("url", "hits", F.col("ts").alias("window_start"), (F.col("ts") + F.expr("INTERVAL 60 seconds")).alias("window_end"))
        write(df, n)
        if n == 20:
            write(df, n)                                        # a replayed epoch changes nothing
    kept = [d for d, _, names in os.walk(log) if "_SUCCESS" in names]
    assert len(kept) <= 2 * folders.RADIX
    top = corrected_top_n(spark.read.parquet(log).drop("level", "upto"), 9, "url", "hits")
    assert {(r["url"], int(r["window_start"].timestamp()) - BASE): r["hits"] for r in top.collect()} == last

    seen = []
    run = sdistinct.running_unique_writer(totals, lambda df, n: seen.extend(r["uv"] for r in df.collect()), repeats_only=False)
    for n in range(12):
        ms = (BASE + n) * 1000
        rows = [((BASE + 3600) * 1000, str(n), ms, n, True, False, ms - 1), ((BASE + 3600) * 1000, str(n), ms, n, False, False, ms - 1)]
        run(spark.createDataFrame(rows, sdistinct.FIRST_OUT), n)
    assert sorted(seen) == sorted([k for k in range(1, 13) for _ in range(2)])
    assert sorted(os.listdir(totals)) == ["epoch=10", "epoch=11"]


def test_incomplete_run_is_an_error(spark):
    src = files(spark, [(1, 10)], ["user_id", "t"], [[0]])
    with pytest.raises(TimeoutError):
        run_available(src, "et_never", checkpoint=_ck(), available_now=False, until=lambda: False, poll_seconds=0.2, max_seconds=2)
