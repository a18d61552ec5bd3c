"""Rows without an event time in every processor, and state that expires by itself."""

import tempfile
import time

from pyspark.sql import functions as F

from helpers import BASE
from tidemark.streaming import processors, state
from tidemark.streaming.ending import Ending, run_to_end
from tidemark.streaming.runner import run_available, start


def _tmp(what):
    return tempfile.mkdtemp(prefix=f"tidemark-{what}-")


_FOLDERS = []


def _feed(spark, rows, schema, parts=1):
    d = _tmp("edge")
    _FOLDERS.append(d)
    for i in range(parts):
        df = spark.createDataFrame(rows[i::parts], schema)
        df.withColumn("ts", F.timestamp_seconds(F.col("t") + BASE)).drop("t").coalesce(1).write.parquet(f"{d}/p={i}")
    one = spark.read.parquet(f"{d}/p=0")
    return spark.readStream.schema(one.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/p=*")


def test_rows_without_time_or_tie_break_come_out_late(spark):
    rows = [(1, "fail", None, 1), (1, "fail", 5, None), (1, "fail", 6, 2), (1, "create", 7, 3), (1, "pay", 9, None), (2, "pay", None, None)]
    schema = "k long, event_type string, t long, seq long"
    cases = {
        "login": (lambda s: processors.login_fail_stream(s.withColumnRenamed("k", "user_id"), "2 seconds"), ["user_id", "first_fail_ms", "warning"],
                  {(1, None, "late"), (2, None, "late"), (1, (BASE + 5) * 1000, "login fail in 2 seconds")}),
        "pattern": (lambda s: processors.pattern_stream(s, "k", "create", "pay", "1 minute"), ["key", "start_ms", "outcome"],
                    {(1, (BASE + 7) * 1000, "match"), (1, None, "late"), (2, None, "late")}),
        "order": (lambda s: processors.order_outcomes_stream(s.withColumnRenamed("k", "order_id"), "1 minute"), ["order_id", "ts_ms", "result"],
                  {(1, (BASE + 9) * 1000, "payed successfully"), (1, None, "late"), (2, None, "late")}),
        "cap": (lambda s: processors.click_cap_stream(s.withColumnRenamed("k", "user_id").withColumn("ad_id", F.lit(1)), 9), ["user_id", "ts_ms", "tag"],
                {(1, (BASE + t) * 1000, "pass") for t in (5, 6, 7, 9)} | {(1, None, "late"), (2, None, "late")}),
    }
    for name, (build, cols, want) in cases.items():
        end = Ending(spark, _tmp("mark"))
        run_to_end(build(end.attach(_feed(spark, rows, schema))), f"null_{name}", end, _tmp("ck"))
        assert {tuple(r[c] for c in cols) for r in spark.table(f"null_{name}").collect()} == want, name
    end = Ending(spark, _tmp("mark"))
    pays = end.attach(_feed(spark, [("a", 1, 1), ("b", None, None)], "tx string, t long, seq long"))
    recs = end.attach(_feed(spark, [("a", 2, None)], "tx string, t long, seq long"))
    run_to_end(processors.one_to_one_stream(pays, recs, "tx", "-5 seconds", "5 seconds"), "null_match", end, _tmp("ck"))
    got = {(r["tx_id"], r["pay_ms"], r["receipt_ms"], r["tag"]) for r in spark.table("null_match").collect()}
    assert got == {("a", (BASE + 1) * 1000, (BASE + 2) * 1000, "matched"), ("b", None, None, "late_pay")}


def test_state_expires_by_itself_and_clicks_equal_the_timer_form(spark):
    rows = [(u, 7, t, i) for i, (u, t) in enumerate([(1, 1), (1, 2), (1, 3), (1, 4), (2, 5), (1, 90_000), (1, 90_001), (1, 90_002)])]
    schema = "user_id long, ad_id long, t long, seq long"
    passed, ck = {}, _tmp("ck")
    for reset, kw in (("event", {"decide": "arrival"}), ("ttl", {"reset": "ttl", "ttl": "3 seconds"})):
        out = processors.click_cap_stream(_feed(spark, rows, schema), 2, **kw)
        passed[reset] = _run(out, f"ttl_{reset}", ck if reset == "ttl" else _tmp("ck"), reset == "event", 7)
    assert passed["ttl"] == passed["event"] and len(passed["ttl"]) == 7
    time.sleep(3)
    (spark.createDataFrame([(9, 9, 90_003, 0)], schema).withColumn("ts", F.timestamp_seconds(F.col("t") + BASE)).drop("t")
     .coalesce(1).write.parquet(f"{_FOLDERS[-1]}/p=9"))
    _run(out, "ttl_ttl", ck, False, 1)                                 # the next micro-batch drops what has expired
    assert [r["key"]["user_id"] for r in state.read_state(spark, ck, "packed").collect()] == [9]


def _run(df, name, ck, ends, rows):
    """Rows of a run; a query on processing time never ends by itself."""
    got = []
    run_available(df, name, checkpoint=ck, available_now=ends, until=lambda: len(got) >= rows, max_seconds=90,
                  foreach_batch=lambda b, e: got.extend((r["user_id"], r["ts_ms"], r["tag"]) for r in b.collect()))
    return sorted(got)


def test_hot_user_is_split_by_time_and_answers_equal_batch(spark):
    """Half of the rows are one user's: its rows stand in many keys of the state, each answered once."""
    from tidemark.operators import patterns
    from tidemark.sources import tables
    ev = tables.table(spark, "/root/testdata/sf0.001", "events").withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    d = _tmp("hot")
    ev.withColumn("ts", F.col("ts").cast("timestamp")).orderBy("ts").coalesce(1).write.parquet(f"{d}/p")
    ev = spark.read.parquet(f"{d}/p")
    stream = spark.readStream.schema(ev.schema).parquet(f"{d}/p")
    end, ck = Ending(spark, _tmp("mark")), _tmp("ck")
    pairs = processors.login_fail_stream(end.attach(tables.logins(stream)), "6 hours", delay="40 days")
    q = start(pairs, "hot_login_open", checkpoint=ck, foreach_batch=lambda df, e: df.count(), available_now=True)
    q.awaitTermination()
    keys = state.read_state(spark, ck, "packed").select("key.user_id", "key.bucket")
    assert keys.where("user_id = -1").count() > 20
    for strict in (True, False):
        end, name = Ending(spark, _tmp("mark")), f"hot_pattern_{strict}"
        src = end.attach(tables.behaviour(stream).withColumnRenamed("behavior", "event_type"))
        run_to_end(processors.pattern_stream(src, "user_id", "click", "purchase", "6 hours", strict=strict), name, end, _tmp("ck"))
        got = sorted(((r["key"], r["start_ms"], r["end_ms"], r["outcome"]) for r in spark.table(name).collect()), key=str)
        b = patterns.two_step(tables.behaviour(ev).withColumnRenamed("behavior", "event_type"), ["user_id"], F.col("event_type") == "click",
                              F.col("event_type") == "purchase", "6 hours", "strict" if strict else "relaxed")
        want = b.select("user_id", F.unix_millis("ts"), F.unix_millis("second_.ts"), "outcome").collect()
        if strict:                                                  # the stream names a start that nothing follows in time a timeout, as the batch does
            assert got and {g for g in got if g[3] == "match"} == {tuple(w) for w in want if w[3] == "match"}
        assert got == sorted([tuple(w) for w in want], key=str)
    end = Ending(spark, _tmp("mark"))
    run_to_end(processors.login_fail_stream(end.attach(tables.logins(stream)), "6 hours"), "hot_login", end, _tmp("ck"))
    got = sorted((r["user_id"], r["first_fail_ms"], r["last_fail_ms"]) for r in spark.table("hot_login").collect())
    want = patterns.login_fail_pairs(tables.logins(ev), "6 hours")
    assert got == sorted(tuple(r) for r in want.select("user_id", F.unix_millis("first_fail_time"), F.unix_millis("last_fail_time")).collect())
