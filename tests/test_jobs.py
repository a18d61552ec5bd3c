"""Reference jobs end to end on text-line streams."""

import tempfile

from tidemark.sources import read_lines
from tidemark.streaming import jobs
from tidemark.streaming.ending import Ending, run_to_end
from tidemark.streaming.runner import run_available

def _lines_dir(spark, chunks):
    d = tempfile.mkdtemp(prefix="tidemark-jobs-")
    for i, chunk in enumerate(chunks):
        spark.createDataFrame([(c,) for c in chunk], ["value"]).coalesce(1).write.text(f"{d}/f{i:02d}")
    return f"{d}/f*"


def test_hot_items_job_from_lines(spark):
    base = 1704067200
    rows = [f"{u},{item},1,{b},{base + t}" for u, item, b, t in
            [(1, 2, "pv", 0), (1, 1, "pv", 10), (2, 3, "buy", 29), (3, 2, "pv", 30), (4, 3, "pv", 60),
             (5, 9, "pv", 7200)]] + ["bad,line"]
    src = read_lines(spark, _lines_dir(spark, [rows[:3], rows[3:]]), stream=True, max_files_per_trigger=1)
    counts, writer_for, bad = jobs.hot_items(src, n=2, size="60 seconds", slide="30 seconds")
    out = tempfile.mkdtemp(prefix="tidemark-hot-")
    from tidemark.streaming.windows import parquet_epoch_writer
    run_available(counts, "hot_job", foreach_batch=writer_for(parquet_epoch_writer(out)), checkpoint=tempfile.mkdtemp())
    got = sorted((r["window_end"].timestamp() - base, r["rank"], r["item_id"], r["cnt"])
                 for r in spark.read.parquet(out).collect())
    assert got[:7] == [(30, 1, 1, 1), (30, 2, 2, 1), (60, 1, 2, 2), (60, 2, 1, 1), (90, 1, 2, 1), (90, 2, 3, 1),
                       (120, 1, 3, 1)]
    run_available(bad, "hot_bad", checkpoint=tempfile.mkdtemp())
    assert [r["line"] for r in spark.table("hot_bad").collect()] == ["bad,line"]


def _tx_lines(spark):
    """Order and receipt lines (seconds): in range, out of range, missing on either side, no tx id."""
    t = 1704067200
    orders = [(1, "create", "", 0), (1, "pay", "a", 10), (2, "create", "", 5), (2, "pay", "b", 20), (3, "pay", "c", 30),
              (4, "create", "", 40), (9, "create", "", 5000), (9, "pay", "z", 5001)]
    recs = [("a", "card", 12), ("b", "bank", 40), ("d", "card", 50), ("z", "card", 5002)]
    o = _lines_dir(spark, [[f"{i},{k},{x},{t + s}" for i, k, x, s in orders]])
    r = _lines_dir(spark, [[f"{x},{c},{t + s},extra" for x, c, s in recs]])
    return o, r


def test_tx_and_order_jobs_from_lines(spark):
    o, r = _tx_lines(spark)
    for one_to_one, name in ((True, "tx_job"), (False, "tx_interval_job")):
        out, bad = jobs.tx_match(read_lines(spark, o, stream=True), read_lines(spark, r, stream=True), bound="5 seconds", one_to_one=one_to_one)
        run_available(out, name, checkpoint=tempfile.mkdtemp())
        key = "tx_id" if one_to_one else "coalesce(p_tx_id, r_tx_id)"
        got = {(x[0], x[1]) for x in spark.table(name).selectExpr("tag", f"{key} AS tx").where("tx <> 'z'").collect()}
        assert got == {("matched", "a"), ("unmatched_pay", "b"), ("unmatched_receipt", "b"), ("unmatched_pay", "c"), ("unmatched_receipt", "d")}
    res, _ = jobs.order_timeout(read_lines(spark, o, stream=True), within="15 minutes")
    run_available(res, "order_job", checkpoint=tempfile.mkdtemp())
    assert {(x["order_id"], x["result"]) for x in spark.table("order_job").collect()} == {
        (1, "payed successfully"), (2, "payed successfully"), (3, "already pay but not found create"), (4, "order timeout")}


def test_login_job_from_lines(spark):
    t = 1704067200
    rows = [(5, "fail", 1), (5, "fail", 2), (6, "fail", 1), (6, "success", 2), (6, "fail", 2), (7, "success", 900)]
    d = _lines_dir(spark, [[f"{u},10.0.0.1,{k},{t + s}" for u, k, s in rows] + ["broken line"]])
    warn, bad = jobs.login_failures(read_lines(spark, d, stream=True))
    run_available(warn, "login_job", checkpoint=tempfile.mkdtemp())
    got = spark.table("login_job").collect()
    assert (5, (t + 1) * 1000, (t + 2) * 1000) in {(r["key"], r["start_ms"], r["end_ms"]) for r in got}
    run_available(bad, "login_bad", checkpoint=tempfile.mkdtemp())
    assert [r["line"] for r in spark.table("login_bad").collect()] == ["broken line"]


def test_hot_urls_job_from_access_log(spark):
    lines = ["10.0.0.1 - - 01/01/2024:00:00:05 +0000 GET /a", "10.0.0.1 - - 01/01/2024:00:00:08 +0000 GET /b",
             "10.0.0.1 - - 01/01/2024:00:01:10 +0000 GET /a", "10.0.0.1 - - 01/01/2024:00:00:09 +0000 GET /b",
             "10.0.0.1 - - 01/01/2024:00:03:10 +0000 POST /a", "10.0.0.1 - - 01/01/2024:00:03:10 +0000 GET /a",
             "not a log line"]
    src = read_lines(spark, _lines_dir(spark, [[x] for x in lines]), stream=True, max_files_per_trigger=1)
    counts, bad = jobs.hot_urls(src, size="60 seconds", slide="60 seconds")
    from tidemark.streaming.windows import change_log_writer, corrected_top_n
    log = tempfile.mkdtemp(prefix="tidemark-urls-")
    run_available(counts, "urls_job", mode="update", foreach_batch=change_log_writer(log, "url", "cnt"), checkpoint=tempfile.mkdtemp())
    top = corrected_top_n(spark.read.parquet(log).drop("level", "upto"), 5, "url")
    got = sorted((r["window_end"].isoformat()[11:19], r["rank"], r["url"], r["cnt"]) for r in top.collect())
    assert got == [("00:01:00", 1, "/b", 2), ("00:01:00", 2, "/a", 1), ("00:02:00", 1, "/a", 1),
                   ("00:04:00", 1, "/a", 1)]
    run_available(bad, "urls_bad", checkpoint=tempfile.mkdtemp())
    assert spark.table("urls_bad").count() == 1


def test_filtered_rows_still_move_the_watermark(spark):
    """A dropped 'buy' row far ahead in time still closes the earlier window."""
    base = 1704067200
    rows = [[f"1,7,1,pv,{base + 10}"], [f"2,8,1,buy,{base + 7200}"]]
    src = read_lines(spark, _lines_dir(spark, rows), stream=True, max_files_per_trigger=1)
    counts, _, _ = jobs.hot_items(src, n=5, size="60 seconds", slide="60 seconds")
    run_available(counts, "d23_counts", checkpoint=tempfile.mkdtemp())
    assert [(r["item_id"], r["cnt"]) for r in spark.table("d23_counts").collect()] == [(7, 1)]


def _behaviour_lines_dir(spark):
    """sf0.001 events as behaviour lines (user,item,category,behavior,ts_s), 4 time-ordered files;
    'view' is written as the reference's 'pv'."""
    from pyspark.sql import functions as F
    from tidemark.sources import tables
    b = tables.behaviour(tables.table(spark, "/root/testdata/sf0.001", "events"))
    b = b.withColumn("behavior", F.when(F.col("behavior") == "view", F.lit("pv")).otherwise(F.col("behavior")))
    lines = b.select(F.unix_timestamp("ts").alias("s"), F.concat_ws(
        ",", "user_id", "item_id", F.lit(1), "behavior", F.unix_timestamp("ts")).alias("value"))
    lo, hi = lines.agg(F.min("s"), F.max("s")).first()
    d = tempfile.mkdtemp(prefix="tidemark-blines-")
    step = (hi - lo) / 4
    for i in range(4):
        part = lines.where((F.col("s") >= lo + step * i) & ((F.col("s") < lo + step * (i + 1)) if i < 3 else F.lit(True)))
        part.select("value").coalesce(1).write.text(f"{d}/f{i}")
    return f"{d}/f*", b


def test_behaviour_jobs_match_batch(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import distinct, windows
    path, b = _behaviour_lines_dir(spark)
    pv_rows = b.where(F.col("behavior") == "pv")

    end = Ending(spark, tempfile.mkdtemp())
    counts, _ = jobs.page_views(read_lines(spark, path, stream=True, max_files_per_trigger=1), size="1 hour", end=end)
    run_to_end(counts, "job_pv", end, tempfile.mkdtemp())
    got = {(r["window_end"].replace(tzinfo=None), r["pv"]) for r in spark.table("job_pv").collect()}
    batch = {(r["window_end"], r["pv"]) for r in windows.window_counts(pv_rows, "1 hour", out="pv").collect()}
    assert {(e.isoformat(), n) for e, n in got} == {(e.isoformat(), n) for e, n in batch}

    end = Ending(spark, tempfile.mkdtemp())
    uv, _ = jobs.unique_visitors(read_lines(spark, path, stream=True, max_files_per_trigger=1), size="1 day", end=end)
    run_to_end(uv, "job_uv", end, tempfile.mkdtemp())
    got = {(r["window_end"].isoformat(), r["uv"]) for r in spark.table("job_uv").collect()}
    batch = {(r["window_end"].isoformat(), r["uv"]) for r in distinct.distinct_count(pv_rows, "1 day").collect()}
    assert got == batch

    first, writer_for, _ = jobs.running_unique_visitors(
        read_lines(spark, path, stream=True, max_files_per_trigger=1), tempfile.mkdtemp(), size="1 day", bitmap=False)
    out = tempfile.mkdtemp()
    from tidemark.streaming.windows import parquet_epoch_writer
    run_available(first, "job_ru", foreach_batch=writer_for(parquet_epoch_writer(out)), checkpoint=tempfile.mkdtemp())
    got = sorted(r["uv"] for r in spark.read.parquet(out).collect())
    batch = sorted(r["uv"] for r in distinct.running_distinct(pv_rows, "1 day").collect())
    assert got == batch


def test_marketing_and_pattern_jobs(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import windows
    from tidemark.sources import tables
    ev = tables.table(spark, "/root/testdata/sf0.001", "events")
    mk = tables.marketing(ev).withColumn("behavior", F.when(F.col("behavior") == "error", F.lit("uninstall"))
                                         .otherwise(F.col("behavior")))
    d = tempfile.mkdtemp(prefix="tidemark-mk-") + "/d"
    from tidemark.functions.eventtime import as_watermarkable
    as_watermarkable(mk).coalesce(1).write.parquet(d)
    src = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    end = Ending(spark, tempfile.mkdtemp())
    run_to_end(jobs.marketing(src, size="1 day", slide="1 hour", end=end), "job_mk", end, tempfile.mkdtemp())
    got = {(r["channel"], r["behavior"], r["window_end"], r["cnt"]) for r in spark.table("job_mk").collect()}
    batch = {(r["channel"], r["behavior"], r["window_end"], r["cnt"]) for r in windows.window_counts(
        as_watermarkable(mk).where(F.col("behavior") != "uninstall"), "1 day", "1 hour",
        keys=["channel", "behavior"]).collect()}
    assert got == batch


def test_order_pattern_and_keyed_login_jobs(spark):
    """F-PATTERN as order lines (times in ms), and F-LOGIN as login lines through the keyed form."""
    base = 1704067200000
    ev = [(1, "create", 0), (1, "other", 1000), (1, "pay", 1500), (2, "create", 0), (2, "pay", 2000),
          (3, "create", 0), (3, "create", 1000), (3, "pay", 1500), (4, "create", 0), (4, "pay", 1000),
          (4, "pay", 1500), (5, "pay", 0), (6, "create", 0), (99, "other", 60000)]
    src = read_lines(spark, _lines_dir(spark, [[f"{o},{k},,{base + t}" for o, k, t in ev]]), stream=True)
    res, _ = jobs.order_timeout(src, within="2 seconds", unit="ms", pattern=True)
    run_available(res, "job_pattern", checkpoint=tempfile.mkdtemp())
    got = {}
    for r in spark.table("job_pattern").collect():
        got[(r["key"], r["outcome"])] = got.get((r["key"], r["outcome"]), 0) + 1
    assert got == {(1, "match"): 1, (2, "timeout"): 1, (3, "match"): 2, (4, "match"): 1, (6, "timeout"): 1}

    b = 1704067200
    rows = [(1, "fail", 10), (1, "fail", 13), (1, "fail", 12), (2, "fail", 20), (2, "success", 20),
            (2, "fail", 21), (3, "fail", 30), (3, "fail", 32), (9, "success", 500)]
    src = read_lines(spark, _lines_dir(spark, [[f"{u},10.0.0.1,{k},{b + t}" for u, k, t in rows]]), stream=True)
    warn, _ = jobs.login_failures(src, within="2 seconds", disorder="5 seconds", strict_pattern=False)
    run_available(warn, "job_login_keyed", checkpoint=tempfile.mkdtemp())
    assert [(r["user_id"], r["first_fail_ms"] // 1000 - b, r["last_fail_ms"] // 1000 - b)
            for r in spark.table("job_login_keyed").collect()] == [(1, 12, 13)]
