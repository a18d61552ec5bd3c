"""T4 / T7 firings, ST11 map state, K2 rank changes, S6 state as a table, ST13 tagged sinks."""

import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import BASE
from tidemark.functions.eventtime import as_watermarkable
from tidemark.operators import distinct, topn, windows
from tidemark.plans import catalog
from tidemark.sinks import tagged_writer
from tidemark.sources import tables
from tidemark.streaming import corrections, distinct as sdistinct, firing, processors, state
from tidemark.streaming.ending import Ending, run_to_end
from tidemark.streaming.runner import run_available
from tidemark.streaming.windows import parquet_epoch_writer

SF = "/root/testdata/sf0.001"
ROWS = [("a", 5), ("b", 8), ("a", 12), ("a", 70), ("b", 9), ("c", 30), ("a", 125), ("b", 59), ("a", 61), (None, 80), ("a", 200),
        ("b", 50), ("a", 150), ("c", 199), ("a", 400), ("a", 10), ("d", 335), ("d", 336)]


def _tmp(what):
    return tempfile.mkdtemp(prefix=f"tidemark-{what}-")


def _feed(spark, rows, cut):
    """One file, so one micro-batch, per group of ``cut`` rows."""
    d = _tmp("fire")
    for i in range(0, len(rows), cut):
        df = spark.createDataFrame([(u, BASE + t) for u, t in rows[i:i + cut]], "url string, t long")
        df.select("url", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.parquet(f"{d}/part={i:03d}")
    schema = "url string, ts timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/part=*")


def _brute(rows, cut, size, lateness, delay):
    """Firings of tumbling windows; the watermark is the newest time before the micro-batch, less the disorder."""
    n, fired, out, wm = Counter(), set(), [], -10**9

    def close():
        for w, u in sorted(set(n) - fired):
            if w <= wm:
                out.append((w, u, n[w, u], "close"))
                fired.add((w, u))

    for i in range(0, len(rows), cut):
        close()
        for u, t in rows[i:i + cut]:
            if u is None:
                continue
            w = t // size * size + size
            if w + lateness <= wm:
                out.append((w, u, None, "late"))
            elif w <= wm:
                n[w, u] += 1
                fired.add((w, u))
                out.append((w, u, n[w, u], "correction"))
            else:
                n[w, u] += 1
        wm = max(wm, max(t for _, t in rows[i:i + cut]) - delay)
    wm = 10**9
    close()
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", [4, 18])
def test_firings_equal_event_time_brute_force(spark, cut):
    end = Ending(spark, _tmp("mark"))
    out = firing.window_firings(end.attach(_feed(spark, ROWS, cut)), "url", "60 seconds", lateness="60 seconds", delay="1 second")
    run_to_end(out, f"firings_{cut}", end, _tmp("ck"))
    got = [(int(r["window_end"].timestamp()) - BASE, r["url"], r["cnt"], r["firing"]) for r in spark.table(f"firings_{cut}").collect()]
    assert sorted(got, key=str) == _brute(ROWS, cut, 60, 60, 1)


def _clicks(spark, files):
    """sf0.001 clicks as ``files`` files in time order, and the whole as a table."""
    d = _tmp("clicks")
    gets = as_watermarkable(tables.web_log(tables.table(spark, SF, "events")).where(F.col("method") == "GET").select("url", "ts"))
    a, b = gets.select(F.min("ts"), F.max("ts")).first()
    for i in range(files):
        lo, hi = a + (b - a) / files * i, a + (b - a) / files * (i + 1)
        gets.where((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < files - 1 else F.lit(True))).coalesce(1).write.parquet(f"{d}/part={i}")
    return spark.readStream.schema(gets.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/part=*"), gets


def test_map_state_top_n_equals_batch_and_leaves_no_state(spark):
    stream, gets = _clicks(spark, 3)
    end, ck, out = Ending(spark, _tmp("mark")), _tmp("ck"), _tmp("top")
    tops = firing.bucket_tops(end.attach(stream), "url", 5, "6 hours", "30 minutes", lateness="1 hour", buckets=4, count="hits")

    def write(df, epoch):
        parquet_epoch_writer(out)(topn.top_n_by_count(df.where("firing = 'close'"), 5, "url", "hits"), epoch)

    run_available(tops, "bucket_tops", checkpoint=ck, foreach_batch=write)
    assert state.read_state(spark, ck, "fired").count() > 0
    run_to_end(tops, "bucket_tops", end, ck, foreach_batch=write)
    cols = ["window_start", "window_end", "rank", "url", "hits"]
    want = catalog.hot_urls_top5(spark, SF).select(*[F.col(c).cast("timestamp") if c.startswith("w") else F.col(c) for c in cols])
    assert sorted(spark.read.parquet(out).select(*cols).collect()) == sorted(want.collect())
    assert state.read_state(spark, ck, "fired").count() == 0


def test_map_state_corrections_keep_the_rank_table(spark):
    """Late rows change the ranks of closed windows; the table equals a batch count of all rows but the late ones."""
    end, base = Ending(spark, _tmp("mark")), _tmp("ranks")
    tops = firing.bucket_tops(end.attach(_feed(spark, ROWS, 4)), "url", 2, "60 seconds", lateness="60 seconds", buckets=2, delay="1 second")
    changes = []
    write = corrections.rank_changes_writer(f"{base}/counts", 2, "url", lambda df, e: changes.extend(df.collect()), "cnt")
    run_to_end(tops, "bucket_changes", end, _tmp("ck"), foreach_batch=write)
    count = defaultdict(Counter)
    for w, u, n, kind in _brute(ROWS, 4, 60, 60, 1):
        if kind != "late":
            count[w][u] = max(count[w][u], n)
    want = {(w, i + 1, u, n) for w, c in count.items() for i, (u, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:2])}
    got = corrections.current_top_n(spark, f"{base}/counts", 2, "url").collect()
    assert {(int(r["window_end"].timestamp()) - BASE, r["rank"], r["url"], r["cnt"]) for r in got} == want
    last = {}
    for r in changes:
        last[int(r["window_end"].timestamp()) - BASE, r["rank"]] = (r["url"], r["cnt"])
    assert {(w, k, u, n) for (w, k), (u, n) in last.items()} == want


def test_rank_changes_read_only_touched_windows_and_replay(spark):
    base, seen = _tmp("ranks"), []
    write = corrections.rank_changes_writer(f"{base}/counts", 2, "url", lambda df, e: seen.append(sorted(df.collect())))

    def batch(*rows):
        return (spark.createDataFrame([(BASE + w, u, n) for w, u, n in rows], "w long, url string, cnt long")
                .select(F.timestamp_seconds(F.col("w") - 60).alias("window_start"), F.timestamp_seconds("w").alias("window_end"), "url", "cnt"))

    write(batch((60, "a", 3), (60, "b", 2), (60, "c", 1), (120, "a", 1)), 0)
    write(batch((60, "c", 9)), 1)
    write(batch((60, "c", 9)), 1)                                       # a replayed epoch
    assert seen[1] == seen[2] and [(r["epoch"], r["rank"], r["url"], r["cnt"]) for r in seen[1]] == [(1, 1, "c", 9), (1, 2, "a", 3)]
    write(batch((60, "b", 2)), 2)                                       # nothing changes
    assert seen[3] == []
    write(batch(), 3)
    assert seen[4] == []
    wanted = corrections.touched_versions(spark, f"{base}/counts", "window_start TIMESTAMP, window_end TIMESTAMP, url STRING, cnt LONG",
                                          {(BASE + 60) * 1000: 2})
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "window_ms" in filters and "epoch" in filters
    assert wanted.count() == 3


def test_seen_users_read_back_from_the_checkpoint(spark):
    d, ck = _tmp("views"), _tmp("ck")
    views = as_watermarkable(tables.table(spark, SF, "events")).where("event_type = 'view'").withColumn("seq", F.col("event_id"))
    views.coalesce(1).write.parquet(f"{d}/v")
    stream = spark.readStream.schema(views.schema).parquet(f"{d}/v")
    run_available(sdistinct.first_sightings(stream, "1 day"), "seen_users", checkpoint=ck)
    uv = {r["window_end"]: r["uv"] for r in distinct.distinct_count(views, "1 day").collect()}
    newest = views.agg(F.max("ts")).first()[0]
    got = {r["window_end"]: r["uv"] for r in state.open_window_visitors(spark, ck).collect()}
    assert got == {e: n for e, n in uv.items() if e > newest} and got
    first = {r["window_end"]: r["uv"] for r in state.open_window_visitors(spark, ck, batch=0).collect()}
    assert set(got) <= set(first)


def test_one_step_feeds_all_sinks_and_replays_change_nothing(spark):
    """Q10: pass, warning, late and reject rows of one query, each to its own sink."""
    day = BASE * 1000
    rows = [(1, 7, i) for i in range(4)] + [(2, 7, 5), (1, 7, 90_000_000), (3, 7, 1)]
    d = _tmp("taps")
    for i, part in enumerate((rows[:5], rows[5:6], rows[6:])):
        (spark.createDataFrame([(u, a, day + t, n) for n, (u, a, t) in enumerate(part)], "user_id long, ad_id long, ms long, seq long")
         .select("user_id", "ad_id", F.timestamp_millis("ms").alias("ts"), "seq").coalesce(1).write.parquet(f"{d}/part={i}"))
    src = spark.readStream.schema("user_id long, ad_id long, ts timestamp, seq long").option("maxFilesPerTrigger", 1).parquet(f"{d}/part=*")
    end, out, got = Ending(spark, _tmp("mark")), _tmp("tagged"), defaultdict(dict)
    bad = src.where("user_id = 2").withColumns({"ts_ms": F.lit(None).cast("long"), "tag": F.lit("reject"), "msg": F.lit("bad line")})
    tagged = processors.click_cap_stream(end.attach(src.where("user_id <> 2")), 2).unionByName(bad)

    def keep(tag):
        return lambda df, e: got[tag].__setitem__(e, sorted((r["user_id"], r["msg"]) for r in df.collect()))

    write = tagged_writer(out, {t: keep(t) for t in ("pass", "warning", "late", "reject")})

    def twice(df, epoch):
        write(df, epoch)
        before = {t: dict(e) for t, e in got.items()}
        write(df.limit(0), epoch)                                        # a replay, even one that would read nothing
        assert before == {t: dict(e) for t, e in got.items()}

    run_to_end(tagged, "tagged_q10", end, _tmp("ck"), foreach_batch=twice)
    flat = {t: sorted(x for rows in e.values() for x in rows) for t, e in got.items()}
    assert [u for u, _ in flat["pass"]] == [1, 1, 1]
    assert [u for u, _ in flat["warning"]] == [1]
    assert [u for u, _ in flat["late"]] == [3] and flat["reject"] == [(2, "bad line")]
