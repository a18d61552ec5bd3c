"""Property tests: rewritten forms equal the plain Spark forms on random input."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from helpers import frame
from tidemark.operators import ordered, windows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 400), st.sampled_from(["a", "b", "c"])),
                   min_size=1, max_size=40)


def _df(spark, rows):
    return frame(spark, [(k, t, e) for k, t, e in rows], ["key", "t", "kind"])


@SETTINGS
@given(rows=rows_st)
def test_panes_equal_plain_sliding(spark, rows):
    df = _df(spark, rows)
    plain = windows.window_counts(df, "60 seconds", "10 seconds", ["key"], panes=False)
    panes = windows.window_counts(df, "60 seconds", "10 seconds", ["key"], panes=True)
    assert sorted(plain.collect()) == sorted(panes.collect())


@SETTINGS
@given(rows=rows_st)
def test_bucketed_running_count_equals_row_number(spark, rows):
    df = _df(spark, rows)
    w = Window.partitionBy("key").orderBy("ts", "seq")
    expected = sorted(df.select("seq", F.row_number().over(w).alias("n")).collect())
    got = ordered.running_sum(df, ["key"], ["ts", "seq"], F.lit(1), "n", bucket="30 seconds")
    assert sorted(got.select("seq", F.col("n").cast("int")).collect()) == expected


@SETTINGS
@given(rows=rows_st)
def test_look_ahead_finds_the_next_match_within_the_limit(spark, rows):
    df = _df(spark, rows)
    data = sorted((k, t, s, e) for s, (k, t, e) in enumerate(rows))
    for kind in (None, "b"):
        brute = {}
        for k, t, s, e in data:
            later = [(t2, s2) for k2, t2, s2, e2 in data if k2 == k and kind in (None, e2) and (t2, s2) > (t, s)]
            brute[s] = min(later)[1] if later and min(later)[0] - t <= 30 else None
        cond = F.lit(True) if kind is None else F.col("kind") == kind
        at = {s: t for _, t, s, _ in data}
        got = ordered.next_within(df, ["key"], ["ts", "seq"], cond, ["seq"], "nx", 30)
        found = {r["seq"]: (r["nx"]["seq"] if r["nx"] and at[r["nx"]["seq"]] - at[r["seq"]] <= 30 else None) for r in got.collect()}
        assert found == brute


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 200), st.integers(0, 2)), min_size=1, max_size=30))
def test_running_distinct_with_tied_rows(spark, rows):
    """Rows that tie in (ts, seq) go by user; equal rows of a user are one sighting."""
    from tidemark.operators.distinct import running_distinct
    df = spark.createDataFrame([(u, t, s) for u, t, s in rows], "user_id long, t int, seq long").withColumn(
        "ts", F.timestamp_seconds(F.lit(1704067200) + F.col("t"))).drop("t")
    got = sorted((int(r["ts"].timestamp()) - 1704067200, r["seq"], r["uv"]) for r in running_distinct(df, "100 seconds", repeats_only=False, bucket="10 seconds").collect())
    want, seen = [], {}
    for t, s, u in sorted((t, s, u) for u, t, s in rows):
        seen.setdefault(t // 100, set()).add(u)
        want.append((t, s, len(seen[t // 100])))
    assert got == sorted(want)


side_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=0, max_size=25)


@SETTINGS
@given(left=side_st, right=side_st)
def test_bucketed_interval_join_equals_plain(spark, left, right):
    from tidemark.operators import matching
    L = frame(spark, left or [(9, 0)], ["key", "t"]).withColumnRenamed("seq", "id")
    R = frame(spark, right or [(9, 0)], ["key", "t"]).withColumnRenamed("seq", "id")
    lo, hi = "-20 seconds", "35 seconds"
    plain = {(a["id"], b["id"]) for a in L.collect() for b in R.collect()
             if a["key"] == b["key"] and a["ts"] + __import__("datetime").timedelta(seconds=-20) <= b["ts"]
             <= a["ts"] + __import__("datetime").timedelta(seconds=35)}
    for width in (None, 7):
        got = {(r["p_id"], r["r_id"]) for r in matching.interval_join(L, R, "key", lo, hi, width=width).collect()}
        assert got == plain, width
        ul = {r["id"] for r in matching.unmatched_left(L, R, "key", lo, hi, width=width).collect()}
        assert ul == {r["id"] for r in L.collect()} - {p for p, _ in plain}, width
        ur = {r["id"] for r in matching.unmatched_right(L, R, "key", lo, hi, width=width).collect()}
        assert ur == {r["id"] for r in R.collect()} - {q for _, q in plain}, width


@SETTINGS
@given(rows=rows_st, seed=st.integers(0, 1000))
def test_input_order_does_not_change_answers(spark, rows, seed):
    from tidemark.operators import limits, patterns
    df = _df(spark, rows)
    shuffled = df.orderBy(F.rand(seed)).repartition(3)
    for fn in (lambda d: limits.capped_clicks(d.withColumnRenamed("key", "user_id").withColumn("ad_id", F.lit(1)), 2),
               lambda d: patterns.two_step(d, ["key"], F.col("kind") == "a", F.col("kind") == "b", "50 seconds"),
               lambda d: windows.window_counts(d, "60 seconds", "20 seconds", ["key"])):
        assert sorted(fn(df).collect()) == sorted(fn(shuffled).collect())


@SETTINGS
@given(users=st.lists(st.integers(0, 10**12), min_size=1, max_size=60))
def test_bitmap_distinct_at_most_exact(spark, users):
    from tidemark.operators import distinct
    df = frame(spark, [(u, i) for i, u in enumerate(users)], ["user_id", "t"])
    exact = {r["window_end"]: r["uv"] for r in distinct.distinct_count(df, "1 hour").collect()}
    bitmap = {r["window_end"]: r["uv"] for r in distinct.bitmap_distinct_count(df, "1 hour").collect()}
    assert exact.keys() == bitmap.keys()
    assert all(bitmap[k] <= exact[k] for k in exact)


@SETTINGS
@given(left=side_st, right=side_st)
def test_one_to_one_every_row_matched_or_unmatched(spark, left, right):
    from tidemark.operators import matching
    L = frame(spark, left or [(9, 0)], ["key", "t"]).withColumnRenamed("seq", "id")
    R = frame(spark, right or [(9, 0)], ["key", "t"]).withColumnRenamed("seq", "id")
    out = matching.one_to_one(L, R, "key", "-20 seconds", "35 seconds", left_order=["ts", "id"],
                              right_order=["ts", "id"])
    m = out["matched"].count()
    assert m + out["unmatched_left"].count() == L.count()
    assert m + out["unmatched_right"].count() == R.count()


pattern_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.sampled_from(["c", "p", "x"])),
                      min_size=1, max_size=30)


def _brute_pattern(rows, within, strict):
    """Per key, in (ts, seq) order: each 'c' starts a match; its partner is the next
    event (strict) or the next 'p' (relaxed), in time if partner.ts < start.ts + within."""
    out = {}
    by_key = {}
    for seq, (k, t, e) in enumerate(rows):
        by_key.setdefault(k, []).append((t, seq, e))
    for k, evs in by_key.items():
        evs.sort()
        for i, (t, seq, e) in enumerate(evs):
            if e != "c":
                continue
            later = evs[i + 1:]
            if strict:
                nxt = later[0] if later else None
                ok = nxt is not None and nxt[2] == "p"
            else:
                nxt = next((x for x in later if x[2] == "p"), None)
                ok = nxt is not None
            in_time = nxt is not None and nxt[0] < t + within
            if ok and in_time:
                out[seq] = "match"
            elif not (strict and nxt is not None and not ok and in_time):
                out[seq] = "timeout"
    return out


@SETTINGS
@given(rows=pattern_st)
def test_two_step_equals_brute_force(spark, rows):
    from tidemark.operators import patterns
    df = frame(spark, rows, ["key", "t", "kind"])
    for strict in (False, True):
        got = patterns.two_step(df, ["key"], F.col("kind") == "c", F.col("kind") == "p", "30 seconds",
                                "strict" if strict else "relaxed")
        assert {r["seq"]: r["outcome"] for r in got.collect()} == _brute_pattern(rows, 30, strict), strict
