"""Hot keys: one user holding a third of all rows (derived from the driver's events).

The bucketed scans must give the plain window functions' answers, and the hot
user's rows must be processed by several tasks, not one."""

from pyspark.sql import Window, functions as F

from tidemark.operators import distinct, ordered, patterns
from tidemark.sources import tables

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    ev = tables.table(spark, SF, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") + 1)
    return ev.withColumn("user_id", hot)


def test_hot_user_running_count_spreads_and_is_exact(spark):
    ev = _skewed(spark).withColumnRenamed("event_id", "seq")
    got = ordered.running_sum(ev, ["user_id"], ["ts", "seq"], F.lit(1), "n", bucket="1 hour")
    # Adaptive execution merges this tiny sample's partitions; switch that off to see the spread.
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        # keep `n` in the result, or the optimizer drops the window and measures the scan
        placed = got.withColumn("pid", F.spark_partition_id()).where("user_id = 0")
        pids = len(placed.groupBy("pid").agg(F.max("n")).collect())   # collect, not count: see above
    finally:
        spark.conf.set(key, old)
    assert pids >= 4
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    plain = ev.select("seq", F.row_number().over(w).cast("long").alias("n"))
    assert got.select("seq", "n").exceptAll(plain).count() == 0
    assert plain.exceptAll(got.select("seq", "n")).count() == 0


def test_hot_user_login_pairs_exact(spark):
    lg = tables.logins(_skewed(spark))
    got = patterns.login_fail_pairs(lg, "6 hours", message="x")
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    nxt = lg.select("user_id", "event_type", "ts", F.lead("event_type").over(w).alias("t2"),
                    F.lead("ts").over(w).alias("ts2"))
    plain = (nxt.where((F.col("event_type") == "fail") & (F.col("t2") == "fail")
                       & (F.col("ts2") < F.col("ts") + F.expr("INTERVAL 6 hours")))
             .select("user_id", F.col("ts").alias("first_fail_time"), F.col("ts2").alias("last_fail_time")))
    g = got.select("user_id", "first_fail_time", "last_fail_time")
    assert g.count() > 0
    assert g.exceptAll(plain).count() == 0 and plain.exceptAll(g).count() == 0


def test_hot_user_running_distinct_exact(spark):
    views = _skewed(spark).where("event_type = 'view'").withColumnRenamed("event_id", "seq")
    got = distinct.running_distinct(views, "1 day").select("seq", "uv")
    w = Window.partitionBy("window_end").orderBy("ts", "seq")
    first = Window.partitionBy("window_end", "user_id").orderBy("ts", "seq")
    b = (views.withColumn("window_end", F.window("ts", "1 day").end)
         .withColumn("f", (F.row_number().over(first) == 1).cast("long"))
         .withColumn("uv", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .where("f = 0").select("seq", "uv"))
    assert got.exceptAll(b).count() == 0 and b.exceptAll(got).count() == 0


def test_one_window_runs_in_many_tasks_by_default(spark):
    """All users of one day: the running count's rows of a window are spread, with no setting."""
    views = _skewed(spark).where("event_type = 'view'").withColumnRenamed("event_id", "seq")
    day = views.where("ts < TIMESTAMP_NTZ'2024-01-02 00:00:00'")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        placed = distinct.running_distinct(day, "1 day").withColumn("pid", F.spark_partition_id())
        pids = len(placed.groupBy("pid").agg(F.max("uv")).collect())
    finally:
        spark.conf.set(key, old)
    assert pids >= 4


def test_hot_user_patterns_equal_plain_windows(spark):
    """Look-ahead copies against an unsplit window per user, both contiguities."""
    ev = _skewed(spark).withColumnRenamed("event_id", "seq")
    w = Window.partitionBy("user_id").orderBy("ts", "seq").rowsBetween(1, Window.unboundedFollowing)
    hour = F.expr("INTERVAL 1 hour")
    for contiguity in ("relaxed", "strict"):
        got = patterns.two_step(ev, ["user_id"], F.col("event_type") == "click", F.col("event_type") == "purchase", "1 hour",
                                contiguity).select("seq", "outcome", F.col("second_.ts").alias("e"))
        if contiguity == "relaxed":
            nxt, second = F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).over(w), F.lit(True)
        else:
            lead = Window.partitionBy("user_id").orderBy("ts", "seq")
            nxt, second = F.lead("ts").over(lead), F.lead("event_type").over(lead) == "purchase"
        b = (ev.withColumn("n", nxt).withColumn("ok", F.col("n").isNotNull() & second).withColumn("near", F.coalesce(F.col("n") < F.col("ts") + hour, F.lit(False)))
             .where("event_type = 'click'"))
        plain = b.where("NOT (near AND NOT ok)").select("seq", F.when(F.col("near"), "match").otherwise("timeout").alias("outcome"),
                                                        F.when(F.col("near"), F.col("n")).alias("e"))
        assert got.count() > 0
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
