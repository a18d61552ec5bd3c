"""Catalog of the reference's jobs as batch queries over the driver tables.

Each entry maps a job onto the driver tables by the fixed projections in
:mod:`tidemark.sources.tables` and composes the operators.  Every entry reads
whole tables; parameters are the ones stated in SURVEY 7.3.  Computed
columns are aliased to the names used by :mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import sinks
from tidemark.functions.formatting import encode_line, text_time
from tidemark.operators import distinct, limits, matching, patterns, topn, windows
from tidemark.sources import tables
from tidemark.sources.lines import (
    ACCESS_LOG_TIME, parse_access_log, parse_behaviour, parse_login, parse_order, parse_receipt, split_rejects)
from tidemark.session import ensure_checkpoint_dir
from tidemark.streaming.corrections import rank_changes_writer
from tidemark.streaming.windows import corrected_top_n, parquet_epoch_writer

# Parameters of the catalog (longer than the reference's because `events`
# averages one row per 259 s over 30 days).
HOT_ITEMS = dict(size="1 day", slide="1 hour", n=5)
HOT_ITEMS_SINK_N = 10
HOT_URLS = dict(size="6 hours", slide="30 minutes", n=5)
CLICK_CAP = 2
MARKET = dict(size="1 day", slide="1 hour")
LOGIN_WITHIN = "6 hours"
ORDER_WITHIN = "1 day"
ORDER_DEADLINE = "365 days"
TX_BOUND = "60 days"
PART_BOUND = "10 days"
RANK_EPOCHS = 3


# The channel and behaviour labels of the reference's total row.
TOTAL_CHANNEL = "total channel"
TOTAL_BEHAVIOR = "total"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "events")


def _views(spark, sf):
    return tables.behaviour(_events(spark, sf)).where(F.col("behavior") == "view")


def _item_counts(spark, sf):
    return windows.window_counts(_views(spark, sf), HOT_ITEMS["size"], HOT_ITEMS["slide"],
                                 keys=["item_id"], out="view_count")


def hot_items_top5(spark, sf):
    """Q1: top 5 viewed items per sliding window."""
    ranked = topn.top_n_by_count(_item_counts(spark, sf), HOT_ITEMS["n"], "item_id", "view_count")
    return ranked.select("window_start", "window_end", "rank", "item_id", "view_count")


def hot_items_top10_upsert(spark, sf):
    """Q2 state: top 10 per window, then the newest row per item (what the upsert leaves)."""
    ranked = topn.top_n_by_count(_item_counts(spark, sf), HOT_ITEMS_SINK_N, "item_id", "view_count")
    return topn.newest_per_key(ranked, ["item_id"], "window_end", ["view_count"])


def hot_items_report(spark, sf):
    """Q1 as printed: one text report per window from the typed top 5 (K4)."""
    ranked = topn.top_n_by_count(_item_counts(spark, sf), HOT_ITEMS["n"], "item_id", "view_count")
    return sinks.report_text(ranked, "item_id", "view_count")


def hot_urls_top5(spark, sf):
    """Q4: top 5 GET urls per sliding window."""
    gets = tables.web_log(_events(spark, sf)).where(F.col("method") == "GET")
    counts = windows.window_counts(gets, HOT_URLS["size"], HOT_URLS["slide"], keys=["url"], out="hits")
    ranked = topn.top_n_by_count(counts, HOT_URLS["n"], "url", "hits")
    return ranked.select("window_start", "window_end", "rank", "url", "hits")


def page_views(spark, sf):
    """Q5: views per 1 h tumbling window."""
    return windows.window_counts(_views(spark, sf), "1 hour", out="pv")


def unique_visitors(spark, sf):
    """Q6: exact distinct viewers per day."""
    return distinct.distinct_count(_views(spark, sf), "1 day")


def unique_visitors_bitmap(spark, sf):
    """Q7: distinct hashed user offsets per day (bitmap count)."""
    return distinct.bitmap_distinct_count(_views(spark, sf), "1 day")


def running_unique_visitors(spark, sf):
    """Q7 per event: the running distinct count, emitted at repeat visits."""
    r = distinct.running_distinct(_views(spark, sf), "1 day")
    return r.select(F.col("seq").alias("event_id"), "user_id", "ts", "window_start", "window_end", "uv")


def running_unique_visitors_bitmap(spark, sf):
    """Q7 as the reference counts: running distinct over hashed bitmap offsets."""
    r = distinct.running_distinct(_views(spark, sf), "1 day", key="offset")
    return r.select(F.col("seq").alias("event_id"), "user_id", "ts", "window_start", "window_end", "uv")


def _marketing(spark, sf):
    return tables.marketing(_events(spark, sf)).where(F.col("behavior") != "error")


def marketing_by_channel(spark, sf):
    """Q8: count per (channel, behaviour) and sliding window (pane form)."""
    return windows.window_counts(_marketing(spark, sf), MARKET["size"], MARKET["slide"],
                                 keys=["channel", "behavior"], out="cnt")


def marketing_total(spark, sf):
    """Q9: count over all channels per sliding window."""
    c = windows.window_counts(_marketing(spark, sf), MARKET["size"], MARKET["slide"], out="cnt")
    return c.select("window_start", "window_end", F.lit(TOTAL_CHANNEL).alias("channel"),
                    F.lit(TOTAL_BEHAVIOR).alias("behavior"), "cnt")


def _ads(spark, sf):
    return tables.ad_clicks(_events(spark, sf))


def ad_clicks_capped(spark, sf):
    """Q10 main output: clicks within the daily cap per (user, ad)."""
    kept = limits.capped_clicks(_ads(spark, sf), CLICK_CAP)
    return kept.select(F.col("seq").alias("event_id"), "user_id", "ad_id", "province", "ts", "day")


def ad_blacklist(spark, sf):
    """Q10 side output: one warning per (user, ad, day) over the cap."""
    return limits.blacklist_warnings(_ads(spark, sf), CLICK_CAP)


def ad_clicks_by_province(spark, sf):
    """Q10: capped clicks per province and sliding window (pane form)."""
    kept = limits.capped_clicks(_ads(spark, sf), CLICK_CAP)
    return windows.window_counts(kept, MARKET["size"], MARKET["slide"], keys=["province"], out="cnt")


def login_fail_pairs(spark, sf):
    """Q11: two failed logins in a row per user, less than the limit apart."""
    return patterns.login_fail_pairs(tables.logins(_events(spark, sf)), LOGIN_WITHIN, message="login fail")


def order_pattern(spark, sf):
    """Click followedBy purchase per user within the limit; match or timeout."""
    b = tables.behaviour(_events(spark, sf)).withColumnRenamed("behavior", "event_type")
    m = patterns.order_pattern(b, ORDER_WITHIN, key="user_id",
                               create=F.col("event_type") == "click", pay=F.col("event_type") == "purchase")
    return m.select("user_id", "start_ts", "end_ts", "outcome")


def order_state_machine(spark, sf):
    """create/pay outcome per order against a deadline."""
    ev = tables.order_events(tables.table(spark, sf, "orders"), tables.table(spark, sf, "lineitem"))
    return patterns.order_outcomes(ev, ORDER_DEADLINE)


def _tx(spark, sf):
    return (tables.pays(tables.table(spark, sf, "orders")).select("tx_id", "ts"),
            tables.receipts(tables.table(spark, sf, "lineitem")))


_RECEIPT_ORDER = ["ts", "l_linenumber", "l_partkey", "l_suppkey"]


def tx_interval_join(spark, sf):
    """All (pay, receipt) pairs of a tx within +-bound (o_orderkey is unique: one pay per tx)."""
    p, r = _tx(spark, sf)
    j = matching.interval_join(p, r, "tx_id", f"-{TX_BOUND}", TX_BOUND, left_unique=True)
    return j.select(F.col("p_tx_id").alias("tx_id"), F.col("p_ts").alias("pay_ts"),
                    F.col("r_ts").alias("receipt_ts"), F.col("r_l_linenumber").alias("l_linenumber"),
                    F.col("r_l_partkey").alias("l_partkey"), F.col("r_l_suppkey").alias("l_suppkey"))


def tx_match_one_to_one(spark, sf):
    """K-th pay pairs with the k-th receipt of its tx, within +-bound."""
    p, r = _tx(spark, sf)
    m = matching.one_to_one(p, r, "tx_id", f"-{TX_BOUND}", TX_BOUND, right_order=_RECEIPT_ORDER,
                            left_unique=True)["matched"]
    return m.select(F.col("p_tx_id").alias("tx_id"), F.col("p_ts").alias("pay_ts"),
                    F.col("r_ts").alias("receipt_ts"), F.col("r_l_linenumber").alias("l_linenumber"),
                    F.col("r_l_partkey").alias("l_partkey"), F.col("r_l_suppkey").alias("l_suppkey"))


def tx_unmatched_pays(spark, sf):
    """Q13 side output: pays with no receipt of the tx within +-bound."""
    p, r = _tx(spark, sf)
    return matching.unmatched_left(p, r, "tx_id", f"-{TX_BOUND}", TX_BOUND, left_unique=True).select("tx_id", "ts")


def tx_unmatched_receipts(spark, sf):
    """Q13 side output: receipts with no pay of the tx within +-bound."""
    p, r = _tx(spark, sf)
    return matching.unmatched_right(p, r, "tx_id", f"-{TX_BOUND}", TX_BOUND, left_unique=True).select(
        "tx_id", "ts", "l_linenumber", "l_partkey", "l_suppkey")


def _one_to_one(spark, sf):
    p, r = _tx(spark, sf)
    # o_orderkey is the key of `orders`: one pay per tx, so pays need no ranking.
    return matching.one_to_one(p, r, "tx_id", f"-{TX_BOUND}", TX_BOUND, right_order=_RECEIPT_ORDER,
                               left_unique=True)


def tx_unmatched_pays_one_to_one(spark, sf):
    """Q13a side output: pays whose k-th receipt is missing or out of range."""
    return _one_to_one(spark, sf)["unmatched_left"].select("tx_id", "ts")


def tx_unmatched_receipts_one_to_one(spark, sf):
    """Q13a side output: receipts not paired one-to-one within range."""
    return _one_to_one(spark, sf)["unmatched_right"].select(
        "tx_id", "ts", "l_linenumber", "l_partkey", "l_suppkey")


def _by_part(spark, sf):
    """Returned and accepted line items per part: keys repeat on both sides."""
    li = tables.table(spark, sf, "lineitem")
    row = [F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", "l_suppkey"]
    return li.where("l_returnflag = 'R'").select(*row), li.where("l_returnflag = 'A'").select(*row)


def part_interval_join(spark, sf):
    """J1 in general form: all (returned, accepted) pairs of a part within +-bound."""
    r, a = _by_part(spark, sf)
    j = matching.interval_join(r, a, "part", f"-{PART_BOUND}", PART_BOUND)
    return j.select(F.col("p_part").alias("part"), *[F.col(p + c).alias(p + c) for p in ("p_", "r_") for c in ("ts", "l_orderkey", "l_linenumber", "l_suppkey")])


def _part_one_to_one(spark, sf):
    r, a = _by_part(spark, sf)
    order = ["ts", "l_orderkey", "l_linenumber", "l_suppkey"]
    return matching.one_to_one(r, a, "part", f"-{PART_BOUND}", PART_BOUND, left_order=order, right_order=order)


def part_one_to_one(spark, sf):
    """J2 in general form: the k-th returned item of a part with its k-th accepted one, within +-bound."""
    m = _part_one_to_one(spark, sf)["matched"]
    return m.select(F.col("p_part").alias("part"), *[F.col(p + c).alias(p + c) for p in ("p_", "r_") for c in ("ts", "l_orderkey", "l_linenumber", "l_suppkey")])


def part_unmatched_left(spark, sf):
    """J3 in general form: returned items with no accepted one of the part within +-bound."""
    r, a = _by_part(spark, sf)
    return matching.unmatched_left(r, a, "part", f"-{PART_BOUND}", PART_BOUND)


def part_unmatched_right(spark, sf):
    """J4 in general form: accepted items with no returned one of the part within +-bound."""
    r, a = _by_part(spark, sf)
    return matching.unmatched_right(r, a, "part", f"-{PART_BOUND}", PART_BOUND)


def part_unmatched_one_to_one(spark, sf):
    """J3 and J4 of the k-th pairing, both sides."""
    o = _part_one_to_one(spark, sf)
    return (o["unmatched_left"].withColumn("side", F.lit("returned"))
            .unionByName(o["unmatched_right"].withColumn("side", F.lit("accepted"))))


def hot_url_rank_changes(spark, sf):
    """K2: the top 5 urls per day kept by the incremental writer over three epochs (clicks dealt by event id, so
    every epoch corrects every day); the rank changes of each epoch."""
    clicks = (tables.web_log(_events(spark, sf)).where(F.col("method") == "GET")
              .withColumn("ep", F.pmod(F.col("seq"), F.lit(RANK_EPOCHS))))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-ranks/{uuid.uuid4().hex}"
    write = rank_changes_writer(f"{base}/counts", HOT_URLS["n"], "url", parquet_epoch_writer(f"{base}/changes"), "hits")
    w = F.window("ts", "1 day")
    for epoch in range(RANK_EPOCHS):
        counts = (clicks.where(F.col("ep") <= epoch).groupBy("url", w.alias("w")).agg(F.count(F.lit(1)).alias("hits"), F.max("ep").alias("last"))
                  .where(F.col("last") == epoch))
        write(counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "url", "hits"), epoch)
    changes = spark.read.parquet(*[f"{base}/changes/epoch={e}" for e in range(RANK_EPOCHS)])
    return changes.select("epoch", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "rank", "url", "hits")


def topic_lines(spark, sf):
    """S7 + P1: events encoded as behaviour lines, then parsed back by position."""
    b = tables.behaviour(_events(spark, sf))
    lines = b.select("seq", encode_line(
        "user_id", "item_id", F.pmod(F.col("item_id"), F.lit(10)), "behavior",
        F.unix_timestamp("ts")).alias("value"))
    good, _ = split_rejects(parse_behaviour(lines, keep=("seq",)))
    return good.select(F.col("seq").alias("event_id"), "user_id", "item_id", "category_id", "behavior",
                       F.unix_seconds("ts").alias("ts_s"))


def _ts_s(ts="ts"):
    return F.unix_timestamp(ts)


def behaviour_lines_trimmed(spark, sf):
    """Behaviour lines with blanks around every field and fields beyond the layout."""
    b = tables.behaviour(_events(spark, sf))
    spaced = [F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")) for c in ("user_id", "item_id")]
    lines = b.select("seq", encode_line(*spaced, F.lit(" 7"), F.concat(F.col("behavior"), F.lit("  ")), _ts_s(), F.lit("extra"),
                                        F.lit("")).alias("value"))
    good, _ = split_rejects(parse_behaviour(lines, trim=True, keep=("seq",)))
    return good.select(F.col("seq").alias("event_id"), "user_id", "item_id", "category_id", "behavior",
                       F.unix_seconds("ts").alias("ts_s"))


def access_log_lines(spark, sf):
    """Events as access-log lines, parsed back with their zone."""
    w = tables.web_log(_events(spark, sf))
    lines = w.select("seq", encode_line(F.lit("10.0.0.1"), "user_id", F.lit("-"), F.date_format("ts", ACCESS_LOG_TIME),
                                        F.lit("+0000"), "method", "url", sep=" ").alias("value"))
    good, _ = split_rejects(parse_access_log(lines, keep=("seq",)))
    return good.select(F.col("seq").alias("event_id"), "ip", "user_id", "method", "url", F.unix_seconds("ts").alias("ts_s"))


def login_lines(spark, sf):
    """Login lines; those of every seventh user are cut short and must be rejected."""
    lg = tables.logins(_events(spark, sf))
    whole = encode_line("user_id", F.lit("10.0.0.1"), "event_type", _ts_s())
    lines = lg.select("seq", F.when(F.pmod("user_id", F.lit(7)) == 0, encode_line("user_id", "event_type")).otherwise(whole).alias("value"))
    good, _ = split_rejects(parse_login(lines, keep=("seq",)))
    return good.select(F.col("seq").alias("event_id"), "user_id", "ip", "event_type", F.unix_seconds("ts").alias("ts_s"))


def order_lines_paid(spark, sf):
    """P5 + F3: order lines; only those with a transaction id pass."""
    o = tables.table(spark, sf, "orders")
    tx = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.lit("")).otherwise(F.concat(F.lit("tx"), F.col("o_orderkey").cast("string")))
    lines = o.select(encode_line("o_orderkey", F.lit("pay"), tx, _ts_s("o_orderdate")).alias("value"))
    good, _ = split_rejects(parse_order(lines))
    return good.where(F.col("tx_id") != "").select("order_id", "event_type", "tx_id", F.unix_seconds("ts").alias("ts_s"))


def receipt_lines(spark, sf):
    """Receipt lines of all line items."""
    li = tables.table(spark, sf, "lineitem")
    lines = li.select("l_linenumber", encode_line(F.concat(F.lit("tx"), F.col("l_orderkey").cast("string")), "l_returnflag",
                                                  _ts_s("l_shipdate"), "l_partkey").alias("value"))
    good, _ = split_rejects(parse_receipt(lines, keep=("l_linenumber",)))
    return good.select("tx_id", "pay_channel", F.unix_seconds("ts").alias("ts_s"), "l_linenumber")


def hot_urls_corrected(spark, sf):
    """K2: the top 5 from a change log in which every tenth event came late, one epoch after the rest."""
    gets = tables.web_log(_events(spark, sf)).where(F.col("method") == "GET")

    def epoch(rows, n):
        counts = windows.window_counts(rows, HOT_URLS["size"], HOT_URLS["slide"], keys=["url"], out="hits")
        return counts.withColumn("epoch", F.lit(n).cast("long"))

    log = epoch(gets.where(F.pmod("seq", F.lit(10)) != 0), 0).unionByName(epoch(gets, 1))
    top = corrected_top_n(log, HOT_URLS["n"], "url", "hits")
    return top.select("window_start", "window_end", "rank", "url", "hits")


def hot_items_documents(spark, sf):
    """S5 / S7 JSON: one document per report row, with a stable id."""
    top = hot_items_top5(spark, sf).withColumn("window", text_time("window_end"))
    return sinks.documents(top, ["window", "rank"], ["window", "rank", "item_id", "view_count"])


def unique_visitor_lines(spark, sf):
    """UV rows as text lines with a formatted time (fn6)."""
    uv = unique_visitors(spark, sf)
    return uv.select(encode_line(text_time("window_end"), "uv").alias("value"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items_top5": hot_items_top5,
    "hot_items_top10_upsert": hot_items_top10_upsert,
    "hot_items_report": hot_items_report,
    "hot_urls_top5": hot_urls_top5,
    "page_views": page_views,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "running_unique_visitors": running_unique_visitors,
    "running_unique_visitors_bitmap": running_unique_visitors_bitmap,
    "marketing_by_channel": marketing_by_channel,
    "marketing_total": marketing_total,
    "ad_clicks_capped": ad_clicks_capped,
    "ad_blacklist": ad_blacklist,
    "ad_clicks_by_province": ad_clicks_by_province,
    "login_fail_pairs": login_fail_pairs,
    "order_pattern": order_pattern,
    "order_state_machine": order_state_machine,
    "tx_interval_join": tx_interval_join,
    "tx_match_one_to_one": tx_match_one_to_one,
    "tx_unmatched_pays": tx_unmatched_pays,
    "tx_unmatched_receipts": tx_unmatched_receipts,
    "tx_unmatched_pays_one_to_one": tx_unmatched_pays_one_to_one,
    "tx_unmatched_receipts_one_to_one": tx_unmatched_receipts_one_to_one,
    "topic_lines": topic_lines,
    "behaviour_lines_trimmed": behaviour_lines_trimmed,
    "access_log_lines": access_log_lines,
    "login_lines": login_lines,
    "order_lines_paid": order_lines_paid,
    "receipt_lines": receipt_lines,
    "hot_urls_corrected": hot_urls_corrected,
    "hot_items_documents": hot_items_documents,
    "unique_visitor_lines": unique_visitor_lines,
    "part_interval_join": part_interval_join,
    "part_one_to_one": part_one_to_one,
    "part_unmatched_left": part_unmatched_left,
    "part_unmatched_right": part_unmatched_right,
    "part_unmatched_one_to_one": part_unmatched_one_to_one,
    "hot_url_rank_changes": hot_url_rank_changes,
}

flagship = hot_items_top5
