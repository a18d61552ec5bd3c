"""The reference's jobs end to end on streams, with its parameters as defaults.

Each function takes a stream of text lines (``read_lines(..., stream=True)``
or ``read_kafka``) and returns the result stream(s) plus the rejected lines;
the caller picks sinks and starts them (``runner.run_available`` or
``writeStream``).  Top-N jobs return the count stream and the
``foreachBatch`` function that ranks each micro-batch's closed windows.  With ``end`` (an
:class:`~tidemark.streaming.ending.Ending`) a finished input comes out whole, as in batch (T6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.eventtime import keep_for_watermark, watermark
from tidemark.sources.lines import parse_access_log, parse_behaviour, parse_login, parse_order, parse_receipt
from tidemark.sources.lines import split_rejects
from tidemark.streaming import distinct, processors, windows
from tidemark.streaming.ending import Ending


def _seq(lines: DataFrame) -> DataFrame:
    # The tie-break for rows with equal times (see sources.readers).
    return lines if "seq" in lines.columns else lines.withColumn("seq", F.xxhash64(*lines.columns))


def _ends(good: DataFrame, end: Ending | None) -> DataFrame:
    return good if end is None else end.attach(good)


def hot_items(lines: DataFrame, n: int = 5, size: str = "1 hour", slide: str = "5 minutes",
              behavior: str = "pv", end: Ending | None = None):
    """Q1-Q3: counts of ``behavior`` per item and sliding window, plus the top-N batch writer factory.

    The filter names the event-time column so dropped rows still move the
    watermark (D23)."""
    good, bad = split_rejects(parse_behaviour(_seq(lines), keep=("seq",)))
    views = watermark(_ends(good, end)).where(keep_for_watermark(F.col("behavior") == behavior))
    counts = windows.windowed_counts(views, size, slide, keys=["item_id"], out="cnt", upstream_watermark=True)
    return counts, (lambda write: windows.top_n_writer(n, "item_id", "cnt", write)), bad


def hot_urls(lines: DataFrame, size: str = "1 minute", slide: str = "5 seconds",
             disorder: str = "1 second", lateness: str = "60 seconds", end: Ending | None = None):
    """Q4: GET counts per url in ``update`` mode with lateness; write with ``change_log_writer``."""
    p = parse_access_log(_seq(lines), keep=("seq",))
    good, bad = p.where(~F.col("_rejected")).drop("_line", "_rejected"), p.where("_rejected").select(
        F.col("_line").alias("line"))
    delay = f"{_ms(disorder) + _ms(lateness)} milliseconds"
    gets = watermark(_ends(good, end), "ts", delay).where(keep_for_watermark(F.col("method") == "GET"))
    return windows.windowed_counts(gets, size, slide, keys=["url"], out="cnt", upstream_watermark=True), bad


def _ms(d: str) -> int:
    from tidemark.operators.windows import seconds
    return seconds(d) * 1000


def page_views(lines: DataFrame, size: str = "1 hour", end: Ending | None = None):
    """Q5: ``pv`` count per tumbling window (with window bounds, D18)."""
    good, bad = split_rejects(parse_behaviour(_seq(lines), trim=True, keep=("seq",)))
    pv = watermark(_ends(good, end)).where(keep_for_watermark(F.col("behavior") == "pv"))
    return windows.windowed_counts(pv, size, out="pv", upstream_watermark=True), bad


def unique_visitors(lines: DataFrame, size: str = "1 hour", bitmap: bool = False, end: Ending | None = None):
    """Q6 / Q7: distinct visitors per window (exact, or over bitmap offsets)."""
    good, bad = split_rejects(parse_behaviour(_seq(lines), trim=True, keep=("seq",)))
    pv = watermark(_ends(good, end)).where(keep_for_watermark(F.col("behavior") == "pv"))
    return distinct.unique_visitors(pv, size, bitmap=bitmap, upstream_watermark=True), bad


def marketing(events: DataFrame, size: str = "1 hour", slide: str = "10 seconds", by_channel: bool = True,
              end: Ending | None = None):
    """Q8 / Q9: counts per (channel, behaviour) or in total, all but ``uninstall``; pane form."""
    kept = watermark(_ends(events, end)).where(keep_for_watermark(F.col("behavior") != "uninstall"))
    keys = ["channel", "behavior"] if by_channel else []
    return windows.windowed_counts(kept, size, slide, keys=keys, out="cnt", upstream_watermark=True)


def ad_clicks(clicks: DataFrame, cap: int = 10, size: str = "1 hour", slide: str = "5 seconds", end: Ending | None = None):
    """Q10: (tagged click-cap stream, passing clicks counted per province and sliding window).

    The cap is decided on arrival here (ascending input), because its rows go on
    ahead of the watermark into the counts.  Both come from one stateful step; start the tagged stream for the
    warnings (tag ``warning``) and the counts as a second query, or write both
    from one ``foreachBatch``."""
    tagged = processors.click_cap_stream(_ends(_seq(clicks), end), cap, decide="arrival")
    passed = tagged.where(F.col("tag") == "pass")
    counts = windows.windowed_counts(passed, size, slide, keys=["province"], out="cnt", upstream_watermark=True)
    return tagged, counts


def login_failures(lines: DataFrame, within: str = "2 seconds", disorder: str = "5 seconds", strict_pattern=True,
                   end: Ending | None = None):
    """Two failures in a row under the limit, in event-time order."""
    good, bad = split_rejects(parse_login(_seq(lines), keep=("seq",)))
    good = _ends(good, end)
    if strict_pattern:
        out = processors.pattern_stream(good, "user_id", "fail", "fail", within, strict=True, delay=disorder)
        return out.where("outcome = 'match'"), bad
    return processors.login_fail_stream(good, within, delay=disorder), bad


def order_timeout(lines: DataFrame, within: str = "15 minutes", unit: str = "s", pattern: bool = False,
                  end: Ending | None = None):
    """Q12a (pattern, create followedBy pay) / Q12b (state machine with deadline)."""
    good, bad = split_rejects(parse_order(_seq(lines), unit=unit, keep=("seq",)))
    good = _ends(good, end)
    if pattern:
        return processors.pattern_stream(good, "order_id", "create", "pay", within), bad
    return processors.order_outcomes_stream(good, within), bad


def tx_match(order_lines: DataFrame, receipt_lines: DataFrame, bound: str = "5 seconds", unit: str = "s",
             one_to_one: bool = True, end: Ending | None = None):
    """Q13a (one-to-one with unmatched outputs) / Q13b (interval join, all pairs)."""
    pays, bad_p = split_rejects(parse_order(_seq(order_lines), unit=unit, keep=("seq",)))
    recs, bad_r = split_rejects(parse_receipt(_seq(receipt_lines), unit=unit, keep=("seq",)))
    pays = pays.where(F.col("tx_id") != "")             # F3: before event time, a plain filter
    if one_to_one:
        return processors.one_to_one_stream(_ends(pays, end), _ends(recs, end), "tx_id", f"-{bound}", bound), bad_p.unionByName(bad_r)
    from tidemark.streaming.matching import match_streams_bucketed
    return match_streams_bucketed(_ends(pays.select("tx_id", "ts", "order_id"), end), _ends(recs.select("tx_id", "ts", "pay_channel"), end),
                                  "tx_id", f"-{bound}", bound), bad_p.unionByName(bad_r)


def running_unique_visitors(lines: DataFrame, totals_path: str, size: str = "1 hour", bitmap: bool = True,
                            end: Ending | None = None):
    """Q7 per event: first-sighting stream plus the ``foreachBatch`` writer factory that
    emits the running distinct count at every repeat visit (the reference's output)."""
    good, bad = split_rejects(parse_behaviour(_seq(lines), trim=True, keep=("seq",)))
    pv = watermark(_ends(good, end)).where(keep_for_watermark(F.col("behavior") == "pv"))
    return (distinct.first_sightings(pv, size, bitmap=bitmap, upstream_watermark=True),
            (lambda write: distinct.running_unique_writer(totals_path, write)), bad)
