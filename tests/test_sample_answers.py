"""Hand-made login, order and receipt lines through parsers and operators, in batch."""

import tempfile

from pyspark.sql import functions as F

from tidemark.operators import matching, patterns
from tidemark.sources import parse_login, parse_order, parse_receipt, read_lines, split_rejects

T = 1704067200


def _parsed(spark, lines, parser, **kw):
    d = tempfile.mkdtemp(prefix="tidemark-lines-") + "/d"
    spark.createDataFrame([(x,) for x in lines], ["value"]).coalesce(1).write.text(d)
    good, bad = split_rejects(parser(read_lines(spark, d), keep=("seq",), **kw))
    return good, [r["line"] for r in bad.collect()]


def test_login_pairs_in_event_time_order(spark):
    lines = [f"{u},10.0.0.1,{k},{T + s}" for u, k, s in [(1, "fail", 43), (1, "fail", 42), (1, "fail", 44), (1, "success", 45),
                                                         (1, "fail", 46), (2, "fail", 50), (2, "fail", 52)]]
    logins, bad = _parsed(spark, lines + ["1,10.0.0.1,fail", f"x,10.0.0.1,fail,{T}"], parse_login)
    got = sorted((r["user_id"], r["a"] - T, r["b"] - T) for r in patterns.login_fail_pairs(logins, "2 seconds").select(
        "user_id", F.unix_seconds("first_fail_time").alias("a"), F.unix_seconds("last_fail_time").alias("b")).collect())
    assert got == [(1, 42, 43), (1, 43, 44)]
    assert len(bad) == 2


def test_order_lines_pattern_and_outcomes(spark):
    lines = [f"{o},{k},{x},{T + s}" for o, k, x, s in [(1, "create", "", 0), (1, "pay", "a", 899), (2, "create", "", 0), (2, "pay", "b", 900),
                                                       (3, "create", "", 0), (4, "pay", "c", 7)]]
    orders, bad = _parsed(spark, lines + [f"5,pay,d,{T},more,fields"], parse_order)
    assert not bad and orders.where("order_id = 5 AND tx_id = 'd'").count() == 1
    assert orders.where("tx_id = ''").count() == 3
    res = {r["order_id"]: r["result"] for r in patterns.order_outcomes(orders, "15 minutes").collect()}
    assert res == {1: "payed successfully", 2: "payed but already timeout", 3: "order timeout",
                   4: "already pay but not found create", 5: "already pay but not found create"}
    match = patterns.order_pattern(orders, "15 minutes").where("outcome = 'match'").collect()
    assert [r["order_id"] for r in match] == [1]


def test_receipt_lines_match_by_interval_and_one_to_one(spark):
    pays, _ = _parsed(spark, [f"{i},pay,{x},{T + s}" for i, x, s in [(1, "a", 10), (2, "b", 20), (3, "c", 30)]], parse_order)
    recs, _ = _parsed(spark, [f"{x},card,{T + s}" for x, s in [("a", 15), ("a", 14), ("b", 26), ("d", 9)]], parse_receipt)
    for unique in (False, True):
        pairs = matching.interval_join(pays, recs, "tx_id", "-5 seconds", "5 seconds", left_unique=unique)
        assert sorted((r["p_tx_id"], r["s"] - T) for r in pairs.select("p_tx_id", F.unix_seconds("r_ts").alias("s")).collect()) == [("a", 14), ("a", 15)]
        one = matching.one_to_one(pays, recs, "tx_id", "-5 seconds", "5 seconds", right_order=["ts", "seq"], left_unique=unique)
        assert [(r["p_tx_id"], r["s"] - T) for r in one["matched"].select("p_tx_id", F.unix_seconds("r_ts").alias("s")).collect()] == [("a", 14)]
        assert sorted(r["tx_id"] for r in one["unmatched_left"].collect()) == ["b", "c"]
        assert sorted((r["tx_id"], r["s"] - T) for r in one["unmatched_right"].select("tx_id", F.unix_seconds("ts").alias("s")).collect()) == [
            ("a", 15), ("b", 26), ("d", 9)]
        assert sorted(r["tx_id"] for r in matching.unmatched_left(pays, recs, "tx_id", "-5 seconds", "5 seconds", left_unique=unique).collect()) == ["b", "c"]
        assert sorted(r["tx_id"] for r in matching.unmatched_right(pays, recs, "tx_id", "-5 seconds", "5 seconds", left_unique=unique).collect()) == ["b", "d"]
    left = matching.interval_join(pays, recs, "tx_id", "-5 seconds", "5 seconds", spread="left")
    assert left.count() == 2
