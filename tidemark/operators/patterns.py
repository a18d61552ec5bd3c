"""Two-step event patterns per key (C1-C7), login failures (ST4), order outcomes (ST5).

A pattern here is exactly what the reference uses: a start predicate, a
second predicate reached by strict (``next``) or relaxed (``followedBy``)
contiguity, and a time limit ``within``.  Each row matching the start begins
its own partial match (C1).  Events are ordered by (ts, seq) per key (C7).
The limit is strict: second.ts - first.ts < within (D22).

Batch evaluation is one look-ahead scan per (key, time bucket) (see
:mod:`tidemark.operators.ordered`), or over range partitions with a carry where a key's bucket is too
large for a task (:mod:`tidemark.operators.carry`): no automaton, no pairs within a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.eventtime import interval
from tidemark.operators.carry import MAX_GROUP, look_ahead
from tidemark.operators.windows import seconds

MATCH = "match"
TIMEOUT = "timeout"


def two_step(df: DataFrame, keys: list[str], first: Column, second: Column, within: str,
             contiguity: str = "relaxed", ts: str = "ts", seq: str = "seq",
             payload: list[str] | None = None, max_group: int = MAX_GROUP) -> DataFrame:
    """Evaluate ``begin(first).<next|followedBy>(second).within(within)``.

    Returns one row per start event with ``second_`` (struct of the partner's
    ``payload`` or NULL) and ``outcome``: ``match``, or ``timeout`` when no
    partner came within the limit (C6).  Under strict contiguity a start
    whose very next event, in time, fails ``second`` is discarded, not timed out.
    ``max_group``: rows of one key and time bucket that one task may take (beyond it, see
    :mod:`tidemark.operators.carry`).
    """
    payload = payload or [ts, seq]
    limit = seconds(within)
    if contiguity == "relaxed":
        scanned = look_ahead(df, keys, [ts, seq], second, payload, "_partner", limit, max_group)
        ok_partner = F.col("_partner").isNotNull()
        discarded = F.lit(False)
    elif contiguity == "strict":
        marked = df.withColumn("_ok2", F.coalesce(second, F.lit(False)))
        scanned = look_ahead(marked, keys, [ts, seq], F.lit(True), payload + ["_ok2"], "_partner", limit, max_group)
        ok_partner = F.col("_partner").isNotNull() & F.col("_partner._ok2")
        discarded = F.col("_partner").isNotNull() & ~F.col("_partner._ok2")
    else:
        raise ValueError("contiguity is 'strict' or 'relaxed'")
    in_time = F.col(f"_partner.{ts}") < F.col(ts) + interval(within)
    matched = ok_partner & in_time
    out = (scanned.where(first)
           .withColumn("outcome", F.when(matched, F.lit(MATCH)).when(discarded & in_time, F.lit(None))
                       .otherwise(F.lit(TIMEOUT)))
           .where(F.col("outcome").isNotNull())
           .withColumn("second_", F.when(matched, F.struct(*[F.col(f"_partner.{c}").alias(c) for c in payload])))
           .drop("_partner"))
    if contiguity == "strict":
        out = out.drop("_ok2")
    return out


# Fixed text of the reference's login warning (keyed-state version).
LOGIN_WARNING = "login fail in 2 seconds"


def login_fail_pairs(logins: DataFrame, within: str = "2 seconds", user: str = "user_id",
                     ts: str = "ts", seq: str = "seq", message: str = LOGIN_WARNING,
                     max_group: int = MAX_GROUP) -> DataFrame:
    """ST4 / Q11: a failure directly followed (next event of the user) by another
    failure less than ``within`` later, in event-time order (D9)."""
    is_fail = F.col("event_type") == "fail"
    m = two_step(logins, [user], is_fail, is_fail, within, "strict", ts, seq, [ts, seq], max_group)
    return (m.where(F.col("outcome") == MATCH)
            .select(user, F.col(ts).alias("first_fail_time"),
                    F.col(f"second_.{ts}").alias("last_fail_time"), F.lit(message).alias("warning")))


def order_pattern(orders: DataFrame, within: str, key: str = "order_id", ts: str = "ts", seq: str = "seq",
                  create: Column | None = None, pay: Column | None = None, max_group: int = MAX_GROUP) -> DataFrame:
    """Create followedBy pay within the limit; matches and timeouts.

    Rows that are neither cannot matter under relaxed contiguity; they are left at the scan."""
    create = create if create is not None else F.col("event_type") == "create"
    pay = pay if pay is not None else F.col("event_type") == "pay"
    m = two_step(orders.where(create | pay), [key], create, pay, within, "relaxed", ts, seq, [ts, seq], max_group)
    return m.select(key, F.col(ts).alias("start_ts"), F.col(f"second_.{ts}").alias("end_ts"), "outcome")


# Fixed result texts of the reference's order state machine.
PAYED_SUCCESSFULLY = "payed successfully"
PAYED_LATE = "payed but already timeout"
ORDER_TIMEOUT = "order timeout"
PAY_BEFORE_CREATE = "payed"
PAY_WITHOUT_CREATE = "already pay but not found create"


def order_outcomes(events: DataFrame, deadline: str, key: str = "order_id", ts: str = "ts",
                   kind: str = "event_type", create: str = "create", pay: str = "pay") -> DataFrame:
    """ST5 / Q12b in batch: one outcome per order.

    The first pay decides: with a create at or before it, the latest such
    create sets the deadline (create + ``deadline``), and the pay is in time
    when strictly before it; a pay before every create is ``payed``; a pay
    with no create, or creates with no pay, time out.  One scan of the pays
    (their minimum, partial before its shuffle), one of the creates, and a
    full outer join on the order key; no per-order sequence is gathered.
    """
    first_pay = (events.where(F.col(kind) == pay).groupBy(F.col(key).alias("_pk"))
                 .agg(F.min(ts).alias("pay_ts")))
    creates = events.where(F.col(kind) == create).select(F.col(key).alias("_ck"), F.col(ts).alias("_c"))
    both = creates.join(first_pay, F.col("_ck") == F.col("_pk"), "full")
    per_order = (both.groupBy(F.coalesce("_ck", "_pk").alias(key))
                 .agg(F.max(F.when(F.col("pay_ts").isNull() | (F.col("_c") <= F.col("pay_ts")), F.col("_c"))).alias("create_ts"),
                      F.max(F.col("_ck").isNotNull()).alias("_has_c"), F.min("pay_ts").alias("pay_ts")))
    c, p = F.col("create_ts"), F.col("pay_ts")
    result = (F.when(p.isNull(), F.lit(ORDER_TIMEOUT))
              .when(c.isNull() & F.col("_has_c"), F.lit(PAY_BEFORE_CREATE))
              .when(c.isNull(), F.lit(PAY_WITHOUT_CREATE))
              .when(p < c + interval(deadline), F.lit(PAYED_SUCCESSFULLY))
              .otherwise(F.lit(PAYED_LATE)))
    return per_order.select(key, "create_ts", "pay_ts", result.alias("result"))
