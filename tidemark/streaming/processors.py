"""Keyed stateful processors for streams (ST1-ST13, C7) on ``transformWithStateInPandas``.

Event time decides, not arrival: rows of a key wait in list state until the
watermark passes them and are then taken in (ts_ms, seq) order, so results do not
depend on how the input was cut into micro-batches.  Times enter as ``ts_ms`` (epoch
milliseconds, LONG); nothing depends on a time zone.

Late rows are never dropped unseen: the time column that carries the watermark is
not passed on to the processor, so Spark does not filter by it, and a row at or
behind the watermark comes out with the tag ``late`` (or ``late_<side>``).  So does a row without an
event time (its time null); a missing ``seq`` counts as 0.

State per key: the waiting rows (list state, appended to, read and rewritten once
per release) and one packed value with everything else, the pending timer
included, read and written once per callback.  One timer is pending per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.eventtime import ASCENDING, END, watermark
from tidemark.operators import limits, patterns
from tidemark.operators.ordered import LOOKAHEAD
from tidemark.operators.windows import seconds

DAY_MS = 86_400_000
LATE = "late"


def _frame(batches) -> pd.DataFrame:
    parts = [b for b in batches if len(b)]
    return (parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)) if parts else pd.DataFrame()


# Stands for a missing event time inside a processor: behind every watermark, so such rows come out ``late``.
NO_TIME = -(1 << 62)


def _with_ms(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    s = watermark(stream, ts, delay).withColumn("ts_ms", F.coalesce(F.unix_millis(F.col(ts)), F.lit(NO_TIME)))
    return s.withColumn("seq", F.coalesce(F.col("seq"), F.lit(0)).cast("long")) if "seq" in s.columns else s


def _timed(out: DataFrame, *cols: str) -> DataFrame:
    """Missing event times as nulls again."""
    return out.withColumns({c: F.nullif(F.col(c), F.lit(NO_TIME)) for c in cols})


def _typed(rows: list[tuple], cols: list[str], types: dict) -> pd.DataFrame:
    """Rows as a frame; whole-number columns stay whole where values are missing."""
    return pd.DataFrame(rows, columns=cols).astype({c: t for c, t in types.items() if c in cols})


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _plain(col: pd.Series, kind: str) -> list:
    """Values for the state store: missing ones as None, whole numbers whole."""
    if kind in _WHOLE:
        return [None if v is None or v != v else int(v) for v in col]
    return [None if v is None or v != v else v for v in col.tolist()]


def _in_micros(df: DataFrame, cols: list[str]) -> DataFrame:
    """Timestamps as microseconds: exact in the state store and in no time zone."""
    return df.withColumns({c: F.unix_micros(F.col(c)) for c in cols if _type(df, c) == "timestamp"})


def _from_micros(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.timestamp_micros(F.col(c)) for c in cols})


def _stamps(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if _type(df, c) == "timestamp"]


class _Released(StatefulProcessor):
    """Rows wait for the watermark; subclasses say what to do with released ones.

    ``held``: DDL of a waiting row, ``ts_ms`` and ``seq`` first; ``packed``: DDL of
    the rest of the state; ``start``: that rest for a new key.
    """

    held: str
    packed: str
    start: tuple

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("held", self.held)
        self.state = handle.getValueState("packed", f"timer LONG, {self.packed}")

    def _load(self) -> tuple[int | None, list]:
        got = self.state.get()
        return (None, list(self.start)) if got is None else (got[0], list(got[1:]))

    def _arm(self, old: int | None, new: int | None) -> int | None:
        """Move the pending timer to ``new`` if that is earlier (or none is pending)."""
        if new is None or (old is not None and old <= new):
            return old
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(new))
        return int(new)

    def rows_of(self, pdf: pd.DataFrame) -> list[tuple]:
        """Input rows as waiting rows."""
        raise NotImplementedError

    def late(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        """Output rows for input at or behind the watermark."""
        raise NotImplementedError

    def release(self, key, ready: list[tuple], rest: list, t: int) -> tuple[list[tuple], int | None]:
        """Take ``ready`` (sorted, all up to ``t``), change ``rest`` in place; returns output
        rows and the next time something falls due without input."""
        raise NotImplementedError

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows)
        if not len(pdf):
            return
        behind = pdf["ts_ms"] <= timerValues.getCurrentWatermarkInMs()
        if behind.any():
            yield self.late(key, pdf[behind])
            pdf = pdf[~behind]
        if len(pdf):
            self.waiting.appendList(self.rows_of(pdf))
            timer, rest = self._load()
            moved = self._arm(timer, int(pdf["ts_ms"].min()))
            if moved != timer:
                self.state.update((moved, *rest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Work up to the current watermark, not only to this timer.
        t = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        _, rest = self._load()
        held = sorted((tuple(v) for v in self.waiting.get()), key=lambda v: v[:2])
        cut = next((i for i, v in enumerate(held) if v[0] > t), len(held))
        out, due = self.release(key, held[:cut], rest, t)
        if cut:
            self.waiting.put(held[cut:]) if cut < len(held) else self.waiting.clear()
        times = [x for x in (held[cut][0] if cut < len(held) else None, due) if x is not None]
        timer = self._arm(None, min(times)) if times else None
        if timer is None and tuple(rest) == tuple(self.start):
            self.state.clear()
        else:
            self.state.update((timer, *rest))
        if out:
            yield self.frame(out)

    def close(self) -> None:
        """Nothing is held outside the state store."""


def _copies(pdf: pd.DataFrame) -> pd.Series:
    return pdf["copy"].astype(bool) if "copy" in pdf else pd.Series(False, index=pdf.index)


def _split_by_time(s: DataFrame, key: str, within_ms: int) -> DataFrame:
    """Rows with ``bucket`` and ``copy``: a key's rows are dealt out by time, and a row near the start of its
    bucket goes to the bucket before as well, as a copy that may end a pattern there but starts none.  The
    stream form of ``operators.ordered.next_within``: what is ahead by at most the limit is in the same bucket."""
    width = max(1, within_ms) * LOOKAHEAD
    own = F.floor(F.col("ts_ms") / width).cast("long")
    here, before = (F.struct(b.alias("bucket"), F.lit(c).alias("copy")) for b, c in ((own, False), (own - 1, True)))
    early = F.col("ts_ms") - own * width <= within_ms
    return s.withColumn("_to", F.explode(F.when(early, F.array(here, before)).otherwise(F.array(here)))).select(
        *s.columns, "_to.bucket", "_to.copy")


# ---------------------------------------------------------------- ST5 order machine

class OrderMachine(_Released):
    """Create/pay per order with a deadline (Q12b) on event time (ST6, ST7, ST9).

    A create sets the deadline at create + deadline (a newer create replaces it, D13).
    A pay before the deadline is ``payed successfully``, at it or later ``payed but
    already timeout``; when time passes the deadline with no pay, ``order timeout``
    comes out first and a later pay is still reported as late (D14).  A pay with no
    create waits ``pay_wait`` for one (D2).  Once a pay has decided an order its later
    events are ignored, for ``retention``: that bounds the state, and events of an
    order that come later than that begin a new create/pay cycle.
    """

    held = "ts_ms LONG, seq LONG, create BOOLEAN"
    packed = "deadline LONG, paid LONG, expired LONG, done LONG"
    start = (None, None, None, None)

    def __init__(self, deadline_ms: int, pay_wait_ms: int | None = None, retention_ms: int | None = None):
        self.deadline_ms = deadline_ms
        self.pay_wait_ms = pay_wait_ms if pay_wait_ms is not None else deadline_ms
        self.retention_ms = retention_ms if retention_ms is not None else deadline_ms

    def rows_of(self, pdf):
        mine = pdf[pdf["event_type"].isin(["create", "pay"])]
        return [(int(t), int(s), k == "create") for t, s, k in zip(mine["ts_ms"], mine["seq"], mine["event_type"])]

    def late(self, key, pdf):
        return self.frame([(key[0], LATE, int(t)) for t in pdf["ts_ms"]])

    def frame(self, rows):
        return pd.DataFrame(rows, columns=["order_id", "result", "ts_ms"])

    def _dues(self, s: list) -> list[tuple[int, int]]:
        add = (0, self.pay_wait_ms, self.retention_ms, self.retention_ms)
        return [(v + d, i) for i, (v, d) in enumerate(zip(s, add)) if v is not None]

    def release(self, key, ready, rest, t):
        out, order = [], key[0]
        # creates before pays at one time, as in the batch form
        for ts, _, create in [*sorted(ready, key=lambda v: (v[0], not v[2], v[1])), (t + 1, 0, None)]:
            while True:                                   # what fell due before this row
                due, what = min(self._dues(rest), default=(ts, -1))
                if due >= ts:
                    break
                if what == 0:
                    out.append((order, patterns.ORDER_TIMEOUT, due))
                    rest[2] = due
                elif what == 1:
                    out.append((order, patterns.PAY_WITHOUT_CREATE, due))
                    rest[3] = due
                rest[what] = None
            if create is None or rest[3] is not None:
                continue
            deadline, paid, expired, _ = rest
            result = None
            if create:
                if paid is not None:
                    result = patterns.PAY_BEFORE_CREATE
                else:
                    rest[0] = ts + self.deadline_ms
            elif deadline is not None:
                result = patterns.PAYED_SUCCESSFULLY if ts < deadline else patterns.PAYED_LATE
            elif expired is not None:
                result = patterns.PAYED_LATE
            elif paid is None:
                rest[1] = ts
            if result:
                out.append((order, result, ts))
                rest[:] = [None, None, None, ts]
        return out, min(self._dues(rest), default=(None, 0))[0]


def order_outcomes_stream(stream: DataFrame, deadline: str, key: str = "order_id", ts: str = "ts",
                          delay: str = ASCENDING, pay_wait: str | None = None,
                          retention: str | None = None) -> DataFrame:
    """Q12b on a stream: input (key, event_type, ts, seq) -> (order_id, result, ts_ms); result
    ``late`` marks rows behind the watermark.

    ``retention`` (default: the deadline) is how long a decided order swallows its later events."""
    s = _with_ms(stream, ts, delay).select(F.col(key).alias("order_id"), "event_type", "ts_ms", "seq")
    proc = OrderMachine(seconds(deadline) * 1000, seconds(pay_wait) * 1000 if pay_wait else None,
                        seconds(retention) * 1000 if retention else None)
    return _timed(s.groupBy("order_id").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=f"order_id {_type(s, 'order_id')}, result STRING, ts_ms LONG",
        outputMode="Append", timeMode="EventTime"), "ts_ms")


# ---------------------------------------------------------------- ST1-ST3 click cap

class ClickCap(_Released):
    """Pass the first ``cap`` clicks per (user, ad, UTC day) by event time; warn once at the next.

    The day is part of the key; an event-time timer at its end (plus ``grace``) clears
    the state: the daily reset of ST3 on event time (D7).  Of the waiting rows only the
    ``cap + 1`` earliest can pass or warn, so no more are kept, however hot the key.
    """

    packed = "n LONG, warned BOOLEAN"
    start = (0, False)

    def __init__(self, cap: int, types: dict[str, str], held: str, grace_ms: int = 0):
        self.cap, self.types, self.held, self.grace_ms = cap, types, held, grace_ms
        self.cols = list(types)

    def _out(self, pdf, tag, msg=None):
        return pdf[self.cols].assign(tag=tag, msg=msg)

    def frame(self, rows):
        return pd.concat([self._out(_typed([v[2:] for v in rs], self.cols, {c: "Int64" for c, t in self.types.items() if t in _WHOLE}), tag,
                                    limits.WARNING_TEXT.format(cap=self.cap) if tag == "warning" else None) for tag, rs in rows], ignore_index=True)

    def late(self, key, pdf):
        return self._out(pdf, LATE)

    def rows_of(self, pdf):
        return list(zip(pdf["ts_ms"].astype(int).tolist(), pdf["seq"].astype(int).tolist(), *[_plain(pdf[c], t) for c, t in self.types.items()]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        timer, rest = self._load()
        room = max(self.cap - rest[0], 0) + (not rest[1])
        best: pd.DataFrame | None = None
        for pdf in rows:                                   # Arrow batch by batch: a hot key is not gathered
            behind = pdf["ts_ms"] <= wm
            if behind.any():
                yield self.late(key, pdf[behind])
                pdf = pdf[~behind]
            best = pdf if best is None else pd.concat([best, pdf])
            best = best.sort_values(["ts_ms", "seq"], kind="stable").head(room)
        if best is None or not len(best):
            return
        held = sorted([*(tuple(v) for v in self.waiting.get()), *self.rows_of(best)], key=lambda v: v[:2])[:room]
        self.waiting.put(held)
        moved = self._arm(timer, min(held[0][0], (int(key[2]) + 1) * DAY_MS + self.grace_ms))
        if moved != timer:
            self.state.update((moved, *rest))

    def release(self, key, ready, rest, t):
        out = []
        room = max(self.cap - rest[0], 0)
        if ready[:room]:
            out.append(("pass", ready[:room]))
        if not rest[1] and len(ready) > room:
            out.append(("warning", ready[room:room + 1]))
            rest[1] = True
        rest[0] += len(ready[:room])
        end = (int(key[2]) + 1) * DAY_MS + self.grace_ms
        if end <= t:
            rest[:] = list(self.start)
            return out, None
        return out, end


class ClickCapNow(StatefulProcessor):
    """The cap decided as rows arrive (rows of one micro-batch in event-time order).

    For ascending input this is the event-time answer.  It is what a windowed count
    chained behind the cap in the same query needs (rows must come out ahead of the
    watermark), and with ``processing_reset`` the wall-clock reset of ST8.
    """

    def __init__(self, cap: int, cols: list[str], grace_ms: int = 0, processing_reset: bool = False):
        self.cap, self.cols, self.grace_ms, self.processing_reset = cap, cols, grace_ms, processing_reset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("packed", "n LONG, warned BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = self.state.get()
        n, warned = got if got is not None else (0, False)
        room = max(self.cap - n, 0)
        best = None
        for pdf in rows:
            best = pdf if best is None else pd.concat([best, pdf])
            best = best.sort_values(["ts_ms", "seq"], kind="stable").head(room + 1)
        if best is None or not len(best):
            return
        if got is None:
            self.begin(key, timerValues)
        out = [best[self.cols].head(room).assign(tag="pass", msg=None)]
        if not warned and len(best) > room:
            out.append(best[self.cols].iloc[room:].assign(tag="warning", msg=limits.WARNING_TEXT.format(cap=self.cap)))
            warned = True
        self.state.update((n + min(room, len(best)), bool(warned)))
        yield pd.concat(out, ignore_index=True)

    def begin(self, key, timerValues) -> None:
        if self.processing_reset:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer((now // DAY_MS + 1) * DAY_MS)
        else:
            self.handle.registerTimer((int(key[2]) + 1) * DAY_MS + self.grace_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        """Nothing is held outside the state store."""


class ClickCapTtl(ClickCapNow):
    """The same per (user, ad, UTC day of the click), with state that expires ``ttl_ms`` after the key's last
    change: the store drops it by itself, no timer is set."""

    def __init__(self, cap: int, cols: list[str], ttl_ms: int):
        super().__init__(cap, cols)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("packed", "n LONG, warned BOOLEAN", self.ttl_ms)

    def begin(self, key, timerValues) -> None:
        """Nothing to set."""


def click_cap_stream(stream: DataFrame, cap: int, ts: str = "ts", delay: str = ASCENDING,
                     grace: str = "0 seconds", reset: str = "event", decide: str = "event", ttl: str = "2 days") -> DataFrame:
    """Q10 on a stream: all input columns with ``ts_ms``, ``tag`` (``pass`` / ``warning`` / ``late``)
    and ``msg`` (one query, split by tag, ST13).

    ``reset='event'`` (default, D7) keys the state by the event's UTC day and clears it with an
    event-time timer.  ``decide='event'`` waits for the watermark, so arrival order does not matter;
    ``decide='arrival'`` answers at once and keeps the event time, so windowed counts can follow in
    the same query (rows without an event time are left out there).  ``reset='processing'`` keys by (user, ad) only and clears at the next wall-clock
    UTC midnight (ST8), as the reference does, at the price of answers that depend on when it runs.
    ``reset='ttl'`` decides at once per event day and lets the state expire ``ttl`` of wall-clock time after the
    key's last click (ST3): a day must be over for longer than that before late clicks of it start anew.
    """
    s = _with_ms(stream, ts, delay)
    if reset in ("processing", "ttl") or decide == "arrival":           # decided now, by a time there must be
        s = s.where(F.col("ts_ms") != NO_TIME)
    names = list(s.columns)
    types = [f"`{c}` {_type(s, c)}" for c in names]
    out = ", ".join(types) + ", tag STRING, msg STRING"
    if reset == "processing":
        return s.groupBy("user_id", "ad_id").transformWithStateInPandas(
            statefulProcessor=ClickCapNow(cap, names, processing_reset=True), outputStructType=out,
            outputMode="Append", timeMode="ProcessingTime")
    s = s.withColumn("day", F.floor(F.col("ts_ms") / DAY_MS).cast("long"))
    if reset == "ttl":
        return s.groupBy("user_id", "ad_id", "day").transformWithStateInPandas(
            statefulProcessor=ClickCapTtl(cap, names, seconds(ttl) * 1000), outputStructType=out, outputMode="Append", timeMode="ProcessingTime")
    if decide == "arrival":
        return s.groupBy("user_id", "ad_id", "day").transformWithStateInPandas(
            statefulProcessor=ClickCapNow(cap, names, seconds(grace) * 1000), outputStructType=out,
            outputMode="Append", timeMode="EventTime", eventTimeColumnName=ts)
    # The watermarked column stays behind; its value travels as a number and comes back after.
    plain = _in_micros(s, names)
    kinds = {c: _type(plain, c) for c in names}
    typed = ", ".join(f"`{c}` {t}" for c, t in kinds.items())
    got = plain.groupBy("user_id", "ad_id", "day").transformWithStateInPandas(
        statefulProcessor=ClickCap(cap, kinds, f"w_ms LONG, w_seq LONG, {typed}", seconds(grace) * 1000),
        outputStructType=f"{typed}, tag STRING, msg STRING", outputMode="Append", timeMode="EventTime")
    return _timed(_from_micros(got, _stamps(s, names)), "ts_ms")


# ---------------------------------------------------------------- ST4 login failures

class LoginFailPairs(_Released):
    """Two failures in a row per user less than ``within`` apart, in event-time order (ST4, C7).

    Only the time of the last released row is carried, and only if it is a failure that can
    still pair.  A copy from the next bucket ends a pair here and starts none."""

    held = "ts_ms LONG, seq LONG, fail BOOLEAN, copy BOOLEAN"
    packed = "last LONG"
    start = (None,)

    def __init__(self, within_ms: int, message: str):
        self.within_ms, self.message = within_ms, message

    def rows_of(self, pdf):
        return list(zip(pdf["ts_ms"].astype(int).tolist(), pdf["seq"].astype(int).tolist(), (pdf["event_type"] == "fail").tolist(),
                        _copies(pdf).tolist()))

    def late(self, key, pdf):
        return self.frame([(key[0], int(t), None, LATE) for t in pdf["ts_ms"][~_copies(pdf)]])

    def frame(self, rows):
        return _typed(rows, ["user_id", "first_fail_ms", "last_fail_ms", "warning"], {"first_fail_ms": "Int64", "last_fail_ms": "Int64"})

    def release(self, key, ready, rest, t):
        out, last = [], rest[0]
        for ts, _, fail, copy in ready:
            if fail and last is not None and ts - last < self.within_ms:
                out.append((key[0], last, ts, self.message))
            last = ts if fail and not copy else None
        # once the watermark is past last + limit no later row can pair with it
        rest[0] = last if last is not None and last + self.within_ms > t else None
        return out, rest[0] + self.within_ms if rest[0] is not None else None


def login_fail_stream(stream: DataFrame, within: str, ts: str = "ts", delay: str = ASCENDING,
                      message: str = patterns.LOGIN_WARNING, split: bool = True) -> DataFrame:
    """Q11 on a stream: input (user_id, event_type, ts, seq) -> (user_id, first_fail_ms, last_fail_ms,
    warning); warning ``late`` marks rows behind the watermark (their time in first_fail_ms).

    ``split`` keys the state by (user, time bucket), so a hot user is spread over its buckets."""
    s = _with_ms(stream, ts, delay).select("user_id", "event_type", "ts_ms", "seq")
    s = _split_by_time(s, "user_id", seconds(within) * 1000) if split else s.withColumns({"bucket": F.lit(0).cast("long"), "copy": F.lit(False)})
    return _timed(s.groupBy("user_id", "bucket").transformWithStateInPandas(
        statefulProcessor=LoginFailPairs(seconds(within) * 1000, message),
        outputStructType=f"user_id {_type(s, 'user_id')}, first_fail_ms LONG, last_fail_ms LONG, warning STRING",
        outputMode="Append", timeMode="EventTime"), "first_fail_ms")


# ---------------------------------------------------------------- C1-C7 two-step pattern

class TwoStepPattern(_Released):
    """``begin(first).<next|followedBy>(second).within(limit)`` per key, with timeouts.

    Released rows are walked once in order.  The state is the times of undecided starts: a
    start is decided by the next row (strict) or the next ``second`` row (relaxed), or when the
    watermark passes its limit.  Rows that start nothing leave no state behind.  Copies from the next
    bucket start nothing.
    """

    held = "ts_ms LONG, seq LONG, first BOOLEAN, second BOOLEAN"
    packed = "open ARRAY<LONG>"
    start = ([],)

    def __init__(self, first: str, second: str, within_ms: int, strict: bool = False):
        self.first, self.second, self.within_ms, self.strict = first, second, within_ms, strict

    def rows_of(self, pdf):
        kind = pdf["event_type"]
        return list(zip(pdf["ts_ms"].astype(int).tolist(), pdf["seq"].astype(int).tolist(),
                        ((kind == self.first) & ~_copies(pdf)).tolist(), (kind == self.second).tolist()))

    def late(self, key, pdf):
        return self.frame([(key[0], int(t), None, LATE) for t in pdf["ts_ms"][~_copies(pdf)]])

    def frame(self, rows):
        return _typed(rows, ["key", "start_ms", "end_ms", "outcome"], {"start_ms": "Int64", "end_ms": "Int64"})

    def release(self, key, ready, rest, t):
        out, open_, k = [], list(rest[0]), key[0]
        for ts, _, first, second in ready:
            if open_ and (second or self.strict):
                for s in open_:
                    if ts >= s + self.within_ms:
                        out.append((k, s, None, patterns.TIMEOUT))
                    elif second:
                        out.append((k, s, ts, patterns.MATCH))
                open_ = []
            if first:
                open_.append(ts)
        over = [s for s in open_ if s + self.within_ms <= t]
        out += [(k, s, None, patterns.TIMEOUT) for s in over]
        rest[0] = open_[len(over):]
        return out, rest[0][0] + self.within_ms if rest[0] else None


def pattern_stream(stream: DataFrame, key: str, first: str, second: str, within: str,
                   strict: bool = False, ts: str = "ts", delay: str = ASCENDING, split: bool = True) -> DataFrame:
    """C1-C7 on a stream: input (key, event_type, ts, seq) -> (key, start_ms, end_ms, outcome);
    outcome ``late`` marks rows behind the watermark (their time in start_ms).

    ``split`` keys the state by (key, time bucket), so a hot key is spread over its buckets."""
    s = _with_ms(stream, ts, delay)
    if not strict:
        # Only starts and partners matter under relaxed contiguity: drop the rest
        # JVM-side, in a filter that still lets them move the watermark.
        # Rows without a time pass too, to come out late.
        s = s.where(F.when(F.col(ts).isNull(), F.lit(True)).otherwise(F.col("event_type").isin(first, second)))
    s = s.select(F.col(key).alias("key"), "event_type", "ts_ms", "seq")
    s = _split_by_time(s, "key", seconds(within) * 1000) if split else s.withColumns({"bucket": F.lit(0).cast("long"), "copy": F.lit(False)})
    return _timed(s.groupBy("key", "bucket").transformWithStateInPandas(
        statefulProcessor=TwoStepPattern(first, second, seconds(within) * 1000, strict),
        outputStructType=f"key {_type(s, 'key')}, start_ms LONG, end_ms LONG, outcome STRING",
        outputMode="Append", timeMode="EventTime"), "start_ms")


# ---------------------------------------------------------------- J2-J4 one-to-one matching

class OneToOneMatch(_Released):
    """k-th pay with k-th receipt of a tx, within [lower, upper] (J2), with both
    unmatched outputs (J3, J4) on a tagged union of the two streams.

    A released row pairs with the oldest waiting row of the other side (that is the
    k-th pairing); a pair out of range reports both sides unmatched.  A waiting row whose
    range the watermark has closed is reported unmatched at once and leaves only a count
    behind (``owed``): the k-th row of the other side that comes later still takes its place
    and is unmatched too, exactly as in the batch form.  So full records are kept no longer
    than their range.  Every row ends as matched or unmatched (D15).
    """

    packed = "owed LONG, owed_pay BOOLEAN, queued BOOLEAN"
    start = (0, False, False)

    def __init__(self, lower_ms: int, upper_ms: int, types: dict[str, dict[str, str]], held: str):
        self.lower_ms, self.upper_ms, self.cols, self.held = lower_ms, upper_ms, types, held
        self.types = {**types["pay"], **types["receipt"]}
        self.names = list(self.types)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.queue = handle.getListState("queue", self.held)      # released, unreported, all of one side

    def rows_of(self, pdf):
        return list(zip(pdf["ts_ms"].astype(int).tolist(), pdf["seq"].astype(int).tolist(), pdf["side"].tolist(), *[_plain(pdf[c], t) for c, t in self.types.items()]))

    def _row(self, tx, pay, receipt, tag):
        n = len(self.cols["pay"])
        return (tx, pay[0] if pay else None, receipt[0] if receipt else None, tag,
                *(pay[3:3 + n] if pay else [None] * n), *(receipt[3 + n:] if receipt else [None] * len(self.cols["receipt"])))

    def _alone(self, tx, row, prefix="unmatched"):
        return self._row(tx, row if row[2] == "pay" else None, row if row[2] == "receipt" else None, f"{prefix}_{row[2]}")

    def late(self, key, pdf):
        return self.frame([self._alone(key[0], r, LATE) for r in self.rows_of(pdf)])

    def frame(self, rows):
        whole = ["pay_ms", "receipt_ms", *[c for c, t in self.types.items() if t in _WHOLE]]
        return _typed(rows, ["tx_id", "pay_ms", "receipt_ms", "tag", *self.names], dict.fromkeys(whole, "Int64"))

    def _closes(self, row) -> int:
        # from this time on no row of the other side can fall in range
        return row[0] + (self.upper_ms if row[2] == "pay" else -self.lower_ms) + 1

    def release(self, key, ready, rest, t):
        tx, out = key[0], []
        queue = [tuple(v) for v in self.queue.get()] if rest[2] else []
        at = 0
        for row in ready:
            other = queue[at] if at < len(queue) and queue[at][2] != row[2] else None
            if rest[0] and rest[1] != (row[2] == "pay"):
                rest[0] -= 1                              # its partner was reported before
                out.append(self._alone(tx, row))
            elif other is not None and not rest[0]:
                at += 1
                pay, receipt = (row, other) if row[2] == "pay" else (other, row)
                if self.lower_ms <= receipt[0] - pay[0] <= self.upper_ms:
                    out.append(self._row(tx, pay, receipt, "matched"))
                else:
                    out += [self._alone(tx, other), self._alone(tx, row)]
            else:
                queue.append(row)
        queue = queue[at:]
        done = next((i for i, r in enumerate(queue) if self._closes(r) > t), len(queue))
        if done:
            out += [self._alone(tx, r) for r in queue[:done]]
            rest[0], rest[1] = rest[0] + done, queue[0][2] == "pay"
            queue = queue[done:]
        if queue:
            self.queue.put(queue)
        elif rest[2]:
            self.queue.clear()
        rest[2] = bool(queue)
        if not rest[0]:
            rest[1] = False
        return out, self._closes(queue[0]) if queue else None


def one_to_one_stream(pays: DataFrame, receipts: DataFrame, key: str, lower: str, upper: str,
                      ts: str = "ts", delay: str = ASCENDING) -> DataFrame:
    """J2-J4 on streams -> (tx_id, pay_ms, receipt_ms, tag, p_*, r_*) with the full records of both sides.

    Tags: matched, unmatched_pay, unmatched_receipt, late_pay, late_receipt.  Each input has its own
    watermark and the slower one governs (``multipleWatermarkPolicy=min``, Spark's default)."""
    def side(df, name, prefix):
        w = _with_ms(df, ts, delay)
        mine = [c for c in df.columns if c not in (key, "seq", END)]
        return w.select(F.col(key).alias("tx_id"), "ts_ms", "seq", F.lit(name).alias("side"), *[F.col(c).alias(prefix + c) for c in mine])
    p, r = side(pays, "pay", "p_"), side(receipts, "receipt", "r_")
    stamps = _stamps(p, p.columns[4:]) + _stamps(r, r.columns[4:])
    p, r = _in_micros(p, p.columns[4:]), _in_micros(r, r.columns[4:])
    u = p.unionByName(r, allowMissingColumns=True)
    types = {"pay": {c: _type(p, c) for c in p.columns[4:]}, "receipt": {c: _type(r, c) for c in r.columns[4:]}}
    payload = ", ".join(f"`{c}` {t}" for one in types.values() for c, t in one.items())
    sign = lambda d: -1 if d.strip().startswith("-") else 1
    lo = sign(lower) * seconds(lower.strip().lstrip("-")) * 1000
    hi = sign(upper) * seconds(upper.strip().lstrip("-")) * 1000
    got = u.groupBy("tx_id").transformWithStateInPandas(
        statefulProcessor=OneToOneMatch(lo, hi, types, f"ts_ms LONG, seq LONG, side STRING, {payload}"),
        outputStructType=f"tx_id {_type(u, 'tx_id')}, pay_ms LONG, receipt_ms LONG, tag STRING, {payload}",
        outputMode="Append", timeMode="EventTime")
    return _timed(_from_micros(got, stamps), "pay_ms", "receipt_ms")
