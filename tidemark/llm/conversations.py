"""Conversation structure repair by lightest derivations (operator 13).

A conversation's rows go by turn (nulls first), ties by role and text.  Each has at most one fault, the
first of: blank (no character but white space), duplicate (role and text seen earlier), truncated (last
character that is not white space is none of ``.!?``).  Edits make the initials of the roles
``(s?(ua)+)?``: Keep a row (0), Rerole it to user or assistant (1), Delete it (2; blank and duplicate rows
must go), Insert an empty user or assistant row (5); a truncated row that stays adds 5.  The cheapest
edits win, ties by their initials in ASCII order.

Method: the states of that language and the rows are the items (row, state) of a weighted hypergraph, each
edit a deduction that puts one edit before what follows.  Knuth's agenda pops items by (cost, rows covered,
audit).  A deduction adds rows or cost, so its weight is above its antecedents', and it keeps the
order of two weights: the first time an item is popped it is final, and the search ends with the goal.

Scale: rows are range-partitioned by (conversation, turn, role, text), so a conversation may span many
partitions.  One that lies whole inside a partition, with at most ``SEGMENT`` rows, is solved there.  Else
each stretch of at most ``SEGMENT`` rows becomes the items [state before -> state after]; the same
agenda joins those over a partition, then over the conversation (one small row per partition).
Two derivations of one stretch with equal cost are never prefixes of each other (they delete, keep or
rerole the same rows and differ by whole inserts, which cost), so the order holds on both sides of a join.
The chosen states go back to the stretches.  Equal rows are counted before any shuffle of theirs ends, and a
text that recurs in a conversation is found by partial minima, so no group of copies meets in a task.  The
one thing that takes a conversation in one sequence is the sha256 of its repaired text: it is streamed,
a stretch at a time.

Defined cases: null role or text is one space; a null conv_id is a conversation of its own; a null turn
is no turn for ``gaps``; an empty role has no initial, so its row cannot be kept as it is; repeated rows are
duplicates; an empty table gives an empty result.  Texts are whole, of any length.  Other input columns, also
such as are called like those of the result, are left aside.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lookup, scratch

# Rows solved at once, and characters of text held with them.
SEGMENT = 256
SEGMENT_CHARS = 4_000_000
# Range bounds look at so many characters of the text; rows sort by all of it.
BOUND_CHARS = 32

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
# States: nothing yet, after s, after u, after a.  A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# initial -> (state before, state after)
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
# state after -> states before, by user or assistant
BY_ROLE = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
MOST = 2**63 - 1


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage planted by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 sets role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


# --- the agenda -----------------------------------------------------------------------------------

def lightest(ends, deduce, goals: set) -> dict:
    """Final (cost, audit, trace) per item, until every goal is final or no deduction is left.

    ``deduce(item)`` gives (item, cost, rows covered, audit and trace put before) for each conclusion."""
    agenda = [(0, 0, "", "", item) for item in ends]
    heapq.heapify(agenda)
    final, left = {}, set(goals)
    while agenda and left:
        cost, covered, audit, trace, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit, trace)
        left.discard(item)
        for conclusion, more, rows, edit, mark in deduce(item):
            if conclusion not in final:
                heapq.heappush(agenda, (cost + more, covered + rows, edit + audit, mark + trace, conclusion))
    return final


def _over_rows(rows):
    """Deductions over rows (role, text, must go, cut, copies): the item (i, state) covers the rows from i on."""
    def deduce(item):
        i, state = item
        for before in BY_ROLE.get(state, ()):
            yield (i, before), INSERT, 0, "I", ""
        if i == 0:
            return
        role, _, must_go, cut, copies = rows[i - 1]
        yield (i - 1, state), DELETE * copies, copies, "D" * copies, ""
        if must_go:
            return
        stays = CUT if cut else 0
        for before, after in STEPS.get(role[:1], ()):
            if after == state:
                yield (i - 1, before), KEEP + stays, 1, "K", ""
        for before in BY_ROLE.get(state, ()):
            yield (i - 1, before), REROLE + stays, 1, "R", ""
    return deduce


def _over_parts(parts):
    """Deductions over stretches, each a dict (before, after) -> (cost, audit, trace)."""
    into = [{after: [(b, v) for (b, a), v in part.items() if a == after] for after in range(4)} for part in parts]

    def deduce(item):
        i, state = item
        if i:
            for before, (cost, audit, trace) in into[i - 1][state]:
                yield (i - 1, before), cost, 1, audit, trace
    return deduce


def _whole(n: int, deduce):
    """(cost, audit, trace) of the cheapest way from the start to an end."""
    return lightest([(n, s) for s in ENDS], deduce, {(0, START)})[(0, START)]


def _stretch(n: int, deduce, marked: bool):
    """(before, after) -> (cost, audit, trace); a stretch of rows is marked by its two states."""
    out = {}
    for after in range(4):
        for (i, before), (cost, audit, trace) in lightest([(n, after)], deduce, {(0, s) for s in range(4)}).items():
            if i == 0:
                out[before, after] = (cost, audit, f"{before}{after}" if marked else trace)
    return out


def apply_edits(rows, audit: str, state: int = START):
    """The repaired (role, text) rows."""
    at, seen = 0, 0
    for edit in audit:
        if edit != "I":
            role, text, _, _, copies = rows[at]
            seen += 1
            if seen == copies:
                at, seen = at + 1, 0
            if edit == "D":
                continue
        if edit == "K":
            state = next(a for b, a in STEPS[role[:1]] if b == state)
            yield role, text
        else:
            state = ASSISTANT if state == USER else USER
            yield ("assistant" if state == ASSISTANT else "user"), (text if edit == "R" else "")


def _joined(rows) -> str:
    return "\n".join(f"{role}:{text}" for role, text in rows)


# --- one pass over the sorted rows ----------------------------------------------------------------

COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
ITEM = T.ArrayType(T.StructType([T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()),
                                 T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                                 T.StructField("trace", T.StringType())]))
ROWS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                                 T.StructField("must_go", T.BooleanType()), T.StructField("cut", T.BooleanType()),
                                 T.StructField("copies", T.LongType())]))


def _schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), T.StructField("kind", T.StringType()), T.StructField("part", T.IntegerType()),
                         T.StructField("seg", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in [*COUNTS, "lo", "hi"]],
                         T.StructField("head", T.StringType()), T.StructField("tail", T.StringType()),
                         T.StructField("items", ITEM), T.StructField("rows", ROWS), T.StructField("cost", T.LongType()),
                         T.StructField("audit", T.StringType()), T.StructField("sha", T.StringType())])


class _Run:
    """What one pass gathers of one conversation in one partition."""

    def __init__(self, conv, segment):
        self.segment_rows = segment
        self.conv, self.counts = conv, dict.fromkeys(COUNTS, 0)
        self.lo = self.hi = self.head = self.tail = None
        self.rows, self.chars, self.parts = [], 0, []

    def add(self, turn, role, text, copies, seen):
        c, first = self.counts, role[:1]
        if turn is not None and turn != self.hi:
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn
            c["turns"] += 1
        if self.head is None:
            self.head = first
        elif self.tail + first not in LEGAL:
            c["illegal"] += 1
        c["illegal"] += copies - 1
        self.tail = first
        said = text.strip(SPACE)
        if not said:
            c["blank"] += copies
            self.rows.append((role, text, True, False, copies))
        else:
            cut = said[-1] not in ".!?"
            c["duplicate"] += copies - 1 + seen
            c["truncated"] += cut and not seen
            self.rows.append((role, text, bool(seen), cut, 1))
            if copies > 1:
                self.rows.append((role, "", True, False, copies - 1))
        self.chars += len(text)

    def full(self):
        return len(self.rows) >= self.segment_rows or self.chars >= SEGMENT_CHARS

    def base(self, kind, part, seg=None):
        return {"conv_id": self.conv, "kind": kind, "part": part, "seg": seg}

    def stats(self):
        return {**self.counts, "lo": self.lo, "hi": self.hi, "head": self.head, "tail": self.tail}

    def solved(self, part, texts):
        cost, audit, _ = _whole(len(self.rows), _over_rows(self.rows))
        done = list(apply_edits(self.rows, audit))
        sha = hashlib.sha256(_joined(done).encode()).hexdigest()
        return {**self.base("whole", part, 0), **self.stats(), "cost": cost, "audit": audit, "sha": sha,
                "rows": [{"role": role, "text": text} for role, text in done] if texts else None}

    def segment(self, part):
        items = _stretch(len(self.rows), _over_rows(self.rows), True)
        out = {**self.base("seg", part, len(self.parts)), "items": _listed(items),
               "rows": [dict(zip(("role", "text", "must_go", "cut", "copies"), r)) for r in self.rows]}
        self.parts.append(items)
        self.rows, self.chars = [], 0
        return out

    def closed(self, part):
        return {**self.base("sum", part), **self.stats(), "items": _listed(_stretch(len(self.parts), _over_parts(self.parts), False))}


def _listed(items):
    return [{"before": b, "after": a, "cost": c, "audit": s, "trace": t} for (b, a), (c, s, t) in items.items()]


def _same(a, b):
    return a == b or (a != a and b != b)


def _batches(records, schema: pa.Schema, size: int = 200):
    rows = []
    for r in records:
        rows.append(r)
        if len(rows) >= (size if r.get("kind") == "whole" else 8):
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _scan(schema: T.StructType, texts: bool, segment: int):
    def records(batches):
        from pyspark import TaskContext

        part, run, first = TaskContext.get().partitionId(), None, True
        for b in batches:
            for conv, turn, role, text, copies, seen in zip(*(b.column(c).to_pylist() for c in ("c", "t", "r", "x", "k", "seen"))):
                if run is not None and not _same(run.conv, conv):
                    # Begun after the partition's first conversation and ended before its last: whole.
                    if first or run.parts:
                        if run.rows:
                            yield run.segment(part)
                        yield run.closed(part)
                    else:
                        yield run.solved(part, texts)
                    run, first = None, False
                if run is None:
                    run = _Run(conv, segment)
                elif run.full():
                    yield run.segment(part)
                run.add(turn, role, text, copies, seen)
        if run is not None:
            if run.rows:
                yield run.segment(part)
            yield run.closed(part)

    def run_all(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        yield from _batches(records(batches), to_arrow_schema(schema))

    return run_all


def _items(listed):
    return {(d["before"], d["after"]): (d["cost"], d["audit"], d["trace"]) for d in listed}


def _merge(schema: T.StructType):
    """One conversation from its rows per partition."""
    def merge(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        sums = sorted(table.to_pylist(), key=lambda d: d["part"])
        out = {c: sum(d[c] for d in sums) for c in COUNTS}
        hi, tail = None, None
        for d in sums:
            if tail is not None and tail + d["head"] not in LEGAL:
                out["illegal"] += 1
            out["turns"] -= hi is not None and d["lo"] == hi
            tail, hi = d["tail"], d["hi"] if d["hi"] is not None else hi
        cost, audit, trace = _whole(len(sums), _over_parts([_items(d["items"]) for d in sums]))
        lows = [d["lo"] for d in sums if d["lo"] is not None]
        out |= {"conv_id": sums[0]["conv_id"], "lo": min(lows, default=None), "hi": hi, "cost": cost, "audit": audit,
                "parts": [d["part"] for d in sums], "trace": trace}
        return pa.Table.from_pylist([out], schema=to_arrow_schema(schema))

    return merge


def _pieces(batches):
    """The repaired rows of each stretch, joined, for its chosen states."""
    for b in batches:
        texts, counts, kept = [], [], []
        for items, rows, before, after in zip(*(b.column(c).to_pylist() for c in ("items", "rows", "before", "after"))):
            rows = [tuple(r[c] for c in ("role", "text", "must_go", "cut", "copies")) for r in rows]
            done = list(apply_edits(rows, _items(items)[before, after][1], before))
            texts.append(_joined(done))
            counts.append(len(done))
            kept.append([{"role": role, "text": text} for role, text in done])
        pair = pa.struct([("role", pa.string()), ("text", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("part"), b.column("seg"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
             pa.array(kept, pa.list_(pair))], names=["conv_id", "part", "seg", "text", "n", "kept"])


def _hashed(schema: T.StructType):
    """sha256 of the pieces of each conversation in order, streamed."""
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        conv, sha, begun = None, None, False
        for b in batches:
            out = []
            for c, text, n in zip(*(b.column(x).to_pylist() for x in ("conv_id", "text", "n"))):
                if sha is None or not _same(c, conv):
                    if sha is not None:
                        out.append({"conv_id": conv, "sha": sha.hexdigest()})
                    conv, sha, begun = c, hashlib.sha256(), False
                if n:
                    sha.update(("\n" if begun else "").encode() + text.encode())
                    begun = True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "sha": sha.hexdigest()}], schema=arrow)

    return run


# --- the job --------------------------------------------------------------------------------------

def _ordered(rows: DataFrame) -> DataFrame:
    """Equal rows counted, later sightings of a text marked, sorted by conversation across partitions."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    turns = rows.select(F.col("conv_id").alias("c"), F.col("turn").cast("long").alias("t"), F.coalesce("role", F.lit(" ")).alias("r"),
                        F.coalesce("text", F.lit(" ")).alias("x"), copies.cast("long").alias("k"))
    turns = turns.groupBy("c", "t", "r", "x").agg(F.sum("k").alias("k")).withColumn("m", F.unhex(F.md5(F.col("x").cast("binary"))))
    turns = scratch(turns, "conv-turns")
    again = (turns.groupBy("c", "r", "m").agg(F.min(F.struct(F.col("t").isNotNull().alias("a"), F.col("t").alias("t"))).alias("first"),
                                              F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    marked = lookup(turns, scratch(again, "conv-again"), ["c", "r", "m"], F.col("t"))
    seen = F.col("first").isNotNull() & ~F.col("first.t").eqNullSafe(F.col("t"))
    marked = marked.select("c", "t", "r", "x", "k", seen.alias("seen"))
    return (marked.repartitionByRange("c", "t", "r", F.substring("x", 1, BOUND_CHARS))
            .sortWithinPartitions("c", "t", "r", "x"))


KEPT = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def _solve(rows: DataFrame, texts: bool, segment: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of one pass; conversations merged from partitions; the repaired rows of their stretches."""
    schema = _schema(rows.schema["conv_id"].dataType)
    out = scratch(_ordered(rows).mapInArrow(_scan(schema, texts, segment), schema), "conv-scan")
    merged_schema = T.StructType([schema["conv_id"], *[schema[c] for c in [*COUNTS, "lo", "hi", "cost", "audit"]],
                                  T.StructField("parts", T.ArrayType(T.IntegerType())), T.StructField("trace", T.StringType())])
    sums = out.where("kind = 'sum'").select("conv_id", "part", *COUNTS, "lo", "hi", "head", "tail", "items")
    merged = scratch(sums.groupBy("conv_id").applyInArrow(_merge(merged_schema), merged_schema), "conv-merged")
    segs = out.where("kind = 'seg'").select("conv_id", "part", "seg", "items", "rows")
    # Stretches count from 0 in each partition; the trace holds two states for each in order.
    sizes = segs.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("segs"))
    starts = (merged.select(F.col("conv_id").alias("_c"), F.posexplode("parts").alias("_at", "_part"), "trace")
              .join(sizes, F.col("_c").eqNullSafe(F.col("conv_id")) & (F.col("_part") == F.col("part"))))
    before = Window.partitionBy("_c").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_c", "_part", F.substr("trace", 2 * F.coalesce(F.sum("segs").over(before), F.lit(0)) + 1, 2 * F.col("segs")).alias("states"))
    pairs = segs.join(starts, F.col("_c").eqNullSafe(F.col("conv_id")) & (F.col("_part") == F.col("part")))

    def state(k: int) -> Column:
        return F.substr("states", 2 * F.col("seg") + k, F.lit(1)).cast("int")

    pairs = pairs.select("conv_id", "part", "seg", "items", "rows", state(1).alias("before"), state(2).alias("after"))
    pieces = pairs.mapInArrow(_pieces, T.StructType([schema[c] for c in ("conv_id", "part", "seg")] + [
        T.StructField("text", T.StringType()), T.StructField("n", T.LongType()), T.StructField("kept", KEPT)]))
    return out, merged, pieces


def repaired_rows(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The repaired rows (conv_id, part, seg, at, role, text); a conversation's rows go by (part, seg, at)."""
    out, _, pieces = _solve(rows, True, segment)
    whole = out.where("kind = 'whole'").select("conv_id", "part", "seg", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).cast(KEPT).alias("kept"))
    every = whole.unionByName(pieces.select("conv_id", "part", "seg", "kept"))
    return every.select("conv_id", "part", "seg", F.posexplode("kept").alias("at", "row")).select("conv_id", "part", "seg", "at", "row.role", "row.text")


def repair(rows: DataFrame, every: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: gaps in its turns, faults, cost, audit and hash of the repaired rows.

    ``rows`` has conv_id, turn, role, text and maybe ``copies`` (how often a row stands there);
    ``every`` (conv_id) adds the conversations that have no rows; ``segment`` rows are solved at once."""
    out, merged, pieces = _solve(rows, False, segment)
    conv = rows.schema["conv_id"]
    hash_schema = T.StructType([T.StructField("conv_id", conv.dataType), T.StructField("sha", T.StringType())])
    hashed = (pieces.drop("kept").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
              .mapInArrow(_hashed(hash_schema), hash_schema).withColumnRenamed("conv_id", "_c"))
    long_ones = merged.join(hashed, F.col("_c").eqNullSafe(F.col("conv_id")))
    columns = ["conv_id", *COUNTS, "lo", "hi", "cost", "audit", "sha"]
    solved = out.where("kind = 'whole'").select(*columns).unionByName(long_ones.select(*columns))
    if every is None:
        done = solved.withColumn("_id", F.col("conv_id"))
    else:
        ids = every.select(F.col("conv_id").alias("_id")).distinct()
        done = ids.join(solved, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    span = F.col("hi").cast("decimal(20,0)") - F.col("lo").cast("decimal(20,0)") + 1 - F.col("turns")
    gaps = F.least(F.coalesce(span, F.lit(0)), F.lit(MOST).cast("decimal(20,0)")).cast("long")

    def number(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)

    return done.select(F.col("_id").alias("conv_id"), gaps.alias("gaps"), *[number(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# Shared text: crc32 of short ASCII strings, bit by bit.  {source} gives the column s.
CRC_SQL = """crc AS (
  SELECT s, 0 AS k, 4294967295::BIGINT AS c FROM ({source})
  UNION ALL
  SELECT s, k + 1, xor(x >> 1, (x & 1) * 3988292384)
  FROM (SELECT s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE k < 8 * len(s))),
crc32_of AS (SELECT s, xor(c, 4294967295) AS c FROM crc WHERE k = 8 * len(s))"""

_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
ORACLE = f"""
WITH RECURSIVE {CRC_SQL.format(source=f"SELECT DISTINCT {_KEY} AS s FROM conversations")},
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, c % 20 AS kind
        FROM conversations JOIN crc32_of ON s = {_KEY})
  WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (
  SELECT *, blank OR again AS must_go, NOT blank AND again AS duplicate, NOT blank AND NOT again AND NOT ends AS cut
  FROM (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') AS ends,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM n)),
stats AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
         count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
put(a, b, k) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (3, 2, 1), (2, 3, 1), (0, 3, 2), (1, 3, 2)),
move(kind, initial, a, b, c) AS (VALUES ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
  ('R', '', 0, 2, 1), ('R', '', 1, 2, 1), ('R', '', 3, 2, 1), ('R', '', 2, 3, 1), ('D', '', 0, 0, 2), ('D', '', 1, 1, 2), ('D', '', 2, 2, 2), ('D', '', 3, 3, 2)),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS w FROM stats
  UNION ALL
  SELECT best.conv_id, best.i + 1, move.b, min({{'cost': w.cost + 5 * put.k + move.c + CASE WHEN f.cut AND move.kind <> 'D' THEN 5 ELSE 0 END,
                                                'audit': w.audit || repeat('I', put.k) || move.kind}})
  FROM best JOIN put ON put.a = best.state JOIN move ON move.a = put.b
  JOIN f ON f.conv_id IS NOT DISTINCT FROM best.conv_id AND f.i = best.i + 1
  WHERE move.kind = 'D' OR (NOT f.must_go AND (move.kind = 'R' OR move.initial = left(f.role, 1)))
  GROUP BY best.conv_id, best.i, move.b),
done AS (
  SELECT best.conv_id, min({{'cost': w.cost + 5 * put.k, 'audit': w.audit || repeat('I', put.k)}}) AS w
  FROM best JOIN stats ON stats.conv_id IS NOT DISTINCT FROM best.conv_id AND best.i = stats.rows
  JOIN put ON put.a = best.state WHERE put.b IN (0, 3) GROUP BY best.conv_id),
walk AS (
  SELECT conv_id, w.audit AS audit, 0 AS pos, 0::BIGINT AS i, 0 AS state, []::VARCHAR[] AS lines FROM done
  UNION ALL
  SELECT conv_id, audit, pos + 1, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
         CASE WHEN e = 'D' THEN state WHEN e = 'K' THEN CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END WHEN state = 2 THEN 3 ELSE 2 END,
         CASE WHEN e = 'D' THEN lines ELSE list_append(lines, CASE WHEN e = 'K' THEN role WHEN state = 2 THEN 'assistant' ELSE 'user' END
                                                              || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END
  FROM (SELECT walk.*, audit[pos + 1] AS e, f.role, f.text FROM walk LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.i = walk.i + 1
        WHERE pos < len(audit)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(done.w.cost, 0) AS cost, coalesce(done.w.audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM c.conv_id AND walk.pos = len(walk.audit)
"""
