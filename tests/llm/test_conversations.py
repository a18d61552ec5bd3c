"""Conversation repair: the agenda against all edits, whole jobs against a plain forward search."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
OK = re.compile(r"(s?(ua)+)?\Z")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def entry(role, text="t.", must_go=False, cut=False, copies=1):
    return (role, text, must_go, cut, copies)


def all_edits(rows):
    """Cheapest (cost, audit) over every edit string with up to two inserts in each gap."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and r[2] for e, r in zip(edits, rows)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            slots, cost, audit = [], 0, ""
            for i, r in enumerate([*rows, None]):
                slots += ["ua"] * gaps[i]
                audit += "I" * gaps[i]
                cost += 5 * gaps[i]
                if r is None:
                    break
                e = edits[i]
                audit += e
                cost += {"K": 0, "R": 1, "D": 2}[e] + (5 if r[3] and e != "D" else 0)
                if e != "D":
                    slots.append(r[0][:1] or "?" if e == "K" else "ua")
            if any(OK.match("".join(c)) for c in itertools.product(*slots)):
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_agenda_finds_the_cheapest_of_all_edits():
    rng = random.Random(3)
    for _ in range(60):
        rows = [entry(rng.choice(["system", "user", "assistant", "tool", ""]), must_go=rng.random() < 0.2, cut=rng.random() < 0.3)
                for _ in range(rng.randint(0, 4))]
        cost, audit, _ = C._whole(len(rows), C._over_rows(rows))
        assert (cost, audit) == all_edits(rows), rows


@pytest.mark.parametrize("cut", [1, 2, 3, 5])
def test_stretches_joined_equal_the_whole(cut):
    rng = random.Random(cut)
    for _ in range(40):
        rows = [entry(rng.choice(["system", "user", "assistant", "tool"]), must_go=rng.random() < 0.2, cut=rng.random() < 0.3)
                for _ in range(rng.randint(1, 14))]
        parts = [rows[i:i + cut] for i in range(0, len(rows), cut)]
        items = [C._stretch(len(p), C._over_rows(p), True) for p in parts]
        cost, audit, trace = C._whole(len(items), C._over_parts(items))
        assert (cost, audit) == C._whole(len(rows), C._over_rows(rows))[:2]
        states = [(int(trace[2 * i]), int(trace[2 * i + 1])) for i in range(len(parts))]
        pieces = [list(C.apply_edits(p, it[s][1], s[0])) for p, it, s in zip(parts, items, states)]
        assert sum(pieces, []) == list(C.apply_edits(rows, audit))


# --- a plain version of the whole contract ---------------------------------------------------------

def damaged(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def forward(rows):
    """(cost, audit) by a forward search over (state) with all insert counts."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def grown(front):
        for _ in range(3):
            for st, (c, a) in list(front.items()):
                for ch in "ua":
                    to = step.get((st, ch))
                    if to is not None and (c + 5, a + "I") < front.get(to, (10**9, "")):
                        front[to] = (c + 5, a + "I")
        return front

    front = grown({"": (0, "")})
    for role, must_go, cut in rows:
        new = {}
        for st, (c, a) in front.items():
            options = [(st, c + 2, a + "D")]
            if not must_go:
                extra = 5 if cut else 0
                options += [(step[st, role[:1]], c + extra, a + "K")] if (st, role[:1]) in step else []
                options += [(step[st, ch], c + 1 + extra, a + "R") for ch in "ua" if (st, ch) in step]
            for to, cc, aa in options:
                new[to] = min(new.get(to, (10**9, "")), (cc, aa))
        front = grown(new)
    return min(front[s] for s in ("", "a") if s in front)


def brute(rows, all_ids):
    by = {c: [] for c in all_ids}
    for r in rows:
        by[r[0]].append(r)
    out = []
    for c, rs in by.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in rs if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, marked, n = set(), [], [0, 0, 0]
        for _, _, role, text in rs:
            said = text.strip(SPACE)
            again, cut = (role, text) in seen, bool(said) and said[-1] not in ".!?"
            seen.add((role, text))
            fault = 0 if not said else 1 if again else 2 if cut else None
            if fault is not None:
                n[fault] += 1
            marked.append((role, fault in (0, 1), fault == 2))
        illegal = sum(a[2][:1] + b[2][:1] not in {"su", "ua", "au"} for a, b in zip(rs, rs[1:]))
        cost, audit = forward(marked) if rs else (0, "")
        done = C.apply_edits([entry(r[2], r[3]) for r in rs], audit)
        text = "\n".join(f"{a}:{b}" for a, b in done)
        out.append((c, gaps, *n, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, rows, segment=256):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted([tuple(r[c] for c in COLS) for r in C.repair(C.damage(df), every=df, segment=segment).collect()], key=str)


def expected(rows):
    return brute(damaged(rows), {r[0] for r in rows})


def made(n_convs, seed, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(n_convs):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]) if rng.random() < 0.4 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, rng.choice([f"text {t}.", f"text {t}", "same!", " \n", "cut off,", "Ünïcode? "])))
    return rows


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_whole_job(spark):
    rows = made(80, 1)
    assert run(spark, rows) == expected(rows)


def test_conversations_cut_into_stretches_and_partitions(spark, many_partitions):
    rng = random.Random(9)
    rows = made(20, 2) + [(99, t, rng.choice(["user", "assistant"]), f"turn {t % 40}" + rng.choice([".", ""])) for t in range(400)]
    want = expected(rows)
    assert run(spark, rows, segment=7) == want
    assert run(spark, rows, segment=256) == want


def test_nulls_ties_repeats_and_odd_roles(spark, many_partitions):
    rows = [(None, None, None, None), (None, 1, "user", "hi."), (None, 2, "assistant", "a."), (5, None, "user", "q."), (5, None, "user", "q."),
            (5, 1, "assistant", None), (5, 1, "assistant", "yes."), (5, 1, "", "none."), (5, 9, "system", "s."), (5, -4, "user", "early!"),
            (6, 3, "user", ""), (7, 2**62, "user", "far."), (7, -(2**62), "assistant", "off")]
    rows += [(8, 3, "user", "copy.")] * 50 + [(8, 4, "user", "x" * 200_000 + ".")] + [(9, i, "user", "same text.") for i in range(60)]
    assert run(spark, rows, segment=5) == expected(rows)


def test_conversation_that_loses_all_rows_and_empty_table(spark):
    ids = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:2]
    rows = [(i, 0, "user", "gone.") for i in ids]
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, rows) == sorted([(i, 0, 0, 0, 0, 0, 0, "", empty) for i in ids], key=str)
    assert run(spark, []) == []


def test_extra_and_clashing_columns(spark):
    rows = made(5, 4)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS cost", "1 AS c", "2 AS _c", "3 AS part", "4 AS _salt")
    got = sorted([tuple(r[c] for c in COLS) for r in C.repair(C.damage(df), every=df).collect()], key=str)
    assert got == expected(rows)


def test_repaired_rows_are_the_hashed_ones(spark, many_partitions):
    rows = made(15, 6) + [(77, t, ("user", "assistant")[t % 2], f"t {t}.") for t in range(90)]
    df = C.damage(spark.createDataFrame(rows, SCHEMA))
    sha = {r["conv_id"]: r["repaired_sha256"] for r in C.repair(df, segment=6).collect()}
    got = {}
    for r in sorted(C.repaired_rows(df, segment=6).collect(), key=lambda r: (r["part"], r["seg"], r["at"])):
        got.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, want in sha.items():
        assert hashlib.sha256("\n".join(got.get(conv, [])).encode()).hexdigest() == want
