"""Benchmark decontamination by one Aho-Corasick automaton (operator 3).

Texts are normalised to their words (lower-case A-Z; ASCII other than letters and digits
separates).  Every window of ``width`` consecutive item words is a pattern `` w1 ... w10 `` with
its outer blanks; an item of fewer words is one window.  The automaton over all patterns reads
each normalised text once; matches are mapped to word numbers and, for the spans, to code-point
offsets of the original text.

The patterns go to the executors as a broadcast whose size is checked first: benchmarks of more
than ``PART_BYTES`` of patterns are split by item into parts, and the texts pass one automaton
after the other (each part is bounded, nothing is left out).

Defined cases: a null text, document or item, has no words; an item without words has no window;
rows of one item_id count as one item, a null item_id as the item ``""``; repeated documents are
reported each; empty tables give no rows or no hits; the added columns replace input columns of
the same name.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import resolve

WIDTH = 10
PART_BYTES = 4_000_000     # pattern text per automaton: some hundred MB of nodes in a worker
RESULT = ["n_words", "n_hit", "items", "spans"]
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_AUTOMATA: dict = {}       # one automaton per worker process


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_KEEP).split()


def patterns(items: Iterable[tuple[str, str | None]], width: int = WIDTH) -> dict[bytes, list[str]]:
    """{window: ids of the items that have it}."""
    out: dict[bytes, set] = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            out[b" ".join(w[i:i + width])].add(item)
    return {k: sorted(v) for k, v in out.items()}


def _automaton(key: str, found: dict[bytes, list[str]]):
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for p, ids in found.items():
            # bytes as Latin-1 text: one character per byte, equal where the bytes are equal
            a.add_word(f" {p.decode('latin-1')} ", (p.count(b" ") + 1, ids))
        if found:
            a.make_automaton()
        _AUTOMATA[key] = a if found else None
    return _AUTOMATA[key]


def _runs(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals [first, end) merged where they touch or overlap."""
    out: list[list[int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def scan_text(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, hit word intervals, items found) of one whole text."""
    w = words(text)
    if not w or automaton is None:
        return len(w), [], set()
    line = b" " + b" ".join(w) + b" "
    found = list(automaton.iter(line.decode("latin-1")))
    if not found:
        return len(w), [], set()
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(blanks, [end for end, _ in found])       # one past the window's last word
    hits = {(int(e) - n, int(e)) for e, (_, (n, _)) in zip(last, found)}
    return len(w), _runs(list(hits)), {i for _, (_, ids) in found for i in ids}


def _spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Hit word intervals as code-point spans of the original text."""
    at = [m.span() for m in _WORD.finditer(text)] if runs else []
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs]


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text",
         drop_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words, n_hit`` (long), ``items`` (sorted item ids as text) and ``spans``
    (start, end code points of the maximal runs of hit words)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t"))
    n_bytes = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_parts = max(1, -(-n_bytes * (width + 1) // PART_BYTES))
    docs, text = docs.drop(*RESULT), resolve(docs, text)
    names = docs.columns
    for part in range(n_parts):
        mine = items.where(F.pmod(F.xxhash64("i"), F.lit(n_parts)) == part).collect()
        found = spark.sparkContext.broadcast(patterns(((r["i"], r["t"]) for r in mine), width))
        docs = _scan_part(docs, names, found, text, part, n_parts, drop_text)
    return docs


def _scan_part(docs: DataFrame, names: list[str], found, text: str, part: int, n_parts: int, drop_text: bool) -> DataFrame:
    first, last = part == 0, part == n_parts - 1
    kept = [n for n in names if not (last and drop_text and n == text)]
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    key = uuid.uuid4().hex                       # names this part's automaton in a worker

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, found.value)
        for b in batches:
            out = {"n_words": [], "n_hit": [], "items": [], "spans": []}
            column = b.column(b.schema.get_field_index(text))
            before = [] if first else list(zip(b.column(b.schema.get_field_index("items")).to_pylist(),
                                               b.column(b.schema.get_field_index("spans")).to_pylist()))
            for k, t in enumerate(column):
                t = t.as_py()
                n, runs, ids = scan_text(automaton, t)
                if not first:
                    ids |= set(before[k][0])
                    runs = _runs(runs + [(s["start"], s["end"]) for s in before[k][1]])
                out["n_words"].append(n)
                out["n_hit"].append(sum(e - a for a, e in runs))
                out["items"].append(sorted(ids))
                # between parts the spans are word numbers
                out["spans"].append(_spans(t, runs) if last else [{"start": a, "end": e} for a, e in runs])
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(n)) for n in kept]
                + [pa.array(out["n_words"], pa.int64()), pa.array(out["n_hit"], pa.int64()),
                   pa.array(out["items"], pa.list_(pa.string())), pa.array(out["spans"], spans)],
                names=[*kept, *RESULT])

    types = dict(docs.dtypes)
    schema = ", ".join([f"`{n}` {types[n]}" for n in kept]
                       + ["n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"])
    return docs.mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents in which any window occurs; columns and rows else as they are."""
    names = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{[n.lower() for n in names].index('text')}"
    return scan(renamed, benchmark, width, text=text).where("n_hit = 0").drop(*RESULT).toDF(*names)


def items_digest(items) -> object:
    """Column: sha-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", items), 256)


def digest(ids: Iterable[str]) -> str:
    """The same for a plain list."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
starts AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM starts),
lens AS (SELECT DISTINCT n FROM win),
wins AS (SELECT rid, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT wins.rid, wins.i, wins.n, win.item FROM wins JOIN win ON wins.n = win.n AND array_to_string(wins.w[wins.i:wins.i + wins.n - 1], ' ') = win.key),
pos AS (SELECT DISTINCT rid, unnest(range(i, CAST(i + n AS BIGINT))) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)),
nh AS (SELECT rid, count(*) AS n_hit FROM pos GROUP BY rid),
ni AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS s FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(nh.n_hit, 0) AS n_hit, coalesce(ni.n_items, 0) AS n_items,
       sha256(coalesce(ni.s, '')) AS items_sha256, coalesce(nh.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (rid) LEFT JOIN ni USING (rid)
"""
