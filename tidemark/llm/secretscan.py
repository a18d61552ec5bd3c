"""Secret scans: base patterns and a linear-chain conditional random field (operator 2).

Base kinds (``assign``, ``access``, ``hex``) are patterns over the whole text.  The field tags
tokens (runs of word characters, runs of punctuation) as secret begin, inside or outside from
their shape, the kind of the neighbouring tokens (three before, one after) and file features; the
best tagging is found by Viterbi and its spans that touch no base span are added as kind ``crf``.

Training: a bounded sample of documents (``sample_docs``, the smallest hashes of id and text) labelled
by the base patterns, with made-up credentials and harmless look-alikes written in at seeded
places; the conditional likelihood is climbed by forward-backward gradients on the driver.

Decoding is exact and cheap: a token whose outside score leads by more than any pair of
transitions can make up is outside on every best path, so only the runs between such tokens are
decoded (the lead is bounded by shape, and by whether a neighbour is of a telling kind).  All transitions are finite, which makes the bound hold.

Defined cases: null text is empty and has no spans; offsets are code points, end exclusive;
repeated rows are scanned each; an empty table trains on the made-up texts only and gives no rows;
a column named ``spans`` in the input is replaced.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, resolve

KINDS = ("assign", "access", "hex", "crf")
SAMPLE_DOCS = 100
# The three base patterns of the contract.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")                    # a maximal run, as [0-9a-f]+ of 24 and more
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HINTS = (*_NAMES, b"bearer", b"credential", b"private", b"access_key", b"auth")

O, B, I = 0, 1, 2
_BLANK, _WORDCH, _PUNCT = 0, 1, 2
_CLASS = np.array([_BLANK if c <= 0x20 or c == 0x7F else _WORDCH if c >= 0x80 or chr(c) in string.ascii_letters + string.digits + "+/_-"
                   else _PUNCT for c in range(256)], np.uint8)
_DIGIT = np.array([chr(c) in string.digits for c in range(256)], np.uint8)
_LOWER = np.array([chr(c) in string.ascii_lowercase for c in range(256)], np.uint8)
_UPPER = np.array([chr(c) in string.ascii_uppercase for c in range(256)], np.uint8)
_EQUALS = np.array([chr(c) in "=:" for c in range(256)], np.uint8)
_QUOTE = np.array([chr(c) in "\"'`" for c in range(256)], np.uint8)
N_SHAPES, N_CATS, N_FILE = 28, 8, 4
EDGE, PLAIN, HINT, ASSIGN, QUOTE, MARK, NUMBER, CODE = range(N_CATS)
_SPECIAL = np.array([HINT, ASSIGN, QUOTE, CODE])       # categories that raise a neighbour's odds
SLOTS = (N_SHAPES, N_CATS, N_CATS, N_CATS, N_CATS, N_FILE)
CHUNK = 2_000_000


# ---- base patterns -------------------------------------------------------------------------

def base_spans(data: bytes, long_token: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes; ``long_token`` False promises no run of 20 word bytes."""
    out = []
    low = data.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 6]
    if long_token:
        if b"AKIA" in data:
            out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(data)]
    return sorted(out)


# ---- tokens and features -------------------------------------------------------------------

class Tokens:
    """Tokens of several texts laid end to end, with shape, category and document of each."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        self.offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        a = np.frombuffer(self.data, np.uint8)
        cls = _CLASS[a]
        cut = np.flatnonzero(cls[1:] != cls[:-1]) + 1
        lo = np.concatenate(([0], cut))
        hi = np.concatenate((cut, [len(a)]))
        kind = cls[lo]
        real = kind != _BLANK
        self.lo, self.hi, kind = lo[real], hi[real], kind[real]
        self.doc = np.searchsorted(self.offsets, self.lo, side="right") - 1

        def count(table):
            c = np.concatenate(([0], np.cumsum(table[a], dtype=np.int32)))
            return c[self.hi] - c[self.lo]

        n, digits, lower, upper = self.hi - self.lo, count(_DIGIT), count(_LOWER), count(_UPPER)
        length = np.searchsorted([6, 12, 20, 32], n, side="right")
        letters = (lower > 0) | (upper > 0)
        mix = np.where(digits == 0, ((upper > 1) & (lower > 0)).astype(int),
                       np.where(~letters, 2, np.where((lower > 0) & (upper > 0), 4, 3)))
        word = kind == _WORDCH
        equals, quote = _EQUALS[a[self.lo]] > 0, _QUOTE[a[self.lo]] > 0
        self.shape = np.where(word, length * 5 + mix, np.where(equals, 25, np.where(quote, 26, 27))).astype(np.int8)
        cat = np.where(word, np.where(mix <= 1, PLAIN, np.where(mix == 2, NUMBER, CODE)),
                       np.where(equals, ASSIGN, np.where(quote, QUOTE, MARK))).astype(np.int8)
        low = self.data.lower()
        hinted = np.zeros(len(texts) + 1, bool)
        for h in _HINTS:
            at = low.find(h)
            while at >= 0:
                t = np.searchsorted(self.lo, at, side="right") - 1
                cat[t] = HINT
                hinted[self.doc[t]] = True
                at = low.find(h, at + len(h))
        self.cat = cat
        size = np.diff(self.offsets)
        in_doc = np.bincount(self.doc, weights=digits, minlength=len(texts))[:len(texts)]
        self.file = hinted[:len(texts)] * 2 + (in_doc > 0.02 * size)

    def features(self, at: np.ndarray) -> list[np.ndarray]:
        """One category per slot for the tokens ``at``."""
        def near(step):
            j = np.clip(at + step, 0, len(self.cat) - 1)
            same = (at + step >= 0) & (at + step < len(self.cat)) & (self.doc[j] == self.doc[at])
            return np.where(same, self.cat[j], EDGE)

        return [self.shape[at], near(-1), near(-2), near(-3), near(1), self.file[self.doc[at]].astype(np.int8)]


# ---- the field -----------------------------------------------------------------------------

class Field:
    """Weights per slot, category and label, and transition weights between labels."""

    def __init__(self, weights: list[np.ndarray], moves: np.ndarray):
        self.weights, self.moves = weights, moves
        gain = max(moves[a, x] + moves[x, b] - moves[a, O] - moves[O, b]
                   for a in range(3) for b in range(3) for x in (B, I))
        # at the start or end of a text one of the two transitions is missing
        gain = max(gain, *(moves[a, x] - moves[a, O] for a in range(3) for x in (B, I)),
                   *(moves[x, b] - moves[O, b] for b in range(3) for x in (B, I)), 0.0)
        lead = [w[:, O] - w[:, 1:].max(axis=1) for w in weights]
        # outside by shape alone: in any context, and among ordinary neighbours only
        usual = np.setdiff1d(np.arange(N_CATS), _SPECIAL)
        self.sure = lead[0] + sum(x.min() for x in lead[1:]) > gain + 1e-6
        self.sure_usual = lead[0] + sum(x[usual].min() for x in lead[1:5]) + lead[5].min() > gain + 1e-6

    def open_tokens(self, tokens: Tokens) -> np.ndarray:
        """Tokens that may be other than outside; all others are outside on every best path."""
        special = np.isin(tokens.cat, _SPECIAL)
        near = np.zeros(len(special), bool)
        for step in (1, 2, 3):
            near[step:] |= special[:-step]
        near[:-1] |= special[1:]
        return np.flatnonzero(~np.where(near, self.sure[tokens.shape], self.sure_usual[tokens.shape]))

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return sum(w[f] for w, f in zip(self.weights, features))

    def viterbi(self, scores: np.ndarray, before: bool, after: bool) -> list[int]:
        """Best labels of a run; ``before`` / ``after``: an outside token stands next to it."""
        m = self.moves.tolist()
        rows = scores.tolist()
        best = [rows[0][y] + (m[O][y] if before else 0.0) for y in range(3)]
        back = []
        for row in rows[1:]:
            frm = [max(range(3), key=lambda x: best[x] + m[x][y]) for y in range(3)]
            best = [best[x] + m[x][y] + row[y] for y, x in enumerate(frm)]
            back.append(frm)
        if after:
            best = [best[y] + m[y][O] for y in range(3)]
        y = max(range(3), key=lambda x: best[x])
        path = [y]
        for frm in reversed(back):
            y = frm[y]
            path.append(y)
        return path[::-1]

    def tag(self, tokens: Tokens) -> list[tuple[int, int, int]]:
        """(document number, start, end) of tagged spans, in bytes of the document."""
        open_ = self.open_tokens(tokens)
        if not len(open_):
            return []
        scores = self.scores(tokens.features(open_))
        doc = tokens.doc[open_]
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(open_) != 1) | (np.diff(doc) != 0))))
        out = []
        for a, b in zip(heads, np.concatenate((heads[1:], [len(open_)]))):
            first, last, d = open_[a], open_[b - 1], doc[a]
            if (scores[a:b, O] >= scores[a:b, 1:].max(axis=1) + _SLACK * self._span()).all():
                continue
            before = first > 0 and tokens.doc[first - 1] == d
            after = last + 1 < len(tokens.doc) and tokens.doc[last + 1] == d
            path = self.viterbi(scores[a:b], before, after)
            start = None
            for t, y in zip(range(first, last + 2), [*path, O]):
                if start is not None and y != I:
                    out.append((int(d), start, int(tokens.hi[t - 1] - tokens.offsets[d])))
                    start = None
                if y == B or (y == I and start is None):
                    start = int(tokens.lo[t] - tokens.offsets[d])
        return out

    def _span(self) -> float:
        return float(self.moves.max() - self.moves.min())


_SLACK = 2.0     # all-outside beats every other path if each token leads by two transition spans


def train(texts: list[bytes], labels: list[list[tuple[int, int]]], steps: int = 50, rate: float = 0.4,
          ridge: float = 1e-4, width: int = 48) -> Field:
    """Fit by gradient steps on the log-likelihood; ``labels``: secret byte spans of each text."""
    t = Tokens(texts)
    y = np.full(len(t.lo), O)
    for d, spans in enumerate(labels):
        for a, b in spans:
            a, b = a + t.offsets[d], b + t.offsets[d]
            inside = np.arange(np.searchsorted(t.hi, a, side="right"), np.searchsorted(t.lo, b))
            y[inside] = I
            y[inside[:1]] = B
    x = t.features(np.arange(len(y)))
    # sequences of ``width`` tokens within a document, padded, all stepped at once
    head = np.concatenate(([True], np.diff(t.doc) != 0))
    in_doc = np.arange(len(y)) - np.maximum.accumulate(np.where(head, np.arange(len(y)), 0))
    seq = np.cumsum(head | (in_doc % width == 0)) - 1
    col = in_doc % width
    n = seq[-1] + 1
    weights = [np.zeros((k, 3)) for k in SLOTS]
    moves = np.zeros((3, 3))
    gold = np.zeros((width, n), int)
    gold[col, seq] = y
    live = np.zeros((width, n), bool)
    live[col, seq] = True
    pair = live[1:] & live[:-1]
    true_moves = np.bincount((gold[:-1] * 3 + gold[1:])[pair], minlength=9).reshape(3, 3)
    hot = np.eye(3)[y]
    m1 = [np.zeros_like(w) for w in (*weights, moves)]
    m2 = [np.zeros_like(w) for w in (*weights, moves)]
    for step in range(1, steps + 1):
        s = sum(w[f] for w, f in zip(weights, x))
        e = np.ones((width, n, 3))
        e[col, seq] = np.exp(s - s.max(axis=1, keepdims=True))
        move = np.exp(moves)
        fw, bw = np.empty_like(e), np.ones_like(e)              # scaled to sum 1 per token
        fw[0] = e[0] / e[0].sum(axis=1, keepdims=True)
        for k in range(1, width):
            fw[k] = e[k] * (fw[k - 1] @ move)
            fw[k] /= fw[k].sum(axis=1, keepdims=True)
        expected = np.zeros((3, 3))
        for k in range(width - 2, -1, -1):
            ahead = e[k + 1] * bw[k + 1]
            to = ahead @ move.T
            bw[k] = np.where(pair[k, :, None], to / to.sum(axis=1, keepdims=True), 1.0)
            z = ((fw[k] @ move) * ahead).sum(axis=1)
            expected += move * ((fw[k] * (pair[k] / z)[:, None]).T @ ahead)
        p = (fw * bw)[col, seq]
        p /= p.sum(axis=1, keepdims=True)
        slopes = [np.stack([np.bincount(f, weights=(hot - p)[:, c], minlength=k) for c in range(3)], 1) for f, k in zip(x, SLOTS)]
        slopes.append(true_moves - expected)
        for i, (w, g) in enumerate(zip((*weights, moves), slopes)):
            g = g / len(y) * 100 - ridge * w
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.99 * m2[i] + 0.01 * g * g
            w += rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.99**step)) + 1e-8)
    return Field(weights, moves)


def _made_up(rnd: random.Random) -> tuple[bytes, bytes, bytes]:
    """(before, value, after) of a made-up credential or look-alike; an empty value labels nothing."""
    def some(chars, lo, hi):
        return "".join(rnd.choice(chars) for _ in range(rnd.randint(lo, hi)))

    mixed, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    value = rnd.choice([some(hexa, 32, 64), some(mixed, 20, 44), some(mixed + "+/", 32, 48),
                        rnd.choice(["ghp_", "sk-", "xoxb-"]) + some(mixed, 24, 40), "AKIA" + some(string.ascii_uppercase + string.digits, 16, 16)])
    name = rnd.choice(["password", "secret", "token", "api_key", "Bearer", "credential", "access_key", "auth"])
    harmless = [some(string.digits, 9, 19), some(string.digits, 4, 8), f"{some(string.digits, 3, 3)}-{some(string.digits, 4, 4)}",
                f"{rnd.randint(1990, 2030)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}", some(string.ascii_lowercase, 4, 26),
                some(string.ascii_lowercase, 3, 8) + "." + some(string.digits, 1, 3) + "@" + some(string.ascii_lowercase, 3, 8) + some(string.digits, 1, 2) + ".example",
                some(string.ascii_uppercase, 12, 30), name, f"{name}: {some(string.ascii_lowercase, 3, 12)}", some(string.ascii_letters, 4, 12) + some("*%$#&", 3, 3)]
    how = rnd.random()
    if how < 0.35:
        return f" {name}{rnd.choice([' = ', ': ', '=', ' '])}{rnd.choice(['', chr(34)])}".encode(), value.encode(), rnd.choice([b" ", b'" ', b"\n"])
    if how < 0.5:
        return b" ", value.encode(), rnd.choice([b" ", b". "])
    return f" {rnd.choice(harmless)} ".encode(), b"", b""


def training_set(docs: list[str], seed: int = 2, extra: int = 60) -> tuple[list[bytes], list[list[tuple[int, int]]]]:
    """Sampled texts with their base spans (values only), and copies of lines with made-up values."""
    rnd = random.Random(seed)
    texts, labels = [], []
    for d in docs:
        data = d.encode("utf-8", "surrogatepass")
        spans = []
        for a, kind, b in base_spans(data):
            if kind == 0:
                a = _ASSIGN.match(data, a).start(2)
            if not any(x < b and a < y for x, y in spans):
                spans.append((a, b))
        texts.append(data)
        labels.append(spans)
    plain = [line for d in docs for line in d.split("\n")[:4] if line] or ["plain words stand here, and some more of them."]
    for _ in range(extra * 10):
        data, spans = b"", []
        for piece in rnd.choice(plain)[:300].split(" "):
            data += piece.encode("utf-8", "surrogatepass") + b" "
            if rnd.random() < 0.12:
                before, value, after = _made_up(rnd)
                data += before
                if value:
                    spans.append((len(data), len(data) + len(value)))
                data += value + after
        known = [(a, b) for a, _, b in base_spans(data) if not any(x < b and a < y for x, y in spans)]
        texts.append(data)
        labels.append(sorted(spans + known))
    return texts, labels


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 2) -> Field:
    """Train on the ``sample_docs`` documents of smallest hash (a fixed bound, collected)."""
    sample = bounded_sample(docs.where(F.length("text") > 0).select("doc_id", "text"), ["doc_id", "text"], sample_docs).collect()
    return train(*training_set([r["text"] for r in sample], seed))


_SOLID = re.compile(rb"[0-9A-Za-z\x80-\xff]")


# ---- the operator --------------------------------------------------------------------------

def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[dict]:
    """(start, kind, end) in bytes -> spans in code points, by start, then kind as listed."""
    if not data.isascii():
        starts = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
        spans = [(int(starts[a]), k, int(starts[b])) for a, k, b in spans]
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]


def scan_texts(field: Field, texts: list[bytes]) -> list[list[dict]]:
    """All spans of some whole texts."""
    tokens = Tokens(texts)
    longest = np.zeros(len(texts) + 1, np.int64)
    np.maximum.at(longest, tokens.doc, tokens.hi - tokens.lo)
    spans = [base_spans(t, bool(longest[d] >= 20)) for d, t in enumerate(texts)]
    for d, a, b in field.tag(tokens):
        # what the base spans leave of a tagged span is a span: a secret's rest stays one
        at = a
        for x, _, y in sorted(s for s in spans[d] if s[1] < 3 and s[0] < b and a < s[2]):
            if at < x and _SOLID.search(texts[d], at, x):
                spans[d].append((at, 3, x))
            at = max(at, y)
        if at == a or (at < b and _SOLID.search(texts[d], at, b)):
            spans[d].append((at, 3, b))
    return [_code_points(t, s) if s else [] for t, s in zip(texts, spans)]


def find(docs: DataFrame, field: Field, drop_text: bool = False, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end)."""
    docs, text = docs.drop("spans"), resolve(docs, text)
    kept = [n for n in docs.columns if not (drop_text and n == text)]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, some, size = [], [], 0
            for t in b.column(b.schema.get_field_index(text)):
                some.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(some[-1])
                if size > CHUNK:
                    out += scan_texts(field, some)
                    some, size = [], 0
            if some:
                out += scan_texts(field, some)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in kept] + [pa.array(out, kind)],
                                             names=[*kept, "spans"])

    types = dict(docs.dtypes)
    schema = ", ".join([f"`{n}` {types[n]}" for n in kept] + ["spans array<struct<kind: string, start: long, end: long>>"])
    return docs.mapInArrow(run, schema)


def joined(spans, kinds: tuple[str, ...] = KINDS):
    """Column: kind:start:end of the spans of some kinds, comma-joined."""
    mine = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; n_chars follows."""
    names, at = docs.columns, docs.columns.index(resolve(docs, "text"))
    chars = [i for i, n in enumerate(names) if n.lower() == "n_chars"][:1]
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = find(plain, field, text=f"c{at}")
    types, width = dict(plain.dtypes), len(names)
    renamed = [*plain.columns, "changed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [_cut_out(t, s, mark) if s else t for t, s in zip(texts, b.column(width).to_pylist())]
            columns = list(b.columns[:width])
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([None if t is n else len(n) for t, n in zip(texts, new)], pa.int64())],
                                             names=renamed)

    out = found.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in plain.columns] + ["changed long"]))
    for i in chars:
        out = out.withColumn(f"c{i}", F.coalesce(F.col("changed").cast(types[f"c{i}"]), F.col(f"c{i}")))
    return out.drop("changed").toDF(*names)


def _cut_out(text: str, spans: list[dict], mark: str) -> str:
    """``text`` with its spans replaced; spans that overlap or touch at no character between are as one."""
    pieces, end = [], 0
    for s in spans:                                        # by start
        if s["start"] >= end:
            pieces += [text[end:s["start"]], mark]
        end = max(end, s["end"])
    return "".join([*pieces, text[end:]])
