"""LM scoring by subword lattice likelihood (operator 10).

A text is its words (lower-case A-Z, ASCII white space) and one end.  The pieces of a public
vocabulary span a lattice over each word (with the word-start mark in front); a text's probability
is the sum over all segmentations of the product of piece probabilities, by forward recursion in
log space, times the end's probability.  The vocabulary's own scores (ranks) weight the first
lattice; expected piece counts over all training words under it give the final piece
probabilities (one step of expectation maximisation per ``rounds``).

Words are scored once each, not once per occurrence:

1. ``blocks``: texts are cut into blocks of bounded size, each with its distinct words (by hash
   bucket) and, per document, numbers of those words and how often they occur;
2. per bucket the words of all blocks are merged into the corpus vocabulary with training counts
   (a word comes once per block, so frequent words are no hot keys);
3. expected piece counts are summed over the vocabulary; per bucket counts and log-probabilities
   go back to the blocks, where they are added up per document.

Buckets hold about ``BUCKET_WORDS`` words, blocks about ``BLOCK_BYTES`` of text, whatever the
corpus; the driver sees sums and the piece table only.

Defined cases: null and empty texts have the end token only; null ids are scored like others
(their fold counts the id as empty text), ids may be of any type; repeated rows count and are scored each; an empty
table gives no rows; with no training rows every count is 0 and the vocabulary's own scores
hold; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import scratch

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 4_000_000
BUCKET_WORDS = 200_000     # block words per bucket
WORDS_AT_ONCE = 50_000     # words in one lattice pass
START = "▁".encode()  # the vocabulary's word-start mark
SMOOTH = 0.1


# ---- the lattice ---------------------------------------------------------------------------

@dataclass
class Pieces:
    """Piece byte strings, the end's number, and log10-free natural log-probabilities."""
    texts: list[bytes]
    end: int
    logp: np.ndarray

    @staticmethod
    def load(path: str = VOCABULARY) -> "Pieces":
        """Pieces of a vocabulary file; probability falls with the piece's own rank (its score)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        whole, single = {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                single[bytes([int(model.id_to_piece(i)[3:5], 16)])] = 0.0
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                whole[model.id_to_piece(i).encode()] = max(0.0, -model.get_score(i))
        for b in range(256):                          # every text can be spelled in bytes
            single.setdefault(bytes([b]), 0.0)
        last = max([*[s for s in whole.values() if s < 1e8], 0.0])
        ranks = {p: min(s, last) for p, s in whole.items()} | {p: last for p in single if p not in whole}
        texts = sorted(ranks)
        weight = np.array([1.0 / (ranks[t] + 10.0) for t in texts] + [1.0 / 10.0])
        return Pieces(texts, len(texts), np.log(weight / weight.sum()))

    def automaton(self):
        a = ahocorasick.Automaton()
        for i, t in enumerate(self.texts):
            a.add_word(t.decode("latin-1"), len(t) << 32 | i)
        a.make_automaton()
        return a


def _arcs(automaton, words: list[bytes]) -> tuple[np.ndarray, ...]:
    """(arc end, arc length, piece, first position, last position) of the words laid end to end."""
    line = b"".join(b"\x00" + START + w for w in words) + b"\x00"
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + len(START)
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))       # position before the word's first byte
    found = np.fromiter(chain.from_iterable(automaton.iter(line.decode("latin-1"))), np.int64).reshape(-1, 2)
    ends, lens, ids = found[:, 0], found[:, 1] >> 32, found[:, 1] & 0xFFFFFFFF
    a = np.frombuffer(line, np.uint8)
    inside = a[ends] != 0                              # the byte piece of the separator is no arc
    return ends[inside], lens[inside], ids[inside], first, first + sizes


def _by(step: np.ndarray) -> np.ndarray:
    """Stable order by step (a radix sort where steps are small)."""
    return np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")


def _swept(to: np.ndarray, frm: np.ndarray, weight: np.ndarray, value: np.ndarray, step: np.ndarray) -> None:
    """value[to] = log sum exp(value[frm] + weight), step by step (``to`` ascending); all words move at once."""
    order = _by(step)
    to, frm, weight, step = to[order], frm[order], weight[order], step[order]
    bounds = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1], [True])))
    for a, b in zip(bounds[:-1], bounds[1:]):
        t = to[a:b]
        heads = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        v = value[frm[a:b]] + weight[a:b]
        top = np.maximum.reduceat(v, heads)
        size = np.diff(np.concatenate((heads, [b - a])))
        value[t[heads]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, size)), heads))


def _forward(arcs, logp: np.ndarray) -> np.ndarray:
    """Log-probability of every prefix, by position in the joined words."""
    ends, lens, ids, first, last = arcs
    alpha = np.zeros(last[-1] + 1)
    word = np.searchsorted(first, ends, side="left") - 1
    step = ends - first[word]
    _swept(ends, ends - lens, logp[ids], alpha, step)
    return alpha


def word_logp(automaton, logp: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log of the marginal probability of each word over all segmentations."""
    out = [np.empty(0)]
    for i in range(0, len(words), WORDS_AT_ONCE):
        arcs = _arcs(automaton, words[i:i + WORDS_AT_ONCE])
        out.append(_forward(arcs, logp)[arcs[4]])
    return np.concatenate(out)


def expected_counts(automaton, logp: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over ``counts`` occurrences of the words."""
    total = np.zeros(len(logp))
    for i in range(0, len(words), WORDS_AT_ONCE):
        arcs = _arcs(automaton, words[i:i + WORDS_AT_ONCE])
        ends, lens, ids, first, last = arcs
        alpha = _forward(arcs, logp)
        beta = np.zeros(len(alpha))
        word = np.searchsorted(first, ends, side="left") - 1
        start = ends - lens
        o = np.argsort(start, kind="stable")
        _swept(start[o], ends[o], logp[ids[o]], beta, last[word[o]] - start[o])
        use = np.exp(alpha[start] + logp[ids] + beta[ends] - alpha[last[word]]) * counts[i:i + WORDS_AT_ONCE][word]
        total += np.bincount(ids, weights=use, minlength=len(logp))
    return total


_READY: dict = {}


def _ready(pieces: Pieces):
    """The automaton of a piece table, built once per worker process."""
    key = (len(pieces.texts), zlib.crc32(b"\n".join(pieces.texts)))
    if key not in _READY:
        _READY.clear()
        _READY[key] = pieces.automaton()
    return _READY[key]


# ---- blocks and buckets --------------------------------------------------------------------

_BLOCK = ("block long, bucket array<int>, n_words array<int>, words array<binary>, train array<int>, doc_id array<{id}>, "
          "held_out array<boolean>, n_tokens array<long>, kinds array<int>, word_no binary, times binary, train_tokens long, train_docs long")


def bucket_of(word: bytes, n: int) -> int:
    return zlib.crc32(word) % n


def _block(number: int, docs: list[tuple], n_buckets: int) -> dict:
    numbers: dict = defaultdict()
    numbers.default_factory = numbers.__len__
    tokens = [d[1].lower().split() for d in docs]
    at = [np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in tokens]
    words = list(numbers)
    train = np.zeros(len(words), np.int64)
    kinds, word_no, times = [], [], []
    for (_, _, held), a in zip(docs, at):
        u, n = np.unique(a, return_counts=True)
        if not held:
            train[u] += n
        kinds.append(len(u))
        word_no.append(u)
        times.append(n)
    bucket = np.fromiter((bucket_of(w, n_buckets) for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(words), np.int32)
    place[order] = np.arange(len(words))
    some, size = np.unique(bucket, return_counts=True)
    return {"block": number, "bucket": some.tolist(), "n_words": size.tolist(), "words": [words[i] for i in order],
            "train": train[order].tolist(), "doc_id": [d[0] for d in docs], "held_out": [d[2] for d in docs],
            "n_tokens": [len(t) + 1 for t in tokens], "kinds": kinds,
            "word_no": place[np.concatenate(word_no)].astype("<i4").tobytes(), "times": np.concatenate(times).astype("<i4").tobytes(),
            "train_tokens": sum(len(t) + 1 for t, d in zip(tokens, docs) if not d[2]), "train_docs": sum(not d[2] for d in docs)}


def blocks(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Blocks of (doc_id, text, held_out) rows; numbered by task, so they must be written before use."""
    kind = docs.schema["doc_id"].dataType
    types = {**_TYPES, "doc_id": pa.list_(to_arrow_type(kind))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, some, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            for i, t, h in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                some.append((i, (t.as_py() or "").encode("utf-8", "surrogatepass"), h))
                size += len(some[-1][1]) + 100
                if size >= BLOCK_BYTES:
                    yield _batch(_block(number, some, n_buckets), types)
                    number, some, size = number + 1, [], 0
        if some:
            yield _batch(_block(number, some, n_buckets), types)

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, _BLOCK.replace("{id}", kind.simpleString()))


_TYPES = {"block": pa.int64(), "bucket": pa.list_(pa.int32()), "n_words": pa.list_(pa.int32()), "words": pa.list_(pa.binary()),
          "train": pa.list_(pa.int32()), "doc_id": None, "held_out": pa.list_(pa.bool_()),
          "n_tokens": pa.list_(pa.int64()), "kinds": pa.list_(pa.int32()), "word_no": pa.binary(), "times": pa.binary(),
          "train_tokens": pa.int64(), "train_docs": pa.int64()}


def _batch(row: dict, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in types.items()], names=list(types))


def _by_bucket(cut: DataFrame) -> DataFrame:
    """(bucket, block, words, train): the part of each block's words that is in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                buckets, sizes = b.column(1)[r].values.to_numpy(), b.column(2)[r].values.to_numpy()
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                words, train = b.column(3)[r].values, b.column(4)[r].values
                # values may be a slice of a longer column: offsets are relative to it
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()), pa.array(np.full(len(buckets), b.column(0)[r].as_py()), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), words), pa.ListArray.from_arrays(pa.array(ends), train)],
                    names=["bucket", "block", "words", "train"])

    return (cut.select("block", "bucket", "n_words", "words", "train")
            .mapInArrow(run, "bucket int, block long, words array<binary>, train array<int>"))


def _merge(table: pa.Table) -> pa.Table:
    """One bucket's distinct words over all blocks, with training counts."""
    total: dict = defaultdict(int)
    for words, train in zip(table.column("words"), table.column("train")):
        for w, c in zip(words.values.to_pylist(), train.values.to_pylist()):
            total[w] += c
    return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                     "words": pa.array([list(total)], pa.list_(pa.binary())),
                     "train": pa.array([list(total.values())], pa.list_(pa.int64()))})


def train_pieces(vocabulary: DataFrame, n_docs: int, start: Pieces, rounds: int = 1) -> Pieces:
    """Piece probabilities from expected counts over the whole training vocabulary."""
    pieces = start
    for _ in range(rounds):
        now = vocabulary.sparkSession.sparkContext.broadcast(pieces)       # the vocabulary file's size

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(now.value.logp))
            for b in batches:
                for r in range(b.num_rows):
                    c = b.column(1)[r].values.to_numpy()
                    seen = np.flatnonzero(c > 0)
                    words = b.column(0)[r].values.take(pa.array(seen)).to_pylist()
                    if words:
                        total += expected_counts(_ready(now.value), now.value.logp, words, c[seen].astype(float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

        rows = vocabulary.select("words", "train").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        if not rows:
            return start
        count = np.full(len(pieces.logp), SMOOTH)
        for r in rows:
            count[r["piece"]] += r["n"]
        count[pieces.end] += n_docs
        pieces = Pieces(pieces.texts, pieces.end, np.log(count / count.sum()))
    return pieces


def score(docs: DataFrame, vocabulary_file: str = VOCABULARY, rounds: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of ``docs``
    (doc_id, text, held_out); rows with ``held_out`` are not learned from."""
    spark: SparkSession = docs.sparkSession
    # about one distinct word in 20 bytes of text and block; only the bucket size depends on it
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(64, -(-n_bytes // 20 // BUCKET_WORDS))
    cut = scratch(blocks(docs, n_buckets), "lm-blocks")
    sums = cut.agg(F.sum("train_tokens").alias("n"), F.sum("train_docs").alias("d")).first()
    n, n_docs = sums["n"] or 0, sums["d"] or 0
    parts = _by_bucket(cut)
    merged = scratch(parts.groupBy("bucket").applyInArrow(_merge, "bucket int, words array<binary>, train array<long>"), "lm-words")
    v = (merged.agg(F.sum(F.expr("size(filter(train, c -> c > 0))"))).first()[0] or 0) + (n_docs > 0)
    trained = train_pieces(merged, n_docs, Pieces.load(vocabulary_file), rounds)
    model = spark.sparkContext.broadcast(trained)

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        words, train = right.column("words")[0].values.to_pylist(), right.column("train")[0].values.to_numpy()
        logp = word_logp(_ready(model.value), model.value.logp, words)
        number = {w: i for i, w in enumerate(words)}
        out = []
        for mine in left.column("words"):
            out.append(np.fromiter(map(number.__getitem__, mine.values.to_pylist()), np.int64, len(mine.values)))
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"),
                         "count": pa.array([train[i] for i in out], pa.list_(pa.int64())),
                         "logp": pa.array([logp[i] for i in out], pa.list_(pa.float64()))})

    looked = (parts.groupBy("bucket").cogroup(merged.groupBy("bucket"))
              .applyInArrow(look_up, "block long, bucket int, count array<long>, logp array<double>"))
    floor, end_logp, end_count = n + SMOOTH * (v + 1), float(trained.logp[trained.end]), n_docs

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        join = lambda c, t: np.concatenate([x.values.to_numpy() for x in right.column(c)] or [np.empty(0, t)])
        count, logp = join("count", np.int64), join("logp", np.float64)
        base = np.log10((count + SMOOTH) / floor)
        no = np.frombuffer(left.column("word_no")[0].as_py(), "<i4")
        times = np.frombuffer(left.column("times")[0].as_py(), "<i4")
        kinds = left.column("kinds")[0].values.to_numpy()
        doc = np.repeat(np.arange(len(kinds)), kinds)
        add = lambda x: np.bincount(doc, weights=times * x, minlength=len(kinds)) if len(doc) else np.zeros(len(kinds))
        known = add(count[no] > 0) + (end_count > 0)
        return pa.table({
            "doc_id": left.column("doc_id")[0].values, "held_out": left.column("held_out")[0].values,
            "n_tokens": left.column("n_tokens")[0].values, "n_known": pa.array(known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(kinds), n, np.int64)),
            "base_score": pa.array(add(base[no]) + np.log10((end_count + SMOOTH) / floor)),
            "score": pa.array((add(logp[no]) + end_logp) / np.log(10))})

    rows = cut.select("block", "doc_id", "held_out", "n_tokens", "kinds", "word_no", "times")
    return (rows.groupBy("block").cogroup(looked.groupBy("block"))
            .applyInArrow(add_up, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double"))
