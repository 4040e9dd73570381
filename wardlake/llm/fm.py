"""Factorisation machine for document quality.

Inputs are hashed words, hashed word shapes (letters and digits folded, punctuation kept),
statistics of the text's structure, and its size as metadata. The score is
  sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j),
and the pairwise part is computed in linear time as half of
  sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2).

Scale: the model is fitted on a bounded sample of labelled rows (``max_rows``, those with the
smallest id hash); its size is fixed (``buckets`` x (``rank`` + 1) numbers), so it is broadcast.
Every text is scored whole, where it lies, without a shuffle.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CACHE_WORDS = 1 << 18
_FOLDS = [(re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"9"),
          (re.compile(rb"(.)\1+", re.S), rb"\1\1")]
#: byte classes: 0 other, 1 lower and non-ASCII, 2 upper, 3 digit, 4 white space, 5 sentence marks, 6 symbols
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1], _CLASS[128:], _CLASS[ord("A"):ord("Z") + 1] = 1, 1, 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[list(b" \t\n\x0b\x0c\r")], _CLASS[list(b".,;:!?'\"()-")], _CLASS[list(b"#*$%&|<>=@_~^{}[]+\\/")] = 4, 5, 6
STATS = 16


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 14      # of hashed words and shapes
    rank: int = 8
    max_rows: int = 8192        # labelled rows the model is fitted on, at most
    epochs: int = 12
    rate: float = 0.05
    decay: float = 1e-4
    batch: int = 128
    seed: int = 7


class _Buckets(dict):
    """Word -> buckets of the word and of its shape, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.half = buckets // 2

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        shape = word
        for pattern, to in _FOLDS:
            shape = pattern.sub(to, shape)
        out = self[word] = (zlib.crc32(word.lower()) % self.half, self.half + zlib.crc32(shape) % self.half)
        return out


def _stats(text: bytes, words: list[bytes], counts: Counter) -> np.ndarray:
    """Structure of the text and, last, its size."""
    n, size = max(len(words), 1), max(len(text), 1)
    share = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=7) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    many = max(len(lines), 1)
    return np.array([
        *share[1:7], text.count(b"!") / n, text.count(b"|") / n,
        sum(map(len, words)) / n, len(counts) / n, (counts.most_common(1)[0][1] / n) if counts else 0.0,
        (len(lines) - len(set(lines))) / many, np.log1p(n / many), sum(w.isupper() for w in counts) / max(len(counts), 1),
        np.log1p(len(words)), np.log1p(len(text))])


def inputs(text: bytes | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed inputs (index, value; unit length) and statistics of one text."""
    text = text or b""
    words = text.split()
    counts = Counter(words)
    at: dict[int, float] = {}
    for word, n in counts.items():
        a, b = buckets[word]
        at[a] = at.get(a, 0.0) + n
        at[b] = at.get(b, 0.0) + n
    index = np.fromiter(at.keys(), dtype=np.int64, count=len(at))
    value = np.log1p(np.fromiter(at.values(), dtype=np.float64, count=len(at)))
    return index, value / max(np.sqrt((value ** 2).sum()), 1e-12), _stats(text, words, counts)


@dataclass
class Machine:
    params: Params
    mean: np.ndarray
    spread: np.ndarray
    bias: float
    linear: np.ndarray          # buckets + STATS
    factors: np.ndarray         # (buckets + STATS) x rank

    def rows(self, parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index and value of all inputs of all rows, one row after another, and where rows start."""
        own = np.arange(STATS) + self.params.buckets
        index = np.concatenate([np.r_[i, own] for i, _, _ in parts])
        value = np.concatenate([np.r_[v, np.clip((s - self.mean) / self.spread, -4, 4) / np.sqrt(STATS)] for _, v, s in parts])
        return index, value, np.cumsum([0, *[len(i) + STATS for i, _, _ in parts[:-1]]])

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vx = self.factors[index] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs, sums

    def scores(self, parts: list[tuple]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.rows(parts))[0], -30, 30)))


def fit(parts: list[tuple], labels: np.ndarray, p: Params) -> Machine:
    """Logistic loss, AdaGrad on mini-batches."""
    rng = np.random.default_rng(p.seed)
    n = p.buckets + STATS
    stats = np.array([s for _, _, s in parts]) if parts else np.zeros((1, STATS))
    m = Machine(p, stats.mean(axis=0), stats.std(axis=0) + 1e-6, 0.0, np.zeros(n), rng.normal(0, 0.05, (n, p.rank)))
    if not parts:
        return m
    good = np.clip(labels.mean(), 0.01, 0.99)
    m.bias = float(np.log(good / (1 - good)))
    g_bias, g_linear, g_factors = 1e-6, np.full(n, 1e-6), np.full((n, p.rank), 1e-6)
    for _ in range(p.epochs):
        order = rng.permutation(len(parts))
        for at in range(0, len(order), p.batch):
            pick = order[at:at + p.batch]
            index, value, starts = m.rows([parts[i] for i in pick])
            y, sums = m.raw(index, value, starts)
            slope = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[pick]
            sizes = np.diff(np.append(starts, len(index)))
            each = np.repeat(slope, sizes) * value
            used, place = np.unique(index, return_inverse=True)
            d_linear = np.bincount(place, each) / len(pick) + p.decay * m.linear[used]
            inner = np.repeat(sums, sizes, axis=0) - m.factors[index] * value[:, None]
            d_factors = np.stack([np.bincount(place, each * inner[:, f]) for f in range(p.rank)], axis=1) / len(pick) \
                + p.decay * m.factors[used]
            g_linear[used] += d_linear ** 2
            g_factors[used] += d_factors ** 2
            m.linear[used] -= p.rate * 4 * d_linear / np.sqrt(g_linear[used])
            m.factors[used] -= p.rate * d_factors / np.sqrt(g_factors[used])
            g_bias += slope.mean() ** 2
            m.bias -= p.rate * slope.mean() / np.sqrt(g_bias)
    return m


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Machine:
    """A machine fitted on labelled rows of ``docs`` that are not held out. Null labels and
    documents whose labels disagree are left out; without labels every score is near 1/2."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("l_id")).agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi"))
    sample = known.orderBy(F.xxhash64("l_id"), "l_id").limit(p.max_rows).select("l_id", "lo")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("l_id")).select("doc_id", "lo", "text")      # max_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets(p.buckets)
        for batch in batches:
            got = [inputs(t.as_py(), buckets) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()), *(pa.array([x[k].astype(kind).tobytes() for x in got], pa.binary())
                                                                      for k, kind in enumerate(("<i4", "<f4", "<f8")))],
                ["doc_id", "label", "i", "v", "s"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {r["doc_id"]: r for batch in batches for r in batch.to_pylist()}      # repeated rows share a place
        rows = [got[k] for k in sorted(got)]        # a fixed order makes the fit repeatable
        parts = [(np.frombuffer(r["i"], "<i4").astype(np.int64), np.frombuffer(r["v"], "<f4").astype(float), np.frombuffer(r["s"], "<f8"))
                 for r in rows]
        m = fit(parts, np.array([r["label"] for r in rows], dtype=float), p)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(m)], pa.binary())], ["machine"])

    # the sample, at most max_rows rows, goes to one task; only the machine comes back
    made = rows.mapInArrow(run, "doc_id long, label int, i binary, v binary, s binary")
    done = made.repartition(1).mapInArrow(fitted, "machine binary").collect()
    return pickle.loads(done[0]["machine"]) if done else fit([], np.zeros(0), p)


def score(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """A struct ``row`` of the columns ``keep`` of ``docs`` (default: all) beside the ``score``
    (0 to 1) of its ``text``.

    Null and empty text: scored from its statistics alone. Null ``doc_id``, repeated rows and
    clashing column names: the row is passed through as it is. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)      # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        buckets = _Buckets(m.params.buckets)
        for batch in batches:
            texts, scores = batch.column(1), []
            for at in range(0, len(texts), 256):
                scores.append(m.scores([inputs(t.as_py(), buckets) for t in texts.slice(at, 256)]))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["row", "score"])

    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    rows = docs.select(kept, F.col("text").cast("binary").alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row_type}, score double")
