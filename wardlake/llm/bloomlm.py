"""Language-model scoring from a log-frequency Bloom filter.

Training counts words and word pairs of all training texts. A count c is quantised to level
q = 1 + floor(log_b c), and the n-gram is stored q times, once with each level number, in a
Bloom filter. A reader probes level 1, 2, ... until one is missing and so gets q back, never
too small. A token's probability interpolates the pair estimate with the add-one word
probability, both from such probes:
  p = (1 - w) (c(v) + 1) / (N + V + 1) + w c(u v) / c(u).
Beside it stands the exact add-one word score, from exact word counts.

The bits of a stored level lie in one 64-bit word of the filter, so a probe reads one word.

Scale: tasks combine their counts before the one shuffle of training, so a very frequent word
or pair occurs once per block of some million tokens. The hash of an n-gram names its segment of
the filter, with bits in proportion to what it stores, and a part of some segments is built in one
task. A block sends a part the sorted hashes as packed differences, about six bytes each.

While the filter fits ``broadcast_bytes`` (checked from its exact size) it is broadcast and texts
are scored where they lie. Exact counts of the ``frequent_words`` commonest words are broadcast, a
bounded table; the other words of the texts are joined with the table of counts. What is known of a
word is kept per task, up to a bound.

Beyond the bound, texts are cut once into blocks of word numbers. A block asks the parts for its
distinct n-grams, packed as in training; they answer with levels and exact word counts in the order
they were asked, so that no hash is sent back, and the block scores its texts: the same results.
(Sending a larger filter in waves would read the corpus once per wave: the work would grow with
the square of the corpus.)
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

END, START = xxhash.xxh64_intdigest(b" end", 1), xxhash.xxh64_intdigest(b" start", 1)   # no word holds a space
_CACHE_WORDS = 1 << 19
_BLOCK_TOKENS = 1 << 19
_COUNT_TOKENS = 1 << 21
_ASK_TOKENS = 1 << 21
_PROBED = 1 << 18   # hashes at once, where a part answers
_ROWS = 64     # of a batch of packed rows
_ZSTD = pa.Codec("zstd")


@dataclass(frozen=True)
class Params:
    base: float = 1.5            # b of the count levels
    probes: int = 5              # bits set for each stored level, in one word of 64
    bits_each: float = 9.0       # filter bits for each stored level
    pair_weight: float = 0.4     # w
    segments_per_partition: int = 8     # filter segments for each shuffle partition
    broadcast_bytes: int = 256 << 20
    frequent_words: int = 1 << 17


class _Words(dict):
    """Word -> its number in this task; ``hashes`` has the 64-bit hash of each. Number 0 is the end."""

    def __init__(self):
        super().__init__()
        self.hashes = [END]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word, 1))
        return n


def _tokens(text: bytes | None, words: _Words) -> np.ndarray:
    """Numbers of the words (A-Z lower-cased, cut at ASCII white space) and the end."""
    cut = (text or b"").lower().split()       # bytes: A-Z and ASCII white space only
    out = np.zeros(len(cut) + 1, dtype=np.int64)
    out[:-1] = np.fromiter(map(words.__getitem__, cut), dtype=np.int64, count=len(cut))
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unmix(x: np.ndarray) -> np.ndarray:
    """What ``_mix`` made ``x`` from."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def _pairs(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before it, and that one's hash."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = START
    return _mix(before * np.uint64(0x9E3779B97F4A7C15) + _mix(tokens)), before


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, _Words]]:
    """(other columns' values by row, word numbers, first token of each row, words) of up to about
    ``size`` tokens; the text is the last column. Once ``words`` has ``_CACHE_WORDS`` it is begun anew."""
    words, rows, parts, n = _Words(), [], [], 0
    for batch in batches:
        for *row, text in zip(*batch.columns):
            rows.append([x.as_py() for x in row])
            parts.append(_tokens(text.as_py(), words))
            n += len(parts[-1])
            if n >= size:
                yield rows, np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])]), words
                rows, parts, n = [], [], 0
                if len(words) >= _CACHE_WORDS:
                    words = _Words()
    if rows:
        yield rows, np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])]), words


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


_SEED = np.uint64(0x5851F42D4C957F2D)


def _keys(h: np.ndarray) -> np.ndarray:
    """The key of each hash, one to one: modulo the number of segments it names the segment."""
    return _mix(h ^ _SEED)


def _hashes(keys: np.ndarray) -> np.ndarray:
    return _unmix(keys) ^ _SEED


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return (_keys(h) % np.uint64(segments)).astype(np.int32)


@dataclass(frozen=True)
class Parts:
    """The filter in ``n`` parts: part i has the segments that are i modulo n. Rows go by ``places``, numbers
    that are i modulo n and that Spark's hash spreads evenly over n partitions."""
    n: int
    places: np.ndarray


def _spark_hash(x: np.ndarray) -> np.ndarray:
    """Murmur3 of an int with seed 42, by which Spark deals rows out."""
    turn = lambda v, by: (v << np.uint32(by)) | (v >> np.uint32(32 - by))
    h = turn(x.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    h = (turn(h ^ np.uint32(42), 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def parts_of(segments: int, p: Params) -> Parts:
    n = segments // math.gcd(segments, p.segments_per_partition)
    places, taken, left = np.arange(n), np.zeros(n, dtype=bool), np.arange(n)
    for turn in range(min(64, (1 << 31) // n)):
        to = _spark_hash(left + turn * n).astype(np.int64) % n
        first = np.zeros(len(left), dtype=bool)
        first[np.unique(to, return_index=True)[1]] = True
        first &= ~taken[to]
        places[left[first]] += turn * n
        taken[to[first]] = True
        left = left[~first]
    return Parts(n, places)


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0 up: compressed planes of bytes, as many as the largest number needs."""
    if not len(x):
        return b""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return struct.pack("<QB", len(x), width) + _ZSTD.compress(planes.tobytes(), asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    size, width = struct.unpack_from("<QB", data)
    planes = np.frombuffer(_ZSTD.decompress(memoryview(data)[9:], size * width), dtype=np.uint8)
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, size).T
    return out.view("<u8").ravel()


def _joined(packed: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.uint64), *map(_unpack, packed)]).astype(np.int64)


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings sorted ``keys`` together by part, and how many each part has."""
    part = (keys % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
    return np.argsort(part, kind="stable"), np.bincount(part, minlength=parts)


def _parted(parts: Parts, *kinds: tuple[np.ndarray, ...]) -> Iterator[list[pa.Array]]:
    """Batches of one row per part that has something: its place and, for each kind (sorted keys, numbers
    beside them ...), packed columns. Keys of a part are the differences of their quotients by ``parts.n``."""
    columns, some = [], np.zeros(parts.n, dtype=bool)
    for keys, *numbers in kinds:
        order, size = _by_part(keys, parts.n)
        cuts = np.cumsum(size)[:-1]
        some |= size > 0
        columns.append([_pack(np.diff(x, prepend=np.uint64(0))) for x in np.split((keys // np.uint64(parts.n))[order], cuts)])
        columns += [[_pack(x) for x in np.split(n[order], cuts)] for n in numbers]
    rows = np.flatnonzero(some)
    for at in range(0, len(rows), _ROWS):
        some = rows[at:at + _ROWS]
        yield [pa.array(parts.places[some], pa.int32()), *[pa.array([c[i] for i in some], pa.binary()) for c in columns]]


def _keys_of(packed: list[bytes], part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of ``_parted`` again, and how many each item has."""
    each = [np.cumsum(_unpack(x), dtype=np.uint64) * np.uint64(parts) + np.uint64(part) for x in packed]
    return np.concatenate([np.zeros(0, dtype=np.uint64), *each]), np.array([len(x) for x in each], dtype=np.int64)


def counts(texts: DataFrame, parts: Parts) -> DataFrame:
    """(place, words, words_n, pairs, pairs_n): for each block of texts and part the words (and the end)
    and the pairs with their counts, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, numbers, starts, words in _blocks(batches, _COUNT_TOKENS):
            hashes = np.array(words.hashes, dtype=np.uint64)
            times = np.bincount(numbers, minlength=len(hashes))
            word, n = _keys(hashes[times > 0]), times[times > 0]
            order = np.argsort(word)
            pairs = np.unique(_keys(_pairs(hashes[numbers], starts)[0]), return_counts=True)
            for columns in _parted(parts, (word[order], n[order]), pairs):
                yield pa.RecordBatch.from_arrays(columns, ["place", "words", "words_n", "pairs", "pairs_n"])

    return texts.select(F.col("text").cast("binary")).mapInArrow(
        run, "place int, words binary, words_n binary, pairs binary, pairs_n binary")


def levels_of(n: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(n) / math.log(base) + 1e-9).astype(np.int64)


def level_values(base: float, levels: int = 256) -> np.ndarray:
    """Count that stands for each level: the middle of the counts that share it; 0 at 0."""
    with np.errstate(over="ignore"):
        low = np.ceil(base ** np.arange(levels) - 1e-9)
        high = np.ceil(base ** np.arange(1, levels + 1) - 1e-9) - 1
        return np.concatenate([[0.0], (low + np.maximum(low, high)) / 2])


def _word_and_mask(h: np.ndarray, level: int, words: np.ndarray | np.uint64, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word, of ``words``, that has a hash's bits at ``level``, and the bits."""
    x = _mix(h + np.uint64(level * 0xD1342543DE82EF95 % (1 << 64)))
    y = _mix(x)
    mask = np.zeros(len(h), dtype=np.uint64)
    for i in range(probes):
        mask |= np.uint64(1) << ((y >> np.uint64(6 * i)) & np.uint64(63))
    # the high half of a product with the 32 high bits is even over any number of words under 2**32
    return ((x >> np.uint64(32)) * words) >> np.uint64(32), mask


class Filter:
    """Probing side: segments one after another in ``data`` (64-bit words); ``starts`` are their first
    words and the end, by segment number."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, segments: int, p: Params):
        self.data, self.starts, self.segments, self.p = data, starts, segments, p
        self.values = level_values(p.base)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Level of each hash: levels are probed until one is missing."""
        seg = segment_of(h, self.segments)
        start, words = self.starts[seg], (self.starts[seg + 1] - self.starts[seg]).astype(np.uint64)
        q, alive, level = np.zeros(len(h), dtype=np.int64), np.flatnonzero(words), 1
        while len(alive):
            word, mask = _word_and_mask(h[alive], level, words[alive], self.p.probes)
            alive = alive[self.data[start[alive] + word.astype(np.int64)] & mask == mask]
            q[alive] = level
            level += 1
        return np.minimum(q, len(self.values) - 1)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Estimated count of each hash."""
        return self.values[self.levels(h)]


def segment_bits(h: np.ndarray, q: np.ndarray, p: Params) -> np.ndarray:
    """The filter's words that store each hash at the levels 1 to its q."""
    size = max(1, math.ceil(q.sum() * p.bits_each / 64))
    bits = np.zeros(size, dtype=np.uint64)
    for level in range(1, int(q.max()) + 1):
        at, mask = _word_and_mask(h[q >= level], level, np.uint64(size), p.probes)
        order = np.argsort(at, kind="stable")
        at, mask = at[order].astype(np.int64), mask[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        bits[at[first]] |= np.bitwise_or.reduceat(mask, first)
    return bits


def segment_tables(counted: DataFrame, segments: int, parts: int, p: Params) -> DataFrame:
    """(place, seg, bits, words_h, words_n): the filter's segments, each with its words' exact counts."""
    schema = pa.schema([("place", pa.int32()), ("seg", pa.int32()), ("bits", pa.binary()), ("words_h", pa.list_(pa.int64())), ("words_n", pa.list_(pa.int64()))])

    def summed(part: int, keys: pa.ChunkedArray, n: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        keys, n = _keys_of(keys.to_pylist(), part, parts)[0], _joined(n.to_pylist())
        if not len(keys):
            return keys, n
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[first], np.add.reduceat(n, first)

    def build(key: tuple, blocks: pa.Table) -> pa.Table:
        place, rows = key[0].as_py(), []
        part = place % parts
        words, words_n = summed(part, blocks["words"], blocks["words_n"])
        pairs, pairs_n = summed(part, blocks["pairs"], blocks["pairs_n"])
        of_word, of_pair = words % np.uint64(segments), pairs % np.uint64(segments)
        for seg in range(part, segments, parts):
            h, n = _hashes(words[of_word == seg]), words_n[of_word == seg]
            all_h, all_n = np.r_[h, _hashes(pairs[of_pair == seg])], np.r_[n, pairs_n[of_pair == seg]]
            if len(all_h):
                bits = segment_bits(all_h, levels_of(all_n, p.base), p)
                rows.append((place, seg, bits.astype("<u8").tobytes(), h.view(np.int64), n))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema)

    return counted.groupBy("place").applyInArrow(build, "place int, seg int, bits binary, words_h array<long>, words_n array<long>")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``written``; the shuffle files of the write go at its end, not when the driver next collects its garbage,
    and few texts or packed rows at a time are handed to Python."""
    conf = df.sparkSession.conf
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
    before = {k: conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        return written(df, name)
    finally:
        for k, v in before.items():
            conf.set(k, v)


@dataclass
class Model:
    """A trained model: its table in the shared folder, and exact totals."""
    table: DataFrame            # place, seg, bits, words_h, words_n
    segments: int
    parts: Parts
    bytes: int                  # of the filter
    tokens: int                 # N
    vocabulary: int             # V
    params: Params

    def words(self) -> DataFrame:
        return self.table.select(F.explode(F.arrays_zip("words_h", "words_n")).alias("w")).select(
            F.col("w.words_h").alias("h"), F.col("w.words_n").alias("n"))

    def total(self) -> float:
        return float(self.tokens + self.vocabulary + 1)


def train(texts: DataFrame, p: Params = Params()) -> Model:
    """Counts over every row of ``texts`` (``text``; null: empty)."""
    segments = p.segments_per_partition * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts_of(segments, p)
    made = _kept(segment_tables(counts(texts, parts), segments, parts.n, p), "filter-segments")
    size, tokens, words = made.agg(
        F.sum(F.octet_length("bits")), F.sum(F.aggregate("words_n", F.lit(0).cast("long"), lambda s, n: s + n)),
        F.sum(F.size("words_n"))).first()
    return Model(made, segments, parts, size or 0, tokens or 0, words or 0, p)


def _share_filter(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The filter's words (at most broadcast_bytes, checked by the caller) and segment starts."""
    sizes = np.zeros(model.segments, dtype=np.int64)
    for seg, size in model.table.select("seg", F.octet_length("bits")).collect():
        sizes[seg] = size // 8
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.zeros(max(1, int(starts[-1])), dtype=np.uint64)
    for seg, bits in model.table.select("seg", "bits").toLocalIterator():
        data[starts[seg]:starts[seg + 1]] = np.frombuffer(bits, dtype="<u8")
    return data, starts


def _log_share(word_n: np.ndarray, before_n: np.ndarray, pair_n: np.ndarray, total: float, w: float) -> np.ndarray:
    """log10 of the interpolated probability of each token."""
    plain = (word_n + 1) / total
    share = np.minimum(pair_n, before_n) / np.maximum(before_n, 1)
    return np.log10(np.where(before_n > 0, (1 - w) * plain + w * share, plain))


def _frequent(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and exact counts of the commonest words, a table of bounded size."""
    top = model.words().orderBy(F.desc("n"), "h").limit(model.params.frequent_words).toPandas()
    h, n = top["h"].to_numpy(dtype=np.int64).view(np.uint64), top["n"].to_numpy(dtype=np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _look_up(h: np.ndarray, known: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Exact count of each hash, 0 where it is not in the table."""
    if not len(known):
        return np.zeros(len(h), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, n[at], 0)


class _Known:
    """What a task knows of its words: exact count (0: not a frequent one) and the filter's estimate."""

    def __init__(self, known: np.ndarray, known_n: np.ndarray, table: Filter):
        self.known, self.known_n, self.table = known, known_n, table
        self.words: _Words | None = None

    def of(self, words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, exact, estimate) of all ``words`` so far; only new ones are looked up."""
        if words is not self.words:
            self.words = words
            self.hashes, self.exact, self.estimate = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        new = np.array(words.hashes[len(self.hashes):], dtype=np.uint64)
        self.hashes = np.r_[self.hashes, new]
        self.exact = np.r_[self.exact, _look_up(new, self.known, self.known_n)]
        self.estimate = np.r_[self.estimate, self.table.counts(new)]
        return self.hashes, self.exact, self.estimate


_SCORED = ("doc_id long, text_hash long, h long, tf long, n_tokens long, known long, exact double, score double")


def _texts_scored(rows: DataFrame, model: Model, shared) -> DataFrame:
    """Two kinds of rows. One per text: tokens, the frequent words' part of the exact score, and
    the model's score (its h only spreads the rows). One per text
    and other word: its hash and how often it occurs; n_tokens is null there."""
    total, p, segments = model.total(), model.params, model.segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_n, stored = shared.value
        table = Filter(*stored, segments, p)
        cache = _Known(known, known_n, table)
        for ids, numbers, starts, words in _blocks(batches, _BLOCK_TOKENS):
            hashes, exact_n, estimate = cache.of(words)
            exact_log = np.where(exact_n > 0, np.log10((exact_n + 1) / total), 0.0)
            frequent = exact_n[numbers] > 0
            word_n = estimate[numbers]
            before_n = np.empty_like(word_n)
            before_n[1:] = word_n[:-1]
            before_n[starts] = estimate[0]          # as many ends as texts
            pair_n = table.counts(_pairs(hashes[numbers], starts)[0])
            score = np.add.reduceat(_log_share(word_n, before_n, pair_n, total, p.pair_weight), starts)
            size = np.diff(np.append(starts, len(numbers)))
            doc = pa.array([x[0] for x in ids], pa.int64())
            text = pa.array([x[1] for x in ids], pa.int64())
            spread = _mix(np.array([x[0] or 0 for x in ids], dtype=np.int64).view(np.uint64)
                          + _mix(np.array([x[1] for x in ids], dtype=np.int64).view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [doc, text, _signed(spread), pa.array(np.zeros(len(ids), np.int64)), pa.array(size),
                 pa.array(np.add.reduceat(frequent.astype(np.int64), starts)),
                 pa.array(np.add.reduceat(exact_log[numbers], starts)), pa.array(score)], _NAMES)
            # the others, counted by (text, word)
            row = np.repeat(np.arange(len(ids)), size)[~frequent]
            key, tf = np.unique(row * len(hashes) + numbers[~frequent], return_counts=True)
            row, h = pa.array(key // len(hashes)), hashes[key % len(hashes)]
            none = pa.nulls(len(tf), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc.take(row), text.take(row), _signed(h), pa.array(tf), none, none,
                 pa.nulls(len(tf), pa.float64()), pa.nulls(len(tf), pa.float64())], _NAMES)

    return rows.mapInArrow(run, _SCORED)


_NAMES = [c.split()[0] for c in _SCORED.split(", ")]


def _with_rare_words(scored: DataFrame, model: Model) -> DataFrame:
    """One row per text from both kinds of rows: the exact counts of the other words are joined in."""
    words = model.words().select(F.col("h").alias("w_h"), "n")
    n, word = F.coalesce("n", F.lit(0)), F.col("n_tokens").isNull()
    joined = scored.join(words, F.col("h") == F.col("w_h"), "left")
    rare_known = F.coalesce(F.sum(F.when(word & (n > 0), F.col("tf"))), F.lit(0))
    rare_exact = F.coalesce(F.sum(F.when(word, F.col("tf") * F.log10((n + 1) / model.total()))), F.lit(0.0))
    one = joined.groupBy("doc_id", "text_hash").agg(
        F.count("n_tokens").alias("repeats"), rare_known.alias("rare_known"), rare_exact.alias("rare_exact"),
        *[F.max(c).alias(c) for c in ("n_tokens", "known", "exact", "score")])
    return one.select(
        "doc_id", "text_hash", "n_tokens", (F.col("known") + (F.col("rare_known") / F.col("repeats")).cast("long")).alias("n_known"),
        (F.col("exact") + F.col("rare_exact") / F.col("repeats")).alias("base_score"), "score",
        F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("repeat")).drop("repeat")


_CUT = "block long, doc_id array<long>, text_hash array<long>, size array<int>, numbers binary, words binary"


def _cut(rows: DataFrame) -> DataFrame:
    """One row per block of texts: their ids and sizes, all word numbers packed (the commonest word is 0) and
    the words' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, numbers, starts, words in _blocks(batches, _ASK_TOKENS):
            hashes = np.array(words.hashes, dtype=np.uint64)
            times = np.bincount(numbers, minlength=len(hashes))
            used = np.argsort(-times, kind="stable")[:np.count_nonzero(times)]
            rank = np.zeros(len(hashes), dtype=np.uint64)
            rank[used] = np.arange(len(used), dtype=np.uint64)
            size = np.diff(np.append(starts, len(numbers)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *[pa.array([[x[i] for x in ids]], pa.list_(pa.int64())) for i in (0, 1)],
                 pa.array([size], pa.list_(pa.int32())), pa.array([_pack(rank[numbers])], pa.binary()),
                 pa.array([hashes[used].astype("<u8").tobytes()], pa.binary())], [c.split()[0] for c in _CUT.split(", ")])
            block += 1

    return rows.mapInArrow(run, _CUT)


def _opened(blocks: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, word numbers, first token and number of tokens of each text of block ``i``."""
    size = blocks["size"][i].values.to_numpy().astype(np.int64)
    numbers = _unpack(blocks["numbers"][i].as_py()).astype(np.int64)
    return np.frombuffer(blocks["words"][i].as_py(), dtype="<u8"), numbers, np.cumsum(size) - size, size


_ANSWERS = "block long, place int, words_q binary, words_n binary, pairs_q binary"


def _answers(blocks: DataFrame, model: Model) -> DataFrame:
    """For each block and part, by ascending key: level and exact count of the block's words, level of its pairs."""
    p, segments, parts = model.params, model.segments, model.parts
    n, names = parts.n, [c.split()[0] for c in _ANSWERS.split(", ")]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes, numbers, starts, _ = _opened(batch, i)
                pairs = np.sort(_keys(_pairs(hashes[numbers], starts)[0]))      # np.unique alone would hash, much slower
                pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
                for place, *columns in _parted(parts, (np.sort(_keys(hashes)),), (pairs,)):
                    block = pa.array(np.full(len(place), batch["block"][i].as_py()), pa.int64())
                    yield pa.RecordBatch.from_arrays([place, block, *columns], ["place", "block", "words", "pairs"])

    def answer(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
        part, stored = key[0].as_py() % n, stored.sort_by("seg")
        sizes = np.zeros(segments, dtype=np.int64)
        sizes[stored["seg"].to_numpy()] = [len(x) // 8 for x in stored["bits"].to_pylist()]
        data = np.frombuffer(b"".join(stored["bits"].to_pylist()), dtype="<u8")
        table = Filter(data, np.concatenate([[0], np.cumsum(sizes)]), segments, p)
        known = pa.chunked_array([x.flatten() for x in stored["words_h"].chunks], pa.int64()).to_numpy().view(np.uint64)
        known_n = pa.chunked_array([x.flatten() for x in stored["words_n"].chunks], pa.int64()).to_numpy()
        order = np.argsort(known)
        levels = lambda h: np.concatenate([table.levels(x) for x in np.split(h, range(_PROBED, len(h), _PROBED))])
        words, words_size = _keys_of(asked["words"].to_pylist(), part, n)
        pairs, pairs_size = _keys_of(asked["pairs"].to_pylist(), part, n)
        words, pairs = _hashes(words), _hashes(pairs)
        columns = [[_pack(x) for x in np.split(got, np.cumsum(size)[:-1])] if len(size) else [] for got, size in (
            (levels(words), words_size), (_look_up(words, known[order], known_n[order]), words_size),
            (levels(pairs), pairs_size))]
        return pa.table([asked["block"], asked["place"], *[pa.array(c, pa.binary()) for c in columns]], names)

    asked = blocks.mapInArrow(ask, "place int, block long, words binary, pairs binary")
    return asked.groupBy("place").cogroup(model.table.groupBy("place")).applyInArrow(answer, _ANSWERS)


_RESULT = "doc_id long, text_hash long, n_tokens long, n_known long, base_score double, score double"


def _asked_scores(rows: DataFrame, model: Model) -> DataFrame:
    """The result of ``score`` without a broadcast of the filter: blocks of texts ask its parts."""
    total, p, parts = model.total(), model.params, model.parts.n
    values, names = level_values(p.base), [c.split()[0] for c in _RESULT.split(", ")]

    def in_order(keys: np.ndarray, got: np.ndarray) -> np.ndarray:
        """Answers came by part; here by ``keys``, which are sorted."""
        out = np.empty(len(keys), dtype=np.int64)
        out[_by_part(keys, parts)[0]] = got
        return out

    def finish(key: tuple, answers: pa.Table, blocks: pa.Table) -> pa.Table:
        answers = answers.take(np.argsort(answers["place"].to_numpy() % parts))
        words_q, words_n, pairs_q = (_joined(answers[c].to_pylist()) for c in ("words_q", "words_n", "pairs_q"))
        hashes, numbers, starts, size = _opened(blocks, 0)
        keys = _keys(hashes)
        order = np.argsort(keys)
        estimate, exact = np.empty(len(keys)), np.empty(len(keys), dtype=np.int64)
        estimate[order], exact[order] = values[in_order(keys[order], words_q)], in_order(keys[order], words_n)
        pairs, at = np.unique(_keys(_pairs(hashes[numbers], starts)[0]), return_inverse=True)
        pair_n = values[in_order(pairs, pairs_q)][at]
        word_n = estimate[numbers]
        before_n = np.empty_like(word_n)
        before_n[1:] = word_n[:-1]
        before_n[starts] = estimate[np.argmax(hashes == END)]       # as many ends as texts
        return pa.table([
            blocks["doc_id"][0].values, blocks["text_hash"][0].values, pa.array(size),
            pa.array(np.add.reduceat((exact > 0).astype(np.int64)[numbers], starts)),
            pa.array(np.add.reduceat(np.log10((exact + 1) / total)[numbers], starts)),
            pa.array(np.add.reduceat(_log_share(word_n, before_n, pair_n, total, p.pair_weight), starts))], names)

    blocks = _kept(_cut(rows), "blocks")
    answers = _kept(_answers(blocks, model), "answers")
    return answers.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(finish, _RESULT)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``text_hash``, n_tokens, n_known (tokens that training has seen), base_score
    (log10, exact add-one words) and score (log10, the model) of every row of ``docs``
    (``doc_id``, ``text``; other columns are ignored).

    Ids are numbers. Null and empty text: the end alone. Null ``doc_id`` and repeated rows: scored like any other
    row. Empty table: no rows. A model trained on nothing gives every token the same probability.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    if model.bytes > model.params.broadcast_bytes:
        return _asked_scores(rows, model)
    shared = spark.sparkContext.broadcast((*_frequent(model), _share_filter(model)))
    return _with_rare_words(_texts_scored(rows, model, shared), model).select(
        "doc_id", "text_hash", "n_tokens", "n_known", "base_score", "score")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids: null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
