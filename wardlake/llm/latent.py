"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages. A distributed randomised SVD of their TF-IDF matrix
(document frequencies from the whole corpus) gives a latent space. Windows of every document
are projected into it and compared with passages by cosine; a pair above the threshold is a
candidate. A candidate counts as a leak if the longest common subsequence of item and region
covers most of the item, and, for looser matches (paraphrases), if the item's answer, its last
sentence, is there too. Items under ``min_words`` words are matched as whole phrases instead.
Scripts without spaces (Chinese, Japanese, Thai and others) count each character as a word.

Only windows that can pass the check are projected. A region with the share ``min_lcs`` of a
passage's n words lacks at most the other n - need of them; of any n - need + k of its words it
holds k. The rarest are the passage's marks: places where k of them lie within the length of a
region are found by one sort of (passage, position), and the windows there are compared with
that passage alone, unless the words there cannot share need words with it, each counted as
often as the passage has it. No pair that passes the check at a passage is lost by that.

Scale: documents are read twice (frequencies, search) for each round of blocks, never shuffled,
and cut into words once per reading. Items go in blocks of bounded size, and as many blocks form
a round as fit ``round_bytes`` of broadcast basis. A passage that stands in a third of all documents
only gives as many result rows.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

_BLOCK_WORDS = 1 << 17
_MARKS = string.punctuation.encode()
_SENTENCE = re.compile("[.?!\u3002\uff01\uff1f\n]+")
#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
                       "\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WIDE_MARKS = re.compile("[\u3000-\u3003\u3008-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


@dataclass(frozen=True)
class Params:
    window: int = 32            # words of the largest window; shorter items get windows of their own length
    rank: int = 128             # dimensions of the latent space
    oversample: int = 8
    passes: int = 2             # power iterations of the SVD
    min_cosine: float = 0.6
    min_lcs: float = 0.6        # share of the item's words in common order
    sure_lcs: float = 0.85      # from here on no answer check is needed
    min_answer: float = 0.5     # share of the answer's words in common order
    min_words: int = 5          # items with fewer words are matched as whole phrases
    marks: int = 3              # k: marks that must lie together
    block_items: int = 2000
    block_bytes: int = 1 << 20
    round_bytes: int = 64 << 20


def normal(text: str | None) -> list[bytes]:
    """Words in lower case without ASCII marks (marks alone are no word); characters of unspaced
    scripts are words."""
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", _WIDE_MARKS.sub(" ", text))
    return text.encode("utf-8", "replace").translate(None, _MARKS).split()


def numbers(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The words' numbers; -1 for words of no item."""
    words = normal(text)
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a row of bits for each number of ``b``."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Block:
    """A bounded part of the benchmark, with its vocabulary and, once fitted, its basis."""
    items: list[tuple[int | None, list[int], list[int]]]        # item_id, words, words of the answer
    vocabulary: dict[bytes, int]
    passages: list[tuple[int, int, int]] = field(default_factory=list)     # item, first word, words
    phrases: list[tuple[int | None, list[int]]] = field(default_factory=list)       # item_id, words
    idf: np.ndarray | None = None       # one more than words: the last stands for all other words
    weighted: np.ndarray | None = None  # the basis, each row times its word's weight
    latent: np.ndarray | None = None    # passages x rank, unit length


def _blocks(benchmark: DataFrame, p: Params) -> Iterator[Block]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    n, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(1, math.ceil(n / p.block_items), math.ceil((size or 0) / p.block_bytes))
    for part in range(parts):
        # distinct rows spread evenly: bounded by block_items and block_bytes on average
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        block = _block(mine.collect(), p)
        if block.passages or block.phrases:
            yield block


def _block(rows: list, p: Params) -> Block:
    block = Block([], {})

    def ids(text: str) -> list[int]:
        return [block.vocabulary.setdefault(w, len(block.vocabulary)) for w in normal(text)]

    for row in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"])):
        words = ids(row["text"])
        if len(words) < p.min_words:
            if words:
                block.phrases.append((row["item_id"], words))
            continue
        sentences = [s for s in map(ids, _SENTENCE.split(row["text"])) if s]
        block.items.append((row["item_id"], words, sentences[-1]))
        step, last = p.window // 2, max(len(words) - p.window, 0)
        for at in sorted({*range(0, last, step), last}):
            block.passages.append((len(block.items) - 1, at, min(p.window, len(words) - at)))
    return block


def _rounds(blocks: Iterator[Block], p: Params) -> Iterator[list[Block]]:
    """Blocks whose bases together fit ``round_bytes`` (one block at least)."""
    some, size = [], 0
    for block in blocks:
        mine = len(block.vocabulary) * (4 * p.rank + 100)
        if some and size + mine > p.round_bytes:
            yield some
            some, size = [], 0
        some.append(block)
        size += mine
    if some:
        yield some


def _vocabulary(blocks: list[Block]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for block in blocks:
        for word in block.vocabulary:
            out.setdefault(word, len(out))
    return out


def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """Rows of ``docs`` (null: empty) and how many of them hold each word."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        found, n = np.zeros(len(vocabulary), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                got = numbers(text.as_py(), vocabulary)
                found[np.unique(got[got >= 0])] += 1
        word = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, word], pa.int64()), pa.array(np.r_[n, found[word]], pa.int64())],
                                         ["word", "df"])

    rows = (docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, df long")
            .groupBy("word").agg(F.sum("df").alias("df")).toArrow())        # at most the round's words
    word, count = (rows.column(c).to_numpy() for c in ("word", "df"))
    df = np.zeros(len(vocabulary))
    df[word[word >= 0]] = count[word >= 0]
    return int(count[word < 0].sum()), df


def _fit(docs: DataFrame, block: Block, p: Params) -> None:
    """Weights and latent basis of one block alone."""
    n, df = _frequencies(docs, block.vocabulary)
    _fit_basis(docs.sparkSession, block, n, df, p)


def _fit_basis(spark: SparkSession, block: Block, n: int, df: np.ndarray, p: Params) -> None:
    """Weights and latent basis of a block, from the document frequencies of its words.

    Randomised SVD of the passages' TF-IDF matrix A (rows spread over the cluster): from a
    random M, each pass sends A' A M (one row per word) and the small Gram matrix of A M back;
    its Cholesky factor makes the columns of A M orthonormal. The last pass gives B = Q' A,
    whose right singular vectors are the basis."""
    words = len(block.vocabulary)
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    block.idf = np.r_[idf, idf.mean()]
    if not block.passages:
        return
    columns = min(p.rank + p.oversample, len(block.passages), words)
    source = [(block.items[i][1][at:at + size],) for i, at, size in block.passages]
    rows = spark.createDataFrame(source, "words array<long>").repartition(spark.sparkContext.defaultParallelism)
    m = np.random.default_rng(1).normal(size=(words, columns))
    for _ in range(p.passes + 1):
        shared = spark.sparkContext.broadcast((idf, m))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, m = shared.value
            back, gram = np.zeros_like(m), np.zeros((m.shape[1], m.shape[1]))
            for batch in batches:
                for row in batch.column(0):
                    word, tf = np.unique(row.as_py(), return_counts=True)
                    x = tf * idf[word]
                    y = x @ m[word]
                    back[word] += np.outer(x, y)
                    gram += np.outer(y, y)
            used = np.flatnonzero(back.any(axis=1))
            lines = np.vstack([back[used], gram])
            yield pa.RecordBatch.from_arrays([pa.array([*used, *range(-len(gram), 0)], pa.int64()),
                                              pa.ListArray.from_arrays(np.arange(len(lines) + 1, dtype=np.int32) * lines.shape[1],
                                                                       pa.array(lines.ravel()))], ["at", "v"])

        def add(a, b):
            return F.zip_with(a, b, lambda x, y: x + y)

        zero = F.array_repeat(F.lit(0.0), columns)
        got = (rows.mapInArrow(run, "at long, v array<double>").groupBy("at")      # one row per word and task
               .agg(F.aggregate(F.collect_list("v"), zero, add).alias("v")).toArrow())
        at = got.column("at").to_numpy()
        lines = got.column("v").combine_chunks().flatten().to_numpy().reshape(-1, columns)
        back, gram = np.zeros((words, columns)), np.zeros((columns, columns))
        back[at[at >= 0]] = lines[at >= 0]
        gram[at[at < 0]] = lines[at < 0]
        root = np.linalg.cholesky(gram + np.eye(columns) * (1e-10 * np.trace(gram) + 1e-30))
        m = back @ np.linalg.inv(root).T      # A' Q; the factor is small
        shared.unpersist()
    # left singular vectors of m, by the small matrix m' m
    size, turn = np.linalg.eigh(m.T @ m)
    best = np.flatnonzero(size > 1e-12 * size[-1])[::-1][:p.rank]
    place(block, m @ turn[:, best] / np.sqrt(size[best]))


def place(block: Block, basis: np.ndarray) -> None:
    """Put the passages into the space of ``basis`` (words x rank)."""
    block.weighted = (block.idf[:, None] * np.vstack([basis, np.zeros(basis.shape[1])])).astype(np.float32)
    latent = np.array([block.weighted[block.items[i][1][at:at + n]].sum(axis=0) for i, at, n in block.passages])
    block.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)


@dataclass
class Index:
    """Passages and phrases of a round's blocks by their marks, over the round's vocabulary."""
    first: np.ndarray       # places in ``passage`` of each word's passages, and the end
    passage: np.ndarray
    block: np.ndarray       # of each passage: its block, its number there, its words,
    number: np.ndarray
    size: np.ndarray
    need: np.ndarray        # how many of its words a region must hold,
    together: np.ndarray    # and how many of its marks, within
    span: np.ndarray        # this many words
    words: list[tuple[np.ndarray, np.ndarray]]      # its distinct words, as its block numbers them, and how often it has each
    local: list[np.ndarray]         # per block: number of each of the round's words in it
    phrase_first: np.ndarray
    phrase: np.ndarray
    phrase_words: np.ndarray        # phrases x most words; -1 where a phrase has ended
    phrase_mark: np.ndarray         # place of a phrase's rarest word
    phrase_item: list[int | None]


def _by_word(pairs: list[tuple[int, int]], words: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = sorted(pairs)
    count = np.bincount([w for w, _ in pairs], minlength=words + 1) if pairs else np.zeros(words + 1, dtype=np.int64)
    return np.r_[0, np.cumsum(count)], np.array([k for _, k in pairs], dtype=np.int64)


def _slack(words: int, p: Params) -> int:
    return max(p.window // 4, words // 4)


def _index(blocks: list[Block], vocabulary: dict[bytes, int], p: Params) -> Index:
    block_of, number, size, needs, together, span, distinct, local, pairs = [], [], [], [], [], [], [], [], []
    phrases, phrase_pairs = [], []
    for b, block in enumerate(blocks):
        place = np.array([vocabulary[w] for w in block.vocabulary], dtype=np.int64)
        inverse = np.full(len(vocabulary) + 1, len(place), dtype=np.int32)
        inverse[place] = np.arange(len(place))
        local.append(inverse)
        for k, (i, at, n) in enumerate(block.passages):
            words = block.items[i][1]
            need = max(1, math.ceil(p.min_lcs * n - 1e-9))
            few = min(p.marks, need)
            word, times = np.unique(words[at:at + n], return_counts=True)
            rare = np.argsort(-block.idf[word], kind="stable")
            marks = rare[:1 + int(np.searchsorted(np.cumsum(times[rare]), n - need + few))]
            pairs += [(int(place[w]), len(size)) for w in word[marks]]
            block_of.append(b)
            number.append(k)
            size.append(n)
            needs.append(need)
            distinct.append((word, times))
            together.append(few)
            span.append(n + p.window // 2 + 2 * _slack(n, p))
        for item, words in block.phrases:
            mark = int(np.argmax(block.idf[words]))
            phrase_pairs.append((int(place[words[mark]]), len(phrases)))
            phrases.append((item, [int(place[w]) for w in words], mark))
    first, passage = _by_word(pairs, len(vocabulary))
    phrase_first, phrase = _by_word(phrase_pairs, len(vocabulary))
    longest = max((len(w) for _, w, _ in phrases), default=1)
    return Index(first, passage, *(np.array(x, dtype=np.int64) for x in (block_of, number, size, needs, together, span)), distinct, local,
                 phrase_first, phrase, np.array([w + [-1] * (longest - len(w)) for _, w, _ in phrases], dtype=np.int64).reshape(-1, longest),
                 np.array([m for _, _, m in phrases], dtype=np.int64), [i for i, _, _ in phrases])


def _met(ids: np.ndarray, first: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, entry) of every word of ``ids`` that has entries."""
    count = (first[1:] - first[:-1])[ids]       # -1 stands for other words, the last, which has none
    at = np.flatnonzero(count)
    count = count[at]
    before = np.cumsum(count) - count
    place = np.arange(count.sum()) - np.repeat(before - first[ids[at]], count)
    return np.repeat(at, count), entries[place]


def _places(ids: np.ndarray, starts: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(document, passage, first and last place) of stretches where enough of a passage's marks lie
    together. ``ids`` holds some documents' words one after another, ``starts`` where each begins, and the end."""
    at, passage = _met(ids, index.first, index.passage)
    if not len(at):
        return
    gap = int(index.span.max())
    spread = starts[:-1] + np.arange(len(starts) - 1) * gap         # documents lie too far apart to share a stretch
    doc = np.searchsorted(starts[1:], at, side="right")
    wide = len(ids) + len(starts) * gap + 1
    key = np.sort(passage * wide + at + doc * gap)
    passage = key // wide
    end = np.arange(len(key)) + index.together[passage] - 1
    inside = end < len(key)
    inside[inside] = key[end[inside]] - key[inside] < index.span[passage[inside]]
    low = np.flatnonzero(inside)
    if not len(low):
        return
    high, passage = key[end[low]], passage[low]
    low = key[low]
    cut = np.flatnonzero(np.r_[True, np.diff(low) > index.size[passage[1:]]])
    last = np.r_[cut[1:], len(low)] - 1
    for k, a, b in zip(passage[cut].tolist(), low[cut].tolist(), high[last].tolist()):
        d = int(np.searchsorted(spread, a - k * wide, side="right")) - 1
        yield d, k, a - k * wide - d * gap, b - k * wide - d * gap


def _enough(region: np.ndarray, passage: np.ndarray, times: np.ndarray, words: int, need: int, span: int) -> bool:
    """Can some ``span`` words of ``region`` share ``need`` words with a passage, no word more often than
    the passage has it? (``passage``: its distinct words, ``times``: how often.)"""
    found = np.bincount(region, minlength=words)[passage]
    if int(np.minimum(found, times).sum()) < need:
        return False
    member = np.zeros(words, dtype=bool)
    member[passage] = True
    running = np.r_[0, np.cumsum(member[region])]
    return len(region) <= span or int((running[span:] - running[:-span]).max()) >= need


def _windows(ids: np.ndarray, low: int, high: int, start: int, end: int, local: np.ndarray, block: Block, k: int,
             p: Params) -> list[tuple[float, int]]:
    """(cosine, first word) of the windows of a passage's length that meet [low, high] and are near enough to
    it, the nearest first, and of those that overlap by seven eighths the nearest only."""
    n = block.passages[k][2]
    begin, stop = max(start, low - n + 1), min(end, high + n)
    rows = block.weighted[local[ids[begin:stop]]]
    running = np.vstack([np.zeros(rows.shape[1]), np.cumsum(rows, axis=0, dtype=np.float64)])
    first = np.arange(high - begin + 1)
    x = running[np.minimum(first + n, len(rows))] - running[first]
    cosine = (x @ block.latent[k]) / np.maximum(np.linalg.norm(x, axis=1), 1e-9)
    near = np.flatnonzero(cosine >= p.min_cosine)
    out, free, apart = [], np.ones(len(cosine), dtype=bool), max(1, n // 8)
    for w in near[np.argsort(-cosine[near], kind="stable")].tolist():
        if free[w]:
            out.append((float(cosine[w]), begin + w))
            free[max(0, w - apart + 1):w + apart] = False
    return out


def _phrases(ids: np.ndarray, starts: np.ndarray, index: Index) -> Iterator[tuple[int, int | None, int]]:
    """(document, item, first word) of every whole phrase."""
    at, k = _met(ids, index.phrase_first, index.phrase)
    doc = np.searchsorted(starts[1:], at, side="right")
    at = at - index.phrase_mark[k]
    fine = at >= starts[:-1][doc]
    for j in range(index.phrase_words.shape[1]):
        want = index.phrase_words[k, j]
        fine &= (want < 0) | ((at + j < starts[1:][doc]) & (ids[np.minimum(at + j, len(ids) - 1)] == want))
    for d, i, w in zip(doc[fine].tolist(), k[fine].tolist(), (at - starts[:-1][doc])[fine].tolist()):
        yield d, index.phrase_item[i], w


def _leaks(docs: list[np.ndarray], blocks: list[Block], index: Index, p: Params) -> dict[tuple[int, int | None], tuple]:
    """(document, item) -> best checked region: LCS share, answer share, cosine, first word."""
    best: dict[tuple[int, int | None], tuple] = {}
    starts = np.cumsum([0, *map(len, docs)])
    ids = np.concatenate(docs)
    if not len(ids):
        return best
    for doc, item, at in _phrases(ids, starts, index):
        best.setdefault((doc, item), (1.0, 1.0, 1.0, at))
    for doc, k, low, high in _places(ids, starts, index):
        block, local = blocks[index.block[k]], index.local[index.block[k]]
        number, start, end = int(index.number[k]), int(starts[doc]), int(starts[doc + 1])
        i, first, _ = block.passages[number]
        item, words, answer = block.items[i]
        slack = _slack(len(words), p)
        span = int(index.span[k])
        if not _enough(local[ids[max(start, low - span):min(end, high + span)]], *index.words[k], int(local[-1]) + 1, int(index.need[k]), span):
            continue
        for cosine, at in _windows(ids, low, high, start, end, local, block, number, p):
            at -= start
            begin = max(0, at - first - slack)
            region = local[docs[doc][begin:at - first + len(words) + p.window // 2 + slack]].tolist()
            if sum(map(set(region).__contains__, words)) < p.min_lcs * len(words):
                continue        # no common subsequence can be longer than the words found
            lcs = common_subsequence(words, region) / len(words)
            if lcs < p.min_lcs:
                continue
            found = common_subsequence(answer, region) / len(answer)
            if lcs >= p.sure_lcs or found >= p.min_answer:
                best[doc, item] = max(best.get((doc, item), (-1.0,)), (lcs, found, cosine, begin))
                break
    return best


LEAKS = ("doc_id long, text_hash long, item_id long, lcs_share double, answer_share double, cosine double, "
         "first_word long")


def _search(docs: DataFrame, blocks: list[Block], vocabulary: dict[bytes, int], p: Params) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((blocks, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, vocabulary = shared.value
        index = _index(blocks, vocabulary, p)
        for batch in batches:
            out, at = [], 0
            while at < batch.num_rows:
                docs, n = [], 0
                while at + len(docs) < batch.num_rows and n < _BLOCK_WORDS:
                    docs.append(numbers(batch.column(2)[at + len(docs)].as_py(), vocabulary))
                    n += len(docs[-1])
                for (d, item), found in _leaks(docs, blocks, index, p).items():
                    out.append((batch.column(0)[at + d].as_py(), batch.column(1)[at + d].as_py(), item, *found))
                at += len(docs)
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["doc_id", "text_hash", "item_id", "lcs_share", "answer_share", "cosine", "first_word"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")).mapInArrow(run, LEAKS)


def leaks(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """Every (document, benchmark item) leak: ``doc_id``, ``text_hash``, ``item_id``, share of the
    item and of its answer found in order, cosine, and the first word of the region.

    Null and empty texts on either side match nothing. Items under ``min_words`` words match where
    all their words stand in order and unbroken (shares and cosine 1). Ids are numbers; null ids are
    carried as null. Repeated documents and items each give their rows, once per (document id, text,
    item id). Other columns are ignored. An empty table gives no rows.
    """
    out = None
    for blocks in _rounds(_blocks(benchmark, p), p):
        vocabulary = _vocabulary(blocks)
        n, df = _frequencies(docs, vocabulary)
        for block in blocks:
            _fit_basis(docs.sparkSession, block, n, df[[vocabulary[w] for w in block.vocabulary]], p)
        found = _search(docs, blocks, vocabulary, p)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], LEAKS)
    return written(out.dropDuplicates(["doc_id", "text_hash", "item_id"]), "leaks")


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no leak, all columns."""
    bad = found.select(F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    return rows.join(bad, F.col("_id").eqNullSafe(F.col("_leak_id")) & (F.col("_hash") == F.col("_leak_hash")),
                     "left_anti").select("row.*")
