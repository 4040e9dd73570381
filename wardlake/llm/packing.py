"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n**2`` (the feed-forward
and the attention part of a step). Pieces go, in descending length, to the
lowest-cost sequence that still has room for them; a piece that fits nowhere
whole is cut at the room of the lowest-cost open sequence.

Scale: each input partition is packed where it lies, so nothing is shuffled.
A task holds one block of remainders (``block_tokens``) at a time; what does not
fill a sequence moves on to the task's next block. The last rest of a task, under
``max_tokens``, is laid into sequences whose lengths are powers of two, which need
no padding. A hot source or a group of copies only adds rows to its partitions.
The packing of a partition depends on that partition alone, so a task that is run
again after a lost executor gives the same sequences.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = ("doc_id long, start long, length long, token_bytes binary, doc_tokens long, "
          "sequence_id long, offset long, piece_cost double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("token_bytes", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("piece_cost", pa.float64())])
#: Texts with other characters, or with the end-of-text marker, are left to the
#: ``tokenizers`` library itself: the two libraries' Unicode tables could differ there.
_RARE = re.compile("[^\x00-ӿ -⁯₠-₿぀-ヿ一-龥가-힣]|<\\|endoftext\\|>")
_LOADED: dict[tuple, Encoder] = {}


class Encoder:
    """Ids of ``tokenizer_path`` (a ``tokenizers`` JSON file). With ``ranks_path``, the
    same vocabulary as byte-pair ranks, common texts take the faster library."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(tokenizer_path)
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not _RARE.search(text):
            out = self.fast.encode_ordinary(text)
        else:
            out = self.full.encode(text, add_special_tokens=False).ids
        return np.array([*out, 0], dtype="<u4")


def _encoder(*key) -> Encoder:
    if key not in _LOADED:
        _LOADED[key] = Encoder(*key)
    return _LOADED[key]


def balance(lengths: list[int], capacity: int, n: int, linear: float, quadratic: float):
    """Deal ``lengths`` to ``n`` sequences of ``capacity``. Returns placements
    (item, start in item, length, sequence, offset) and the rests that found no
    room, (item, start, length)."""
    room = np.full(n, capacity, dtype=np.int64)
    cost = np.zeros(n)
    placed, rest = [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[item]
        while left:
            open_ = room >= left
            if not open_.any():
                open_ = room > 0
                if not open_.any():
                    rest.append((item, start, left))
                    break
            s = int(np.argmin(np.where(open_, cost, np.inf)))
            take = int(min(left, room[s]))
            placed.append((item, start, take, s, int(capacity - room[s])))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return placed, rest


def powers_of_two(n: int) -> list[int]:
    """The binary digits of ``n``, largest first: 700 -> 512, 128, 32, 16, 8, 4."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    def __init__(self, first_id: int, max_tokens: int, linear: float, quadratic: float):
        self.next_id, self.max_tokens, self.linear, self.quadratic = first_id, max_tokens, linear, quadratic
        self.items: list[tuple] = []      # (doc_id, start, ids, doc_tokens) that wait for a sequence
        self.waiting = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.max_tokens
        for start in range(0, whole, self.max_tokens):
            self._emit(doc_id, start, ids[start:start + self.max_tokens], len(ids), self.next_id, 0)
            self.next_id += 1
        if whole < len(ids):
            self.items.append((doc_id, whole, ids[whole:], len(ids)))
            self.waiting += len(ids) - whole

    def pack(self) -> None:
        """Fill as many whole sequences as the waiting tokens give."""
        n = self.waiting // self.max_tokens
        self._deal(n, self.max_tokens)

    def finish(self) -> None:
        self.pack()
        for size in powers_of_two(self.waiting):
            self._deal(1, size)

    def _deal(self, n: int, capacity: int) -> None:
        placed, rest = balance([len(x[2]) for x in self.items], capacity, n, self.linear, self.quadratic)
        for item, start, length, s, offset in placed:
            doc_id, first, ids, total = self.items[item]
            self._emit(doc_id, first + start, ids[start:start + length], total, self.next_id + s, offset)
        self.next_id += n
        self.items = [(self.items[i][0], self.items[i][1] + start, self.items[i][2][start:], self.items[i][3])
                      for i, start, _ in rest]
        self.waiting = sum(len(x[2]) for x in self.items)

    def _emit(self, doc_id, start, ids, total, sequence, offset) -> None:
        n = len(ids)
        self.rows.append((doc_id, start, n, ids.tobytes(), total, sequence, offset,
                          self.linear * n + self.quadratic * n * n))

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [[] for _ in _ARROW]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
         max_tokens: int = 1024, linear: float = 1.0, quadratic: float = 1.0 / 1024,
         block_tokens: int = 1 << 20) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    A row's ids are its text's, then id 0. Null and empty text: the id 0 alone. Null
    ``doc_id`` and repeated rows: packed like any other row, each on its own. Empty
    table: no piece. ``token_bytes`` holds the ids as little-endian unsigned 32-bit
    numbers. Within a sequence the offsets run gapless from 0; every sequence is
    ``max_tokens`` long, or a power of two.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path, ranks_path, pattern)
        packer = _Packer(TaskContext.get().partitionId() << 40, max_tokens, linear, quadratic)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, enc.ids(text.as_py() or ""))
                if packer.waiting >= block_tokens:
                    packer.pack()
                if len(packer.rows) >= 4096:
                    yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
