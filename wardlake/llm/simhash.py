"""SimHash near-dedup with covering locality-sensitive hashing.

Covering tables: every bit position i of a 64-bit fingerprint gets a non-zero vector
m(i) of radius + 1 bits, and every non-zero vector v of radius + 1 bits is a table
whose mask keeps the positions with odd parity of v & m(i). Two fingerprints that
differ in at most ``radius`` positions have at most ``radius`` vectors m(i) there;
these span less than the whole space, so some v is orthogonal to all of them, and in
that table the two masked fingerprints are equal. No pair within the radius is lost.

Scale: fingerprints are made where the rows lie; copies collapse to one fingerprint
before the tables are built. A bucket of a table is checked in one task only up to
``bucket_size`` fingerprints. The fingerprints of larger buckets are linked exactly
through Hamming balls (two fingerprints are within 3 bits if and only if a point lies
within 1 bit of one and 2 bits of the other), in linear work and without pairs. Links
and components stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components

BITS = 64
SEED = 42
_CHUNK = 1 << 16


def masks(radius: int) -> list[int]:
    """The covering family: 2**(radius + 1) - 1 masks of 64 bits."""
    n = 2 ** (radius + 1) - 1
    vectors = [1 + i % n for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (v & vectors[i]).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of the word shingles of ``text`` (UTF-8)."""
    words = (text or b"").lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[j:j + shingle]), SEED)
                         for j in range(at, min(n, at + _CHUNK))), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("binary"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def _forest(bucket: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join the fingerprints of a bucket as its links do, one less than
    the nodes of each component."""
    near = np.bitwise_count(bucket[:, None] ^ bucket[None, :]) <= radius
    left, out = set(range(len(bucket))), []
    while left:
        root = left.pop()
        todo = [root]
        while todo:
            for j in [j for j in np.flatnonzero(near[todo.pop()]).tolist() if j in left]:
                left.discard(j)
                todo.append(j)
                out.append((root, j))
    return out


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for bucket in batch.column(0):
                fp = np.array(bucket.as_py(), dtype=np.int64)
                for i, j in _forest(fp.view(np.uint64), radius):
                    a.append(int(fp[i]))
                    b.append(int(fp[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def _ball_links(fps: DataFrame, radius: int) -> DataFrame:
    """Exact links of fingerprints of crowded buckets, radius 1 to 3."""
    one = [_signed(1 << i) for i in range(BITS)]
    two = [_signed(1 << i | 1 << j) for i in range(BITS) for j in range(i)]
    inner, outer = ([0], one) if radius == 1 else ([0, *one], two if radius == 3 else [])

    def ball(flips: list[int]) -> DataFrame:
        # the flip list is a small array column, not one expression per flip
        spread = F.transform(F.from_json(F.lit(str(flips)), "array<bigint>"), lambda x: F.col("fp").bitwiseXOR(x))
        return fps.select(F.col("fp"), F.explode(spread).alias("z"))

    centre = ball(inner)
    hub = centre.groupBy("z").agg(F.min("fp").alias("a"))
    members = centre.unionByName(ball(outer)) if outer else centre
    return members.join(hub, "z").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, radius: int = 3, bucket_size: int = 512) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fps`` (fp) that connect exactly what
    the pairs within ``radius`` bits connect."""
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks(radius))])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowd = written(rows.join(sizes, ["t", "key"]), "buckets")
    small = (crowd.where(F.col("n") <= bucket_size).groupBy("t", "key")
             .agg(F.collect_list("fp").alias("fps")))
    large = crowd.where(F.col("n") > bucket_size).select("fp").distinct()
    out = _bucket_links(small, radius)
    if not large.isEmpty():
        out = out.unionByName(_ball_links(large, radius))
    return out


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, bucket_size: int = 512) -> DataFrame:
    """Near-duplicate group of every row of ``docs`` (``doc_id``, ``text``; other
    columns are ignored): ``doc_id``, ``text_hash``, ``fp`` (the fingerprint as a signed
    long), ``root`` (smallest fingerprint of the group) and ``component_id``, the
    smallest ``doc_id`` of the group.

    A text of fewer words than ``shingle`` has one shingle, all its words. Null, empty
    and white-space texts have fingerprint zero and are linked like any other. Ids are numbers. Repeated
    rows each give a row. Null ``doc_id``: the row is grouped, but its id is never a
    group's smallest unless all are null (then null). Empty table: no rows.
    """
    if not 1 <= radius <= 3:
        raise ValueError("radius must be 1, 2 or 3")
    rows = written(fingerprints(docs, shingle), "fingerprints")
    per_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    roots = components(links(per_fp.select("fp"), radius, bucket_size))
    named = (per_fp.join(roots, per_fp["fp"] == roots["node"], "left")
             .select("fp", "lowest", F.coalesce("root", "fp").alias("root")))
    lowest = named.groupBy("root").agg(F.min("lowest").alias("component_id"))
    return rows.join(named.select("fp", "root").join(lowest, "root"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group: the one with the smallest ``doc_id`` (null
    last; ties by text hash, equal rows by either)."""
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
    keys = first.select(F.col("k.doc_id").alias("_keep_id"), F.col("k.text_hash").alias("_keep_hash"))
    # rows that share an id and a text are one document: the shuffle of the join serves this too
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    kept = rows.join(keys, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_hash") == F.col("_keep_hash")))
    return kept.groupBy("_id", "_hash").agg(F.first("row").alias("row")).select("row.*")
