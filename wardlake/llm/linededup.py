"""Line dedup with levelled sorted runs of line hashes.

A run is a table of (h1, h2, n_docs): the 128-bit hash of a line key and the number
of documents that hold it, bucketed by h1 and sorted by (h1, h2). A new batch counts
its keys, merge-anti-joins them with the keys that some run already knows to be
frequent (nothing more is to be learnt about those), and adds the rest as a run of
level 0. ``fanout`` runs of one level are compacted into one run of the next, which
sums their counts. All runs together give the exact verdict "found in at least
``min_docs`` documents" for every key.

Scale: counts are combined before each shuffle, so a line that stands in a third of
all documents is one row per task. Runs are bucketed alike, so only the batch moves
in a merge. The table's frequent lines are never collected or force-broadcast; the
lookup of lines is a plain equi-join that AQE splits at hot keys. Texts are shuffled
once, by document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, delete, shared_path, written

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


class LineRuns:
    """The levelled runs of one corpus, as tables under the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 2, min_chars: int = 1):
        self.spark, self.min_docs, self.fanout, self.min_chars = spark, min_docs, fanout, min_chars
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        self.paths[name] = shared_path(self.spark, name)
        df.write.bucketBy(self.buckets, "h1").sortBy(*KEY).option("path", self.paths[name]).saveAsTable(name)
        return name

    def _add(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._add(level + 1, self._write(self._merge(merged).repartition(self.buckets, "h1")))
            self._forget(merged)

    def _merge(self, names: list[str]) -> DataFrame:
        """The runs merge-joined one after another, counts of a key summed. (No union: Spark 4.1
        takes a union of bucketed scans for one that is bucketed too and leaves out the shuffle.)"""
        merged = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("n_docs").alias("o_n"))
            merged = merged.join(other.hint("merge"), (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2")), "full").select(
                F.coalesce("h1", "o1").alias("h1"), F.coalesce("h2", "o2").alias("h2"),
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("o_n", F.lit(0))).alias("n_docs"))
        return merged

    def _forget(self, names: list[str]) -> None:
        for name in names:      # external tables: their files stay until they are deleted
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, self.paths.pop(name))

    def add(self, docs: DataFrame) -> None:
        """Count the line keys of a batch (``text``), each once per row, and add them."""
        keys = F.array_distinct(F.transform(_lines(F.col("text")), line_key))
        counts = (docs.select(F.explode(keys).alias("k"))
                  .where(F.length("k") >= self.min_chars)
                  .groupBy(*_hashes(F.col("k"))).agg(F.count(F.lit(1)).alias("n_docs"))
                  .repartition(self.buckets, "h1"))
        for name in self.runs():
            known = self.spark.table(name).where(F.col("n_docs") >= self.min_docs).select(*KEY)
            counts = counts.join(known.hint("merge"), KEY, "left_anti")
        self._add(0, self._write(counts))

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents so far."""
        names = self.runs()
        if not names:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return self._merge(names).where(F.col("n_docs") >= self.min_docs).select(*KEY)

    def close(self) -> None:
        self._forget(self.runs())
        self.levels = []


def batches(docs: DataFrame, n: int) -> list[DataFrame]:
    """``docs`` in ``n`` ranges of ``doc_id`` (null ids with the first). A table laid
    down in id order is read once: row-group statistics prune the other ranges."""
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if lo is None or n == 1:
        return [docs]
    cuts = [lo + (hi - lo + 1) * i // n for i in range(1, n)]
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges, edges[1:]):
        cond = F.lit(True)
        if a is not None:
            cond = cond & (F.col("doc_id") >= a)
        if b is not None:
            cond = cond & (F.col("doc_id") < b)
        out.append(docs.where(cond | F.col("doc_id").isNull() if a is None else cond))
    return out


def dedup_lines(docs: DataFrame, min_docs: int = 10, n_batches: int = 4, fanout: int = 2,
                min_chars: int = 1) -> DataFrame:
    """Drop every line whose key stands in at least ``min_docs`` rows of ``docs``.

    Returns ``doc_id``, ``n_lines``, ``n_dropped``, ``kept_text`` and ``row``, a struct
    of all columns of the input (so no column name can clash). A key is the line
    without white space at its ends, A-Z lower-cased; keys under ``min_chars`` code
    points are never dropped. Null and empty text: one empty line, which stays. A text
    that loses all lines becomes empty. Repeated rows count as so many documents; null
    ``doc_id``: treated like any other row. Ids are numbers. Empty table: no rows.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, min_docs, fanout, min_chars)
    thin = docs.select("doc_id", "text")
    for part in batches(thin, n_batches):
        runs.add(part)
    frequent = written(runs.frequent(), "frequent-lines")
    runs.close()

    text_hash = F.xxhash64("text")
    found = (thin.select("doc_id", text_hash.alias("th"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .select("doc_id", "th", "pos", line_key(F.col("line")).alias("k"))
             .where(F.length("k") >= min_chars)
             .select("doc_id", "th", "pos", *_hashes(F.col("k"))))
    dropped = (found.join(frequent, KEY)
               .groupBy(F.col("doc_id").alias("d_id"), F.col("th").alias("d_th"))
               .agg(F.collect_set("pos").alias("drop_pos")))
    rows = docs.select("doc_id", text_hash.alias("th"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = (rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")), "left")
              .select("doc_id", "row", "drop_pos", _lines(F.col("row.text")).alias("lines")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop_pos"))
    text = F.when(F.col("drop_pos").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n"))
    return joined.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop_pos"), F.lit(0)).cast("long").alias("n_dropped"),
        text.alias("kept_text"), "row")
