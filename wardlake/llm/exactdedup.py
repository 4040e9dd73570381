"""Exact dedup by a tree merge of sorted digest runs. DataFrame functions only.

Texts are compared after every run of ASCII white space became one space. A digest row
is (d1, sha, n_bytes): a short digest to sort by, the SHA-256 and the length in bytes.
Two rows are merged only if all three agree, at every level, so a clash of the short
digest never joins texts.

Each input partition is a run: its digests, sorted, each with its smallest identifier
and its number of rows. Runs are numbered in base ``fanin``; in round r the ``fanin``
runs whose numbers differ in digit r alone exchange slices: each keeps the digests whose
own digit r is its digit, and merges the ``fanin`` sorted slices it then holds, keeping
the smallest identifier and adding the counts. After all rounds a run holds every row of
the digests that carry its number.

Scale: a run never grows into the whole table, as slices are swapped and not gathered; a
run is itself spread over tasks by digest. A text that stands in a third of all rows is
one row per run after the first merge and at most ``fanin`` rows in every later one.
Runs are written sorted to the shared folder. In the end each row looks up its digest:
the groups of over 1/4096 of the rows, fewer than 4096 of them, are broadcast, and the
others joined, so no join task meets a large group. Texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KEY = ["d1", "sha", "n_bytes"]
#: A group with more than this share of all rows is looked up by broadcast.
_HOT = 4096
#: Bits of monotonically_increasing_id below the partition number.
_ROW_BITS = 33


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, at, d1, sha, n_bytes, row): ``at`` numbers the rows, ``row`` holds the columns ``keep``."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("struct<>")
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("at"), normal_text(F.col("text")).alias("t"), row.alias("row"))
    cols = ["doc_id", "at", F.xxhash64("t").alias("d1"), F.unhex(F.sha2("t", 256)).alias("sha"),
            F.octet_length("t").cast("long").alias("n_bytes")]
    return texts.select(*cols, *(["row"] if keep else []))


def _digit(number: Column, at: int, fanin: int) -> Column:
    return F.pmod(F.floor(number / F.lit(fanin ** at)).cast("long"), F.lit(fanin))


def merge_round(runs: DataFrame, at: int, fanin: int, rounds: int) -> DataFrame:
    """The runs that differ in digit ``at`` swap slices and merge them: (run, d1, sha, n_bytes,
    best, n), sorted by run and digest in each partition."""
    own = F.pmod("d1", F.lit(fanin ** rounds))
    step = (_digit(own, at, fanin) - _digit(F.col("run"), at, fanin)) * F.lit(fanin ** at)
    merged = (runs.withColumn("run", F.col("run") + step).groupBy("run", *KEY)
              .agg(F.min("best").alias("best"), F.sum("n").alias("n")))
    return merged.sortWithinPartitions("run", *KEY)


def groups(rows: DataFrame, fanin: int = 4, rounds: int = 2) -> DataFrame:
    """(d1, sha, n_bytes, best, n) of every distinct digest of ``rows``; ``best`` is (null id,
    doc_id, at) of the row that stays."""
    run = F.pmod(F.shiftright("at", _ROW_BITS), F.lit(fanin ** rounds))
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")
    runs = rows.select(run.alias("run"), *KEY, best.alias("best"), F.lit(1).cast("long").alias("n"))
    for at in range(rounds):
        runs = written(merge_round(runs, at, fanin, rounds), f"digest-runs-{at}", retire=runs)
    return runs.drop("run")


def exact_groups(docs: DataFrame, fanin: int = 4, rounds: int = 2, keep: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of every row of ``docs``
    (``doc_id``, ``text``), and ``row`` with the columns ``keep`` if asked for.

    Null text: empty; all-white text: one space. Of a group the row with the smallest
    ``doc_id`` stays; null ids come last (``keep_id`` is null only where all are), and of
    repeated rows with that id exactly one stays. Ids of any sortable type. Empty table: no
    rows. Other columns are ignored, and cannot clash as they travel inside ``row``.
    """
    if fanin < 2 or rounds < 1:
        raise ValueError("a merge takes two runs or more, and one round or more")
    rows = written(digests(docs, keep), "digests")
    found = groups(rows, fanin, rounds)
    total = found.agg(F.sum("n")).first()[0] or 0
    cols = [*KEY, "best", "n"]
    hot = F.broadcast(found.where(F.col("n") * _HOT > total).select(*cols))     # fewer than _HOT rows
    cold = found.where(F.col("n") * _HOT <= total).select(*cols)
    both = rows.join(hot, KEY).unionByName(rows.join(hot.select(*KEY), KEY, "left_anti").join(cold, KEY))
    return both.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("at") == F.col("best.at")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
        *(["row"] if keep else []))


def unique_rows(docs: DataFrame, fanin: int = 4, rounds: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    return exact_groups(docs, fanin, rounds, keep=docs.columns).where("kept").select("row.*")
