"""Spelling variants by permuterm rotations.

A word with an end mark has one rotation per position. Turned so that the edited character
comes last, two words that differ by a replaced character share all but that last
character; and where one word has a character more, the other's whole rotation is that
same beginning. So every rotation is sorted under two prefixes: itself, and itself without
its last character. A prefix range holds at most one whole rotation and one word per
letter of the alphabet, any two of them near. A scan of the sorted ranges emits for each
word how many neighbours the range gives it and the best of them; no pairs are listed.
A replacement is found in one range only. A deletion inside a run of equal letters would
be found once for each of them, so only the first letter of a run counts.

Words are ranked by falling count, then code points; a range carries ranks, so the best
neighbour is the least rank. Ranges of over 64 code points are named by their SHA-256:
memory stays linear in the length of a word.

Scale: words are counted with map-side combining, rotations are shuffled by prefix, and
a range is bounded by the alphabet, however frequent its words. Forms are followed by
doubling; each step multiplies a count by ``ratio``, so the rounds are few and known.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

LETTERS = "A-Za-zÀ-ÿ"
END = "\x00"
_LONG = 64
_WHOLE, _CUT, _CUT_AGAIN = 0, 1, 2      # a rotation itself; without its last letter; that within a run of the letter


def damaged(doc_id: Column, word: Column, one_in: int) -> Column:
    """``word`` without the code point crc32(``<doc_id>:<word>``) % length if ``one_in`` divides that crc32."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word), "UTF-8"))
    at = F.pmod(h, F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % one_in == 0, cut).otherwise(word)


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2, one_in: int | None = None) -> DataFrame:
    """(word, n): runs of ``LETTERS`` with A-Z lower-cased, of ``min_chars`` code points or more,
    that occur ``min_count`` times or more in ``docs``. With ``one_in``, about that share of a
    document's words lose a letter first (see ``damaged``); that never lengthens a run, so shorter
    runs are passed over at once."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{max(1, min_chars)},}}"), F.lit(0))
    words = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", ascii_lower(F.col("run")).alias("word"))
    if one_in:
        words = words.select(damaged(F.col("doc_id"), F.col("word"), one_in).alias("word"))
    return (words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def ranked(words: DataFrame) -> DataFrame:
    """(word, n, rank): ranks grow as n falls, then in code-point order."""
    ordered = words.select("word", "n").orderBy(F.desc("n"), "word")
    return ordered.select("word", "n", F.monotonically_increasing_id().alias("rank"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, rank, kind) of ranked words: each rotation, and each without its last letter."""
    n, w = F.length("word"), F.col("word")
    turned = words.select("rank", "word", n.alias("size"), F.concat(w, F.lit(END), w, F.lit(END)).alias("twice"),
                          F.explode(F.sequence(F.lit(0), n)).alias("i"))
    i, size = F.col("i"), F.col("size")
    again = (i > 0) & (F.substring(w, i, F.lit(1)) == F.substring(w, i + 1, F.lit(1)))
    whole = F.struct(F.substring(F.col("twice"), i + 1, size + 1).alias("prefix"), F.lit(_WHOLE).cast("byte").alias("kind"))
    cut = F.struct(F.substring(F.col("twice"), i + 2, size).alias("prefix"),
                   F.when(again, _CUT_AGAIN).otherwise(_CUT).cast("byte").alias("kind"))
    both = F.when(i < size, F.array(whole, cut)).otherwise(F.array(whole))     # the end mark itself is never edited
    rows = turned.select("rank", F.explode(both).alias("r"))
    prefix = F.col("r.prefix")
    short = F.when(F.length(prefix) <= _LONG, prefix).otherwise(F.concat(F.lit(END), F.sha2(prefix, 256)))
    return rows.select(short.alias("prefix"), "rank", F.col("r.kind").alias("kind"))


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, best): of each ranked word with a near word, how many there are and the least rank."""
    kind, rank = F.col("kind"), F.col("rank")
    rows = Window.partitionBy("prefix").orderBy(kind == _WHOLE, rank)
    span = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scan = rotations(words).select(
        "rank", "kind", F.count(F.lit(1)).over(span).alias("n"),
        F.min(F.when(kind == _WHOLE, rank)).over(span).alias("whole"),
        F.sum((kind == _CUT).cast("long")).over(span).alias("n_first"),
        F.min(F.when(kind == _CUT, rank)).over(span).alias("best_first"),
        F.min(F.when(kind != _WHOLE, rank)).over(span).alias("best_cut"),
        F.lead(F.when(kind != _WHOLE, rank)).over(rows).alias("next_cut")).where("n > 1")
    whole, has = F.col("whole"), F.col("whole").isNotNull().cast("long")
    other = F.when(rank == F.col("best_cut"), F.col("next_cut")).otherwise(F.col("best_cut"))
    near = (F.when(kind == _WHOLE, F.col("n_first")).when(kind == _CUT, F.col("n") - 1).otherwise(F.col("n") - 1 - has))
    best = (F.when(kind == _WHOLE, F.col("best_first")).when(kind == _CUT, F.least(other, whole)).otherwise(other))
    found = scan.select("rank", near.alias("near"), best.alias("best")).where("near > 0")
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame, rounds: int) -> DataFrame:
    """(rank, root) from (rank, root = next): followed to the last by doubling."""
    for k in range(rounds):
        onward = links.select(F.col("rank").alias("o_rank"), F.col("root").alias("o_root"))
        links = written(links.join(onward, F.col("root") == F.col("o_rank"), "left")
                        .select("rank", F.coalesce("o_root", "root").alias("root")), f"roots-{k}", retire=links)
    return links


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of ``words`` (word, n;
    words distinct, without U+0000, n at least 1).

    Near words differ by one inserted, deleted or replaced code point. The form is the near word of
    the largest n (ties: the smallest in code-point order) if its n is at least ``ratio`` (2 or more)
    times the word's; the root follows forms to the last. No near word: n_near 0. No form: form and
    form_n null, root the word itself. Null words and nulls in n are left out; the empty word is a word
    like any other. Very long words cost time in the square of their length, memory in proportion to
    it. Other columns are ignored. Empty table: no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    ranks = written(ranked(words.where("word IS NOT NULL AND n IS NOT NULL")), "ranked-words")
    most = ranks.agg(F.max("n")).first()[0] or 1
    other = ranks.select(F.col("rank").alias("best"), F.col("word").alias("b_word"), F.col("n").alias("b_n"))
    near = written(neighbours(ranks), "near-words")
    is_form = F.col("b_n") >= F.col("n") * ratio
    linked = written(
        ranks.join(near, "rank", "left").join(other, "best", "left")
        .select("word", "n", "rank", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(is_form, F.col("b_word")).alias("form"), F.when(is_form, F.col("b_n")).alias("form_n"),
                F.when(is_form, F.col("best")).alias("next")), "forms")
    hops = math.floor(math.log(most, ratio) + 1e-9)
    links = linked.where("next IS NOT NULL").select("rank", F.col("next").alias("root"))
    roots = _roots(links, math.ceil(math.log2(hops)) if hops > 1 else 0).select("rank", F.col("root").alias("r_rank"))
    names = ranks.select(F.col("rank").alias("r_rank"), F.col("word").alias("r_word"))
    roots = roots.join(names, "r_rank").select("rank", "r_word")
    return linked.join(roots, "rank", "left").select(
        "word", "form", F.coalesce("r_word", "word").alias("root"), "n", "n_near", "form_n")
