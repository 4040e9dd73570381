"""Quality rules whose cutoffs carry a proven limit on false rejections.

A rule rejects a document whose value exceeds a cutoff. Cutoffs come from a grid fixed
beforehand, ordered from lax to strict. On labelled good documents of a stratum, a cutoff
is certified when the exact binomial test rejects "its false-rejection rate is over
alpha / number of rules" at level delta / (strata x rules), that is, when the
Clopper-Pearson upper bound lies under that rate. Levels are tested in fixed sequence,
lax first, stopping at the first failure; Bonferroni covers strata and rules. With
probability 1 - delta, all rules together reject at most a share alpha of the good
documents of every stratum. A stratum with too few labels gets no cutoff and loses nothing.

Scale: a document's measures are made in its own row with array functions, without a
shuffle; the labelled counts are one aggregate per stratum; verdicts join a table of one
row per stratum to thin rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, let, written

#: rule -> cutoffs from lax to strict; a document is rejected where the value is larger.
GRID: dict[str, list[float]] = {
    "symbol_share": [2.0, 1.0, 0.5, 0.3, 0.2, 0.1],
    "dup_line_share": [0.9, 0.7, 0.5, 0.3, 0.2],
    "repeat_share": [0.28, 0.25, 0.2, 0.15, 0.1],
    "long_words": [25.0, 20.0, 16.0, 13.0, 11.0],
    "short_words": [-1.5, -2.0, -2.5, -3.0],
}
WINDOW = 8
_NO_SPACE = "[^ \\t-\\r]"


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in ``words``:
    equal windows are neighbours once their hashes are sorted."""
    def covered(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(pos, k + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

    def repeated(rows: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            return F.when((F.get(rows, j - 1)["h"] == x["h"]) | F.coalesce(F.get(rows, j + 1)["h"] == x["h"], F.lit(False)),
                          x["i"])
        return let(F.sort_array(F.filter(F.transform(rows, twin), lambda i: i.isNotNull())), covered)

    def marked(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(rows, repeated))

    def of_words(word_hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(word_hashes) - (window - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(word_hashes, i, F.lit(window)))), marked)

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of_words))


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts of every row: doc_id, stratum, n_words, word_chars, n_symbols, n_lines (lines
    with a word), n_dup_lines, n_repeat_words. A null stratum counts as the empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, "[ \\t-\\r]+", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(ASCII_SPACE))) > 0)
    base = docs.select(
        F.col("doc_id"), F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")).alias("stratum"),
        let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w, WINDOW).cast("long").alias("n_repeat_words"))).alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"))
    return base.select("doc_id", "stratum", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
                       "w.n_repeat_words")


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbol_share": F.col("n_symbols") / words,
            "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeat_share": F.col("n_repeat_words") / words,
            "long_words": F.col("word_chars") / words,
            "short_words": -F.col("word_chars") / words}


def ln_factorial(n: Column) -> Column:
    """Exact to double precision: a table below 20, Stirling's series from there on."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(20)])
    x = F.greatest(n.cast("double"), F.lit(1.0))
    series = (x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + F.lit(1 / 12) / x
              - F.lit(1 / 360) / (x * x * x) + F.lit(1 / 1260) / (x * x * x * x * x))
    return F.when(n < 20, F.get(table, F.least(n, F.lit(19)).cast("int"))).otherwise(series)


def binomial_cdf(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate), summed downwards from k. Above the mean the
    value 1 stands for "no evidence"."""
    top = F.exp(ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k) + k * math.log(rate)
                + (n - k) * math.log1p(-rate))
    terms = F.least(k, (F.sqrt(n * rate) * 12).cast("long") + 60)     # the rest is below double precision

    def step(acc: Column, i: Column) -> Column:
        j = (k - i).cast("double")      # from term j to term j - 1
        term = acc["term"] * j * (1 - rate) / ((n - j + 1) * rate)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(F.when(terms > 0, F.sequence(F.lit(0).cast("long"), terms - 1)).otherwise(F.array().cast("array<bigint>")),
                        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), step, lambda acc: acc["sum"])
    return F.when(k > n * rate, F.lit(1.0)).otherwise(F.least(top * total, F.lit(1.0)))


def thresholds(counted: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.1) -> DataFrame:
    """(stratum, rule, level, cutoff, n, k, p_value): the strictest certified cutoff of each
    rule and stratum. ``counted`` are measures; a document is good if all its ``labels`` rows
    say quality = 1; documents that fail the base rules take no part."""
    good = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
            .where("q = 1").select(F.col("doc_id").alias("l_id")))
    held = counted.where(~base_failed()).join(good, F.col("doc_id") == F.col("l_id"))
    values = rule_values()
    cells = [(rule, level, cutoff) for rule, cuts in GRID.items() for level, cutoff in enumerate(cuts)]
    sums = written(held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((values[rule] > cutoff).cast("long")).alias(f"k{i}") for i, (rule, _, cutoff) in enumerate(cells)]), "strata")
    tests = max(1, sums.count()) * len(GRID)
    long = sums.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(level).alias("level"), F.lit(float(cutoff)).alias("cutoff"),
                 F.col(f"k{i}").alias("k")) for i, (rule, level, cutoff) in enumerate(cells)])).alias("c"))
    rate = alpha / len(GRID)
    tested = (long.select("stratum", "n", "c.*")
              .withColumn("p_value", binomial_cdf(F.col("k"), F.col("n"), rate))
              .withColumn("passed", F.col("p_value") <= delta / tests))
    return (tested.groupBy("stratum", "rule")
            .agg(F.min(F.when(~F.col("passed"), F.col("level"))).alias("stop"),
                 F.collect_list(F.struct("level", "cutoff", "n", "k", "p_value")).alias("levels"))   # a grid's length
            .select("stratum", "rule", F.array_max(F.filter("levels", lambda x: F.col("stop").isNull() | (x["level"] < F.col("stop")))).alias("c"))
            .where(F.col("c").isNotNull()).select("stratum", "rule", "c.*"))


def controlled(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.1,
               stratum: str = "lang") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row of ``docs`` (``doc_id``, ``text`` and
    the stratum column; other columns are ignored).

    Null and empty text: no words, so the base rules fail. Null stratum: a stratum of its own.
    Null ``doc_id``: judged, but never labelled. Null labels and documents whose labels
    disagree do not count as good. Repeated rows are judged alike and count each. Empty
    ``labels``: no cutoff, the base rules alone decide. Empty table: no rows.
    """
    counted = written(measures(docs, stratum), "measures")
    cuts = thresholds(counted, labels, alpha, delta)
    wide = cuts.groupBy(F.col("stratum").alias("s")).agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in GRID])
    values, rejected = rule_values(), F.lit(False)
    judged = counted.join(wide, F.col("stratum") == F.col("s"), "left")
    for rule in GRID:
        rejected = rejected | F.coalesce(values[rule] > F.col(f"cut_{rule}"), F.lit(False))
    return (judged.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected).drop("s"))
