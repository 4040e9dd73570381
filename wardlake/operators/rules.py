"""Declarative data-quality rules evaluated as plain Column expressions.

Row rules (completeness, set membership, regex, comparisons, ranges, custom
row predicates) become one boolean per rule inside a single ``select``: no
shuffle, no cache, no Python. Dataset rules (uniqueness, custom SQL) are
recorded in the summary but never quarantine a row.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = "dq_valid"
FAILED = "dq_failed_rules"

_OPS = {
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, "=": lambda c, v: c == v, "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
}


def _null_policy(col: Column, cond: Column, null_policy: str) -> Column:
    """A value rule on a NULL cell passes ("pass", completeness rules catch
    NULLs) or fails ("fail"). The result is never NULL."""
    if null_policy not in ("pass", "fail"):
        raise ValueError("null_policy must be 'pass' or 'fail'")
    return F.when(col.isNull(), F.lit(null_policy == "pass")).otherwise(F.coalesce(cond, F.lit(False)))


@dataclass(frozen=True)
class RowRule:
    """A rule decided per row. ``build(df)`` returns a non-NULL boolean."""
    name: str
    build: Callable[[DataFrame], Column] = field(compare=False)

    def condition(self, df: DataFrame) -> Column:
        return self.build(df)


@dataclass(frozen=True)
class LookupRule(RowRule):
    """A row rule on membership in a table of values. ``prepare(df)`` joins the values, once each,
    and adds the column ``flag``; ``build`` reads it."""
    prepare: Callable[[DataFrame], DataFrame] = field(compare=False, default=None)
    flag: str = ""


@dataclass(frozen=True)
class DatasetRule:
    """A rule over the whole dataset: metric(df) -> one-row DataFrame with a
    double column ``metric``; passes when ``metric <op> threshold``."""
    name: str
    metric: Callable[[DataFrame], DataFrame] = field(compare=False)
    op: str
    threshold: float
    unique_column: str | None = None     # set for uniqueness rules (lets the summary share one pass)


def rule_is_complete(col: str) -> RowRule:
    return RowRule(f'IsComplete "{col}"', lambda df: F.col(col).isNotNull())


def rule_in_set(col: str, values: Sequence, null_policy: str = "pass") -> RowRule:
    vals = list(values)
    shown = ", ".join(f'"{v}"' if isinstance(v, str) else str(v) for v in vals)
    return RowRule(f'ColumnValues "{col}" in [{shown}]',
                   lambda df: _null_policy(F.col(col), F.col(col).isin(vals), null_policy))


def rule_in_table(col: str, values: DataFrame, value: str, name: str | None = None,
                  null_policy: str = "pass") -> LookupRule:
    """``rule_in_set`` for a set too large for a list: the column ``value`` of ``values`` (repeats
    and NULLs in it do not matter). An existence join gives one more boolean beside the other rules; a
    small set is broadcast behind its size check, a large one joined by shuffle. No row is multiplied."""
    from .joins import broadcast_if_small
    flag = f"__in_{uuid.uuid4().hex[:8]}"
    known = values.where(F.col(value).isNotNull()).select(F.col(value).alias(f"{flag}_v")).distinct()

    def prepare(df: DataFrame) -> DataFrame:
        found = broadcast_if_small(known.withColumn(flag, F.lit(True)))
        return df.join(found, F.col(col) == F.col(f"{flag}_v"), "left").drop(f"{flag}_v")
    return LookupRule(name or f'ColumnValues "{col}" in table of {value}',
                      lambda df: _null_policy(F.col(col), F.col(flag).isNotNull(), null_policy), prepare, flag)


def rule_matches(col: str, pattern: str, anchored: bool = True, null_policy: str = "pass") -> RowRule:
    rx = f"\\A(?:{pattern})\\z" if anchored else pattern
    return RowRule(f'ColumnValues "{col}" matches "{pattern}"',
                   lambda df: _null_policy(F.col(col), F.col(col).cast("string").rlike(rx), null_policy))


def rule_compare(col: str, op: str, value, null_policy: str = "pass") -> RowRule:
    fn = _OPS[op]
    return RowRule(f'ColumnValues "{col}" {op} {value}',
                   lambda df: _null_policy(F.col(col), fn(F.col(col), F.lit(value)), null_policy))


def rule_between(col: str, lo, hi, inclusive: bool = True, null_policy: str = "pass") -> RowRule:
    def build(df):
        c = F.col(col)
        cond = c.between(lo, hi) if inclusive else ((c > F.lit(lo)) & (c < F.lit(hi)))
        return _null_policy(c, cond, null_policy)
    return RowRule(f'ColumnValues "{col}" between {lo} and {hi}', build)


def rule_row_predicate(name: str, predicate: Callable[[DataFrame], Column] | str) -> RowRule:
    """Custom per-row rule: a callable DataFrame -> Column, or SQL text. A
    NULL result fails the row (it is ANDed with the other rules)."""
    if isinstance(predicate, str):
        text = predicate
        return RowRule(name, lambda df: F.coalesce(F.expr(text), F.lit(False)))
    return RowRule(name, lambda df: F.coalesce(predicate(df), F.lit(False)))


def uniqueness_metric(col: str) -> Callable[[DataFrame], DataFrame]:
    """Share of non-NULL values that occur exactly once. Aggregated per value
    with partial aggregation (a hot value costs one partial row per task)."""
    def metric(df: DataFrame) -> DataFrame:
        per_value = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        return per_value.agg(
            F.try_divide(F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).cast("double"),
                         F.sum("n").cast("double")).alias("metric"))
    return metric


def rule_uniqueness(col: str, op: str = ">", threshold: float = 0.99) -> DatasetRule:
    return DatasetRule(f'Uniqueness "{col}" {op} {threshold}', uniqueness_metric(col), op, threshold, col)


_WITH = re.compile(r"\s*with\s+", re.IGNORECASE)


def rule_custom_sql(sql: str, op: str = "=", threshold: float = 0) -> DatasetRule:
    """``select <scalar> from primary ...`` with the dataset bound as the CTE
    ``primary`` (a DataFrame argument of ``spark.sql``, no global temp view);
    the rule's own text, literals and braces included, is left as it is."""
    text = sql.replace("{", "{{").replace("}", "}}")
    own = _WITH.match(text)
    bound = "WITH primary AS (SELECT * FROM {dataset})" + (f", {text[own.end():]}" if own else f" {text}")

    def metric(df: DataFrame) -> DataFrame:
        res = df.sparkSession.sql(bound, dataset=df)
        return res.select(F.col(res.columns[0]).cast("double").alias("metric"))
    return DatasetRule(f'CustomSql "{sql}" {op} {threshold}', metric, op, threshold)


# ------------------------------------------------------------------ evaluation

def _split(rules) -> tuple[list[RowRule], list[DatasetRule]]:
    return ([r for r in rules if isinstance(r, RowRule)], [r for r in rules if isinstance(r, DatasetRule)])


def _with_lookups(df: DataFrame, row_rules: Sequence[RowRule]) -> DataFrame:
    for r in row_rules:
        if isinstance(r, LookupRule):
            df = r.prepare(df)
    return df


def evaluate_rules_rows(df: DataFrame, rules: Sequence, extra: Sequence[RowRule] = ()) -> DataFrame:
    """Input columns + ``dq_valid`` (every row rule passes, never NULL) +
    ``dq_failed_rules`` (names of the failing row rules, in rule order)."""
    row_rules, _ = _split(rules)
    row_rules = row_rules + list(extra)
    df = _with_lookups(df, row_rules)
    flags = [r.flag for r in row_rules if isinstance(r, LookupRule)]
    conds = [r.condition(df) for r in row_rules]
    if not conds:
        return df.withColumns({VALID: F.lit(True), FAILED: F.array().cast("array<string>")})
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(r.name)) for r, c in zip(row_rules, conds)]))
    return df.withColumn(FAILED, failed).withColumn(VALID, F.size(F.col(FAILED)) == 0).drop(*flags)


def evaluate_rules_summary(df: DataFrame, rules: Sequence, extra: Sequence[RowRule] = (),
                           keys: Sequence[str] = ()) -> DataFrame:
    """One row per rule: rule, rule_type, outcome (Passed/Failed),
    failure_reason, metric (pass ratio for row rules, the measured value for
    dataset rules) and evaluated_metrics (map<string,double>).

    All row rules are counted in ONE aggregate, combined per task to one row.
    Each uniqueness rule reads its own column only and shuffles (value, count);
    every other dataset rule is its own small aggregate. The rows are unioned.

    ``keys`` (e.g. ``["dt"]``) gives one outcome row per rule and key value in
    the same passes (grouped instead of global aggregates). Custom-SQL rules
    are scalar over the whole input and have no per-key form: they are
    rejected here and must be evaluated without keys."""
    row_rules, ds_rules = _checked(rules, extra, keys)
    counts = _failures(_with_lookups(df, row_rules), row_rules, keys) if row_rules else None
    return _outcomes(counts, df, row_rules, ds_rules, list(keys))


def summary_of_split(promoted: DataFrame, quarantined: DataFrame, rules: Sequence, extra: Sequence[RowRule] = (),
                     keys: Sequence[str] = ()) -> DataFrame:
    """What :func:`evaluate_rules_summary` gives for all rows, from the two halves of a split by the
    same rules: promoted rows pass every row rule and are only counted."""
    row_rules, ds_rules = _checked(rules, extra, keys)
    counts = None
    if row_rules:
        bad = _failures(_with_lookups(quarantined, row_rules), row_rules, keys)
        good = promoted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        zeros = [F.lit(0).cast("long").alias(f"__f{i}") for i in range(len(row_rules))]
        names = ["__n", *[f"__f{i}" for i in range(len(row_rules))]]
        counts = good.select(*keys, "__n", *zeros).unionByName(bad).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    return _outcomes(counts, promoted.unionByName(quarantined), row_rules, ds_rules, list(keys))


def _checked(rules: Sequence, extra: Sequence[RowRule], keys: Sequence[str]) -> tuple[list[RowRule], list[DatasetRule]]:
    row_rules, ds_rules = _split(rules)
    if keys and any(not r.unique_column for r in ds_rules):
        raise ValueError("custom SQL rules cannot be evaluated per key; evaluate them without keys")
    return row_rules + list(extra), ds_rules


def _failures(df: DataFrame, row_rules: Sequence[RowRule], keys: Sequence[str]) -> DataFrame:
    """keys, rows (__n) and failures per rule (__f0, ...)."""
    fails = [F.count_if(~r.condition(df)).alias(f"__f{i}") for i, r in enumerate(row_rules)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *fails)


def _outcomes(counts: DataFrame | None, df: DataFrame, row_rules: Sequence[RowRule], ds_rules: Sequence[DatasetRule],
              keys: list[str]) -> DataFrame:
    parts = []
    if counts is not None:
        # every outcome row comes from the one aggregate row: a single consumer,
        # so column pruning cannot split it into two scans
        entries = [_row_entry(r.name, F.col(f"__f{i}"), F.col("__n")) for i, r in enumerate(row_rules)]
        parts.append(counts.select(*keys, F.inline(F.array(*entries))))
    for r in ds_rules:
        if keys:   # a uniqueness rule, per key value
            per_value = df.filter(F.col(r.unique_column).isNotNull()).groupBy(*keys, r.unique_column).agg(
                F.count(F.lit(1)).alias("n"))
            m = per_value.groupBy(*keys).agg(F.try_divide(
                F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).cast("double"),
                F.sum("n").cast("double")).alias("metric"))
            parts.append(m.select(*keys, F.inline(F.array(_dataset_entry(r, F.col("metric"))))))
        else:
            parts.append(_dataset_outcome(r.metric(df), r))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _row_entry(name: str, failed: Column, rows: Column) -> Column:
    ratio = F.coalesce(F.try_divide((rows - failed).cast("double"), rows.cast("double")), F.lit(1.0))
    return F.struct(
        F.lit(name).alias("rule"), F.lit("row").alias("rule_type"),
        F.when(failed == 0, "Passed").otherwise("Failed").alias("outcome"),
        F.when(failed > 0, F.format_string("%d of %d rows failed", failed, rows)).alias("failure_reason"),
        ratio.alias("metric"),
        F.create_map(F.lit("rows"), rows.cast("double"), F.lit("failed_rows"), failed.cast("double"),
                     F.lit("pass_ratio"), ratio).alias("evaluated_metrics"))


def _dataset_entry(r: DatasetRule, metric: Column) -> Column:
    """Outcome of a dataset rule; a NULL metric (nothing to measure) passes."""
    ok = F.coalesce(_OPS[r.op](metric, F.lit(r.threshold)), metric.isNull())
    return F.struct(
        F.lit(r.name).alias("rule"), F.lit("dataset").alias("rule_type"),
        F.when(ok, "Passed").otherwise("Failed").alias("outcome"),
        F.when(~ok, F.lit(f"metric does not satisfy {r.op} {r.threshold}")).alias("failure_reason"),
        metric.cast("double").alias("metric"),
        F.create_map(F.lit("metric"), metric.cast("double")).alias("evaluated_metrics"))


def _dataset_outcome(m: DataFrame, r: DatasetRule) -> DataFrame:
    return m.select(F.inline(F.array(_dataset_entry(r, F.col("metric")))))


def split_valid(evaluated: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Promoted rows, original columns only."""
    return evaluated.filter(F.col(VALID)).select(*cols)


def split_quarantine(evaluated: DataFrame, cols: Sequence[str], with_reasons: bool = False) -> DataFrame:
    """Exact complement of :func:`split_valid` (validity is never NULL, and it
    is coalesced again here so NOT(NULL) cannot drop a row)."""
    keep = list(cols) + ([FAILED] if with_reasons else [])
    return evaluated.filter(~F.coalesce(F.col(VALID), F.lit(False))).select(*keep)


def cleanse_counts(evaluated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Promoted and quarantined row counts (per key combination)."""
    return evaluated.groupBy(*keys).agg(
        F.count_if(F.col(VALID)).alias("promoted"),
        F.count_if(~F.col(VALID)).alias("quarantined"))


def cleanse(df: DataFrame, rules: Sequence, extra: Sequence[RowRule] = ()):
    """Evaluate once, return (promoted, quarantined, summary) DataFrames.

    Always succeeds on bad data: bad rows are returned, never raised."""
    cols = df.columns
    ev = evaluate_rules_rows(df, rules, extra)
    return split_valid(ev, cols), split_quarantine(ev, cols), evaluate_rules_summary(df, rules, extra)
