"""Registered rule / cleansing queries and their DuckDB oracles.

The oracle side restates every rule as a SQL predicate; only the rule's
display name is taken from the Spark rule object so both outputs carry the
same text in the ``rule`` column.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators import rulesets as RS
from . import bindings as B
from .bindings import with_ctes
from .catalog import query


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _lst(vals) -> str:
    return ", ".join(_q(v) for v in vals)


# SQL predicates (never NULL), mirroring the rule semantics:
def s_complete(c):
    return f"{c} IS NOT NULL"


def s_in(c, vals):
    return f"CASE WHEN {c} IS NULL THEN TRUE ELSE COALESCE({c} IN ({_lst(vals)}), FALSE) END"


def s_match(c, pattern):
    return (f"CASE WHEN {c} IS NULL THEN TRUE ELSE "
            f"COALESCE(regexp_full_match(CAST({c} AS VARCHAR), {_q(pattern)}), FALSE) END")


def s_cmp(c, op, v):
    op = "=" if op == "==" else op
    return f"CASE WHEN {c} IS NULL THEN TRUE ELSE COALESCE({c} {op} {v}, FALSE) END"


def s_between(c, lo, hi):
    return f"CASE WHEN {c} IS NULL THEN TRUE ELSE COALESCE({c} BETWEEN {lo} AND {hi}, FALSE) END"


def s_pred(text):
    return f"COALESCE({text}, FALSE)"


def s_unique(c, src):
    return (f"SELECT CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(sum(n) AS DOUBLE), 0) "
            f"AS metric FROM (SELECT {c}, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) u")


def s_scalar(sql, src):
    return f"SELECT CAST(({sql.replace('primary', src)}) AS DOUBLE) AS metric"


def summary_sql(rules, preds, src: str) -> str:
    """Per-rule outcome rows. ``preds``: one entry per rule, in order: a
    predicate string for row rules, ("metric", sql) for dataset rules."""
    row = [(r, p) for r, p in zip(rules, preds) if isinstance(r, R.RowRule)]
    dsr = [(r, p) for r, p in zip(rules, preds) if isinstance(r, R.DatasetRule)]
    parts = []
    if row:
        aggs = ", ".join(["count(*) AS n"] + [f"count_if(NOT ({p})) AS f{i}" for i, (_, p) in enumerate(row)])
        for i, (r, _) in enumerate(row):
            parts.append(
                f"SELECT {_q(r.name)} AS rule, 'row' AS rule_type, "
                f"CASE WHEN f{i} = 0 THEN 'Passed' ELSE 'Failed' END AS outcome, "
                f"CASE WHEN f{i} > 0 THEN printf('%d of %d rows failed', f{i}, n) END AS failure_reason, "
                f"COALESCE(CASE WHEN n = 0 THEN NULL ELSE CAST(n - f{i} AS DOUBLE) / CAST(n AS DOUBLE) END, 1.0) "
                f"AS metric, CAST(n AS DOUBLE) AS rows, CAST(f{i} AS DOUBLE) AS failed_rows FROM (SELECT {aggs} FROM {src}) a")
    for r, (_, msql) in dsr:
        op = "=" if r.op == "==" else r.op
        parts.append(
            f"SELECT {_q(r.name)} AS rule, 'dataset' AS rule_type, "
            f"CASE WHEN metric IS NULL OR metric {op} {r.threshold} THEN 'Passed' ELSE 'Failed' END AS outcome, "
            f"CASE WHEN NOT (metric IS NULL OR metric {op} {r.threshold}) "
            f"THEN {_q(f'metric does not satisfy {r.op} {r.threshold}')} END AS failure_reason, "
            f"metric, CAST(NULL AS DOUBLE) AS rows, CAST(NULL AS DOUBLE) AS failed_rows FROM ({msql}) m")
    return "\nUNION ALL\n".join(parts)


SUMMARY_COLS = ["rule", "rule_type", "outcome", "failure_reason"]


def measured(summary):
    """Outcome rows with the evaluated metrics as columns."""
    m = F.col("evaluated_metrics")
    return summary.select(*[c for c in SUMMARY_COLS if c in summary.columns], F.coalesce(m["pass_ratio"], m["metric"]).alias("metric"),
                          m["rows"].alias("rows"), m["failed_rows"].alias("failed_rows"))


def spark_summary(df, rules, extra=()):
    return measured(R.evaluate_rules_summary(df, rules, extra))


# ------------------------------------------------------------ single rules

def _docs_labels(s, d):
    docs = B.table(s, d, "documents").select("doc_id")
    labels = B.table(s, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def _rule_in_set(s, d):
    """The same set as a list and as a table of values."""
    e = B.table(s, d, "events")
    values = s.createDataFrame([(t,) for t in B.EVENT_TYPES_KNOWN + [None, "view"]], "known string")
    rule = R.rule_in_table("event_type", values, "known")
    by_table = R.evaluate_rules_rows(e, [rule]).select("event_id", F.lit("table").alias("form"), F.col(R.VALID).alias("passed"))
    by_list = _rule_rows(e, R.rule_in_set("event_type", B.EVENT_TYPES_KNOWN), ["event_id"])
    return by_table.unionByName(by_list.withColumn("form", F.lit("list")))


def _rule_rows(df, rule, keys):
    return df.select(*keys, rule.condition(df).alias("passed"))


query("rule_is_complete", """
    SELECT d.doc_id, l.quality IS NOT NULL AS passed
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")(
    lambda s, d: _rule_rows(_docs_labels(s, d), R.rule_is_complete("quality"), ["doc_id"]))

query("rule_in_set", f"""
    SELECT event_id, form, {s_in('event_type', B.EVENT_TYPES_KNOWN)} AS passed
    FROM events, (VALUES ('list'), ('table')) f(form)""")(_rule_in_set)

query("rule_matches", f"""
    SELECT c_custkey, {s_match('c_name', B.CUSTOMER_NAME_PATTERN)} AS passed FROM customer""")(
    lambda s, d: _rule_rows(B.table(s, d, "customer"), R.rule_matches("c_name", B.CUSTOMER_NAME_PATTERN),
                            ["c_custkey"]))

query("rule_compare", f"""
    SELECT l_orderkey, l_linenumber, {s_cmp('l_discount', '>=', 0.02)} AS passed FROM lineitem""")(
    lambda s, d: _rule_rows(B.table(s, d, "lineitem"), R.rule_compare("l_discount", ">=", 0.02),
                            ["l_orderkey", "l_linenumber"]))

query("rule_between", f"""
    SELECT l_orderkey, l_linenumber, {s_between('l_quantity', 5, 45)} AS passed FROM lineitem""")(
    lambda s, d: _rule_rows(B.table(s, d, "lineitem"), R.rule_between("l_quantity", 5, 45),
                            ["l_orderkey", "l_linenumber"]))


def _lines_parts(s, d):
    li = B.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                          "l_discount", "l_returnflag")
    p = B.table(s, d, "part").select("p_partkey", "p_size")
    return li.join(p, li.l_partkey == p.p_partkey, "inner")


LP_SQL = ("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_returnflag, p_partkey, p_size "
          "FROM lineitem JOIN part ON l_partkey = p_partkey")

_PRED = R.rule_row_predicate("l_quantity <= p_size", lambda df: F.col("l_quantity") <= F.col("p_size"))
query("rule_row_predicate", with_ctes(f"""
    SELECT l_orderkey, l_linenumber, {s_pred('l_quantity <= p_size')} AS passed FROM lp""", ctes=[("lp", LP_SQL)]))(
    lambda s, d: _rule_rows(_lines_parts(s, d), _PRED, ["l_orderkey", "l_linenumber"]))

_UNIQ = [R.rule_uniqueness("user_id", ">", 0.99), R.rule_uniqueness("event_id", ">", 0.99)]
query("rule_uniqueness", summary_sql(_UNIQ, [("metric", s_unique("user_id", "events")),
                                             ("metric", s_unique("event_id", "events"))], "events"))(
    lambda s, d: spark_summary(B.table(s, d, "events"), _UNIQ))

_CSQL = R.rule_custom_sql("select count(*) from primary where l_quantity > p_size", "=", 0)
query("rule_custom_sql", with_ctes(summary_sql(
    [_CSQL], [("metric", s_scalar("select count(*) from primary where l_quantity > p_size", "lp"))], "lp"),
    ctes=[("lp", LP_SQL)]))(lambda s, d: spark_summary(_lines_parts(s, d), [_CSQL]))

# --------------------------------------------------- evaluation and the split

LP_RULES = [R.rule_between("l_quantity", 5, 45), R.rule_compare("l_discount", ">=", 0.02),
            R.rule_in_set("l_returnflag", ["A", "N"]), _PRED]
LP_PREDS = [s_between("l_quantity", 5, 45), s_cmp("l_discount", ">=", 0.02), s_in("l_returnflag", ["A", "N"]),
            s_pred("l_quantity <= p_size")]


def _eval_rows(s, d):
    ev = R.evaluate_rules_rows(_lines_parts(s, d), LP_RULES)
    return ev.select("l_orderkey", "l_linenumber", F.col(R.VALID).alias("dq_valid"),
                     F.array_join(R.FAILED, "|").alias("failed_rules"))


_FAILED_SQL = "concat_ws('|', " + ", ".join(
    f"CASE WHEN NOT ({p}) THEN {_q(r.name)} END" for r, p in zip(LP_RULES, LP_PREDS)) + ")"
query("evaluate_rules_rows", with_ctes(f"""
    SELECT l_orderkey, l_linenumber, ({' AND '.join('(' + p + ')' for p in LP_PREDS)}) AS dq_valid,
           {_FAILED_SQL} AS failed_rules FROM lp""", ctes=[("lp", LP_SQL)]))(_eval_rows)

query("evaluate_rules_summary", with_ctes(summary_sql(LP_RULES, LP_PREDS, "lp"), ctes=[("lp", LP_SQL)]))(
    lambda s, d: spark_summary(_lines_parts(s, d), LP_RULES))


# rule sets bound to the test-table domains, with their SQL predicate lists
def visits_rules():
    return RS.visits_rules(B.VISIT_FACILITIES, B.PRIORITIES, B.ORDER_STATUSES, B.ID_PATTERN, B.ID_PATTERN)


def visits_preds(src="visits"):
    return [s_complete("visit_id"), s_complete("patient_id"), s_complete("facility_id"),
            s_complete("attending_staff_id"), s_complete("admission_ts"), ("metric", s_unique("visit_id", src)),
            s_match("patient_id", B.ID_PATTERN), s_match("attending_staff_id", B.ID_PATTERN),
            s_in("facility_id", B.VISIT_FACILITIES), s_in("department", B.PRIORITIES),
            s_in("visit_type", B.ORDER_STATUSES)]


def staff_schedules_rules():
    return RS.staff_schedules_rules(B.ALL_FACILITIES, B.RETURN_FLAGS, RS.ROLES, B.LINE_STATUSES, B.ID_PATTERN)


def staff_schedules_preds(src="staff_schedules"):
    return [s_complete("staff_id"), s_complete("facility_id"), s_complete("shift_date"),
            s_match("staff_id", B.ID_PATTERN), s_in("facility_id", B.ALL_FACILITIES),
            s_in("department", B.RETURN_FLAGS), s_in("role", RS.ROLES), s_in("shift_name", B.LINE_STATUSES)]


def billing_claims_rules():
    return RS.billing_claims_rules(B.ALL_FACILITIES, B.SEGMENTS, RS.CLAIM_STATUSES, B.ID_PATTERN)


def billing_claims_preds(src="claims"):
    return [s_complete("claim_id"), s_complete("patient_id"), s_complete("facility_id"),
            s_complete("claim_amount"), ("metric", s_unique("claim_id", src)), s_match("patient_id", B.ID_PATTERN),
            s_in("facility_id", B.ALL_FACILITIES), s_in("payer", B.SEGMENTS), s_in("status", RS.CLAIM_STATUSES),
            s_between("claim_amount", 0, 100000)]


def pharmacy_rules():
    return RS.pharmacy_inventory_rules(B.ALL_FACILITIES)


def pharmacy_preds(src="pharmacy_inventory"):
    return [s_complete("facility_id"), s_complete("drug_name"), s_complete("current_stock"),
            s_complete("reorder_threshold"), s_in("facility_id", B.ALL_FACILITIES),
            s_cmp("current_stock", ">=", 0), s_cmp("reorder_threshold", ">=", 0), s_between("unit_cost", 0, 10000)]


def beds_rules():
    return RS.bed_capacity_rules(B.ALL_FACILITIES, B.RETURN_FLAGS)


def beds_preds(src="bed_capacity"):
    return [s_complete("facility_id"), s_complete("department"), s_complete("total_beds"),
            s_complete("occupied_beds"), s_in("facility_id", B.ALL_FACILITIES), s_in("department", B.RETURN_FLAGS),
            s_cmp("total_beds", ">", 0), s_cmp("occupied_beds", ">=", 0),
            ("metric", s_scalar("select count(*) from primary where occupied_beds > total_beds", src))]


def vitals_rules():
    return RS.vitals_rules(B.ALL_FACILITIES, B.ID_PATTERN, B.VITAL_RANGES)


def vitals_preds(src="vitals"):
    return [s_complete("event_id"), s_complete("patient_id"), s_complete("facility_id"),
            s_match("patient_id", B.ID_PATTERN), s_in("facility_id", B.ALL_FACILITIES),
            *[s_between(c, lo, hi) for c, lo, hi in B.VITAL_RANGES]]


def prescriptions_rules():
    return RS.prescriptions_rules(B.ALL_FACILITIES, B.ID_PATTERN)


def prescriptions_preds(src="prescriptions"):
    return [s_complete("event_id"), s_complete("patient_id"), s_complete("facility_id"),
            s_complete("drug_name"), s_match("patient_id", B.ID_PATTERN), s_in("facility_id", B.ALL_FACILITIES),
            s_cmp("dosage_mg", ">", 0)]


MASTER_REQUIRED = ["full_name", "account_balance"]


def patients_rules():
    return RS.patients_rules(B.ID_PATTERN, MASTER_REQUIRED)


def patients_preds(src="patients"):
    return [s_complete("patient_id"), *[s_complete(c) for c in MASTER_REQUIRED],
            ("metric", s_unique("patient_id", src)), s_match("patient_id", B.ID_PATTERN)]


def staff_rules():
    return RS.staff_rules(B.ID_PATTERN, MASTER_REQUIRED)


def staff_preds(src="staff"):
    return [s_complete("staff_id"), *[s_complete(c) for c in MASTER_REQUIRED],
            ("metric", s_unique("staff_id", src)), s_match("staff_id", B.ID_PATTERN)]


RULE_SETS = {
    # key: (binding, rules(), preds(), extra row rules)
    "cleanse_visits": ("visits", visits_rules, visits_preds, ()),
    "cleanse_staff_schedules": ("staff_schedules", staff_schedules_rules, staff_schedules_preds, ()),
    "cleanse_billing_claims": ("claims", billing_claims_rules, billing_claims_preds, ()),
    "cleanse_pharmacy_inventory": ("pharmacy_inventory", pharmacy_rules, pharmacy_preds, ()),
    "cleanse_bed_capacity": ("bed_capacity", beds_rules, beds_preds, "beds"),
    "cleanse_vitals": ("vitals", vitals_rules, vitals_preds, ()),
    "cleanse_prescriptions": ("prescriptions", prescriptions_rules, prescriptions_preds, ()),
    "cleanse_patients": ("patients", patients_rules, patients_preds, ()),
    "cleanse_staff": ("staff", staff_rules, staff_preds, ()),
}

BED_EXTRA_SQL = s_pred("occupied_beds <= total_beds")


def _register_rule_set(key, binding, rules_fn, preds_fn, extra):
    extra_rules = RS.bed_capacity_extra() if extra == "beds" else []
    rules = rules_fn() + extra_rules
    preds = preds_fn() + ([BED_EXTRA_SQL] if extra == "beds" else [])
    sql = with_ctes(summary_sql(rules, preds, binding), [binding])
    builder = getattr(B, binding)
    query(key, sql)(lambda s, d: spark_summary(builder(s, d), rules_fn(), extra_rules))


for _k, (_b, _r, _p, _e) in RULE_SETS.items():
    _register_rule_set(_k, _b, _r, _p, _e)


def _evaluated_vitals(s, d):
    return R.evaluate_rules_rows(B.vitals(s, d), vitals_rules())


def _valid_sql(preds):
    return " AND ".join(f"({p})" for p in preds if isinstance(p, str))


VITAL_COLS = ["event_id", "patient_id", "facility_id", "heart_rate", "spo2", "systolic_bp", "diastolic_bp",
              "temperature_c", "event_ts"]
query("split_valid", with_ctes(f"SELECT * FROM vitals WHERE {_valid_sql(vitals_preds())}", ["vitals"]))(
    lambda s, d: R.split_valid(_evaluated_vitals(s, d), VITAL_COLS))
query("split_quarantine", with_ctes(f"SELECT * FROM vitals WHERE NOT ({_valid_sql(vitals_preds())})",
                                    ["vitals"]))(
    lambda s, d: R.split_quarantine(_evaluated_vitals(s, d), VITAL_COLS))

query("cleanse_counts", with_ctes(f"""
    SELECT payer, CAST(count_if(v) AS BIGINT) AS promoted, CAST(count_if(NOT v) AS BIGINT) AS quarantined
    FROM (SELECT payer, {_valid_sql(billing_claims_preds())} AS v FROM claims) t GROUP BY payer""", ["claims"]))(
    lambda s, d: R.cleanse_counts(R.evaluate_rules_rows(B.claims(s, d), billing_claims_rules()), ["payer"]))


def _cleanse(s, d):
    good, bad, summary = R.cleanse(B.claims(s, d), billing_claims_rules())
    g = good.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("claim_amount").cast("decimal(18,2)")).alias("amt"))
    b = bad.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("claim_amount").cast("decimal(18,2)")).alias("amt"))
    f = summary.filter(F.col("outcome") == "Failed").agg(F.count(F.lit(1)).alias("n"))
    return (g.select(F.lit("promoted").alias("part"), "n", F.col("amt").cast("double").alias("amount"))
            .unionByName(b.select(F.lit("quarantined").alias("part"), "n", F.col("amt").cast("double").alias("amount")))
            .unionByName(f.select(F.lit("failed_rules").alias("part"), "n",
                                  F.lit(None).cast("double").alias("amount"))))


_CL = f"SELECT claim_amount, {_valid_sql(billing_claims_preds())} AS v FROM claims"
query("cleanse", with_ctes(f"""
    SELECT 'promoted' AS part, CAST(count_if(v) AS BIGINT) AS n,
           CAST(sum(CASE WHEN v THEN CAST(claim_amount AS DECIMAL(18, 2)) END) AS DOUBLE) AS amount FROM cl
    UNION ALL
    SELECT 'quarantined' AS part, CAST(count_if(NOT v) AS BIGINT) AS n,
           CAST(sum(CASE WHEN NOT v THEN CAST(claim_amount AS DECIMAL(18, 2)) END) AS DOUBLE) AS amount FROM cl
    UNION ALL
    SELECT 'failed_rules' AS part, count(*) AS n, CAST(NULL AS DOUBLE) AS amount
    FROM ({summary_sql(billing_claims_rules(), billing_claims_preds(), 'claims')}) s WHERE outcome = 'Failed'""",
    ["claims"], [("cl", _CL)]))(_cleanse)
