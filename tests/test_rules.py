import pytest
from pyspark.sql import functions as F

from wardlake.operators import rules as R
from wardlake.operators import rulesets as RS


def test_null_policy_and_bounds(spark):
    df = spark.createDataFrame([(1, 100.0), (2, None), (3, 100.0001), (4, 0.0)], "id int, spo2 double")
    rows = {r.id: r.ok for r in df.select("id", R.rule_between("spo2", 0, 100).condition(df).alias("ok")).collect()}
    assert rows == {1: True, 2: True, 3: False, 4: True}   # inclusive, NULL passes
    fail = R.rule_between("spo2", 0, 100, null_policy="fail")
    assert df.filter(~fail.condition(df)).count() == 2
    excl = R.rule_between("spo2", 0, 100, inclusive=False)
    assert {r.id for r in df.filter(excl.condition(df)).collect()} == {2}  # 0 and 100 excluded, NULL passes
    with pytest.raises(ValueError):
        R.rule_in_set("x", [1], null_policy="maybe").condition(df)


def test_matches_is_anchored(spark):
    df = spark.createDataFrame([("P00001",), ("XP00001Z",), ("P1",)], "p string")
    full = R.rule_matches("p", "P[0-9]{5}")
    part = R.rule_matches("p", "P[0-9]{5}", anchored=False)
    assert [r.p for r in df.filter(full.condition(df)).collect()] == ["P00001"]
    assert sorted(r.p for r in df.filter(part.condition(df)).collect()) == ["P00001", "XP00001Z"]


def test_split_is_a_partition_of_the_input(spark):
    df = spark.createDataFrame(
        [("a", 5, 3), ("b", 5, 9), ("c", None, 1), ("d", 0, 0), ("e", 2, None)],
        "facility_id string, total_beds int, occupied_beds int").withColumn("department", F.lit("ER"))
    rules = RS.bed_capacity_rules(["a", "b", "c", "d", "e"], ["ER"])
    ev = R.evaluate_rules_rows(df, rules, RS.bed_capacity_extra())
    good = R.split_valid(ev, df.columns)
    bad = R.split_quarantine(ev, df.columns)
    assert good.count() + bad.count() == df.count()
    assert good.unionAll(bad).exceptAll(df).count() == 0 and df.exceptAll(good.unionAll(bad)).count() == 0
    assert {r.facility_id for r in good.collect()} == {"a"}   # b: occupied>total, c/e: NULL, d: total 0
    summary = {r.rule: r.outcome for r in R.evaluate_rules_summary(df, rules, RS.bed_capacity_extra()).collect()}
    assert summary['CustomSql "select count(*) from primary where occupied_beds > total_beds" = 0'] == "Failed"
    assert summary['IsComplete "total_beds"'] == "Failed"


def test_uniqueness_records_but_never_quarantines(spark):
    df = spark.createDataFrame([(i % 95,) for i in range(100)] + [(None,)], "claim_id int")
    rules = [R.rule_uniqueness("claim_id", ">", 0.99)]
    ev = R.evaluate_rules_rows(df, rules)
    assert ev.filter(~F.col(R.VALID)).count() == 0
    row = R.evaluate_rules_summary(df, rules).collect()[0]
    assert row.outcome == "Failed" and abs(row.metric - 90 / 100) < 1e-12
    empty = R.evaluate_rules_summary(df.limit(0), rules).collect()[0]
    assert empty.metric is None and empty.outcome == "Passed"


def test_custom_sql_binds_primary_without_global_view(spark):
    df = spark.createDataFrame([(3, 2), (1, 2)], "occupied_beds int, total_beds int")
    r = R.rule_custom_sql("select count(*) from primary where occupied_beds > total_beds", "=", 0)
    out = R.evaluate_rules_summary(df, [r]).collect()[0]
    assert out.metric == 1.0 and out.outcome == "Failed"
    assert "primary" not in [t.name for t in spark.catalog.listTables()]


def test_row_rules_stay_in_one_codegen_stage(spark):
    df = spark.range(100).select(F.col("id").alias("visit_id"), (F.col("id") % 7).alias("facility_id"))
    ev = R.evaluate_rules_rows(df, [R.rule_is_complete("visit_id"), R.rule_in_set("facility_id", [1, 2, 3])])
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
