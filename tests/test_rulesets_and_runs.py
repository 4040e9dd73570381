"""Default (reference-domain) rule sets and the single-day batch run."""

import os

import pytest
from pyspark.sql.types import StructType

from wardlake.operators import rules as R
from wardlake.operators import rulesets as RS
from wardlake.plans import runs
from wardlake.sources import files as IO

VISITS_DDL = ("visit_id string, patient_id string, facility_id string, department string, visit_type string, "
              "attending_staff_id string, admission_ts string, discharge_ts string")


def test_default_visit_rules(spark):
    rows = [
        ("V1", "P00001", "FAC01", "ER", "Emergency", "S0001", "2025-01-02T10:00:00+00:00", None),   # open stay ok
        ("V2", "P1", "FAC01", "ER", "Emergency", "S0001", "2025-01-02T10:00:00+00:00", None),       # bad patient id
        ("V3", "P00002", "FAC09", "ER", "Emergency", "S0001", "2025-01-02T10:00:00+00:00", None),   # unknown facility
        ("V3", "P00003", "FAC02", "Lab", "Inpatient", "S0002", None, None),                          # dept + no admission
    ]
    df = spark.createDataFrame(rows, VISITS_DDL)
    ev = R.evaluate_rules_rows(df, RS.visits_rules())
    got = {r.patient_id: list(r.dq_failed_rules) for r in ev.collect()}
    assert got["P00001"] == []
    assert got["P1"] == ['ColumnValues "patient_id" matches "P[0-9]{5}"']
    assert got["P00002"] == ['ColumnValues "facility_id" in ["FAC01", "FAC02", "FAC03"]']
    assert set(got["P00003"]) == {'IsComplete "admission_ts"',
                                  'ColumnValues "department" in ["ER", "ICU", "Cardiology", "Pediatrics", "Orthopedics"]'}
    summary = {r.rule: (r.outcome, r.metric) for r in R.evaluate_rules_summary(df, RS.visits_rules()).collect()}
    assert summary['Uniqueness "visit_id" > 0.99'] == ("Failed", 0.5)       # V3 twice: 2 of 4 values unique


def test_default_vitals_ranges_are_inclusive_and_null_tolerant(spark):
    df = spark.createDataFrame([("E1", "P00001", "FAC01", 300.0, 100.0, None, None, 45.0),
                                ("E2", "P00001", "FAC01", 300.5, None, None, None, None)],
                               "event_id string, patient_id string, facility_id string, heart_rate double, "
                               "spo2 double, systolic_bp double, diastolic_bp double, temperature_c double")
    ev = R.evaluate_rules_rows(df, RS.vitals_rules())
    assert {r.event_id: r.dq_valid for r in ev.collect()} == {"E1": True, "E2": False}


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write(text)


def test_single_day_batch_run(spark, scratch):
    raw, clean, cur = scratch("raw"), scratch("clean"), scratch("cur")
    header = "visit_id,patient_id,facility_id,department,visit_type,attending_staff_id,admission_ts,discharge_ts\n"
    _write(f"{raw}/visits/dt=2025-01-02", header +
           "V1,P00001,FAC01,ER,Emergency,S0001,2025-01-01T08:00:00+00:00,2025-01-02T08:00:00+00:00\n"
           "V2,P00001,FAC01,ER,Emergency,S0001,2025-01-02T09:00:00+00:00,\n"
           "V3,BAD,FAC01,ER,Emergency,S0001,2025-01-02T09:00:00+00:00,\n")
    sources = {"visits": (StructType.fromDDL(VISITS_DDL), RS.visits_rules(), []),
               "billing_claims": (StructType.fromDDL(
                   "claim_id string, patient_id string, facility_id string, payer string, claim_amount double, "
                   "status string, service_date string"), RS.billing_claims_rules(), [])}
    log = {r.source: (r.promoted, r.quarantined) for r in
           runs.run_batch_daily(spark, {"raw": raw, "cleansed": clean, "curated": cur}, "2025-01-02",
                                sources, runs.DEFAULT_GOLD).collect()}
    # only gold tables of sources in this run are rebuilt
    assert sorted(os.listdir(cur)) == ["fact_patient_visit"]
    assert log == {"visits": (2, 1), "billing_claims": (None, None)}    # missing day -> skipped, nothing written
    fact = {r.visit_id: (r.still_admitted, r.length_of_stay_hours)
            for r in spark.read.parquet(f"{cur}/fact_patient_visit").collect()}
    assert fact == {"V1": (False, 24.0), "V2": (True, None)}
    assert spark.read.parquet(f"{clean}/_quarantine/visits/dt=2025-01-02").count() == 1


def test_rerun_of_a_day_is_idempotent(spark, scratch):
    root = scratch("clean")
    df = spark.createDataFrame([("F", "ER", 4, 5, "d"), ("F", "ER", 4, 1, "d"), ("F", "ER", 0, 0, "d")],
                               "facility_id string, department string, total_beds int, occupied_beds int, "
                               "snapshot_date string")
    rules = RS.bed_capacity_rules(["F"], ["ER"])
    extra = RS.bed_capacity_extra()
    first = IO.write_cleansing_run(df, rules, root, "beds", "2025-01-02", extra)
    snap = [sorted(map(tuple, spark.read.parquet(p).collect())) for p in
            (f"{root}/beds/dt=2025-01-02", f"{root}/_quarantine/beds/dt=2025-01-02")]
    second = IO.write_cleansing_run(df, rules, root, "beds", "2025-01-02", extra)
    again = [sorted(map(tuple, spark.read.parquet(p).collect())) for p in
             (f"{root}/beds/dt=2025-01-02", f"{root}/_quarantine/beds/dt=2025-01-02")]
    assert first == second and snap == again and (first["promoted"], first["quarantined"]) == (1, 2)


def test_one_threshold_config_drives_fact_and_stream(spark):
    from wardlake.operators.curate import fact_vitals_alert
    from wardlake.plans import bindings as B
    from wardlake.streaming.streams import alerts_from_readings
    v = B.vitals(spark, "/root/testdata/sf0.001")
    for limits in (B.VITAL_LIMITS, {"heart_rate": (5, 400), "spo2": (None, 90)}):
        fact_ids = {r.event_id for r in fact_vitals_alert(v, limits).select("event_id").collect()}
        stream_ids = {r.source_event_id for r in alerts_from_readings(v, limits).select("source_event_id").collect()}
        assert fact_ids == stream_ids and fact_ids


def test_backfill_writes_rule_outcomes_per_day(spark, scratch):
    raw, clean = scratch("raw"), scratch("clean")
    header = "facility_id,department,total_beds,occupied_beds,snapshot_date\n"
    _write(f"{raw}/beds/dt=2025-01-01", header + "FAC01,ER,10,3,2025-01-01\nFAC01,ER,10,12,2025-01-01\n")
    _write(f"{raw}/beds/dt=2025-01-02", header + "FAC01,ER,10,4,2025-01-02\n")
    schema = StructType.fromDDL("facility_id string, department string, total_beds int, occupied_beds int, "
                                "snapshot_date string")
    df = IO.read_raw_csv(spark, raw, "beds", schema, run_date=IO.ALL_DAYS)
    log = IO.write_cleansing_run(df, RS.bed_capacity_rules(), clean, "beds", IO.ALL_DAYS, RS.bed_capacity_extra())
    assert (log["promoted"], log["quarantined"]) == (2, 1)
    dq = spark.read.parquet(f"{clean}/_dq_results/source=beds")
    by_day = {(str(r.dt), r.rule): r.outcome for r in dq.collect()}
    assert by_day[("2025-01-01", "occupied_beds <= total_beds")] == "Failed"
    assert by_day[("2025-01-02", "occupied_beds <= total_beds")] == "Passed"
    sql_rule = 'CustomSql "select count(*) from primary where occupied_beds > total_beds" = 0'
    assert dict(dq.dtypes)["dt"] == "date"
    whole = {r.rule: r.outcome for r in spark.read.parquet(f"{clean}/_dq_results_whole/source=beds").collect()}
    assert whole[sql_rule] == "Failed"
    assert spark.read.parquet(f"{clean}/beds").count() == 2


@pytest.fixture()
def gathered(spark, monkeypatch):
    """The columns of every rebalance hint given from here on: each is a shuffle of all rows."""
    kind, seen = type(spark.range(0)), []
    hint = kind.hint

    def noted(self, name, *args):
        seen.extend([args] if name == "rebalance" else [])
        return hint(self, name, *args)
    monkeypatch.setattr(kind, "hint", noted)
    return seen


def test_backfill_writes_days_from_where_they_were_read(spark, scratch, gathered):
    roots = {k: scratch(k) for k in ("raw", "cleansed", "curated")}
    header = "facility_id,department,total_beds,occupied_beds,snapshot_date\n"
    for day in (1, 2, 3):
        for part in (1, 2):
            folder = f"{roots['raw']}/bed_capacity/dt=2025-01-0{day}"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/p{part}.csv", "w") as f:
                f.write(header + f"FAC01,ER,{10 * day + part},3,d{day}\nFAC01,ER,{part},99,d{day}\n")
    sources = {"bed_capacity": (StructType.fromDDL("facility_id string, department string, total_beds int, occupied_beds int, "
                                                   "snapshot_date string"), RS.bed_capacity_rules(), RS.bed_capacity_extra())}
    log = runs.run_batch_daily(spark, roots, IO.ALL_DAYS, sources, runs.DEFAULT_GOLD).collect()
    assert gathered == []
    assert [(r.promoted, r.quarantined) for r in log] == [(6, 6)]
    good = spark.read.parquet(f"{roots['cleansed']}/bed_capacity").collect()
    bad = spark.read.parquet(f"{roots['cleansed']}/_quarantine/bed_capacity").collect()
    assert sorted((str(r.dt), r.total_beds, r.occupied_beds) for r in good) == sorted(
        (f"2025-01-0{day}", 10 * day + part, 3) for day in (1, 2, 3) for part in (1, 2))
    assert sorted((str(r.dt), r.total_beds, r.occupied_beds) for r in bad) == sorted(
        (f"2025-01-0{day}", part, 99) for day in (1, 2, 3) for part in (1, 2))
    assert spark.read.parquet(f"{roots['curated']}/fact_bed_occupancy").count() == 6


def test_rows_that_do_not_lie_by_day_are_gathered(spark, scratch, gathered):
    df = spark.range(0, 40, 1, 4).selectExpr("id", "date_add(date'2025-01-01', cast(id % 5 as int)) AS dt")
    known = R.rule_in_table("id", spark.range(0, 30).withColumnRenamed("id", "k"), "k")
    for rules, by_day in (([R.rule_compare("id", "<", 30)], False), ([known], True)):
        gathered.clear()
        log = IO.write_cleansing_run(df, rules, scratch("clean"), "ids", IO.ALL_DAYS, by_day=by_day)
        assert gathered == [("__verdict", "dt")] and (log["promoted"], log["quarantined"]) == (30, 10)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_landed_text_is_compressed_and_whole(spark, scratch, gathered, fmt):
    days = IO.OPEN_FILES * 2 + 3        # one task meets more folders than it keeps files open
    rows = spark.range(0, days * 20, 1, 1).selectExpr(
        "id", "if(id % 7 = 0, null, concat('a,\"b\" ', id)) AS note",
        f"cast(date_add(date'2025-01-01', cast(id % {days} as int)) as string) AS day")
    want = sorted((r.id, r.note, r.day) for r in rows.collect())
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    for gather in (True, False):
        gathered.clear()
        root = scratch("raw")
        at = IO.land_partitioned(rows, root, "notes", "day", fmt, gather=gather)
        assert gathered == ([("dt",)] if gather else []) and spark.conf.get(key, None) == before
        files = [f for _, _, names in os.walk(at.removeprefix("file:")) for f in names if f.startswith("part-")]
        assert files and all(f.endswith(f".{fmt}.gz") for f in files)
        read = IO.read_raw_csv if fmt == "csv" else IO.read_raw_json
        got = read(spark, root, "notes", StructType.fromDDL("id long, note string"), run_date=IO.ALL_DAYS).collect()
        assert sorted(((r.id, r.note, str(r.dt)) for r in got), key=str) == sorted(want, key=str)
