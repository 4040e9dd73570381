"""Loads that replace content in one step, committed micro-batches, the keyed alert store."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.operators import curate as C
from wardlake.operators import datasets as D
from wardlake.operators import rules as R
from wardlake.operators import windows as W
from wardlake.plans import runs
from wardlake.sources import files as IO
from wardlake.sources import versions as VS
from wardlake.sources import warehouse as WH
from wardlake.streaming import streams as ST

BEDS = "facility_id string, department string, total_beds int, occupied_beds int, snapshot_date string, occupancy_rate double"
READING = ("event_id string, patient_id string, facility_id string, heart_rate double, spo2 double, systolic_bp double, "
           "diastolic_bp double, temperature_c double, event_ts string")


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def _reading(i, rate=200.0, patient="P1"):
    return json.dumps({"event_id": f"E{i}", "patient_id": patient, "facility_id": "F", "heart_rate": rate, "spo2": 97.0,
                       "systolic_bp": 120.0, "diastolic_bp": 80.0, "temperature_c": 37.0,
                       "event_ts": f"2025-01-01T00:{i:02d}:00+00:00"}) + "\n"


def _stream(spark, src, **kw):
    return ST.stream_source(spark, src, StructType.fromDDL(READING), event_time="event_ts", fmt="json", **kw)


def _beds(spark, n, bad=False):
    rows = [(f"F{i}", "ER", 10, i, "2025-01-01", i / 10) for i in range(n)]
    df = spark.createDataFrame(rows, BEDS)
    # a value that does not fit fails its task, after others may have written their part
    return df.withColumn("total_beds", F.when(F.col("facility_id") == f"F{n - 1}", F.lit(1 << 40)).otherwise(10)) if bad else df


def test_failed_load_keeps_the_old_content(spark, scratch):
    path = scratch("wh") + "/fact_bed_occupancy"
    WH.load_warehouse(_beds(spark, 3), "fact_bed_occupancy", path=path)
    for _ in range(2):
        with pytest.raises(Exception, match="does not fit"):
            WH.load_warehouse(_beds(spark, 8, bad=True).repartition(4), "fact_bed_occupancy", path=path)
        assert WH.read_warehouse(spark, path).count() == 3
    before = WH.read_warehouse(spark, path)
    WH.load_warehouse(_beds(spark, 5), "fact_bed_occupancy", path=path)
    assert WH.read_warehouse(spark, path).count() == 5
    assert before.count() == 3                      # a reader underway finishes on its version
    for n in (6, 7):
        WH.load_warehouse(_beds(spark, n), "fact_bed_occupancy", path=path)
    assert [v.version for v in VS.versions(spark, path)] == [4, 3]       # older ones are retired
    with pytest.raises(FileNotFoundError):
        WH.read_warehouse(spark, scratch("nothing"))


def test_failed_curated_write_keeps_the_old_content(spark, scratch):
    path = scratch("cur") + "/t"
    schema = WH.warehouse_schema("fact_bed_occupancy")
    IO.write_curated(_beds(spark, 3), path, schema)
    with pytest.raises(Exception, match="does not fit"):
        IO.write_curated(_beds(spark, 8, bad=True), path, schema)
    assert spark.read.parquet(path).count() == 3 and os.listdir(os.path.dirname(path)) == ["t"]
    IO.write_curated(_beds(spark, 4), path, schema)
    assert spark.read.parquet(path).count() == 4


def _visits(spark, hot):
    # a third of all visits belong to one patient (or to none)
    rows = [(f"V{i:05d}", hot if i % 3 == 0 else f"P{1 + i % 500}", "F1", "ER", "x", "S", f"2025-01-{1 + i % 28:02d}T{i % 24:02d}:00:00+00:00",
             None if i % 5 == 0 else f"2025-02-{1 + i % 27:02d}T00:00:00+00:00", i % 5 == 0, 1.0) for i in range(3000)]
    return spark.createDataFrame(rows, WH.warehouse_schema("fact_patient_visit"))


@pytest.mark.parametrize("hot", ["P0", None])
def test_visits_over_the_loaded_fact_need_no_exchange(spark, scratch, hot):
    df, name = _visits(spark, hot), f"visits_{'null' if hot is None else 'hot'}"
    schema, layout, where = WH.warehouse_schema("fact_patient_visit"), WH.TABLE_LAYOUT["fact_patient_visit"], scratch("tables")
    for _ in range(3):
        WH.load_warehouse(df, name, schema, layout=layout, buckets=6, location=where)
    assert len(os.listdir(where)) == 2 and spark.table(name).count() == 3000
    assert spark.table(name).where(F.col(W.CHUNK) > 0).count() == 1000
    dim = spark.createDataFrame([("F1", "North")], "facility_id string, facility_name string")
    out = D.ds_visits(spark.table(name), dim)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the rows themselves are not shuffled; only the tails of heavy patients are, which are few
    big = plan[:plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in big
    plain = D.ds_visits(df, dim, chunk=None)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    day = spark.table(name).where("admission_ts >= '2025-01-28'")
    assert "PushedFilters: [IsNotNull(admission_ts), GreaterThanOrEqual(admission_ts" in day._jdf.queryExecution().executedPlan().toString()


def test_failed_table_load_leaves_the_view(spark, scratch):
    where = scratch("tables")
    WH.load_warehouse(_beds(spark, 3), "beds_failing", WH.warehouse_schema("fact_bed_occupancy"), location=where)
    with pytest.raises(Exception, match="does not fit"):
        WH.load_warehouse(_beds(spark, 8, bad=True), "beds_failing", WH.warehouse_schema("fact_bed_occupancy"), location=where)
    assert spark.table("beds_failing").count() == 3 and len(os.listdir(where)) == 1


RULES = [R.rule_is_complete("patient_id"), R.rule_between("heart_rate", 0, 300)]
LIMITS = {"heart_rate": (40, 150)}


def test_batch_that_fails_halfway_is_not_seen_and_its_replay_counts_once(spark, scratch, monkeypatch):
    src, out, ck = scratch("in"), scratch("gold"), scratch("ck")
    _write(src, "a.json", _reading(1) + _reading(2, 999.0) + _reading(3, 80.0))
    ST.stream_to_gold(_stream(spark, src), out, ck, RULES, LIMITS).awaitTermination()
    _write(src, "b.json", _reading(4) + _reading(5, 400.0))
    good = VS.commit_batch

    def broken(*a, **k):
        raise OSError("lost before the commit")
    monkeypatch.setattr(VS, "commit_batch", broken)
    with pytest.raises(Exception):
        ST.stream_to_gold(_stream(spark, src), out, ck, RULES, LIMITS).awaitTermination()
    read = lambda output: sorted(r.event_id for r in VS.read_committed(spark, out, output).collect())
    assert (read(""), read(ST.PROMOTED_DIR), read(ST.BAD_DIR)) == (["E1"], ["E1", "E3"], ["E2"])
    monkeypatch.setattr(VS, "commit_batch", good)
    for _ in range(2):
        ST.stream_to_gold(_stream(spark, src), out, ck, RULES, LIMITS).awaitTermination()
    assert (read(""), read(ST.PROMOTED_DIR), read(ST.BAD_DIR)) == (["E1", "E4"], ["E1", "E3", "E4"], ["E2", "E5"])
    assert [list(r.dq_failed_rules) for r in VS.read_committed(spark, out, ST.BAD_DIR).collect()] == [
        ['ColumnValues "heart_rate" between 0 and 300']] * 2
    assert [(r.source, r.batches, r.promoted, r.quarantined) for r in ST.curation_log(spark, out, "vitals").collect()] == [("vitals", 2, 3, 2)]
    outcomes = VS.read_committed(spark, out, ST.OUTCOMES_DIR).groupBy("rule", "outcome").count().collect()
    assert {(r.rule, r.outcome): r["count"] for r in outcomes} == {
        ('IsComplete "patient_id"', "Passed"): 2, ('ColumnValues "heart_rate" between 0 and 300', "Failed"): 2}


def test_committed_batch_is_left_alone(spark, scratch):
    src, out, ck = scratch("in"), scratch("gold"), scratch("ck")
    _write(src, "a.json", _reading(1))
    ST.stream_to_gold(_stream(spark, src), out, ck, RULES, LIMITS).awaitTermination()
    (commit,) = VS.committed_batches(spark, out).collect()
    # the stream forgets that the batch was done: it is run again and finds its record
    for name in (f"{commit.batch}", f".{commit.batch}.crc"):
        os.remove(f"{ck}/commits/{name}")
    folder = VS.batch_path(out, "", commit["query"], commit.batch)
    names = sorted(os.listdir(folder))
    ST.stream_to_gold(_stream(spark, src), out, ck, RULES, LIMITS).awaitTermination()
    assert sorted(os.listdir(folder)) == names and VS.committed_batches(spark, out).count() == 1
    assert VS.read_committed(spark, scratch("none")) is None


def test_streaming_run_with_two_sources_and_load(spark, scratch):
    roots = {k: scratch(k) for k in ("curated", "cleansed", "warehouse")}
    src, rx, ck = scratch("in"), scratch("rx"), scratch("ck")
    _write(src, "a.json", _reading(1) + _reading(2, 80.0))
    _write(rx, "a.json", '{"event_id": "R1", "dosage_mg": 5}\n{"event_id": "R2", "dosage_mg": 0}\n')
    dose = StructType.fromDDL("event_id string, dosage_mg int")

    def run():
        log = runs.run_streaming_curation(spark, _stream(spark, src), roots, RULES, ST.DEFAULT_VITAL_LIMITS, ck,
                                          {"prescriptions": (ST.stream_source(spark, rx, dose), [R.rule_compare("dosage_mg", ">", 0)])})
        return {r.source: (r.promoted, r.quarantined) for r in log.collect()}
    assert run() == {"vitals": (2, 0), "prescriptions": (1, 1)}
    _write(src, "b.json", _reading(3, 20.0))
    assert run() == {"vitals": (3, 0), "prescriptions": (1, 1)}
    fact = WH.read_warehouse(spark, f"{roots['warehouse']}/fact_vitals_alert")
    assert fact.schema == WH.warehouse_schema("fact_vitals_alert")
    assert sorted(r.event_id for r in fact.collect()) == ["E1", "E3"]
    assert VS.read_committed(spark, f"{roots['cleansed']}/prescriptions", ST.BAD_DIR).first().event_id == "R2"


def test_alert_store_has_one_row_per_key_and_lets_expired_ones_go(spark, scratch):
    store, schema = scratch("store"), "patient_id string, alert_id string, note string, expires_at long"
    put = lambda rows, now: ST.put_alerts(spark, store, spark.createDataFrame(rows, schema), F.lit(now))
    put([("P1", "A1", "x", 100), ("P1", "A1", "x", 100), ("P2", "A1", "y", 100), (None, "A2", "z", 300)], 50)
    put([("P1", "A1", "again", 150)], 60)           # redelivered later: replaces its key
    put([("P1", "A1", "old", 120)], 60)             # an older copy does not
    got = lambda now: sorted((str(r.patient_id), r.note) for r in ST.read_alerts(spark, store, F.lit(now)).collect())
    assert got(60) == [("None", "z"), ("P1", "again"), ("P2", "y")]
    assert got(120) == [("None", "z"), ("P1", "again")]
    ST.put_alerts(spark, store, now=F.lit(200))
    assert VS.read_current(spark, store).count() == 1 and len(VS.versions(spark, store)) == 2
    with pytest.raises(ValueError):
        ST.put_alerts(spark, scratch("empty"))


def test_registering_reads_the_manifest_and_no_footer(spark, scratch):
    root = scratch("clean")
    IO.write_cleansed(spark.createDataFrame([(1, "2025-01-01")], "a int, dt string"), root, "src", "2025-01-01")
    IO.write_cleansed(spark.createDataFrame([(2, "x")], "a int, b string"), root, "src", "2025-01-02")
    IO.write_cleansed(spark.createDataFrame([(3, "y")], "a int, b string"), root, "src", "2025-01-03")
    _write(f"{root}/src/dt=2025-01-04", "broken.parquet", "no footer here")
    WH.register_tables(spark, root, ["src"])            # would fail on that file if it looked
    os.remove(f"{root}/src/dt=2025-01-04/broken.parquet")
    (name,) = WH.register_tables(spark, root, ["src"])
    got = spark.table(name).select("a", "b", F.col("dt").cast("string")).collect()
    assert sorted(map(tuple, got)) == [(1, None, "2025-01-01"), (2, "x", "2025-01-02"), (3, "y", "2025-01-03")]
    assert len([x for x in os.listdir(f"{root}/_schemas/src") if not x.startswith((".", "_"))]) == 2
    IO.record_columns(spark, root, "src", StructType.fromDDL("a string"))
    with pytest.raises(ValueError, match="src.a"):
        WH.register_tables(spark, root, ["src"])


def test_date_range_opens_its_days_only(spark, scratch):
    root = scratch("raw")
    df = spark.createDataFrame([(i, f"2025-01-{i:02d}") for i in range(1, 21)], "v int, d string").where("v <> 5")
    IO.land_partitioned(df, root, "src", "d", "parquet")
    r = IO.read_date_range(spark, root, "src", "2025-01-04", "2025-01-06")          # the 5th never landed
    assert sorted(x.v for x in r.collect()) == [4, 6]
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan
    schema = StructType.fromDDL("v int")
    assert IO.read_date_range(spark, root, "src", "2030-01-01", "2030-01-02", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        IO.read_date_range(spark, root, "src", "2030-01-01", "2030-01-02")


@pytest.mark.parametrize("depth", [1, 5, 50])
def test_glued_objects_of_any_depth(spark, scratch, depth):
    src, deep = scratch("glued"), {"s": 'a}{"b\\'}
    for _ in range(depth):
        deep = {"n": deep}
    lines = [json.dumps({"id": 1, "x": deep}) + json.dumps({"id": 2}) + "  " + json.dumps({"x": deep, "id": 3}),
             json.dumps({"id": 4, "x": deep}) + '{"id": 5, "x": {"torn": 1', '} {"id": 6}', "", "   "]
    _write(src, "a.txt", "\n".join(lines) + "\n")
    got = [r.id for r in IO.split_glued_json(spark, src, StructType.fromDDL("id int, x string")).collect()]
    assert sorted(i for i in got if i is not None) == [1, 2, 3, 4, 5, 6] or sorted(i for i in got if i is not None) == [1, 2, 3, 4, 6]
    assert 6 in got and len(got) == 7       # the torn tail and the stray brace are records of their own


def test_value_table_equals_list(spark):
    rows = [(i, v) for i, v in enumerate(["a", "b", None, "zz", "a", ""])]
    df = spark.createDataFrame(rows, "id int, v string")
    values = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "known string")
    for policy in ("pass", "fail"):
        listed, table = R.rule_in_set("v", ["a", ""], policy), R.rule_in_table("v", values, "known", listed_name(policy), policy)
        want = {r.id: r.dq_valid for r in R.evaluate_rules_rows(df, [listed]).collect()}
        out = R.evaluate_rules_rows(df, [table, R.rule_is_complete("id")])
        assert out.columns == ["id", "v", R.FAILED, R.VALID]
        assert {r.id: r.dq_valid for r in out.collect()} == want
        assert R.evaluate_rules_summary(df, [table]).first().metric == R.evaluate_rules_summary(df, [listed]).first().metric
    none = R.rule_in_table("v", values.where("known = 'nowhere'"), "known")
    assert sorted(r.id for r in R.evaluate_rules_rows(df, [none]).where(R.VALID).collect()) == [2]


def listed_name(policy):
    return f"in table, {policy}"


def test_cleansing_run_reads_the_raw_rows_once(spark, scratch):
    root, seen = scratch("clean"), spark.sparkContext.accumulator(0)
    from pyspark.sql.functions import udf

    def look(x):
        seen.add(1)
        return x
    df = spark.createDataFrame([(i, i % 7) for i in range(100)], "id int, v int").withColumn("v", udf(look, "int")("v"))
    rules = [R.rule_compare("v", "<", 5), R.rule_uniqueness("id", ">", 0.99), R.rule_custom_sql("select count(*) from primary where v = 6")]
    log = IO.write_cleansing_run(df, rules, root, "src", "2025-01-01")
    assert (log["promoted"], log["quarantined"]) == (72, 28) and seen.value == 100
    got = {r.rule: (r.outcome, json.loads(r.evaluated_metrics)) for r in
           spark.read.parquet(f"{root}/_dq_results/source=src/dt=2025-01-01").collect()}
    want = {r.rule: (r.outcome, r.evaluated_metrics) for r in R.evaluate_rules_summary(df, rules).collect()}
    assert got == want
    assert not [x for x in os.listdir(f"{root}/_staging")]


def test_facilities_from_a_table(spark):
    df = spark.createDataFrame([(1, "N"), (1, "M"), (2, None), (None, "x")], "facility_id int, facility_name string")
    assert sorted(map(tuple, C.dim_facility_from(df).collect())) == [("1", "M"), ("2", None)]


def test_viewer_counts_equal_the_filtered_rows(spark):
    from wardlake.operators import access as A
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, facility_id int")
    grants = spark.createDataFrame([("a", 0), ("a", 0), ("b", None)], "user_name string, facility_id int")
    every = spark.createDataFrame([(i,) for i in range(3)], "facility_id int")
    for universe in (every, None):
        rows = (A.row_filter_viewer(df, grants, ["a", "b", "c"], every) if universe is not None
                else A.row_filter_strict(df, grants, ["a", "b", "c"], viewer_col="viewer"))
        want = {(r.viewer, r.facility_id): r["count"] for r in rows.groupBy("viewer", "facility_id").count().collect()}
        got = {(r.viewer, r.facility_id): r.rows_seen for r in A.viewer_counts(df, grants, ["a", "b", "c"], universe).collect()}
        assert got == want and want
