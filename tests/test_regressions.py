"""Inputs that once lost data or gave wrong answers."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.functions.vitals import decode_event
from wardlake.operators import curate as C
from wardlake.operators import metrics as M
from wardlake.operators import rules as R
from wardlake.operators import rulesets as RS
from wardlake.operators.windows import lag_by_entity
from wardlake.plans import runs
from wardlake.sources import files as IO
from wardlake.sources import warehouse as WH
from wardlake.streaming import streams as ST

BIG = 2 ** 53


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_dedupe_keeps_large_and_null_ids_over_batches(spark, scratch):
    src, out, ck = scratch("in"), scratch("dd"), scratch("ck")
    ids = [BIG, BIG + 1, BIG + 2, BIG + 3, None]
    schema = StructType.fromDDL("event_id long, event_ts string")

    def run():
        s = ST.stream_source(spark, src, schema, event_time="event_ts", fmt="json")
        (ST.dedupe_stream(s, ["event_id"], "event_ts", "1 hour").writeStream.option("checkpointLocation", ck)
         .trigger(availableNow=True).format("parquet").start(out).awaitTermination())

    line = [json.dumps({"event_id": i, "event_ts": "2025-01-01T00:00:00+00:00"}) for i in ids]
    _write(src, "a.json", "\n".join(line) + "\n")
    run()
    _write(src, "b.json", "\n".join(line[1:3] + [json.dumps({"event_id": 7, "event_ts": "2025-01-01T00:10:00+00:00"})]) + "\n")
    run()       # a redelivery in a second micro-batch
    got = [r.event_id for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=str) == sorted([*ids, 7], key=str)


def test_missing_raw_day_overwrites_nothing(spark, scratch):
    roots = {k: scratch(k) for k in ("raw", "cleansed", "curated")}
    schema = StructType.fromDDL("facility_id string, department string, total_beds int, occupied_beds int, snapshot_date string")
    header = "facility_id,department,total_beds,occupied_beds,snapshot_date\n"
    _write(f"{roots['raw']}/bed_capacity/dt=2025-01-01", "p.csv", header + "FAC01,ER,10,3,2025-01-01\n")
    sources = {"bed_capacity": (schema, RS.bed_capacity_rules(), RS.bed_capacity_extra())}
    gold = {"fact_bed_occupancy": ("bed_capacity", C.fact_bed_occupancy)}
    runs.run_batch_daily(spark, roots, "2025-01-01", sources, gold)
    import shutil
    moved = scratch("moved")
    shutil.move(f"{roots['raw']}/bed_capacity/dt=2025-01-01", moved)
    log = runs.run_batch_daily(spark, roots, "2025-01-01", sources, gold).collect()
    assert [(r.source, r.promoted, r.quarantined) for r in log] == [("bed_capacity", None, None)]
    assert spark.read.parquet(f"{roots['cleansed']}/bed_capacity").count() == 1
    assert spark.read.parquet(f"{roots['curated']}/fact_bed_occupancy").count() == 1


def test_two_checkpoints_share_one_gold_folder(spark, scratch):
    schema = StructType.fromDDL("event_id string, patient_id string, facility_id string, heart_rate double, spo2 double, "
                                "systolic_bp double, diastolic_bp double, temperature_c double, event_ts string")
    out = scratch("gold")
    for n in (1, 2):
        src = scratch(f"in{n}")
        _write(src, "a.json", json.dumps({"event_id": f"E{n}", "patient_id": "P", "facility_id": "F", "heart_rate": 200.0, "spo2": 97.0,
                                          "systolic_bp": 120.0, "diastolic_bp": 80.0, "temperature_c": 37.0,
                                          "event_ts": "2025-01-01T00:00:00+00:00"}) + "\n")
        s = ST.stream_source(spark, src, schema, event_time="event_ts", fmt="json")
        ST.stream_to_gold(s, out, scratch(f"ck{n}"), [], {"heart_rate": (40, 150)}).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["E1", "E2"]


def test_range_lag_keeps_large_values_and_far_times(spark):
    far = dt.datetime(9999, 12, 31)
    rows = [(BIG + 5, dt.datetime(2025, 1, 1), 1, BIG + 1), (BIG + 5, far, 2, BIG + 3), (None, None, 3, 1), (None, far, 4, None)]
    df = spark.createDataFrame(rows, "entity long, start timestamp, id long, v long")
    got = {(r.entity, r.id): r.prev for r in lag_by_entity(df, "entity", ["start", "id"], "v", "prev", chunk="range", range_partitions=3)
           .select("entity", "id", "prev").collect()}
    assert got == {(BIG + 5, 1): None, (BIG + 5, 2): BIG + 1, (None, 3): None, (None, 4): 1}


def test_conform_reports_what_does_not_fit(spark):
    schema = StructType.fromDDL("beds int")
    fine = WH.conform(spark.createDataFrame([("7",), (None,)], "beds string"), schema)
    assert [r.beds for r in fine.collect()] == [7, None]
    with pytest.raises(Exception, match="beds does not fit int: 3000000000"):
        WH.conform(spark.createDataFrame([(3_000_000_000,)], "beds long"), schema).collect()


def test_glued_objects_with_braces_in_strings(spark, scratch):
    src = scratch("glued")
    _write(src, "a.json", '{"a":"x} {y"}{"a":"z"}\n{"a":"q\\"}{"} {"a":{"b":{"c":1}}} trailing\n\n')
    got = [r.a for r in IO.split_glued_json(spark, src, StructType.fromDDL("a string")).collect()]
    assert sorted(got, key=str) == sorted(["x} {y", "z", 'q"}{', '{"b":{"c":1}}', None], key=str)


def test_pattern_covers_the_whole_value(spark):
    df = spark.createDataFrame([("P00001",), ("P00001\n",), ("xP00001",)], "id string")
    ok = [r.dq_valid for r in R.evaluate_rules_rows(df, [R.rule_matches("id", "P[0-9]{5}")]).collect()]
    assert ok == [True, False, False]


@pytest.mark.parametrize("sql", ["select count(*) from primary where dx = 'primary'",
                                 "with p as (select * from primary) select count(*) from p where dx = 'primary' and '{x}' = '{x}'"])
def test_custom_sql_keeps_its_literals(spark, sql):
    df = spark.createDataFrame([("primary",), ("other",)], "dx string")
    assert R.rule_custom_sql(sql).metric(df).first()[0] == 1.0


def test_broken_payloads_give_nulls(spark):
    good = base64.b64encode(b'{"a": 1}').decode()
    df = spark.createDataFrame([("a",), (good,), (None,)], "p string")
    got = df.select(decode_event("p", StructType.fromDDL("a int")).alias("e")).select("e.a").collect()
    assert [r.a for r in got] == [None, 1, None]


def test_active_alerts_take_a_timestamp_column(spark):
    df = spark.createDataFrame([("x", 100), ("y", 300)], "id string, expires_at long")
    for now in (F.timestamp_seconds(F.lit(200)), F.lit(200), "1970-01-01 00:03:20"):
        assert [r.id for r in ST.active_alerts(df, now).collect()] == ["y"]


def test_sums_and_means_are_exact(spark):
    claims = spark.createDataFrame([(1, 1.004), (2, 1.004), (3, 1.004)], "claim_id int, claim_amount double")
    assert M.kpi_total_claim_value(claims).first()[0] == 3.012
    visits = spark.createDataFrame([(1.00000001,), (1.00000003,)], "length_of_stay_hours double")
    assert M.kpi_avg_length_of_stay(visits).first()[0] == pytest.approx(1.00000002, abs=1e-12)


def test_more_than_99_departments_have_their_own_ids(spark):
    df = spark.createDataFrame([(f"d{i:03d}",) for i in range(120)], "department string")
    ids = [r.department_id for r in C.dim_department_from(df).collect()]
    assert len(set(ids)) == 120 and "DEPT07" in ids and "DEPT120" in ids
