import base64
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.functions.vitals import DEFAULT_VITAL_LIMITS, decode_event
from wardlake.operators import rules as R
from wardlake.sources import files as IO
from wardlake.sources import warehouse as WH
from wardlake.streaming import streams as ST

BED_DDL = "facility_id string, department string, total_beds int, occupied_beds int, snapshot_date string"


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_csv_reader_nulls_and_header_check(spark, scratch):
    root = scratch("raw")
    day = f"{root}/bed_capacity/dt=2025-01-02"
    _write(day, "a.csv", "facility_id,department,total_beds,occupied_beds,snapshot_date\n"
                         "FAC01,ER,10,abc,2025-01-02\nFAC02,,5,3,2025-01-02\n")
    df = IO.read_raw_csv(spark, root, "bed_capacity", StructType.fromDDL(BED_DDL), run_date="2025-01-02")
    rows = df.orderBy("facility_id").collect()
    assert rows[0].occupied_beds is None and rows[1].department is None
    _write(f"{root}/swapped/dt=2025-01-02", "a.csv",
           "department,facility_id,total_beds,occupied_beds,snapshot_date\nER,FAC01,1,1,x\n")
    with pytest.raises(Exception):
        IO.read_raw_csv(spark, root, "swapped", StructType.fromDDL(BED_DDL), run_date="2025-01-02").collect()
    assert IO.read_raw_csv(spark, root, "nothing", StructType.fromDDL(BED_DDL), "2025-01-02", missing="empty").count() == 0


def test_glued_json_recovers_every_object(spark, scratch):
    path = scratch("glued")
    recs = [{"event_id": f"E{i}", "heart_rate": 60 + i} for i in range(7)]
    line1 = "".join(json.dumps(r) for r in recs[:5])
    _write(path, "x.json", line1 + "\n" + json.dumps(recs[5]) + json.dumps(recs[6]) + "\n")
    schema = StructType.fromDDL("event_id string, heart_rate double")
    assert spark.read.schema(schema).json(path).count() == 2          # plain reader loses objects
    assert IO.split_glued_json(spark, path, schema).count() == 7


def test_quarantine_rerun_clears_stale_rows(spark, scratch):
    root = scratch("clean")
    rules = [R.rule_compare("total_beds", ">", 0)]
    bad = spark.createDataFrame([("F", "ER", 0, 0, "d")], BED_DDL)
    fixed = spark.createDataFrame([("F", "ER", 4, 0, "d")], BED_DDL)
    log1 = IO.write_cleansing_run(bad, rules, root, "beds", "2025-01-02")
    assert (log1["promoted"], log1["quarantined"]) == (0, 1)
    log2 = IO.write_cleansing_run(fixed, rules, root, "beds", "2025-01-02")
    assert (log2["promoted"], log2["quarantined"]) == (1, 0)
    assert spark.read.parquet(f"{root}/_quarantine/beds/dt=2025-01-02").count() == 0
    assert spark.read.parquet(f"{root}/beds/dt=2025-01-02").count() == 1
    dq = spark.read.parquet(f"{root}/_dq_results/source=beds/dt=2025-01-02").collect()
    assert dq[0].outcome == "Passed" and json.loads(dq[0].evaluated_metrics)["rows"] == 1.0


def test_date_range_prunes_partitions(spark, scratch):
    root = scratch("raw")
    df = spark.createDataFrame([(i, f"2025-01-{i:02d}") for i in range(1, 11)], "v int, d string")
    IO.land_partitioned(df, root, "src", "d", "parquet")
    r = IO.read_date_range(spark, root, "src", "2025-01-03", "2025-01-05")
    assert sorted(x.v for x in r.collect()) == [3, 4, 5]
    assert "PartitionFilters: [isnotnull(dt" in r._jdf.queryExecution().executedPlan().toString()


def test_conform_and_layout(spark):
    df = spark.createDataFrame([(1, "ER", "10", 3, "2025-01-01", 0.3)],
                               "facility_id int, department string, total_beds string, occupied_beds int, "
                               "snapshot_date string, occupancy_rate double")
    out = WH.conform(df, WH.warehouse_schema("fact_bed_occupancy"))
    assert out.schema == WH.warehouse_schema("fact_bed_occupancy")
    laid = WH.table_layout(df, dist_key="facility_id", sort_keys=["snapshot_date"], partitions=4)
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(facility_id" in plan and "REBALANCE" in plan


def test_decode_and_stream_equals_batch(spark, scratch):
    src = scratch("in")
    readings = [{"event_id": f"E{i}", "patient_id": "P00001", "facility_id": "FAC01",
                 "heart_rate": 30 + 20 * i, "spo2": 95.0, "systolic_bp": None, "temperature_c": 36.6,
                 "event_ts": f"2025-01-01T0{i}:00:00+00:00"} for i in range(8)]
    _write(src, "a.json", "\n".join(json.dumps(r) for r in readings) + "\n")
    schema = StructType.fromDDL("event_id string, patient_id string, facility_id string, heart_rate double, "
                                "spo2 double, systolic_bp double, temperature_c double, event_ts string")
    payload = spark.createDataFrame([(base64.b64encode(json.dumps(readings[0]).encode()).decode(),)], "data string")
    assert payload.select(decode_event("data", schema).alias("e")).collect()[0].e.heart_rate == 30.0
    stream = ST.stream_source(spark, src, schema, fmt="json")
    out, ck = scratch("alerts"), scratch("ck")
    ST.stream_alerts(stream, out, ck).awaitTermination()
    got = {r.source_event_id: list(r.reasons) for r in spark.read.parquet(out).collect()}
    batch = ST.alerts_from_readings(spark.read.schema(schema).json(src))
    assert got == {r.source_event_id: list(r.reasons) for r in batch.collect()}
    assert got["E0"] == ["heart_rate below 40 (was 30.0)"]
    assert set(got) == {"E0", "E7"}   # E6 reads exactly 150: on the limit is not a breach
    assert DEFAULT_VITAL_LIMITS["heart_rate"] == (40, 150)


def test_dedupe_stream_keeps_one_copy(spark, scratch):
    src = scratch("in")
    lines = [json.dumps({"event_id": f"E{i % 5}", "event_ts": "2025-01-01T00:00:00+00:00"}) for i in range(10)]
    # plus a flood of copies of one event (a third of the stream) spread over several files
    lines += [json.dumps({"event_id": "E0", "event_ts": "2025-01-01T00:00:00+00:00"})] * 5
    _write(src, "a.json", "\n".join(lines) + "\n")
    _write(src, "b.json", "\n".join(lines[-5:]) + "\n")
    schema = StructType.fromDDL("event_id string, event_ts string")
    s = ST.stream_source(spark, src, schema, event_time="event_ts", fmt="json")
    out, ck = scratch("dd"), scratch("ck")
    (ST.dedupe_stream(s, ["event_id"], "event_ts", "10 minutes").writeStream.option("checkpointLocation", ck)
     .trigger(availableNow=True).format("parquet").start(out).awaitTermination())
    assert spark.read.parquet(out).count() == 5


def test_land_raw_splits_malformed_and_is_replay_safe(spark, scratch):
    src = scratch("in")
    _write(src, "a.json", '{"event_id": "E1", "heart_rate": 70}\n{"event_id": "E2", "heart_rate": 71}\nnot json\n')
    schema = StructType.fromDDL("event_id string, heart_rate double, _corrupt_record string")
    s = ST.stream_source(spark, src, schema, fmt="json", options={"columnNameOfCorruptRecord": "_corrupt_record"})
    out, err, ck = scratch("landed"), scratch("errors"), scratch("ck")
    main, errors = ST.stream_land_raw(s, out, ck, trigger={"availableNow": True}, error_out=err)
    main.awaitTermination()
    errors.awaitTermination()
    assert spark.read.json(out).count() == 2 and spark.read.json(err).count() == 1
    # restarting from the same checkpoint finds nothing new: nothing is landed twice
    ST.stream_land_raw(ST.stream_source(spark, src, schema, fmt="json",
                                        options={"columnNameOfCorruptRecord": "_corrupt_record"}),
                       out, ck, trigger={"availableNow": True}).awaitTermination()
    assert spark.read.json(out).count() == 2


def test_hourly_append_emits_only_closed_hours(spark, scratch):
    src = scratch("in")
    for i, hour in enumerate([0, 0, 3]):
        _write(src, f"f{i}.json", json.dumps({"event_id": f"E{i}", "patient_id": "P1", "facility_id": "F1",
                                              "heart_rate": 20.0, "event_ts": f"2025-01-01T0{hour}:10:00+00:00"}) + "\n")
    schema = StructType.fromDDL("event_id string, patient_id string, facility_id string, heart_rate double, "
                                "event_ts string")
    s = ST.stream_source(spark, src, schema, event_time="event_ts", fmt="json", max_files_per_trigger=1)
    out, ck = scratch("hourly"), scratch("ck")
    ST.stream_alerts_per_hour(s, out, ck, delay="10 minutes").awaitTermination()
    rows = spark.read.parquet(out).collect()
    # hour 00 is closed by the watermark of the 03:10 event; hour 03 is still open
    assert [(r.hour.hour, r.alert_count) for r in rows] == [(0, 2)]


def test_read_raw_json_split_glued_option(spark, scratch):
    root = scratch("raw")
    recs = [{"event_id": f"E{i}", "heart_rate": 60 + i} for i in range(4)]
    for day, part in [("2025-01-01", recs[:2]), ("2025-01-02", recs[2:])]:
        _write(f"{root}/vitals/dt={day}", "a.json", "".join(json.dumps(r) for r in part) + "\n")
    schema = StructType.fromDDL("event_id string, heart_rate double")
    assert IO.read_raw_json(spark, root, "vitals", schema, "2025-01-01").count() == 1
    assert IO.read_raw_json(spark, root, "vitals", schema, "2025-01-01", split_glued=True).count() == 2
    every = IO.read_raw_json(spark, root, "vitals", schema, IO.ALL_DAYS, split_glued=True)
    assert sorted((r.event_id, str(r.dt)) for r in every.collect()) == [
        ("E0", "2025-01-01"), ("E1", "2025-01-01"), ("E2", "2025-01-02"), ("E3", "2025-01-02")]


def test_register_tables_merges_schemas_additively(spark, scratch):
    root = scratch("clean")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/src/dt=2025-01-01")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"{root}/src/dt=2025-01-02")
    (name,) = WH.register_tables(spark, root, ["src"], prefix="quarantine_")
    rows = sorted(tuple(r) for r in spark.table(name).select("a", "b", F.col("dt").cast("string")).collect())
    assert name == "quarantine_src" and rows == [(1, None, "2025-01-01"), (2, "x", "2025-01-02")]


def test_compact_alerts_keeps_only_active(spark, scratch):
    alerts = spark.createDataFrame([("A1", 100), ("A2", 200), ("A3", 300)], "alert_id string, expires_at long")
    path = scratch("alerts")
    alerts.write.parquet(path)
    out = ST.compact_alerts(spark, path, scratch("compacted"), now=F.lit(150))
    assert sorted(r.alert_id for r in spark.read.parquet(out).collect()) == ["A2", "A3"]
    assert spark.read.parquet(path).count() == 3          # the source version is untouched


def test_stream_lag_monitor_measures_consumer_delay(spark, scratch):
    import time
    src = scratch("in")
    schema = StructType.fromDDL("event_id string, event_ts string")
    out, ck = scratch("lag"), scratch("ck")

    def run():
        s = ST.stream_source(spark, src, schema, event_time="event_ts", fmt="json", max_files_per_trigger=1)
        ST.stream_lag_monitor(s, "event_ts", out, ck, window="1 second").awaitTermination()

    _write(src, "f0.json", json.dumps({"event_id": "E0", "event_ts": "2020-01-01T00:00:00+00:00"}) + "\n")
    run()
    time.sleep(2.5)
    # a later arrival moves the watermark (kept in the checkpoint) past the first window
    _write(src, "f1.json", json.dumps({"event_id": "E1", "event_ts": "2020-01-01T00:00:01+00:00"}) + "\n")
    run()
    rows = spark.read.parquet(out).collect()
    assert rows and all(r.max_lag_ms > 5 * 365 * 24 * 3600 * 1000 and r.alarm for r in rows)
