"""Registered queries for sources/sinks, scalar functions, streams and
monitoring. Files and stream sinks go under the session's shared
checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timefn import iso_timestamp
from ..functions.vitals import breach_reasons, decode_event
from ..operators import datasets as D
from ..operators import monitor as MO
from ..operators import rules as R
from ..session import scratch_path
from ..sources import files as IO
from ..sources import versions as VS
from ..sources import warehouse as WH
from ..streaming import streams as ST
from . import bindings as B
from .bindings import with_ctes
from .catalog import query
from .sqlparts import over
from .catalog_rules import _valid_sql, vitals_preds, vitals_rules

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
ISO_SQL = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"
# The raw columns of the claims and vitals sources.
CLAIMS_RAW_DDL = ("claim_id string, patient_id string, facility_id string, payer string, "
                                "claim_amount double, status string, service_date string")
_READINGS = ["heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature_c"]
VITALS_RAW_DDL = ("event_id string, patient_id string, facility_id string, heart_rate double, "
                                "spo2 double, systolic_bp double, diastolic_bp double, temperature_c double, "
                                "event_ts string")


def _claims_text(s, d):
    """Claims as raw text rows (ISO dates), keyed by the month they land in."""
    c = B.claims(s, d)
    return c.select(*[F.col(x).cast("string").alias(x) for x in ["claim_id", "patient_id", "facility_id", "payer"]],
                    "claim_amount", "status", F.date_format("service_date", ISO_FMT).alias("service_date"),
                    F.date_format(F.trunc("service_date", "month"), "yyyy-MM-dd").alias("land_day"))


def _vitals_text(s, d):
    v = B.vitals(s, d)
    return v.select(*[F.col(x).cast("string").alias(x) for x in ["event_id", "patient_id", "facility_id"]],
                    "heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature_c",
                    F.date_format("event_ts", ISO_FMT).alias("event_ts"),
                    F.date_format("event_ts", "yyyy-MM-dd").alias("land_day"))


CLAIMS_TEXT_SQL = f"""
    SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(patient_id AS VARCHAR) AS patient_id,
           CAST(facility_id AS VARCHAR) AS facility_id, payer, claim_amount, status,
           {ISO_SQL.format(c='service_date')} AS service_date,
           CAST(date_trunc('month', service_date) AS DATE) AS dt
    FROM claims"""
VITALS_TEXT_SQL = f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(patient_id AS VARCHAR) AS patient_id,
           CAST(facility_id AS VARCHAR) AS facility_id, heart_rate, spo2, systolic_bp, diastolic_bp,
           temperature_c, {ISO_SQL.format(c='event_ts')} AS event_ts, CAST(event_ts AS DATE) AS dt
    FROM vitals"""


def _read_raw_csv(s, d):
    root = scratch_path(s, "raw")
    IO.land_partitioned(_claims_text(s, d), root, "billing_claims", "land_day", "csv")
    return IO.read_raw_csv(s, root, "billing_claims", StructType.fromDDL(CLAIMS_RAW_DDL), run_date=IO.ALL_DAYS)


query("read_raw_csv", with_ctes("SELECT * FROM ct", ["claims"], [("ct", CLAIMS_TEXT_SQL)]))(_read_raw_csv)


def _read_raw_json(s, d):
    root = scratch_path(s, "raw")
    IO.land_partitioned(_vitals_text(s, d), root, "vitals", "land_day", "json")
    return IO.read_raw_json(s, root, "vitals", StructType.fromDDL(VITALS_RAW_DDL), run_date=IO.ALL_DAYS)


query("read_raw_json", with_ctes("SELECT * FROM vt", ["vitals"], [("vt", VITALS_TEXT_SQL)]))(_read_raw_json)


def _split_glued(s, d):
    """Five records per line glued as ``}{`` (the delivery bug), six levels deep and with braces in
    their text, then repaired."""
    v = _vitals_text(s, d).drop("land_day")
    note = F.concat(F.lit('}{"'), F.col("event_id"))
    for level in "edcba":
        note = F.struct(note.alias(level))
    lines = (v.groupBy(F.floor(F.col("event_id").cast("bigint") / 5).alias("g"))
             .agg(F.concat_ws("", F.collect_list(F.to_json(F.struct(*v.columns, note.alias("note"))))).alias("value")))
    path = scratch_path(s, "glued")
    lines.select("value").write.text(path)
    schema = VITALS_RAW_DDL + ", note struct<a:struct<b:struct<c:struct<d:struct<e:string>>>>>"
    return IO.split_glued_json(s, path, StructType.fromDDL(schema)).withColumn("note", F.col("note.a.b.c.d.e"))


query("split_glued_json", with_ctes("SELECT * EXCLUDE (dt), '}{\"' || event_id AS note FROM vt", ["vitals"],
                                    [("vt", VITALS_TEXT_SQL)]))(_split_glued)


def _write_cleansed(s, d):
    """Promoted vitals written per event day (all days in one write)."""
    root = scratch_path(s, "clean")
    v = B.vitals(s, d)
    ev = R.evaluate_rules_rows(v, vitals_rules())
    IO.write_cleansed(R.split_valid(ev, v.columns).withColumn("dt", F.to_date("event_ts")), root, "vitals",
                      IO.ALL_DAYS)
    return root


def _write_cleansed_then_read(s, d):
    return IO.read_cleansed(s, _write_cleansed(s, d), "vitals")


query("read_cleansed", with_ctes(f"SELECT * FROM vitals WHERE {_valid_sql(vitals_preds())}", ["vitals"]))(
    _write_cleansed_then_read)

query("write_cleansed", with_ctes(f"""
    SELECT CAST(event_ts AS DATE) AS dt, count(*) AS n FROM vitals WHERE {_valid_sql(vitals_preds())}
    GROUP BY 1""", ["vitals"]))(
    lambda s, d: s.read.parquet(f"{_write_cleansed(s, d)}/vitals").groupBy("dt").agg(F.count(F.lit(1)).alias("n")))


def _read_date_range(s, d):
    root = scratch_path(s, "raw")
    IO.land_partitioned(_claims_text(s, d), root, "billing_claims", "land_day", "csv")
    return IO.read_date_range(s, root, "billing_claims", "1996-01-01", "1996-12-31", StructType.fromDDL(CLAIMS_RAW_DDL), fmt="csv")


query("read_date_range", with_ctes("SELECT * FROM ct WHERE dt BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
                                   ["claims"], [("ct", CLAIMS_TEXT_SQL)]))(_read_date_range)


def _write_quarantine(s, d):
    """Per-day quarantine folders for every day, then read back whole."""
    root = scratch_path(s, "clean")
    v = B.vitals(s, d)
    ev = R.evaluate_rules_rows(v, vitals_rules())
    bad = R.split_quarantine(ev, v.columns).withColumn("dt", F.to_date("event_ts"))
    IO.write_quarantine(bad, root, "vitals", IO.ALL_DAYS)
    return s.read.parquet(f"{root}/{IO.QUARANTINE_DIR}/vitals").drop("dt")


query("write_quarantine", with_ctes(f"SELECT * FROM vitals WHERE NOT ({_valid_sql(vitals_preds())})",
                                    ["vitals"]))(_write_quarantine)


def _load_warehouse(s, d):
    from .catalog import fact_beds
    path = scratch_path(s, "wh") + "/fact_bed_occupancy"
    df = fact_beds(s, d).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    WH.load_warehouse(df, "fact_bed_occupancy", path=path)
    WH.load_warehouse(df, "fact_bed_occupancy", path=path)   # re-run: replaced, never doubled
    return WH.read_warehouse(s, path)


query("load_warehouse", with_ctes("""
    SELECT CAST(facility_id AS VARCHAR) AS facility_id, department, CAST(total_beds AS INTEGER) AS total_beds,
           CAST(occupied_beds AS INTEGER) AS occupied_beds, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
           CAST(occupied_beds AS DOUBLE) / CAST(total_beds AS DOUBLE) AS occupancy_rate
    FROM bed_capacity""", ["bed_capacity"]))(_load_warehouse)

# ------------------------------------------------------------ scalar functions

query("iso_timestamp", "SELECT event_id, ts AS parsed FROM events")(
    lambda s, d: B.table(s, d, "events").select(
        "event_id", iso_timestamp(F.date_format("ts", ISO_FMT)).cast("timestamp_ntz").alias("parsed")))

EVENT_SCHEMA_DDL = ("event_id bigint, user_id bigint, event_type string, value double")
query("decode_event", "SELECT event_id, user_id, event_type, value FROM events")(
    lambda s, d: B.table(s, d, "events")
    .select(F.base64(F.to_json(F.struct("event_id", "user_id", "event_type", "value"))).alias("data"))
    .select(decode_event("data", StructType.fromDDL(EVENT_SCHEMA_DDL)).alias("e")).select("e.*"))


def _reasons_sql(limits):
    parts = []
    for f, (lo, hi) in limits.items():
        if lo is not None:
            parts.append(f"CASE WHEN {f} < {lo} THEN '{f} below {lo} (was ' || CAST({f} AS VARCHAR) || ')' END")
        if hi is not None:
            parts.append(f"CASE WHEN {f} > {hi} THEN '{f} above {hi} (was ' || CAST({f} AS VARCHAR) || ')' END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


query("breach_reasons", with_ctes(f"""
    SELECT event_id, r AS reasons FROM (SELECT event_id, {_reasons_sql(B.VITAL_LIMITS)} AS r FROM vitals) t
    WHERE r <> ''""", ["vitals"]))(
    lambda s, d: B.vitals(s, d).select("event_id", F.array_join(breach_reasons(B.VITAL_LIMITS), "; ")
                                       .alias("reasons")).filter(F.col("reasons") != ""))

# -------------------------------------------------------------------- streams

EVENTS_SCHEMA_DDL = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                   "value double, props string")


def _event_stream(s, d):
    """The events table consumed as a stream (file source over the table)."""
    return ST.stream_source(s, f"{d.rstrip('/')}/events.parque[t]", StructType.fromDDL(EVENTS_SCHEMA_DDL), event_time="ts",
                            fmt="parquet", options={"basePath": d})


def _run(q):
    q.awaitTermination()
    return q


def _stream_source(s, d):
    out, ck = scratch_path(s, "sink"), scratch_path(s, "ckpt")
    _run(_event_stream(s, d).writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
         .format("parquet").start(out))
    return s.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


query("stream_source", "SELECT * FROM events")(_stream_source)

ALERT_SQL = f"""
    SELECT patient_id, sha256('alert:' || CAST(event_id AS VARCHAR)) AS alert_id, facility_id,
           event_id AS source_event_id, event_ts AS triggered_at, {_reasons_sql(B.VITAL_LIMITS)} AS reasons
    FROM vitals WHERE {_reasons_sql(B.VITAL_LIMITS)} <> ''"""


def _raised():
    """The registered queries raise alerts at the event, not at the clock."""
    return F.col("event_ts").cast("timestamp")


def _stream_alerts(s, d):
    out, ck = scratch_path(s, "alerts"), scratch_path(s, "ckpt")
    _run(ST.stream_alerts(B.vitals_from_events(_event_stream(s, d)), out, ck, limits=B.VITAL_LIMITS, raised=_raised()))
    a = s.read.parquet(out)
    return a.select("patient_id", "alert_id", "facility_id", "source_event_id",
                    F.col("triggered_at").cast("timestamp_ntz").alias("triggered_at"),
                    F.array_join("reasons", "; ").alias("reasons"), *[f"vitals.{c}" for c in _READINGS], "expires_at")


query("stream_alerts", with_ctes(f"""
    SELECT a.*, heart_rate, spo2, systolic_bp, diastolic_bp, temperature_c,
           CAST(floor(epoch(triggered_at)) AS BIGINT) + 86400 AS expires_at
    FROM ({ALERT_SQL}) a JOIN vitals ON event_id = source_event_id""", ["vitals"]))(_stream_alerts)


def _alerts_batch(s, d):
    v = B.vitals(s, d)
    return ST.alerts_from_readings(v, B.VITAL_LIMITS, now=F.col("event_ts").cast("timestamp"))


query("alert_expiry", with_ctes(f"""
    SELECT source_event_id, CAST(floor(epoch(triggered_at)) AS BIGINT) + 86400 AS expires_at FROM ({ALERT_SQL}) a""",
    ["vitals"]))(lambda s, d: _alerts_batch(s, d).select("source_event_id", "expires_at"))

ACTIVE_AT = "2024-01-20 00:00:00"


def _active_alerts(s, d):
    """Every alert delivered twice into the keyed store, in two runs; then what is active at a time."""
    store = scratch_path(s, "alert-store")
    for _ in range(2):
        _run(ST.stream_alert_store(B.vitals_from_events(_event_stream(s, d)), store, scratch_path(s, "ckpt"),
                                   limits=B.VITAL_LIMITS, raised=_raised(), now="2024-01-01 00:00:00"))
    ST.put_alerts(s, store, now=ACTIVE_AT)
    return ST.read_alerts(s, store, ACTIVE_AT).select("patient_id", "source_event_id", "alert_id", "expires_at")


query("active_alerts", with_ctes(f"""
    SELECT patient_id, source_event_id, alert_id, CAST(floor(epoch(triggered_at)) AS BIGINT) + 86400 AS expires_at
    FROM ({ALERT_SQL}) a
    WHERE CAST(floor(epoch(triggered_at)) AS BIGINT) + 86400 > CAST(floor(epoch(TIMESTAMP '{ACTIVE_AT}')) AS BIGINT)""",
    ["vitals"]))(_active_alerts)


def _dedupe(s, d):
    """Events in three slices of time, each slice delivered twice in micro-batches of its own, and
    the first slice once more at the end, later than the watermark."""
    src = scratch_path(s, "delivered")
    e = B.table(s, d, "events")
    low, high = e.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    slices = [e.where((at >= low + (high - low + 1) * i // 3) & (at < low + (high - low + 1) * (i + 1) // 3)) for i in range(3)]
    for part in (*[x for x in slices for _ in range(2)], slices[0]):
        part.coalesce(1).write.mode("append").parquet(src)
    stream = ST.stream_source(s, src, StructType.fromDDL(EVENTS_SCHEMA_DDL), event_time="ts", fmt="parquet", max_files_per_trigger=1)
    out, ck = scratch_path(s, "dedup"), scratch_path(s, "ckpt")
    dd = ST.dedupe_stream(stream, ["event_id"], "ts", "1 hour")
    _run(dd.writeStream.option("checkpointLocation", ck).trigger(availableNow=True).format("parquet").start(out))
    return s.read.parquet(out).select("event_id", "user_id", "event_type", "value")


query("dedupe_stream", "SELECT event_id, user_id, event_type, value FROM events")(_dedupe)


_BREACHES = {"heart_rate_breach": "(heart_rate < 1 OR heart_rate > 150)", "spo2_breach": "spo2 < 5",
             "systolic_bp_breach": "(systolic_bp < 70 OR systolic_bp > 180)",
             "temperature_breach": "(temperature_c < 35.0 OR temperature_c > 40.0)"}
_GOLD_ALERTS_BODY = f"""
    SELECT event_id, patient_id, facility_id, {", ".join(_READINGS)}, event_ts,
           {", ".join(f"{sql} AS {name}" for name, sql in _BREACHES.items())}
    FROM vitals WHERE {_valid_sql(vitals_preds())} AND ({" OR ".join(_BREACHES.values())})"""


def _gold_alerts(g):
    return g.select("event_id", "patient_id", "facility_id", *_READINGS,
                    F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), *_BREACHES)


def _curated_rows(output, df, detail):
    return df.select(F.lit(output).alias("output"), F.col("event_id").cast("string").alias("key"),
                     F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in detail]).alias("detail"))


def _outcome_rows(output, df):
    return df.select(F.lit(output).alias("output"), F.col("rule").alias("key"),
                     F.concat_ws("|", "outcome", F.coalesce("failure_reason", F.lit("-"))).alias("detail"))


def _curated_sql(output, source, detail, key="event_id"):
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in detail)
    return f"SELECT '{output}' AS output, CAST({key} AS VARCHAR) AS key, concat_ws('|', {parts}) AS detail FROM ({source}) t"


_VITALS_OUT = [
    _curated_sql("gold", _GOLD_ALERTS_BODY, ["patient_id", "event_ts", *_BREACHES]),
    _curated_sql("promoted", f"SELECT * FROM vitals WHERE {_valid_sql(vitals_preds())}", ["patient_id", "facility_id"]),
    _curated_sql("quarantine", f"SELECT * FROM vitals WHERE NOT ({_valid_sql(vitals_preds())})", ["patient_id", "facility_id"]),
]


def _vitals_outcomes_sql(output, rules, preds, src):
    from .catalog_rules import summary_sql
    return _curated_sql(output, summary_sql(rules, preds, src), ["outcome", "failure_reason"], "rule")


def _stream_to_gold(s, d):
    out, ck = scratch_path(s, "gold"), scratch_path(s, "ckpt")
    _run(ST.stream_to_gold(B.vitals_from_events(_event_stream(s, d)), out, ck, vitals_rules(), B.VITAL_LIMITS))
    read = functools.partial(VS.read_committed, s, out)
    return (_curated_rows("gold", _gold_alerts(read()), ["patient_id", "event_ts", *_BREACHES])
            .unionByName(_curated_rows("promoted", read(ST.PROMOTED_DIR), ["patient_id", "facility_id"]))
            .unionByName(_curated_rows("quarantine", read(ST.BAD_DIR), ["patient_id", "facility_id"]))
            .unionByName(_outcome_rows("outcomes", read(ST.OUTCOMES_DIR))))


query("stream_to_gold", with_ctes("\nUNION ALL\n".join(
    [*_VITALS_OUT, _vitals_outcomes_sql("outcomes", vitals_rules(), vitals_preds(), "vitals")]), ["vitals"]))(_stream_to_gold)


def _stream_per_hour(s, d):
    """Both forms: the closed hours (append) and the snapshot with the open ones (complete)."""
    out = {form: scratch_path(s, f"hourly-{form}") for form in ("append", "complete")}
    for form, path in out.items():
        _run(ST.stream_alerts_per_hour(B.vitals_from_events(_event_stream(s, d)), path, scratch_path(s, "ckpt"),
                                       limits=B.VITAL_LIMITS, mode=form))
    rows = (s.read.parquet(out["append"]).withColumn("form", F.lit("append"))
            .unionByName(VS.read_current(s, out["complete"]).withColumn("form", F.lit("complete"))))
    return rows.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


query("stream_alerts_per_hour", with_ctes(f"""
    SELECT * FROM (
        SELECT date_trunc('hour', triggered_at) AS hour, facility_id, count(*) AS alert_count, form
        FROM ({ALERT_SQL}) a, (VALUES ('append'), ('complete')) f(form) GROUP BY ALL) c
    WHERE form = 'complete' OR hour + INTERVAL 1 HOUR <= (SELECT max(triggered_at) FROM ({ALERT_SQL}) b) - INTERVAL 1 HOUR""",
    ["vitals"]))(_stream_per_hour)

LANDED_DDL = "event_id bigint, user_id bigint, event_type string, value double"


def _land_raw(s, d):
    """Events delivered as JSON files with a broken record for every 50th event, admitted in batches of
    64 KiB: records and errors land in their own folders."""
    src, out, err, ck = (scratch_path(s, n) for n in ("delivered", "landed", "errors", "ckpt"))
    e = B.table(s, d, "events")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    broken = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", torn"))
    lines = e.select(F.explode(F.when(F.col("event_id") % 50 == 0, F.array(line, broken)).otherwise(F.array(line))).alias("value"))
    lines.repartition(16).write.text(src)
    stream = ST.stream_source(s, src, StructType.fromDDL(LANDED_DDL + ", _corrupt_record string"), fmt="json", max_bytes_per_trigger=1 << 16,
                              options={"columnNameOfCorruptRecord": "_corrupt_record"})
    for q in ST.stream_land_raw(stream, out, ck, trigger={"availableNow": True}, error_out=err):
        _run(q)
    good = s.read.schema(LANDED_DDL + ", dt date").json(out).select(
        F.lit("landed").alias("sink"), "event_id", "user_id", "event_type", "value", F.lit(None).cast("string").alias("record"))
    bad = s.read.option("columnNameOfCorruptRecord", "none").schema("_corrupt_record string, dt date").json(err).select(
        F.lit("error").alias("sink"), *[F.lit(None).cast(t).alias(c) for c, t in
                                        (("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"))],
        F.col("_corrupt_record").alias("record"))
    return good.unionByName(bad)


query("stream_land_raw", """
    SELECT 'landed' AS sink, event_id, user_id, event_type, value, NULL AS record FROM events
    UNION ALL
    SELECT 'error', NULL, NULL, NULL, NULL, '{"event_id": ' || event_id || ', torn' FROM events WHERE event_id % 50 = 0""")(_land_raw)

# ----------------------------------------------------------------- monitoring


def _run_log(s, d):
    """One cleansing run per (source, day), run at 01:00 the next day."""
    def per_day(df, rules, day_col, source):
        ev = R.evaluate_rules_rows(df, rules)
        g = ev.groupBy(F.to_date(day_col).alias("day")).agg(F.count_if(~F.col(R.VALID)).alias("quarantined"))
        return g.select(F.lit(source).alias("source"),
                        (F.col("day").cast("timestamp") + F.expr("INTERVAL 25 HOURS")).alias("run_ts"),
                        "quarantined")
    from .catalog_rules import billing_claims_rules
    return per_day(B.vitals(s, d), vitals_rules(), "event_ts", "vitals").unionByName(
        per_day(B.claims(s, d), billing_claims_rules(), "service_date", "billing_claims"))


def _run_log_sql():
    from .catalog_rules import billing_claims_preds
    return f"""
    SELECT date_trunc('hour', CAST(day AS TIMESTAMP) + INTERVAL 25 HOUR) AS window_start,
           CAST(sum(q) AS BIGINT) AS quarantined_rows, CAST(sum(q) AS BIGINT) > 0 AS alarm
    FROM (SELECT CAST(event_ts AS DATE) AS day, count_if(NOT ({_valid_sql(vitals_preds())})) AS q
          FROM vitals GROUP BY 1
          UNION ALL
          SELECT CAST(service_date AS DATE) AS day, count_if(NOT ({_valid_sql(billing_claims_preds())})) AS q
          FROM claims GROUP BY 1) r
    GROUP BY 1"""


query("quarantine_metric", with_ctes(_run_log_sql(), ["vitals", "claims"]))(
    lambda s, d: MO.quarantine_metric(_run_log(s, d)))


def _lagged_events(s, d):
    e = B.table(s, d, "events")
    arrival = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.floor(F.col("value") * 1e6))
    return e.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), arrival.alias("arrival"))


query("stream_lag", """
    SELECT make_timestamp(CAST(floor(a / 300000000) * 300000000 AS BIGINT)) AS window_start,
           max(lag_ms) AS max_lag_ms, max(lag_ms) > 300000 AS alarm
    FROM (SELECT epoch_us(ts) + CAST(floor(value * 1e6) AS BIGINT) AS a,
                 CAST(floor(CAST(floor(value * 1e6) AS BIGINT) / 1000) AS BIGINT) AS lag_ms FROM events) t
    GROUP BY 1""")(lambda s, d: MO.stream_lag(_lagged_events(s, d), "arrival", "event_time"))


# ------------------------------------------------------- writers / warehouse


def _write_dq_results(s, d):
    from .catalog_rules import measured
    root = scratch_path(s, "clean")
    IO.write_dq_results(R.evaluate_rules_summary(B.vitals(s, d), vitals_rules()), root, "vitals", "2024-01-31")
    saved = s.read.parquet(f"{root}/{IO.DQ_RESULTS_DIR}/source=vitals/dt=2024-01-31")
    return measured(saved.withColumn("evaluated_metrics", F.from_json("evaluated_metrics", "map<string,double>")))


def _dq_sql():
    from .catalog_rules import summary_sql
    return with_ctes(f"SELECT * EXCLUDE (rule_type) FROM ({summary_sql(vitals_rules(), vitals_preds(), 'vitals')}) s",
                     ["vitals"])


query("write_dq_results", _dq_sql())(_write_dq_results)


def _write_curated(s, d):
    from .catalog import ds_claims
    path = scratch_path(s, "curated") + "/claims"
    IO.write_curated(ds_claims(s, d), path)
    return s.read.parquet(path)


query("write_curated", over("SELECT * FROM ds_claims", "ds_claims"))(_write_curated)


def _table_layout(s, d):
    """The visit fact loaded twice into its bucketed table, and the visits dataset over it."""
    from .catalog import fact_visit
    name = f"laid_visits_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        WH.load_warehouse(fact_visit(s, d), name, WH.warehouse_schema("fact_patient_visit"),
                          layout=WH.TABLE_LAYOUT["fact_patient_visit"], location=scratch_path(s, "tables"))
    facilities = B.facilities(s, d).withColumn("facility_id", F.col("facility_id").cast("string"))
    return D.ds_visits(s.table(name), facilities).withColumn("admission_time", F.col("admission_time").cast("timestamp_ntz"))


# ids are text in the declared table, and equal admission times are told apart by that text
_LAID_SQL = """
    WITH ordered AS (
        SELECT *, lag(discharge_ts) OVER (PARTITION BY patient_id ORDER BY admission_ts NULLS FIRST, CAST(visit_id AS VARCHAR)) AS before
        FROM fact_patient_visit)
    SELECT CAST(visit_id AS VARCHAR) AS visit_id, CAST(patient_id AS VARCHAR) AS patient_id,
           CAST(facility_id AS VARCHAR) AS facility_id, facility_name, department, visit_type,
           CAST(attending_staff_id AS VARCHAR) AS attending_staff_id, admission_ts AS admission_time,
           CAST(admission_ts AS DATE) AS admission_date, length_of_stay_hours,
           CAST(still_admitted AS INTEGER) AS still_admitted_flag,
           CAST(coalesce(admission_ts <= before + INTERVAL 30 DAY, false) AS INTEGER) AS readmission_flag
    FROM ordered JOIN facilities USING (facility_id)"""
query("table_layout", over(f"SELECT * FROM ({_LAID_SQL}) t", "fact_patient_visit", extra_bindings=["facilities"]))(_table_layout)


def _register_tables(s, d):
    root = scratch_path(s, "clean")
    for name, df, col in [("vitals", B.vitals(s, d), "event_ts"), ("claims", B.claims(s, d), "service_date")]:
        # one folder per month keeps the partition count small for a multi-year table
        IO.write_cleansed(df.withColumn("dt", F.to_date(F.trunc(col, "month"))), root, name, IO.ALL_DAYS)
    views = WH.register_tables(s, root, ["vitals", "claims"], prefix="cleansed_")
    return s.sql(f"SELECT 'vitals' AS src, event_id AS id, heart_rate AS number, dt FROM {views[0]} "
                 f"UNION ALL SELECT 'claims', claim_id, claim_amount, dt FROM {views[1]}")


query("register_tables", with_ctes("""
    SELECT 'vitals' AS src, event_id AS id, heart_rate AS number, CAST(date_trunc('month', event_ts) AS DATE) AS dt FROM vitals
    UNION ALL SELECT 'claims', claim_id, claim_amount, CAST(date_trunc('month', service_date) AS DATE) FROM claims""",
    ["vitals", "claims"]))(_register_tables)

PATIENTS_RAW_DDL = "patient_id string, full_name string, account_balance double, facility_id string, segment string"


def _read_reference(s, d):
    root = scratch_path(s, "raw")
    p = B.patients(s, d)
    text = p.select(*[F.col(c).cast("string").alias(c) for c in ["patient_id", "full_name"]], "account_balance",
                    F.col("facility_id").cast("string").alias("facility_id"), "segment",
                    F.lit("2025-01-01").alias("land_day"))
    IO.land_partitioned(text, root, "patients", "land_day", "csv")
    return IO.read_reference(s, root, "patients", StructType.fromDDL(PATIENTS_RAW_DDL), "2025-01-01")


query("read_reference", with_ctes("""
    SELECT CAST(patient_id AS VARCHAR) AS patient_id, full_name, account_balance,
           CAST(facility_id AS VARCHAR) AS facility_id, segment FROM patients""", ["patients"]))(_read_reference)


def _warehouse_schema(s, d):
    c = B.claims(s, d).withColumn("service_date", F.date_format("service_date", "yyyy-MM-dd"))
    return WH.conform(c, WH.warehouse_schema("fact_claim"))


query("warehouse_schema", with_ctes("""
    SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(patient_id AS VARCHAR) AS patient_id,
           CAST(facility_id AS VARCHAR) AS facility_id, payer, claim_amount, status,
           strftime(service_date, '%Y-%m-%d') AS service_date FROM claims""", ["claims"]))(_warehouse_schema)

# --------------------------------------------------------------------- runs

def _as_raw_text(df, day_col, grain="year"):
    """Binding rows as they would land: dates/times as ISO text, one folder
    per ``grain`` (year: a handful of folders for a multi-year table)."""
    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(f.name, ISO_FMT).alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    land = F.date_format(F.trunc(F.col(day_col), grain), "yyyy-MM-dd").alias("land_day")
    return df.select(*cols, land)


def _batch_sources():
    from ..operators import rulesets as RS
    from .catalog_rules import (beds_preds, beds_rules, billing_claims_preds, billing_claims_rules,
                                pharmacy_preds, pharmacy_rules, staff_schedules_preds, staff_schedules_rules,
                                visits_preds)
    from .catalog_rules import visits_rules as vrules
    return {  # raw source: (binding, binding CTE, rules, sql preds, extra row rules, extra sql, day column)
        "visits": (B.visits, "visits", vrules, visits_preds, [], [], "admission_ts"),
        "staff_schedules": (B.staff_schedules, "staff_schedules", staff_schedules_rules, staff_schedules_preds,
                            [], [], "shift_date"),
        "billing_claims": (B.claims, "claims", billing_claims_rules, billing_claims_preds, [], [], "service_date"),
        "pharmacy_inventory": (B.pharmacy_inventory, "pharmacy_inventory", pharmacy_rules, pharmacy_preds, [], [],
                               "snapshot_date"),
        "bed_capacity": (B.bed_capacity, "bed_capacity", beds_rules, beds_preds, RS.bed_capacity_extra(),
                         ["COALESCE(occupied_beds <= total_beds, FALSE)"], "snapshot_date"),
    }


#: Per loaded table: the columns that tell its content, doubles as whole hundredths.
_LOADED = {
    "fact_patient_visit": (["visit_id", "patient_id", "department", "still_admitted"], "length_of_stay_hours"),
    "fact_bed_occupancy": (["facility_id", "department", "total_beds", "occupied_beds", "snapshot_date"], "occupancy_rate"),
    "fact_staffing": (["staff_id", "facility_id", "department", "role", "shift_date", "shift_name"], None),
    "fact_claim": (["claim_id", "patient_id", "facility_id", "payer", "status"], "claim_amount"),
    "fact_pharmacy_inventory": (["facility_id", "drug_name", "current_stock", "reorder_threshold", "stockout_risk"], "unit_cost"),
    "dim_drug": (["drug_name"], None),
    "dim_payer": (["payer"], None),
}


def _run_batch(s, d):
    """The log of the run, and the content of the seven tables it loaded."""
    from . import runs
    roots = {k: scratch_path(s, k) for k in ("raw", "cleansed", "curated", "warehouse")}
    sources = {}
    for name, (bind, _, rules_fn, _, extra, _, day) in _batch_sources().items():
        text = _as_raw_text(bind(s, d), day)
        if name == "staff_schedules":       # the declared fact has the shift's hours, which the test tables lack
            text = text.withColumns({c: F.lit(None).cast("string") for c in ("shift_start", "shift_end")})
        IO.land_partitioned(text, roots["raw"], name, "land_day", "csv", gather=False)      # a folder per year
        sources[name] = (text.drop("land_day").schema, rules_fn(), extra)
    log = runs.run_batch_daily(s, roots, IO.ALL_DAYS, sources, runs.DEFAULT_GOLD)
    out = log.select(F.lit("log").alias("part"), F.concat_ws("|", "source", "run_date").alias("content"),
                     "promoted", "quarantined")
    for table, (cols, number) in _LOADED.items():
        value = F.round(F.col(number) * 100).cast("long") if number else F.lit(None).cast("long")
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols])
        out = out.unionByName(WH.read_warehouse(s, f"{roots['warehouse']}/{table}").select(
            F.lit(table).alias("part"), text.alias("content"), value.alias("promoted"), F.lit(None).cast("long").alias("quarantined")))
    return out


def _run_batch_sql():
    parts, binds, valid_rows = [], [], {}
    for name, (_, cte, _, preds_fn, _, extra_sql, _) in _batch_sources().items():
        valid = " AND ".join([f"({p})" for p in preds_fn(cte) if isinstance(p, str)] + [f"({x})" for x in extra_sql])
        parts.append(f"SELECT 'log' AS part, '{name}|*' AS content, CAST(count_if(v) AS BIGINT) AS promoted, "
                     f"CAST(count_if(NOT v) AS BIGINT) AS quarantined FROM (SELECT {valid} AS v FROM {cte}) t")
        binds.append(cte)
        valid_rows[name] = f"(SELECT * FROM {cte} WHERE {valid})"
    made = {
        "fact_patient_visit": f"""SELECT *, discharge_ts IS NULL AS still_admitted, date_diff('second', admission_ts, discharge_ts) / 3600.0
            AS length_of_stay_hours FROM {valid_rows['visits']} v""",
        "fact_bed_occupancy": f"SELECT *, occupied_beds / total_beds AS occupancy_rate FROM {valid_rows['bed_capacity']} b",
        "fact_staffing": f"SELECT * FROM {valid_rows['staff_schedules']} s",
        "fact_claim": f"SELECT * FROM {valid_rows['billing_claims']} c",
        "fact_pharmacy_inventory": f"SELECT *, current_stock <= reorder_threshold AS stockout_risk FROM {valid_rows['pharmacy_inventory']} p",
        "dim_drug": f"SELECT DISTINCT drug_name FROM {valid_rows['pharmacy_inventory']} p",
        "dim_payer": f"SELECT DISTINCT payer FROM {valid_rows['billing_claims']} c",
    }
    for table, (cols, number) in _LOADED.items():
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols)
        value = f"CAST(round(CAST({number} AS DOUBLE) * 100) AS BIGINT)" if number else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{table}', concat_ws('|', {text}), {value}, CAST(NULL AS BIGINT) FROM ({made[table]}) t")
    return with_ctes("\nUNION ALL\n".join(parts), binds)


query("run_batch_daily", _run_batch_sql())(_run_batch)


def _run_streaming(s, d):
    """Both streaming sources: every committed output, the loaded fact and the log."""
    from . import runs
    from .catalog_rules import prescriptions_rules
    roots = {k: scratch_path(s, k) for k in ("curated", "cleansed", "warehouse")}
    landed = scratch_path(s, "prescriptions")
    doses = B.prescriptions(s, d)
    doses.write.parquet(landed)
    stream = ST.stream_source(s, landed, doses.schema, fmt="parquet", max_files_per_trigger=4)
    log = runs.run_streaming_curation(s, B.vitals_from_events(_event_stream(s, d)), roots, vitals_rules(), B.VITAL_LIMITS,
                                      scratch_path(s, "ckpt"), {"prescriptions": (stream, prescriptions_rules())})
    read = functools.partial(VS.read_committed, s, f"{roots['curated']}/fact_vitals_alert")
    doses = functools.partial(VS.read_committed, s, f"{roots['cleansed']}/prescriptions")
    fact = WH.read_warehouse(s, f"{roots['warehouse']}/fact_vitals_alert")
    return (_curated_rows("gold", _gold_alerts(read()), ["patient_id", "event_ts", *_BREACHES])
            .unionByName(_curated_rows("loaded", fact, ["patient_id", "facility_id", *_BREACHES]))
            .unionByName(_curated_rows("promoted", read(ST.PROMOTED_DIR), ["patient_id", "facility_id"]))
            .unionByName(_curated_rows("quarantine", read(ST.BAD_DIR), ["patient_id", "facility_id"]))
            .unionByName(_outcome_rows("outcomes", read(ST.OUTCOMES_DIR)))
            .unionByName(_curated_rows("doses promoted", doses(ST.PROMOTED_DIR), ["patient_id", "drug_name", "dosage_mg"]))
            .unionByName(_curated_rows("doses quarantine", doses(ST.BAD_DIR), ["patient_id", "drug_name", "dosage_mg"]))
            .unionByName(doses(ST.OUTCOMES_DIR).groupBy("rule").agg(F.min("outcome").alias("worst")).select(
                F.lit("doses outcomes").alias("output"), F.col("rule").alias("key"), F.col("worst").alias("detail")))
            .unionByName(log.select(F.lit("log").alias("output"), F.col("source").alias("key"),
                                    F.concat_ws("|", F.col("promoted").cast("string"), F.col("quarantined").cast("string")).alias("detail"))))


def _run_streaming_sql():
    from .catalog_rules import prescriptions_preds, prescriptions_rules, summary_sql
    good = _valid_sql(prescriptions_preds())
    outcomes = summary_sql(prescriptions_rules(), prescriptions_preds(), "prescriptions")
    detail = ["patient_id", "drug_name", "dosage_mg"]

    def counts(source, valid):
        return (f"SELECT 'log' AS output, '{source}' AS key, count_if({valid}) || '|' || count_if(NOT ({valid})) AS detail "
                f"FROM {source}")
    return with_ctes("\nUNION ALL\n".join([
        *_VITALS_OUT, _vitals_outcomes_sql("outcomes", vitals_rules(), vitals_preds(), "vitals"),
        _curated_sql("loaded", _GOLD_ALERTS_BODY, ["patient_id", "facility_id", *_BREACHES]),
        _curated_sql("doses promoted", f"SELECT * FROM prescriptions WHERE {good}", detail),
        _curated_sql("doses quarantine", f"SELECT * FROM prescriptions WHERE NOT ({good})", detail),
        _curated_sql("doses outcomes", outcomes, ["outcome"], "rule"),
        counts("vitals", _valid_sql(vitals_preds())), counts("prescriptions", good)]), ["vitals", "prescriptions"])


query("run_streaming_curation", _run_streaming_sql())(_run_streaming)
