"""Structured Streaming operators.

The column logic lives in functions that work on batch *and* streaming
DataFrames (``alerts_from_readings``, ``hourly_alert_counts``, ...), so the
stream result can be checked against the batch result of the same events.
Every sink has its own checkpoint (exactly-once file sinks, restartable
after executor or driver loss).
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from ..functions.vitals import ALERT_TTL_SECONDS, DEFAULT_VITAL_LIMITS, alert_expiry, breach_reasons
from ..sources import versions

READING_COLUMNS = ["event_id", "patient_id", "facility_id", "heart_rate", "spo2", "systolic_bp",
                   "diastolic_bp", "temperature_c", "event_ts"]


def stream_source(spark: SparkSession, path: str, schema: StructType, event_time: str | None = None,
                  fmt: str = "json", max_files_per_trigger: int | None = None,
                  options: Mapping[str, str] | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A file-backed event stream (a message-bus source plugs in the same way
    via ``fmt``/``options``). ``event_time`` is cast to TIMESTAMP right away:
    watermarks reject TIMESTAMP_NTZ. ``max_files_per_trigger`` or
    ``max_bytes_per_trigger`` bounds what a micro-batch admits (whole files, one
    at least)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path)
    if event_time:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def alert_id(event_id: Column) -> Column:
    """Deterministic alert id (a retry of the same event gives the same id)."""
    return F.sha2(F.concat(F.lit("alert:"), event_id.cast("string")), 256)


def alerts_from_readings(df: DataFrame, limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS,
                         ttl_seconds: int = ALERT_TTL_SECONDS, now: Column | None = None) -> DataFrame:
    """Stateless: one alert per breaching reading with id, patient, facility,
    source event, time, reasons, the reading itself and its expiry."""
    vit = [c for c in READING_COLUMNS if c in df.columns]
    # a reading field the payload lacks is skipped, like a NULL reading
    reasons = breach_reasons({f: lim for f, lim in limits.items() if f in df.columns})
    out = df.select(
        "patient_id", alert_id(F.col("event_id")).alias("alert_id"), "facility_id",
        F.col("event_id").alias("source_event_id"), F.col("event_ts").alias("triggered_at"),
        reasons.alias("reasons"), F.struct(*vit).alias("vitals"),
        alert_expiry(ttl_seconds, now).alias("expires_at"))
    return out.filter(F.size("reasons") > 0)


def active_alerts(alerts: DataFrame, now: Column | str | None = None) -> DataFrame:
    """Alerts not yet expired at ``now`` (epoch seconds or timestamp)."""
    if now is None:
        clock = F.unix_timestamp(F.current_timestamp())
    elif isinstance(now, str):
        clock = F.unix_timestamp(F.to_timestamp(F.lit(now)))
    else:
        is_time = isinstance(alerts.select(now.alias("n")).schema["n"].dataType, (DateType, TimestampType, TimestampNTZType))
        clock = F.unix_timestamp(now.cast("timestamp")) if is_time else now
    return alerts.filter(F.col("expires_at") > clock)


def compact_alerts(spark: SparkSession, alerts_path: str, out_root: str, now: Column | str | None = None) -> str:
    """Compaction job for an append-only alert table: keep only unexpired alerts.

    Spark cannot overwrite a folder it is reading, so the active rows become a
    new version under ``out_root``, which readers find with ``versions.read_current``.
    Returns its folder.
    """
    rows = active_alerts(spark.read.parquet(alerts_path), now)
    return versions.publish(spark, out_root, lambda folder: rows.write.parquet(folder))


ALERT_KEY = ["patient_id", "alert_id"]


def put_alerts(spark: SparkSession, store: str, alerts: DataFrame | None = None, now: Column | str | None = None,
               keep: int = 2) -> str:
    """Merge ``alerts`` into the alert store, one row per (patient, alert): a put replaces the row of
    its key if it expires no earlier, and rows expired at ``now`` leave. The result is a new version,
    so readers always meet a whole store. ``alerts=None`` only lets expired rows go. Putting the same
    alerts again changes nothing, so a replayed batch is harmless. The store holds what is active, at
    most one lifetime of alerts; a merge rewrites that much."""
    path = versions.current_path(spark, store)
    rows = alerts
    if path is not None:
        stored = spark.read.parquet(path)
        rows = stored if alerts is None else stored.unionByName(alerts, allowMissingColumns=True)
    if rows is None:
        raise ValueError("the first put brings the columns of the store")
    rest = [c for c in rows.columns if c not in ALERT_KEY]
    latest = rows.groupBy(*ALERT_KEY).agg(F.max_by(F.struct(*rest), "expires_at").alias("a")).select(
        *[F.col(f"a.{c}").alias(c) if c in rest else F.col(c) for c in rows.columns])
    return versions.publish(spark, store, lambda folder: active_alerts(latest, now).write.parquet(folder), keep=keep)


def read_alerts(spark: SparkSession, store: str, now: Column | str | None = None) -> DataFrame:
    """The alerts of the store's current version that are active at ``now``."""
    return active_alerts(versions.read_current(spark, store), now)


def stream_alert_store(readings: DataFrame, store: str, checkpoint: str, trigger: Mapping | None = None,
                       limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS, ttl_seconds: int = ALERT_TTL_SECONDS,
                       raised: Column | None = None, now: Column | str | None = None) -> StreamingQuery:
    """Alert stream -> keyed store. ``raised`` is the time an alert's lifetime starts (default: when
    it is processed), ``now`` the time at which expired alerts leave (default: the clock)."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        put_alerts(batch.sparkSession, store, alerts_from_readings(batch, limits, ttl_seconds, raised), now)
    return _writer(readings, checkpoint, trigger).foreachBatch(merge).start()


def dedupe_stream(df: DataFrame, id_cols: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop redelivered events: state keeps ids for ``delay`` past the
    watermark, so ``delay`` must cover the expected redelivery lateness. Rows
    never leave the JVM, so ids of any size and NULL ids keep their value."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(id_cols))


def hourly_alert_counts(df: DataFrame, time_col: str = "event_ts", key: str = "facility_id") -> DataFrame:
    return (df.groupBy(F.window(time_col, "1 hour").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("alert_count"))
            .select(F.col("w.start").alias("hour"), key, "alert_count"))


def _writer(df: DataFrame, checkpoint: str, trigger: Mapping | None, mode: str = "append"):
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    return w.trigger(**(trigger or {"availableNow": True}))


def stream_alerts(readings: DataFrame, out: str, checkpoint: str, trigger: Mapping | None = None,
                  limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS, raised: Column | None = None) -> StreamingQuery:
    """Alert stream -> Parquet alert table (append, exactly-once file sink). An alert's lifetime starts
    when it is processed, or at ``raised``."""
    return _writer(alerts_from_readings(readings, limits, now=raised), checkpoint, trigger).format("parquet").start(out)


def stream_alerts_per_hour(readings: DataFrame, out: str, checkpoint: str, trigger: Mapping | None = None,
                           limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS, delay: str = "1 hour",
                           key: str = "facility_id", mode: str = "append") -> StreamingQuery:
    """Tumbling 1-hour alert counts.

    ``append``: an hour is written once the watermark passes it, so state
    holds only the open hours (production form). ``complete``: every trigger
    publishes the whole result table, still-open hours included, as a version
    under ``out`` (``versions.read_current`` reads the newest)."""
    alerts = alerts_from_readings(readings, limits).select(
        F.col("triggered_at").alias("event_ts"), key).withWatermark("event_ts", delay)
    counts = hourly_alert_counts(alerts, "event_ts", key)
    if mode == "append":
        return _writer(counts, checkpoint, trigger).format("parquet").start(out)

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        versions.publish(batch.sparkSession, out, lambda folder: batch.write.parquet(folder))
    return _writer(counts, checkpoint, trigger, mode="complete").foreachBatch(snapshot).start()


def stream_land_raw(stream: DataFrame, out: str, checkpoint: str, trigger: Mapping | None = None,
                    error_out: str | None = None, corrupt_col: str = "_corrupt_record"):
    """Land raw events as NDJSON under the *arrival* date (``dt`` = the
    micro-batch's processing day, so late events stay where they arrived).

    Uses the built-in file sink, which commits every batch in its metadata
    log: a batch replayed after a failure is not landed twice. Malformed
    records (``corrupt_col`` set) go to ``error_out`` through a second,
    independently checkpointed sink; then a (landing, errors) pair is
    returned.

    Time and size bounds: the trigger bounds the time, the source's
    ``max_bytes_per_trigger`` the bytes of a micro-batch and so of its files. With
    an ``availableNow`` run every 60 seconds and 1 MiB, a burst is landed at once
    in batches of about 1 MiB, a trickle once a minute."""
    trig = trigger or {"processingTime": "60 seconds"}
    day = stream.withColumn("dt", F.to_date(F.current_timestamp()))
    has_corrupt = corrupt_col in stream.columns
    good = day.filter(F.col(corrupt_col).isNull()).drop(corrupt_col) if has_corrupt else day
    main = (good.writeStream.option("checkpointLocation", checkpoint).trigger(**trig)
            .partitionBy("dt").format("json").start(out))
    if not (error_out and has_corrupt):
        return main
    # whole rows: Spark rejects a query that reads only the corrupt-record column
    bad = day.filter(F.col(corrupt_col).isNotNull())
    errors = (bad.writeStream.option("checkpointLocation", checkpoint.rstrip("/") + "-errors").trigger(**trig)
              .partitionBy("dt").format("json").start(error_out))
    return main, errors


def stream_lag_monitor(stream: DataFrame, event_time: str, out: str, checkpoint: str,
                       window: str = "5 minutes", threshold_ms: int = 300_000,
                       trigger: Mapping | None = None) -> StreamingQuery:
    """Live consumer-lag alarm: arrival = the micro-batch's processing time,
    delay = arrival - event time; max delay per arrival window with an
    ``alarm`` flag, written once the window closes (append, watermark on
    arrival)."""
    from ..operators.monitor import stream_lag
    arrived = stream.withColumn("__arrival", F.current_timestamp()).withWatermark("__arrival", window)
    lag = stream_lag(arrived, "__arrival", event_time, window, threshold_ms)
    return _writer(lag, checkpoint, trigger).format("parquet").start(out)


PROMOTED_DIR, BAD_DIR, OUTCOMES_DIR = "_promoted", "_quarantine", "_dq_results"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns ``checkpoint``."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_curation(stream: DataFrame, out: str, checkpoint: str, rules, extra=(),
                    gold: Callable[[DataFrame], DataFrame] | None = None,
                    trigger: Mapping | None = None) -> StreamingQuery:
    """Cleanse every micro-batch and write all its outputs: promoted rows, quarantined rows with the
    rules they failed, rule outcomes, and ``gold(promoted)`` if given. Each output has a folder per
    query (its id lives in the checkpoint) and batch; the last step adds the batch's commit record with
    its counts. ``versions.read_committed`` reads committed batches only, so a batch that failed halfway
    is not seen, and its replay replaces its folders. A batch that is already committed is left alone. A
    new checkpoint is a new query and overwrites nothing. The micro-batch is evaluated once and kept
    for its writes."""
    from ..operators.rules import cleanse_counts, evaluate_rules_rows, evaluate_rules_summary, split_quarantine, split_valid
    from ..sources.files import _write_outcomes
    cols = stream.columns

    def curate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        if versions.is_committed(spark, out, query, batch_id):
            return
        place = functools.partial(versions.batch_path, out, query=query, batch=batch_id)
        evaluated = evaluate_rules_rows(batch, rules, extra).persist()
        try:
            good = split_valid(evaluated, cols)
            good.write.mode("overwrite").parquet(place(PROMOTED_DIR))
            split_quarantine(evaluated, cols, with_reasons=True).write.mode("overwrite").parquet(place(BAD_DIR))
            if list(rules) + list(extra):
                _write_outcomes(evaluate_rules_summary(evaluated.select(*cols), rules, extra), place(OUTCOMES_DIR))
            if gold is not None:
                gold(good).write.mode("overwrite").parquet(place(""))
            counts = cleanse_counts(evaluated).first()
        finally:
            evaluated.unpersist()
        versions.commit_batch(spark, out, query, batch_id, {k: str(v) for k, v in counts.asDict().items()})
    return _writer(stream, checkpoint, trigger).foreachBatch(curate).start()


def curation_log(spark: SparkSession, out: str, source: str) -> DataFrame:
    """source, batches, promoted, quarantined over the committed micro-batches of ``out``."""
    info = versions.committed_batches(spark, out).select("info")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.col("info")[name].cast("long")), F.lit(0)).alias(name)
    return info.agg(F.count(F.lit(1)).alias("batches"), total("promoted"), total("quarantined")).select(
        F.lit(source).alias("source"), "batches", "promoted", "quarantined")


def stream_to_gold(readings: DataFrame, out: str, checkpoint: str, rules, limits: Mapping[str, tuple],
                   trigger: Mapping | None = None, extra=()) -> StreamingQuery:
    """Incremental curation of readings into the alert fact; see :func:`stream_curation`. The fact
    lies in ``out`` itself (``versions.read_committed(spark, out)``)."""
    from ..operators.curate import fact_vitals_alert
    return stream_curation(readings, out, checkpoint, rules, extra, lambda good: fact_vitals_alert(good, limits), trigger)
