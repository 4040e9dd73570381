"""End-to-end runs: the daily batch and the streaming curation.

One Spark application per run; each source is read once, evaluated once
and written with observed counts (no count actions), the gold tables are
built from what was promoted and loaded into the warehouse. Returns the run log.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import curate as C
from ..sources import versions
from ..sources.files import read_cleansed, read_raw_csv, write_cleansing_run, write_curated
from ..sources.warehouse import load_warehouse


def run_batch_daily(spark: SparkSession, roots: Mapping[str, str], run_date: str,
                    sources: Mapping[str, tuple[StructType, list, list]],
                    gold: Mapping[str, tuple[str, callable]] | None = None) -> DataFrame:
    """Cleanse every batch source for ``run_date`` then rebuild, from all
    cleansed days (full refresh), the gold tables whose source took part in
    this run.

    A source whose raw day has not arrived is skipped: nothing of it is
    written, and its log entry has NULL counts.

    ``roots``: {"raw", "cleansed", "curated"}, and "warehouse" to load every
    rebuilt gold table there (:func:`~wardlake.sources.warehouse.load_warehouse`:
    declared types, layout, replaced in one step); ``sources``: name -> (schema,
    rules, extra row rules); ``gold``: table -> (source, builder(df)->df).
    """
    log, done = [], set()
    for name, (schema, rules, extra) in sources.items():
        try:
            raw = read_raw_csv(spark, roots["raw"], name, schema, run_date=run_date)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            log.append({"source": name, "run_date": run_date, "promoted": None, "quarantined": None})
            continue
        done.add(name)
        log.append(write_cleansing_run(raw, rules, roots["cleansed"], name, run_date, extra, by_day=True))
    for table, (source, build) in (gold or {}).items():
        if source not in done:      # unchanged by this run; nothing to refresh
            continue
        curated = f"{roots['curated'].rstrip('/')}/{table}"
        write_curated(build(read_cleansed(spark, roots["cleansed"], source)), curated)
        if "warehouse" in roots:
            load_warehouse(spark.read.parquet(curated), table, path=f"{roots['warehouse'].rstrip('/')}/{table}")
    return spark.createDataFrame(log, "source string, run_date string, promoted long, quarantined long")


DEFAULT_GOLD = {
    "fact_patient_visit": ("visits", C.fact_patient_visit),
    "fact_bed_occupancy": ("bed_capacity", C.fact_bed_occupancy),
    "fact_staffing": ("staff_schedules", C.fact_staffing),
    "fact_claim": ("billing_claims", C.fact_claim),
    "fact_pharmacy_inventory": ("pharmacy_inventory", C.fact_pharmacy_inventory),
    "dim_drug": ("pharmacy_inventory", C.dim_drug),
    "dim_payer": ("billing_claims", C.dim_payer),
}


def run_streaming_curation(spark: SparkSession, readings: DataFrame, roots: Mapping[str, str], rules,
                           limits, checkpoint: str, others: Mapping[str, tuple[DataFrame, list]] | None = None,
                           extra=()) -> DataFrame:
    """One availableNow run of the streaming sources; returns its log (source, batches, promoted,
    quarantined) when all available input is processed.

    ``readings`` are cleansed and curated into ``<curated>/fact_vitals_alert``; each of ``others``
    (name -> (stream, rules); prescriptions, for one) is cleansed under ``<cleansed>/<name>``. Promoted
    rows, quarantine, rule outcomes and counts of a micro-batch appear with its commit record. The
    streams run side by side, each with a checkpoint of its own under ``checkpoint``. Then, with a
    "warehouse" root, the committed alert fact is loaded there. A run again after a failure goes on
    where the checkpoints stand and gives each output once."""
    from ..streaming.streams import curation_log, stream_curation, stream_to_gold
    fact = f"{roots['curated'].rstrip('/')}/fact_vitals_alert"
    outs = {"vitals": fact}
    started = [stream_to_gold(readings, fact, checkpoint, rules, limits, extra=extra)]
    for name, (stream, its_rules) in (others or {}).items():
        outs[name] = f"{roots['cleansed'].rstrip('/')}/{name}"
        started.append(stream_curation(stream, outs[name], f"{checkpoint.rstrip('/')}-{name}", its_rules))
    try:
        for q in started:
            q.awaitTermination()
    finally:
        for q in started:
            q.stop()
    if "warehouse" in roots:
        alerts = versions.read_committed(spark, fact)
        if alerts is not None:
            load_warehouse(alerts, "fact_vitals_alert", path=f"{roots['warehouse'].rstrip('/')}/fact_vitals_alert")
    log = None
    for name, out in outs.items():
        one = curation_log(spark, out, name)
        log = one if log is None else log.unionByName(one)
    return log
