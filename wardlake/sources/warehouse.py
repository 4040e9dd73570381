"""Warehouse table declarations, conformance and physical layout."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.timefn import as_timestamp
from ..operators.windows import CHUNK, with_chunks
from . import versions

# Declared column types of the 13 warehouse tables (dates/times
# are text, calendar full_date is a DATE).
WAREHOUSE_DDL = {
    "dim_date": "full_date date, date_key string, year int, quarter int, month int, month_name string, "
                "day_of_month int, day_of_week int, day_name string, week_of_year int, is_weekend boolean",
    "dim_department": "department_id string, department_name string",
    "dim_facility": "facility_id string, facility_name string",
    "dim_drug": "drug_name string",
    "dim_payer": "payer string",
    "dim_patient": "patient_id string, full_name string, date_of_birth string, phone string, government_id string",
    "dim_staff": "staff_id string, full_name string, date_of_birth string, phone string, government_id string",
    "fact_patient_visit": "visit_id string, patient_id string, facility_id string, department string, "
                          "visit_type string, attending_staff_id string, admission_ts string, discharge_ts string, "
                          "still_admitted boolean, length_of_stay_hours double",
    "fact_bed_occupancy": "facility_id string, department string, total_beds int, occupied_beds int, "
                          "snapshot_date string, occupancy_rate double",
    "fact_staffing": "staff_id string, facility_id string, department string, role string, shift_date string, "
                     "shift_name string, shift_start string, shift_end string",
    "fact_claim": "claim_id string, patient_id string, facility_id string, payer string, claim_amount double, "
                  "status string, service_date string",
    "fact_pharmacy_inventory": "facility_id string, drug_name string, current_stock int, reorder_threshold int, "
                               "unit_cost double, snapshot_date string, stockout_risk boolean",
    "fact_vitals_alert": "event_id string, patient_id string, facility_id string, heart_rate double, spo2 double, "
                         "systolic_bp double, diastolic_bp double, temperature_c double, event_ts string, "
                         "heart_rate_breach boolean, spo2_breach boolean, systolic_bp_breach boolean, "
                         "temperature_breach boolean",
}

# Physical layout per table: replicated (broadcast) dimensions, facts
# distributed by their entity key and sorted by date. "order" tells the rows
# of an entity apart in time.
TABLE_LAYOUT = {
    "fact_patient_visit": {"dist_key": "patient_id", "sort_keys": ["admission_ts"], "order": ["admission_ts", "visit_id"]},
    "fact_claim": {"dist_key": "patient_id", "sort_keys": ["service_date"]},
    "fact_staffing": {"dist_key": "staff_id", "sort_keys": ["shift_date"]},
    "fact_vitals_alert": {"dist_key": "patient_id", "sort_keys": ["event_ts"]},
    "fact_bed_occupancy": {"dist_key": None, "sort_keys": ["snapshot_date"]},
    "fact_pharmacy_inventory": {"dist_key": None, "sort_keys": ["snapshot_date"]},
}


def warehouse_schema(table: str) -> StructType:
    return StructType.fromDDL(WAREHOUSE_DDL[table])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in declared order with declared types. A
    missing column raises at once; a non-NULL value that does not fit its type
    fails the load, naming the column, and never becomes NULL silently."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")


    def fitted(f) -> Column:
        cast = F.col(f.name).try_cast(f.dataType)
        fault = F.raise_error(F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), F.col(f.name).cast("string")))
        lost = F.col(f.name).isNotNull() & cast.isNull()
        return F.when(lost, fault.cast(f.dataType)).otherwise(cast).alias(f.name)

    return df.select(*[fitted(f) for f in schema.fields])


def table_layout(df: DataFrame, dist_key: str | None = None, sort_keys: Sequence[str] = (),
                 replicate: bool = False, partitions: int | None = None) -> DataFrame:
    """Distribution/sort layout: ``replicate`` -> broadcast hint for a small
    dimension, only after its row count is checked (above the bound it stays
    a normal, evenly spread table);
    ``dist_key`` -> rows clustered by the entity key through a *rebalance*
    (hash partitioning that AQE may split when one key is hot, so a patient
    holding a third of the rows does not become one file/task); ``sort_keys``
    -> local sort so Parquet min/max statistics skip row groups for date
    filters. Without a key rows stay evenly spread (never partition by a
    low-cardinality key like facility)."""
    if replicate:
        from ..operators.joins import broadcast_if_small
        return broadcast_if_small(df)
    out = df
    if dist_key:
        out = out.hint("rebalance", partitions, dist_key) if partitions else out.hint("rebalance", dist_key)
    if sort_keys:
        out = out.sortWithinPartitions(*sort_keys)
    return out


def load_warehouse(df: DataFrame, table: str, schema: StructType | None = None, path: str | None = None,
                   layout: Mapping | None = None, buckets: int | None = None, location: str | None = None,
                   keep: int = 2) -> None:
    """TRUNCATE + COPY semantics that cannot leave the table empty or half full: the rows go to a
    new version, and one step makes it the content. A load that fails changes nothing; a re-run
    never double counts. Declared tables get their ``TABLE_LAYOUT``, others ``layout``.

    ``path``: versions under that folder, read with :func:`read_warehouse`; rows clustered by the
    distribution key (hot keys split) and sorted. Without it: a catalog table per version, bucketed by
    the distribution key and by the chunk of its heavy entities (``operators.windows.with_chunks``) into
    ``buckets`` (default: the shuffle partitions) and sorted, and the view ``table`` over the newest;
    files go under ``location`` if given, else to the catalog's own folder. The newest ``keep``
    versions stay."""
    out = conform(df, schema or warehouse_schema(table)) if (schema or table in WAREHOUSE_DDL) else df
    layout = layout or TABLE_LAYOUT.get(table, {})
    if path:
        laid = table_layout(out, layout.get("dist_key"), layout.get("sort_keys", ()))
        versions.publish(df.sparkSession, path, lambda folder: laid.write.parquet(folder), {"table": table}, keep)
    else:
        _load_table(out, table, layout, buckets, location, keep)


def read_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """The content of a table loaded to ``path``."""
    return versions.read_current(spark, path)


def _version_tables(spark: SparkSession, table: str) -> list[str]:
    """The version tables of ``table``, newest first."""
    found = [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{table}__v*'").collect()]
    return sorted((t for t in found if re.fullmatch(re.escape(table) + r"__v\d{8}", t)), reverse=True)


def _load_table(df: DataFrame, table: str, layout: Mapping, buckets: int | None, location: str | None, keep: int) -> None:
    spark = df.sparkSession
    before = _version_tables(spark, table)
    name = f"{table}__v{int(before[0][-8:]) + 1 if before else 1:08d}"
    key, sort = layout.get("dist_key"), layout.get("sort_keys", [])
    if key:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        laid = _chunked(df, key, layout.get("order", sort), sort)
        # one file per bucket: the shuffle and the buckets hash alike
        writer = laid.repartition(n, key, CHUNK).write.bucketBy(n, key, CHUNK).sortBy(*sort)
    else:
        writer = df.sortWithinPartitions(*sort).write if sort else df.write
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    try:
        writer.saveAsTable(name)
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {name}")
    except Exception:
        _drop(spark, name, location)
        raise
    for old in before[max(keep, 1) - 1:]:
        _drop(spark, old, location)


def _drop(spark: SparkSession, name: str, location: str | None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if location:
        versions._delete(spark, f"{location.rstrip('/')}/{name}")


def _chunked(df: DataFrame, key: str, order: Sequence[str], times: Sequence[str]) -> DataFrame:
    """``df`` with the chunk of its heavy entities; text times are ordered as times, as the LAG does."""
    text = [c for c in order if c in times and isinstance(df.schema[c].dataType, StringType)]
    named = {f"__{c}": as_timestamp(c, df.schema[c].dataType) for c in text}
    return with_chunks(df.withColumns(named), key, [f"__{c}" if c in text else c for c in order]).drop(*named)


def register_tables(spark: SparkSession, root: str, sources: Sequence[str], prefix: str = "",
                    merge_schema: bool = True) -> list[str]:
    """Register each ``<root>/<source>`` Parquet folder as a temp view
    ``<prefix><source>``; partition folders are discovered and schemas of
    different days are merged additively (new columns appear, old ones stay).

    The columns come from the manifest that the writers keep (``files.record_columns``),
    so no file is opened to register a table. A folder without one was written by others:
    its footers are read (``merge_schema``)."""
    from .files import recorded_columns
    names = []
    for src in sources:
        path, known = f"{root.rstrip('/')}/{src}", recorded_columns(spark, root, src)
        if known is not None:
            df = spark.read.schema(known).parquet(path)
        else:
            df = spark.read.option("mergeSchema", merge_schema).parquet(path)
        name = f"{prefix}{src}"
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
