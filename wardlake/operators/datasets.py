"""The six BI datasets: one row-level DataFrame per dashboard subject.

Each is fact -> derived columns -> facility-name lookup (broadcast hash join
behind a size check). Only ``ds_visits`` (LAG) and ``ds_staffing`` (two
pre-aggregations joined on three keys) shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.timefn import as_timestamp
from .joins import join_facility_name, join_staffing_beds
from .windows import CHUNK, readmission_flag

# Threshold for a department at capacity, claim status names
# and the two counted staff roles.
CAPACITY_RISK_RATE = 0.90
STATUS_DENIED = "Denied"
STATUS_PAID = "Paid"
ROLE_NURSE = "Nurse"
ROLE_PHYSICIAN = "Physician"


def _ts(df: DataFrame, name: str) -> Column:
    return as_timestamp(name, df.schema[name].dataType)


def as_date(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    if isinstance(dt, StringType):
        return F.col(name).try_cast("date")
    return F.to_date(F.col(name))


def flag01(c: Column) -> Column:
    """Boolean -> 1/0 integer; NULL counts as 0."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def ds_visits(fact_visit: DataFrame, dim_facility: DataFrame, days: int = 30,
              chunk="auto") -> DataFrame:
    laid = [CHUNK] if CHUNK in fact_visit.columns else []      # a loaded table carries its chunks
    v = fact_visit.select(
        *laid, "visit_id", "patient_id", "facility_id", "department", "visit_type", "attending_staff_id",
        _ts(fact_visit, "admission_ts").alias("admission_time"),
        _ts(fact_visit, "discharge_ts").alias("discharge_time"),
        "still_admitted", "length_of_stay_hours")
    # LAG looks at every facility of the patient, before any facility lookup
    # or viewer filter narrows the rows.
    v = readmission_flag(v, "patient_id", "admission_time", "discharge_time", days=days,
                         tie="visit_id", chunk=chunk)
    v = join_facility_name(v, dim_facility)
    return v.select(
        "visit_id", "patient_id", "facility_id", "facility_name", "department", "visit_type",
        "attending_staff_id", "admission_time",
        F.to_date("admission_time").alias("admission_date"),
        "length_of_stay_hours",
        flag01(F.col("still_admitted")).alias("still_admitted_flag"),
        "readmission_flag")


def ds_bed_occupancy(fact_bed: DataFrame, dim_facility: DataFrame,
                     risk_rate: float = CAPACITY_RISK_RATE) -> DataFrame:
    b = join_facility_name(fact_bed, dim_facility)
    return b.select(
        "facility_id", "facility_name", "department",
        as_date(fact_bed, "snapshot_date").alias("snapshot_date"),
        "total_beds", "occupied_beds", "occupancy_rate",
        flag01(F.col("occupancy_rate") >= F.lit(risk_rate)).alias("at_capacity_risk"))


def ds_claims(fact_claim: DataFrame, dim_facility: DataFrame) -> DataFrame:
    c = join_facility_name(fact_claim, dim_facility)
    return c.select(
        "claim_id", "patient_id", "facility_id", "facility_name", "payer", "status", "claim_amount",
        as_date(fact_claim, "service_date").alias("service_date"),
        flag01(F.col("status") == F.lit(STATUS_DENIED)).alias("denied_flag"),
        F.when(F.col("status") == F.lit(STATUS_PAID), F.col("claim_amount"))
         .otherwise(F.lit(0).cast(fact_claim.schema["claim_amount"].dataType)).alias("paid_amount"))


def shift_totals(fact_staffing: DataFrame) -> DataFrame:
    return (fact_staffing
            .groupBy("facility_id", "department",
                     as_date(fact_staffing, "shift_date").alias("shift_date"), "shift_name")
            .agg(F.count(F.lit(1)).alias("staff_count"),
                 F.sum(flag01(F.col("role") == F.lit(ROLE_NURSE))).alias("nurse_count"),
                 F.sum(flag01(F.col("role") == F.lit(ROLE_PHYSICIAN))).alias("physician_count")))


def bed_totals(fact_bed: DataFrame) -> DataFrame:
    return (fact_bed
            .groupBy("facility_id", "department",
                     as_date(fact_bed, "snapshot_date").alias("shift_date"))
            .agg(F.sum("occupied_beds").alias("occupied_beds")))


def beds_per_staff(occupied: Column, staff: Column) -> Column:
    """round(occupied / staff, 2) in exact decimal arithmetic, NULL when either
    side is missing. decimal(20,2) instead of (10,2) so day totals at large
    scale cannot overflow under ANSI mode."""
    ratio = F.round(occupied.cast("decimal(20,2)") / staff, 2)
    return F.when((staff > 0) & occupied.isNotNull(), ratio.cast("double"))


def ds_staffing(fact_staffing: DataFrame, fact_bed: DataFrame, dim_facility: DataFrame) -> DataFrame:
    s = join_facility_name(shift_totals(fact_staffing), dim_facility)
    j = join_staffing_beds(s, bed_totals(fact_bed), ["facility_id", "department", "shift_date"])
    return j.select(
        "facility_id", "facility_name", "department", "shift_date", "shift_name",
        "staff_count", "nurse_count", "physician_count", "occupied_beds",
        beds_per_staff(F.col("occupied_beds"), F.col("staff_count")).alias("beds_per_staff"))


def ds_pharmacy_stock(fact_pharmacy: DataFrame, dim_facility: DataFrame) -> DataFrame:
    p = join_facility_name(fact_pharmacy, dim_facility)
    return p.select(
        "facility_id", "facility_name", "drug_name",
        as_date(fact_pharmacy, "snapshot_date").alias("snapshot_date"),
        "current_stock", "reorder_threshold", "unit_cost",
        (F.col("current_stock") * F.col("unit_cost")).alias("stock_value"),
        flag01(F.col("stockout_risk")).alias("stockout_flag"))


VITAL_COLUMNS = ["heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature_c"]
FLAG_COLUMNS = ["heart_rate_breach", "spo2_breach", "systolic_bp_breach", "temperature_breach"]


def ds_vitals_alerts(fact_alert: DataFrame, dim_facility: DataFrame) -> DataFrame:
    a = join_facility_name(fact_alert, dim_facility)
    return a.select(
        "event_id", "patient_id", "facility_id", "facility_name",
        _ts(fact_alert, "event_ts").alias("event_time"),
        *VITAL_COLUMNS,
        *[flag01(F.col(f)).alias(f) for f in FLAG_COLUMNS])
