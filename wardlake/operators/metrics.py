"""Aggregates behind the dashboard visuals.

All are ``groupBy().agg()`` with partial (map-side) aggregation, so a hot
group key costs one partial row per task, never one task per group.
Floating-point means are rounded to ``MEAN_DIGITS`` so results do not depend
on the order partial sums are combined in; money is summed as decimal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is summed in decimals, so a total does not depend on the order of its rows.
MONEY = "decimal(38,10)"


def _keys(keys) -> list:
    return [keys] if isinstance(keys, str) else list(keys or [])


def group_count(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """COUNT(*) per key combination."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def conditional_count(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) per condition and key (NULL -> 0)."""
    aggs = [F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(n)
            for n, c in conditions.items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def ratio_of_aggregates(df: DataFrame, flag: str, id_col: str, keys: Sequence[str] = (),
                        name: str = "rate") -> DataFrame:
    """sum(flag) / count(id) evaluated per group (never a mean of row ratios)."""
    return df.groupBy(*_keys(keys)).agg(
        F.try_divide(F.sum(flag).cast("double"), F.count(id_col).cast("double")).alias(name))


def _mean(c) -> Column:
    return F.avg(c)


def _money_sum(c) -> Column:
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def _bucket(df: DataFrame, col: str, grain: str) -> Column:
    if grain == "day":
        return F.to_date(F.col(col))
    return F.date_trunc(grain, F.col(col)).cast("timestamp_ntz")


# ---------------------------------------------------------- executive sheet

def kpi_total_visits(visits: DataFrame) -> DataFrame:
    return visits.agg(F.count("visit_id").alias("total_visits"))


def kpi_avg_length_of_stay(visits: DataFrame) -> DataFrame:
    return visits.agg(_mean("length_of_stay_hours").alias("avg_length_of_stay_hours"))


def kpi_readmission_rate(visits: DataFrame) -> DataFrame:
    return ratio_of_aggregates(visits, "readmission_flag", "visit_id", name="readmission_rate")


def kpi_total_claim_value(claims: DataFrame) -> DataFrame:
    return claims.agg(_money_sum("claim_amount").alias("total_claim_value"))


def trend_occupancy(beds: DataFrame, grain: str = "day") -> DataFrame:
    return (beds.groupBy(_bucket(beds, "snapshot_date", grain).alias("period"), "facility_name")
            .agg(_mean("occupancy_rate").alias("avg_occupancy_rate")))


def visits_by_facility_type(visits: DataFrame) -> DataFrame:
    return visits.groupBy("facility_name", "visit_type").agg(F.count("visit_id").alias("visit_count"))


def trend_claim_value(claims: DataFrame, grain: str = "day") -> DataFrame:
    return (claims.groupBy(_bucket(claims, "service_date", grain).alias("period"), "status")
            .agg(_money_sum("claim_amount").alias("claim_value")))


def denial_rate_by_payer(claims: DataFrame) -> DataFrame:
    return ratio_of_aggregates(claims, "denied_flag", "claim_id", keys=["payer"], name="denial_rate")


def staffing_ratio(staffing: DataFrame) -> DataFrame:
    return (staffing.groupBy("facility_name", "department")
            .agg(_mean("beds_per_staff").alias("avg_beds_per_staff")))


# -------------------------------------------------------- operational sheet

def kpi_avg_occupancy(beds: DataFrame) -> DataFrame:
    return beds.agg(_mean("occupancy_rate").alias("avg_occupancy_rate"))


def kpi_capacity_risk(beds: DataFrame) -> DataFrame:
    return beds.agg(F.sum("at_capacity_risk").cast("bigint").alias("capacity_risk_count"))


def kpi_stockout_risk(pharmacy: DataFrame) -> DataFrame:
    return pharmacy.agg(F.sum("stockout_flag").cast("bigint").alias("stockout_risk_count"))


def kpi_critical_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("event_id").alias("critical_alerts"))


def occupancy_by_department(beds: DataFrame) -> DataFrame:
    return (beds.groupBy("department", "facility_name")
            .agg(_mean("occupancy_rate").alias("avg_occupancy_rate")))


def staff_by_shift(staffing: DataFrame) -> DataFrame:
    return (staffing.groupBy("shift_name", "department")
            .agg(F.sum("staff_count").cast("bigint").alias("staff_total")))


def alerts_per_hour(alerts: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Alert count per hour bucket x facility; hours without alerts are absent."""
    return (alerts.groupBy(_bucket(alerts, time_col, "hour").alias("hour"), "facility_name")
            .agg(F.count(F.lit(1)).alias("alert_count")))


def staffing_pressure(staffing: DataFrame) -> DataFrame:
    return (staffing.groupBy("facility_name", "department", "shift_date", "shift_name")
            .agg(F.sum("staff_count").cast("bigint").alias("staff_total"),
                 F.sum("occupied_beds").cast("bigint").alias("occupied_beds_total"),
                 F.max("beds_per_staff").alias("max_beds_per_staff")))


def stockout_worklist(pharmacy: DataFrame) -> DataFrame:
    return (pharmacy.groupBy("facility_name", "drug_name")
            .agg(F.min("current_stock").alias("min_stock"),
                 F.min("reorder_threshold").alias("min_reorder_threshold"),
                 F.max("stockout_flag").alias("stockout_flag")))


# The columns of the alert worklist.
ALERT_WORKLIST_COLUMNS = ["event_time", "facility_name", "patient_id", "heart_rate", "spo2",
                          "systolic_bp", "temperature_c"]


def alert_worklist(alerts: DataFrame, top_k: int | None = None) -> DataFrame:
    """The unaggregated alert rows (7 columns). ``top_k`` turns it into a
    newest-first top-k report (the only place a limit is the feature)."""
    rows = alerts.select(*ALERT_WORKLIST_COLUMNS)
    if top_k:
        rows = rows.orderBy(F.col("event_time").desc()).limit(top_k)
    return rows
