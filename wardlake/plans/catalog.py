"""Registered queries: key -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir), reads the given tables through the
bindings and returns a lazy DataFrame over the whole tables. Output columns
are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import access as A
from ..operators import curate as C
from ..operators import datasets as D
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import windows as W
from . import bindings as B
from .sqlparts import over

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Means to six digits, for the side-by-side check only (a mean of doubles
    depends on the order of its rows in the last digits)."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else c for c, t in df.dtypes])


# ------------------------------------------------------------- gold builders

def fact_visit(s, d):
    return C.fact_patient_visit(B.visits(s, d))


def fact_beds(s, d):
    return C.fact_bed_occupancy(B.bed_capacity(s, d))


def fact_pharmacy(s, d):
    return C.fact_pharmacy_inventory(B.pharmacy_inventory(s, d))


def fact_alerts(s, d):
    return C.fact_vitals_alert(B.vitals(s, d), B.VITAL_LIMITS)


def ds_visits(s, d):
    return D.ds_visits(fact_visit(s, d), B.facilities(s, d))


def ds_beds(s, d):
    return D.ds_bed_occupancy(fact_beds(s, d), B.facilities(s, d))


def ds_claims(s, d):
    return D.ds_claims(C.fact_claim(B.claims(s, d)), B.facilities(s, d))


def ds_staffing(s, d):
    return D.ds_staffing(C.fact_staffing(B.staff_schedules(s, d)), fact_beds(s, d), B.facilities(s, d))


def ds_pharmacy(s, d):
    return D.ds_pharmacy_stock(fact_pharmacy(s, d), B.facilities(s, d))


def ds_alerts(s, d):
    return D.ds_vitals_alerts(fact_alerts(s, d), B.facilities(s, d))


# ---------------------------------------------------------------- dimensions

query("dim_date", over("""
    SELECT full_date, strftime(full_date, '%Y-%m-%d') AS date_key, CAST(year(full_date) AS INTEGER) AS year,
           CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
           strftime(full_date, '%B') AS month_name, CAST(day(full_date) AS INTEGER) AS day_of_month,
           CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
           strftime(full_date, '%A') AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
           dayofweek(full_date) IN (0, 6) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(CAST(min(admission_ts) AS DATE), CAST(max(admission_ts) AS DATE),
                                             INTERVAL 1 DAY)) AS DATE) AS full_date FROM visits) t""",
    extra_bindings=["visits"]))(lambda s, d: C.dim_date_covering(B.visits(s, d), "admission_ts"))

query("dim_department", over("""
    SELECT printf('DEPT%02d', row_number() OVER (ORDER BY department_name)) AS department_id, department_name
    FROM (SELECT DISTINCT department AS department_name FROM visits WHERE department IS NOT NULL) t""",
    extra_bindings=["visits"]))(lambda s, d: C.dim_department_from(B.visits(s, d), "department"))

query("dim_facility", over("""
    SELECT CAST(facility_id AS VARCHAR) AS facility_id, facility_name FROM facilities
    WHERE facility_id IN (SELECT facility_id FROM visits)""", extra_bindings=["facilities", "visits"]))(
    lambda s, d: C.dim_facility_from(J.join_facility_name(B.visits(s, d), B.facilities(s, d))))

query("dim_drug", over("SELECT DISTINCT drug_name FROM pharmacy_inventory",
                       extra_bindings=["pharmacy_inventory"]))(
    lambda s, d: C.dim_drug(B.pharmacy_inventory(s, d)))

query("dim_payer", over("SELECT DISTINCT payer FROM claims", extra_bindings=["claims"]))(
    lambda s, d: C.dim_payer(B.claims(s, d)))

query("dim_patient", over("SELECT * FROM patients", extra_bindings=["patients"]))(
    lambda s, d: C.dim_patient(B.patients(s, d), "patient_id", ["full_name", "account_balance"]))

query("dim_staff", over("SELECT * FROM staff", extra_bindings=["staff"]))(
    lambda s, d: C.dim_staff(B.staff(s, d), "staff_id", ["full_name", "account_balance"]))

# --------------------------------------------------------------------- facts

query("fact_patient_visit", over("SELECT * FROM fact_patient_visit", "fact_patient_visit"))(fact_visit)
query("fact_bed_occupancy", over("SELECT * FROM fact_bed_occupancy", "fact_bed_occupancy"))(fact_beds)
query("fact_staffing", over("SELECT * FROM fact_staffing", "fact_staffing"))(
    lambda s, d: C.fact_staffing(B.staff_schedules(s, d)))
query("fact_claim", over("SELECT * FROM fact_claim", "fact_claim"))(
    lambda s, d: C.fact_claim(B.claims(s, d)))
query("fact_pharmacy_inventory", over("SELECT * FROM fact_pharmacy_inventory",
                                      "fact_pharmacy_inventory"))(fact_pharmacy)
query("fact_vitals_alert", over("SELECT * FROM fact_vitals_alert", "fact_vitals_alert"))(fact_alerts)

# --------------------------------------------------------------------- joins

query("join_facility_name", over("""
    SELECT c.claim_id, c.facility_id, f.facility_name FROM claims c JOIN facilities f ON f.facility_id = c.facility_id""",
    extra_bindings=["claims", "facilities"]))(
    lambda s, d: J.join_facility_name(B.claims(s, d).select("claim_id", "facility_id"), B.facilities(s, d)))


def _join_staffing_beds(s, d):
    shifts = D.shift_totals(C.fact_staffing(B.staff_schedules(s, d)))
    return J.join_staffing_beds(shifts, D.bed_totals(fact_beds(s, d)), ["facility_id", "department", "shift_date"])


query("join_staffing_beds", over("""
    SELECT s.*, b.occupied_beds
    FROM (SELECT facility_id, department, CAST(shift_date AS DATE) AS shift_date, shift_name,
                 count(*) AS staff_count,
                 CAST(sum(CASE WHEN role = 'Nurse' THEN 1 ELSE 0 END) AS BIGINT) AS nurse_count,
                 CAST(sum(CASE WHEN role = 'Physician' THEN 1 ELSE 0 END) AS BIGINT) AS physician_count
          FROM fact_staffing GROUP BY 1, 2, 3, 4) s
    LEFT JOIN (SELECT facility_id, department, CAST(snapshot_date AS DATE) AS shift_date,
                      CAST(sum(occupied_beds) AS BIGINT) AS occupied_beds
               FROM fact_bed_occupancy GROUP BY 1, 2, 3) b
      USING (facility_id, department, shift_date)""", "fact_staffing", "fact_bed_occupancy"))(_join_staffing_beds)

query("semi_join_access", over("""
    SELECT * FROM claims WHERE facility_id IN
      (SELECT facility_id FROM access_map WHERE user_name = 'north' AND facility_id IS NOT NULL)""",
    extra_bindings=["claims", "access_map"]))(
    lambda s, d: J.semi_join_access(B.claims(s, d), B.access_map(s), "north"))

# ------------------------------------------------------------------ datasets

for _name, _fn in [("ds_visits", ds_visits), ("ds_bed_occupancy", ds_beds), ("ds_claims", ds_claims),
                   ("ds_staffing", ds_staffing), ("ds_pharmacy_stock", ds_pharmacy),
                   ("ds_vitals_alerts", ds_alerts)]:
    query(_name, over(f"SELECT * FROM {_name}", _name))(_fn)


def _readmission(s, d):
    v = fact_visit(s, d).select("visit_id", "patient_id", "admission_ts", "discharge_ts")
    return W.readmission_flag(v, "patient_id", "admission_ts", "discharge_ts", days=30, tie="visit_id",
                              keep_prior=True)


query("readmission_flag", over("""
    SELECT visit_id, patient_id, admission_ts, discharge_ts, prior_discharge_time,
           CASE WHEN prior_discharge_time IS NOT NULL
                 AND admission_ts <= prior_discharge_time + INTERVAL 30 DAY THEN 1 ELSE 0 END AS readmission_flag
    FROM (SELECT *, LAG(discharge_ts) OVER (PARTITION BY patient_id
                   ORDER BY admission_ts ASC NULLS FIRST, visit_id ASC NULLS FIRST) AS prior_discharge_time
          FROM visits) t""", extra_bindings=["visits"]))(_readmission)

# ----------------------------------------------------------------- aggregates

query("group_count", over("""
    SELECT facility_name, department, count(*) AS row_count FROM ds_visits GROUP BY ALL""", "ds_visits"))(
    lambda s, d: M.group_count(ds_visits(s, d), ["facility_name", "department"]))

query("conditional_count", over("""
    SELECT payer, CAST(sum(CASE WHEN status = 'Denied' THEN 1 ELSE 0 END) AS BIGINT) AS denied,
           CAST(sum(CASE WHEN status = 'Paid' THEN 1 ELSE 0 END) AS BIGINT) AS paid,
           CAST(sum(CASE WHEN claim_amount > 300000 THEN 1 ELSE 0 END) AS BIGINT) AS large
    FROM ds_claims GROUP BY payer""", "ds_claims"))(
    lambda s, d: M.conditional_count(ds_claims(s, d), ["payer"], {
        "denied": F.col("status") == "Denied", "paid": F.col("status") == "Paid",
        "large": F.col("claim_amount") > 300000}))

query("ratio_of_aggregates", over("""
    SELECT facility_name, CAST(sum(readmission_flag) AS DOUBLE) / CAST(count(visit_id) AS DOUBLE) AS readmission_rate
    FROM ds_visits GROUP BY facility_name""", "ds_visits"))(
    lambda s, d: M.ratio_of_aggregates(ds_visits(s, d), "readmission_flag", "visit_id", ["facility_name"],
                                       "readmission_rate"))

query("kpi_total_visits", over("SELECT count(visit_id) AS total_visits FROM ds_visits", "ds_visits"))(
    lambda s, d: M.kpi_total_visits(ds_visits(s, d)))
query("kpi_avg_length_of_stay", over(
    "SELECT round(avg(length_of_stay_hours), 6) AS avg_length_of_stay_hours FROM ds_visits", "ds_visits"))(
    lambda s, d: _rounded(M.kpi_avg_length_of_stay(ds_visits(s, d))))
query("kpi_readmission_rate", over("""
    SELECT CAST(sum(readmission_flag) AS DOUBLE) / CAST(count(visit_id) AS DOUBLE) AS readmission_rate
    FROM ds_visits""", "ds_visits"))(lambda s, d: M.kpi_readmission_rate(ds_visits(s, d)))
query("kpi_total_claim_value", over("""
    SELECT CAST(sum(CAST(claim_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_claim_value FROM ds_claims""",
    "ds_claims"))(lambda s, d: M.kpi_total_claim_value(ds_claims(s, d)))
query("trend_occupancy", over("""
    SELECT CAST(snapshot_date AS DATE) AS period, facility_name,
           round(avg(occupancy_rate), 6) AS avg_occupancy_rate
    FROM ds_bed_occupancy GROUP BY ALL""", "ds_bed_occupancy"))(
    lambda s, d: _rounded(M.trend_occupancy(ds_beds(s, d))))
query("visits_by_facility_type", over("""
    SELECT facility_name, visit_type, count(visit_id) AS visit_count FROM ds_visits GROUP BY ALL""",
    "ds_visits"))(lambda s, d: M.visits_by_facility_type(ds_visits(s, d)))
query("trend_claim_value", over("""
    SELECT CAST(service_date AS DATE) AS period, status,
           CAST(sum(CAST(claim_amount AS DECIMAL(18, 2))) AS DOUBLE) AS claim_value
    FROM ds_claims GROUP BY ALL""", "ds_claims"))(lambda s, d: M.trend_claim_value(ds_claims(s, d)))
query("denial_rate_by_payer", over("""
    SELECT payer, CAST(sum(denied_flag) AS DOUBLE) / CAST(count(claim_id) AS DOUBLE) AS denial_rate
    FROM ds_claims GROUP BY payer""", "ds_claims"))(lambda s, d: M.denial_rate_by_payer(ds_claims(s, d)))
query("staffing_ratio", over("""
    SELECT facility_name, department, round(avg(beds_per_staff), 6) AS avg_beds_per_staff
    FROM ds_staffing GROUP BY ALL""", "ds_staffing"))(lambda s, d: _rounded(M.staffing_ratio(ds_staffing(s, d))))
query("kpi_avg_occupancy", over(
    "SELECT round(avg(occupancy_rate), 6) AS avg_occupancy_rate FROM ds_bed_occupancy", "ds_bed_occupancy"))(
    lambda s, d: _rounded(M.kpi_avg_occupancy(ds_beds(s, d))))
query("kpi_capacity_risk", over(
    "SELECT CAST(sum(at_capacity_risk) AS BIGINT) AS capacity_risk_count FROM ds_bed_occupancy",
    "ds_bed_occupancy"))(lambda s, d: M.kpi_capacity_risk(ds_beds(s, d)))
query("kpi_stockout_risk", over(
    "SELECT CAST(sum(stockout_flag) AS BIGINT) AS stockout_risk_count FROM ds_pharmacy_stock",
    "ds_pharmacy_stock"))(lambda s, d: M.kpi_stockout_risk(ds_pharmacy(s, d)))
query("kpi_critical_alerts", over(
    "SELECT count(event_id) AS critical_alerts FROM ds_vitals_alerts", "ds_vitals_alerts"))(
    lambda s, d: M.kpi_critical_alerts(ds_alerts(s, d)))
query("occupancy_by_department", over("""
    SELECT department, facility_name, round(avg(occupancy_rate), 6) AS avg_occupancy_rate
    FROM ds_bed_occupancy GROUP BY ALL""", "ds_bed_occupancy"))(
    lambda s, d: _rounded(M.occupancy_by_department(ds_beds(s, d))))
query("staff_by_shift", over("""
    SELECT shift_name, department, CAST(sum(staff_count) AS BIGINT) AS staff_total
    FROM ds_staffing GROUP BY ALL""", "ds_staffing"))(lambda s, d: M.staff_by_shift(ds_staffing(s, d)))
query("alerts_per_hour", over("""
    SELECT date_trunc('hour', event_time) AS hour, facility_name, count(*) AS alert_count
    FROM ds_vitals_alerts GROUP BY ALL""", "ds_vitals_alerts"))(
    lambda s, d: M.alerts_per_hour(ds_alerts(s, d)))
query("staffing_pressure", over("""
    SELECT facility_name, department, shift_date, shift_name, CAST(sum(staff_count) AS BIGINT) AS staff_total,
           CAST(sum(occupied_beds) AS BIGINT) AS occupied_beds_total, max(beds_per_staff) AS max_beds_per_staff
    FROM ds_staffing GROUP BY ALL""", "ds_staffing"))(lambda s, d: M.staffing_pressure(ds_staffing(s, d)))
query("stockout_worklist", over("""
    SELECT facility_name, drug_name, min(current_stock) AS min_stock,
           min(reorder_threshold) AS min_reorder_threshold, max(stockout_flag) AS stockout_flag
    FROM ds_pharmacy_stock GROUP BY ALL""", "ds_pharmacy_stock"))(
    lambda s, d: M.stockout_worklist(ds_pharmacy(s, d)))
query("alert_worklist", over("""
    SELECT event_time, facility_name, patient_id, heart_rate, spo2, systolic_bp, temperature_c
    FROM ds_vitals_alerts""", "ds_vitals_alerts"))(lambda s, d: M.alert_worklist(ds_alerts(s, d)))

# ------------------------------------------------------------------- access

SELECTED_FACILITIES = ["NATION_1", "NATION_7", "NATION_13"]


def _filter_facilities(s, d):
    sheet = A.filter_facilities({"beds": ds_beds(s, d), "alerts": ds_alerts(s, d)}, SELECTED_FACILITIES)
    beds = sheet["beds"].select(F.lit("beds").alias("dataset"), "facility_name", "department",
                                F.col("occupied_beds").cast("long").alias("number"))
    alerts = sheet["alerts"].select(F.lit("alerts").alias("dataset"), "facility_name",
                                    F.lit(None).cast("string").alias("department"), F.col("event_id").alias("number"))
    return beds.unionByName(alerts)


_SEL = ", ".join(f"'{x}'" for x in SELECTED_FACILITIES)
query("filter_facilities", over(f"""
    SELECT 'beds' AS dataset, facility_name, department, CAST(occupied_beds AS BIGINT) AS number FROM ds_bed_occupancy
    WHERE facility_name IN ({_SEL})
    UNION ALL
    SELECT 'alerts' AS dataset, facility_name, NULL AS department, event_id AS number FROM ds_vitals_alerts
    WHERE facility_name IN ({_SEL})""", "ds_bed_occupancy", "ds_vitals_alerts"))(
    _filter_facilities)

GRANTS = {
    "analyst": [{"tables": "*", "exclude": "pii"}],
    "auditor": [{"tables": "*", "exclude": "pii"}, {"tables": ["dim_patient"], "exclude": []}],
}

query("mask_columns", over("""
    SELECT patient_id, facility_id, segment FROM patients""", extra_bindings=["patients"]))(
    lambda s, d: A.mask_columns(C.dim_patient(B.patients(s, d), "patient_id", ["full_name", "account_balance"]),
                                "analyst", GRANTS, table="dim_patient"))


_ALL_VIEWERS = ["exec", "north", "south", "nobody", "strict_null"]
_VIEWERS_SQL = "(VALUES " + ", ".join(f"('{v}')" for v in _ALL_VIEWERS) + ") u(viewer)"


def _seen(rows, counts):
    """What viewers see, row by row, and how much every viewer sees per facility."""
    n = counts.select("viewer", F.lit("count").alias("part"), F.lit(None).cast("bigint").alias("claim_id"), "facility_id",
                      F.col("rows_seen").cast("double").alias("amount"))
    return rows.select("viewer", F.lit("row").alias("part"), "claim_id", "facility_id",
                       F.col("claim_amount").alias("amount")).unionByName(n)


def _row_filter_viewer(s, d):
    claims, access, universe = ds_claims(s, d), B.access_map(s), B.facilities(s, d)
    rows = A.row_filter_viewer(claims, access, ["exec", "north", "nobody"], universe).unionByName(
        A.row_filter_viewer(claims, access, "south", universe).withColumn("viewer", F.lit("south")))
    return _seen(rows, A.viewer_counts(claims, access, _ALL_VIEWERS, universe))


_SEEN_SQL = """
    WITH seen AS (SELECT u.viewer, c.claim_id, c.facility_id, c.claim_amount FROM {viewers} JOIN {claims} c ON {sees})
    SELECT viewer, 'row' AS part, claim_id, facility_id, claim_amount AS amount FROM seen WHERE viewer IN ({rows})
    UNION ALL
    SELECT viewer, 'count', NULL, facility_id, CAST(count(*) AS DOUBLE) FROM seen GROUP BY viewer, facility_id"""


def _seen_sql(claims, sees, rows):
    return f"SELECT * FROM ({_SEEN_SQL.format(viewers=_VIEWERS_SQL, claims=claims, sees=sees, rows=rows)}) t"


query("row_filter_viewer", over(_seen_sql("ds_claims", """EXISTS (
    SELECT 1 FROM access_map m WHERE m.user_name = u.viewer AND (m.facility_id IS NULL OR m.facility_id = c.facility_id))""",
    "'exec', 'north', 'south', 'nobody'"), "ds_claims", extra_bindings=["access_map"]))(_row_filter_viewer)


def _row_filter_strict(s, d):
    claims, access = C.fact_claim(B.claims(s, d)), B.access_map(s)
    rows = A.row_filter_strict(claims, access, ["exec", "north", "strict_null"], viewer_col="viewer").unionByName(
        A.row_filter_strict(claims, access, "south").withColumn("viewer", F.lit("south")))
    return _seen(rows, A.viewer_counts(claims, access, _ALL_VIEWERS))


query("row_filter_strict", over(_seen_sql("fact_claim", """c.facility_id IN (
    SELECT facility_id FROM access_map m WHERE m.user_name = u.viewer AND m.facility_id IS NOT NULL)""",
    "'exec', 'north', 'south', 'strict_null'"), "fact_claim", extra_bindings=["access_map"]))(_row_filter_strict)
