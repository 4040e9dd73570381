"""DuckDB restatements of the gold tables and datasets (oracle side only).

Each dataset is stated from its definition by another method than the Spark
operator uses (a ranked self-join for the stay before, whole-number shares,
a value table, scalar subqueries), so the side-by-side check compares two
implementations. Output column names are a fixed contract.
"""

from __future__ import annotations

from .bindings import with_ctes

GOLD = {
    "fact_patient_visit": """
        SELECT *, discharge_ts IS NULL AS still_admitted,
               CASE WHEN discharge_ts IS NOT NULL
                    THEN CAST(date_diff('second', admission_ts, discharge_ts) AS DOUBLE) / 3600 END
                   AS length_of_stay_hours
        FROM visits""",
    "fact_bed_occupancy": """
        SELECT *, CASE WHEN total_beds = 0 THEN NULL
                       ELSE CAST(occupied_beds AS DOUBLE) / CAST(total_beds AS DOUBLE) END AS occupancy_rate
        FROM bed_capacity""",
    "fact_pharmacy_inventory": """
        SELECT *, current_stock <= reorder_threshold AS stockout_risk FROM pharmacy_inventory""",
    "fact_staffing": "SELECT * FROM staff_schedules",
    "fact_claim": "SELECT * FROM claims",
    "fact_vitals_alert": """
        SELECT *, (heart_rate < 1 OR heart_rate > 150) AS heart_rate_breach, spo2 < 5 AS spo2_breach,
               (systolic_bp < 70 OR systolic_bp > 180) AS systolic_bp_breach,
               (temperature_c < 35.0 OR temperature_c > 40.0) AS temperature_breach
        FROM vitals
        WHERE (heart_rate < 1 OR heart_rate > 150) OR spo2 < 5 OR (systolic_bp < 70 OR systolic_bp > 180)
           OR (temperature_c < 35.0 OR temperature_c > 40.0)""",
    # the stay before: the one ranked one lower, found by a self-join
    "ds_visits": """
        WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY admission_ts NULLS FIRST, visit_id NULLS FIRST) AS k
            FROM fact_patient_visit),
        gap AS (
            SELECT cur.*, epoch_us(CAST(cur.admission_ts AS TIMESTAMP)) - epoch_us(CAST(earlier.discharge_ts AS TIMESTAMP)) AS away
            FROM ranked cur LEFT JOIN ranked earlier
              ON earlier.k + 1 = cur.k AND earlier.patient_id IS NOT DISTINCT FROM cur.patient_id)
        SELECT visit_id, patient_id, facility_id, facility_name, department, visit_type, attending_staff_id,
               admission_ts AS admission_time, CAST(admission_ts AS DATE) AS admission_date, length_of_stay_hours,
               CAST(still_admitted AS INTEGER) AS still_admitted_flag,
               CAST(coalesce(away <= 2592000000000, false) AS INTEGER) AS readmission_flag
        FROM gap JOIN facilities USING (facility_id)""",
    # at risk: nine tenths of the beds taken, in whole numbers
    "ds_bed_occupancy": """
        SELECT facility_id, facility_name, department, CAST(snapshot_date AS DATE) AS snapshot_date, total_beds,
               occupied_beds, occupancy_rate,
               CAST(coalesce(total_beds <> 0 AND 10 * occupied_beds >= 9 * total_beds, false) AS INTEGER) AS at_capacity_risk
        FROM facilities JOIN fact_bed_occupancy USING (facility_id)""",
    "ds_claims": """
        WITH known(status, denied_flag, share) AS (VALUES ('Denied', 1, 0), ('Paid', 0, 1), ('Pending', 0, 0))
        SELECT claim_id, patient_id, facility_id, facility_name, payer, status, claim_amount,
               CAST(service_date AS DATE) AS service_date, denied_flag, share * claim_amount AS paid_amount
        FROM fact_claim JOIN known USING (status) JOIN facilities USING (facility_id)""",
    # beds of a shift by a scalar subquery on a per-day total
    "ds_staffing": """
        WITH per_day AS (
            SELECT facility_id, department, CAST(snapshot_date AS DATE) AS day, sum(occupied_beds) AS beds
            FROM fact_bed_occupancy GROUP BY ALL),
        shifts AS (
            SELECT facility_id, department, CAST(shift_date AS DATE) AS shift_date, shift_name, count(*) AS staff_count,
                   count(*) FILTER (role = 'Nurse') AS nurse_count, count(*) FILTER (role = 'Physician') AS physician_count
            FROM fact_staffing GROUP BY ALL),
        both_sides AS (
            SELECT shifts.*, CAST((SELECT any_value(beds) FROM per_day WHERE per_day.facility_id = shifts.facility_id
                                   AND per_day.department = shifts.department AND day = shift_date) AS BIGINT) AS occupied_beds
            FROM shifts)
        SELECT facility_id, facility_name, department, shift_date, shift_name, staff_count, nurse_count, physician_count,
               occupied_beds, CAST(round(CAST(occupied_beds AS DECIMAL(20, 2)) / nullif(staff_count, 0), 2) AS DOUBLE) AS beds_per_staff
        FROM both_sides JOIN facilities USING (facility_id)""",
    # fixed values: the output columns; stock value is stock times unit cost, the flag is the fact's risk
    "ds_pharmacy_stock": """
        SELECT facility_id, facility_name, drug_name, CAST(snapshot_date AS DATE) AS snapshot_date, current_stock,
               reorder_threshold, unit_cost, current_stock * unit_cost AS stock_value,
               CASE WHEN stockout_risk THEN 1 ELSE 0 END AS stockout_flag
        FROM fact_pharmacy_inventory JOIN facilities USING (facility_id)""",
    # breaches told from the readings themselves: outside their limits
    "ds_vitals_alerts": """
        SELECT event_id, patient_id, facility_id, facility_name, event_ts AS event_time, heart_rate, spo2, systolic_bp,
               diastolic_bp, temperature_c,
               CAST(coalesce(heart_rate NOT BETWEEN 1 AND 150, false) AS INTEGER) AS heart_rate_breach,
               CAST(coalesce(spo2 < 5, false) AS INTEGER) AS spo2_breach,
               CAST(coalesce(systolic_bp NOT BETWEEN 70 AND 180, false) AS INTEGER) AS systolic_bp_breach,
               CAST(coalesce(temperature_c NOT BETWEEN 35.0 AND 40.0, false) AS INTEGER) AS temperature_breach
        FROM facilities JOIN fact_vitals_alert USING (facility_id)""",
}

# Which bindings / gold parts each gold part needs, in dependency order.
NEEDS = {
    "fact_patient_visit": (["visits"], []),
    "fact_bed_occupancy": (["bed_capacity"], []),
    "fact_pharmacy_inventory": (["pharmacy_inventory"], []),
    "fact_staffing": (["staff_schedules"], []),
    "fact_claim": (["claims"], []),
    "fact_vitals_alert": (["vitals"], []),
    "ds_visits": (["facilities"], ["fact_patient_visit"]),
    "ds_bed_occupancy": (["facilities"], ["fact_bed_occupancy"]),
    "ds_claims": (["facilities"], ["fact_claim"]),
    "ds_staffing": (["facilities"], ["fact_staffing", "fact_bed_occupancy"]),
    "ds_pharmacy_stock": (["facilities"], ["fact_pharmacy_inventory"]),
    "ds_vitals_alerts": (["facilities"], ["fact_vitals_alert"]),
}


def _closure(parts):
    bind, gold = [], []

    def visit(p):
        b, g = NEEDS[p]
        for x in g:
            visit(x)
        for x in b:
            if x not in bind:
                bind.append(x)
        if p not in gold:
            gold.append(p)
    for p in parts:
        visit(p)
    return bind, gold


def over(sql: str, *parts: str, extra_bindings=(), extra_ctes=()) -> str:
    """``sql`` with the CTEs of the named gold parts (and their inputs)."""
    bind, gold = _closure(parts)
    for b in extra_bindings:
        if b not in bind:
            bind.append(b)
    return with_ctes(sql, bind, [(g, GOLD[g]) for g in gold] + list(extra_ctes))
