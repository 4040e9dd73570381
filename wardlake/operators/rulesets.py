"""The nine shipped rule sets, each a configuration of the rule operators.

Defaults are the reference's value domains; callers pass their own domains
(the test-table bindings do) without touching the rule structure.
"""

from __future__ import annotations

from collections.abc import Sequence

from .rules import (
    RowRule, rule_between, rule_compare, rule_custom_sql, rule_in_set, rule_is_complete,
    rule_matches, rule_row_predicate, rule_uniqueness,
)

# Fixed values (the reference's closed value lists and id patterns).
FACILITY_IDS = ["FAC01", "FAC02", "FAC03"]
DEPARTMENTS = ["ER", "ICU", "Cardiology", "Pediatrics", "Orthopedics"]
VISIT_TYPES = ["Emergency", "Inpatient", "Outpatient"]
ROLES = ["Nurse", "Physician", "Technician"]
SHIFTS = ["Day", "Evening", "Night"]
PAYERS = ["Medicare", "Medicaid", "BlueCross", "Aetna", "UnitedHealth", "SelfPay"]
CLAIM_STATUSES = ["Submitted", "Paid", "Denied", "Pending"]
PATIENT_ID_PATTERN = "P[0-9]{5}"
STAFF_ID_PATTERN = "S[0-9]{4}"
UNIQUENESS_THRESHOLD = 0.99
# Physical ranges for vitals: field, low, high.
VITAL_RANGES = [
    ("heart_rate", 0, 300),
    ("spo2", 0, 100),
    ("systolic_bp", 0, 300),
    ("diastolic_bp", 0, 200),
    ("temperature_c", 20, 45),
]
CLAIM_AMOUNT_RANGE = (0, 100000)
UNIT_COST_RANGE = (0, 10000)


def visits_rules(facilities: Sequence = FACILITY_IDS, departments: Sequence = DEPARTMENTS,
                 visit_types: Sequence = VISIT_TYPES, patient_pattern: str = PATIENT_ID_PATTERN,
                 staff_pattern: str = STAFF_ID_PATTERN) -> list:
    return [
        rule_is_complete("visit_id"), rule_is_complete("patient_id"),
        rule_is_complete("facility_id"), rule_is_complete("attending_staff_id"),
        rule_is_complete("admission_ts"),
        rule_uniqueness("visit_id", ">", UNIQUENESS_THRESHOLD),
        rule_matches("patient_id", patient_pattern),
        rule_matches("attending_staff_id", staff_pattern),
        rule_in_set("facility_id", facilities),
        rule_in_set("department", departments),
        rule_in_set("visit_type", visit_types),
    ]


def staff_schedules_rules(facilities: Sequence = FACILITY_IDS, departments: Sequence = DEPARTMENTS,
                          roles: Sequence = ROLES, shifts: Sequence = SHIFTS,
                          staff_pattern: str = STAFF_ID_PATTERN) -> list:
    return [
        rule_is_complete("staff_id"), rule_is_complete("facility_id"), rule_is_complete("shift_date"),
        rule_matches("staff_id", staff_pattern),
        rule_in_set("facility_id", facilities),
        rule_in_set("department", departments),
        rule_in_set("role", roles),
        rule_in_set("shift_name", shifts),
    ]


def billing_claims_rules(facilities: Sequence = FACILITY_IDS, payers: Sequence = PAYERS,
                         statuses: Sequence = CLAIM_STATUSES, patient_pattern: str = PATIENT_ID_PATTERN,
                         amount_range: tuple = CLAIM_AMOUNT_RANGE) -> list:
    return [
        rule_is_complete("claim_id"), rule_is_complete("patient_id"),
        rule_is_complete("facility_id"), rule_is_complete("claim_amount"),
        rule_uniqueness("claim_id", ">", UNIQUENESS_THRESHOLD),
        rule_matches("patient_id", patient_pattern),
        rule_in_set("facility_id", facilities),
        rule_in_set("payer", payers),
        rule_in_set("status", statuses),
        rule_between("claim_amount", *amount_range),
    ]


def pharmacy_inventory_rules(facilities: Sequence = FACILITY_IDS,
                             cost_range: tuple = UNIT_COST_RANGE) -> list:
    return [
        rule_is_complete("facility_id"), rule_is_complete("drug_name"),
        rule_is_complete("current_stock"), rule_is_complete("reorder_threshold"),
        rule_in_set("facility_id", facilities),
        rule_compare("current_stock", ">=", 0),
        rule_compare("reorder_threshold", ">=", 0),
        rule_between("unit_cost", *cost_range),
    ]


def bed_capacity_rules(facilities: Sequence = FACILITY_IDS, departments: Sequence = DEPARTMENTS) -> list:
    return [
        rule_is_complete("facility_id"), rule_is_complete("department"),
        rule_is_complete("total_beds"), rule_is_complete("occupied_beds"),
        rule_in_set("facility_id", facilities),
        rule_in_set("department", departments),
        rule_compare("total_beds", ">", 0),
        rule_compare("occupied_beds", ">=", 0),
        rule_custom_sql("select count(*) from primary where occupied_beds > total_beds", "=", 0),
    ]


def bed_capacity_extra() -> list[RowRule]:
    """The row-attributable form of the custom SQL invariant."""
    return [rule_row_predicate("occupied_beds <= total_beds",
                               lambda df: df["occupied_beds"] <= df["total_beds"])]


def vitals_rules(facilities: Sequence = FACILITY_IDS, patient_pattern: str = PATIENT_ID_PATTERN,
                 ranges: Sequence = VITAL_RANGES) -> list:
    return [
        rule_is_complete("event_id"), rule_is_complete("patient_id"), rule_is_complete("facility_id"),
        rule_matches("patient_id", patient_pattern),
        rule_in_set("facility_id", facilities),
        *[rule_between(c, lo, hi) for c, lo, hi in ranges],
    ]


def prescriptions_rules(facilities: Sequence = FACILITY_IDS,
                        patient_pattern: str = PATIENT_ID_PATTERN) -> list:
    return [
        rule_is_complete("event_id"), rule_is_complete("patient_id"),
        rule_is_complete("facility_id"), rule_is_complete("drug_name"),
        rule_matches("patient_id", patient_pattern),
        rule_in_set("facility_id", facilities),
        rule_compare("dosage_mg", ">", 0),
    ]


def _master_rules(key: str, pattern: str, required: Sequence[str]) -> list:
    return [
        rule_is_complete(key), *[rule_is_complete(c) for c in required],
        rule_uniqueness(key, ">", UNIQUENESS_THRESHOLD),
        rule_matches(key, pattern),
    ]


MASTER_REQUIRED = ["full_name", "date_of_birth", "government_id"]


def patients_rules(patient_pattern: str = PATIENT_ID_PATTERN,
                   required: Sequence[str] = MASTER_REQUIRED) -> list:
    return _master_rules("patient_id", patient_pattern, required)


def staff_rules(staff_pattern: str = STAFF_ID_PATTERN, required: Sequence[str] = MASTER_REQUIRED) -> list:
    return _master_rules("staff_id", staff_pattern, required)
