"""Gold layer: dimensions and facts (full refresh, column-level transforms).

Facts are narrow `select`s on their cleansed source: no shuffle, filters
and projections stay pushable to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefn import as_timestamp, hours_between
from ..functions.vitals import DEFAULT_VITAL_LIMITS, breach_flag

# Fixed values (reference calendar range and department list).
CALENDAR_START = "2025-01-01"
CALENDAR_END = "2027-12-31"
DEPARTMENTS = ["ER", "ICU", "Cardiology", "Pediatrics", "Orthopedics"]
# The personal columns of the patient and staff dimensions.
PII_COLUMNS = ["full_name", "date_of_birth", "phone", "government_id"]


# ---------------------------------------------------------------- dimensions

def calendar_columns(df: DataFrame, date_col: str = "full_date") -> DataFrame:
    d = F.col(date_col)
    return df.select(
        d.alias("full_date"),
        F.date_format(d, "yyyy-MM-dd").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),          # 1 = Sunday
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),        # ISO week
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end]."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return calendar_columns(days)


def dim_date_covering(df: DataFrame, *date_cols: str) -> DataFrame:
    """Calendar spanning every date found in ``date_cols`` of ``df``.

    The bounds come from one global min/max aggregate (partial aggregation,
    one row shuffled per task); the calendar itself is generated."""
    mins = [F.min(F.to_date(c)) for c in date_cols]
    maxs = [F.max(F.to_date(c)) for c in date_cols]
    bounds = df.agg(F.least(*mins).alias("lo") if len(mins) > 1 else mins[0].alias("lo"),
                    F.greatest(*maxs).alias("hi") if len(maxs) > 1 else maxs[0].alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return calendar_columns(days)


def dim_department(spark: SparkSession, names: Sequence[str] = DEPARTMENTS,
                   prefix: str = "DEPT") -> DataFrame:
    """Literal department list, id synthesised in list order (DEPT01, ...)."""
    rows = [(f"{prefix}{i:02d}", n) for i, n in enumerate(names, start=1)]
    return spark.createDataFrame(rows, "department_id string, department_name string")


def dim_department_from(df: DataFrame, key: str = "department", prefix: str = "DEPT") -> DataFrame:
    """Departments found in a fact, id synthesised in name order.

    The distinct set is aggregated first (partial aggregation), so only the
    handful of department names reaches the single ordered numbering step
    (one task over the distinct names, so the key must have few values)."""
    names = df.select(F.col(key).alias("department_name")).where(F.col("department_name").isNotNull()).distinct()
    w = Window.orderBy("department_name")
    return names.select(
        F.concat(F.lit(prefix), _padded(F.row_number().over(w).cast("string"))).alias("department_id"), "department_name")


def _padded(number: Column) -> Column:
    """At least two digits; longer numbers stay whole."""
    return F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)


def dim_facility(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Literal (facility_id, facility_name) rows; the caller owns the list."""
    return spark.createDataFrame(list(rows), "facility_id string, facility_name string")


def dim_facility_from(df: DataFrame, key: str = "facility_id", name: str = "facility_name") -> DataFrame:
    """Facilities found in a table, ids as text: one row per id that is not NULL, with the least of
    its names (one aggregate, combined per task)."""
    return (df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("facility_id"))
            .agg(F.min(name).alias("facility_name")))


def dim_distinct(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct values of one column (column pruned, partially aggregated)."""
    return df.select(F.col(key).alias(alias or key)).distinct()


def dim_drug(df: DataFrame, key: str = "drug_name") -> DataFrame:
    return dim_distinct(df, key, "drug_name")


def dim_payer(df: DataFrame, key: str = "payer") -> DataFrame:
    return dim_distinct(df, key, "payer")


def with_pii_metadata(df: DataFrame, pii_cols: Sequence[str]) -> DataFrame:
    """Tag columns with ``classification=pii`` metadata (drives mask_columns)."""
    cols = []
    for f in df.schema.fields:
        if f.name in pii_cols:
            cols.append(F.col(f.name).alias(f.name, metadata={"classification": "pii"}))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def dim_patient(df: DataFrame, key: str = "patient_id", pii_cols: Sequence[str] = PII_COLUMNS) -> DataFrame:
    return with_pii_metadata(df, [c for c in pii_cols if c in df.columns])


def dim_staff(df: DataFrame, key: str = "staff_id", pii_cols: Sequence[str] = PII_COLUMNS) -> DataFrame:
    return with_pii_metadata(df, [c for c in pii_cols if c in df.columns])


# --------------------------------------------------------------------- facts

def fact_patient_visit(df: DataFrame, start: str = "admission_ts", end: str = "discharge_ts") -> DataFrame:
    """Adds ``still_admitted`` (no discharge yet) and ``length_of_stay_hours``
    (whole-second difference / 3600, NULL while admitted)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    s = as_timestamp(start, types[start])
    e = as_timestamp(end, types[end])
    return df.withColumns({
        "still_admitted": F.col(end).isNull(),
        "length_of_stay_hours": F.when(F.col(end).isNotNull(), hours_between(s, e)),
    })


def fact_bed_occupancy(df: DataFrame, num: str = "occupied_beds", den: str = "total_beds") -> DataFrame:
    """``occupancy_rate`` = occupied / total as double; NULL when total is 0."""
    return df.withColumn("occupancy_rate", F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))


def fact_pharmacy_inventory(df: DataFrame, stock: str = "current_stock",
                            threshold: str = "reorder_threshold") -> DataFrame:
    """``stockout_risk`` = stock at or below the reorder threshold."""
    return df.withColumn("stockout_risk", F.col(stock) <= F.col(threshold))


# The columns of the two facts that are a selection.
STAFFING_COLUMNS = ["staff_id", "facility_id", "department", "role", "shift_date",
                    "shift_name", "shift_start", "shift_end"]
CLAIM_COLUMNS = ["claim_id", "patient_id", "facility_id", "payer", "claim_amount",
                 "status", "service_date"]


def fact_staffing(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in STAFFING_COLUMNS if c in df.columns])


def fact_claim(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in CLAIM_COLUMNS if c in df.columns])


def breach_flag_columns(limits: Mapping[str, tuple]) -> dict:
    names = {"temperature_c": "temperature_breach"}
    return {names.get(f, f"{f}_breach"): breach_flag(f, lim) for f, lim in limits.items()}


def fact_vitals_alert(df: DataFrame, limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS) -> DataFrame:
    """Breach flags per limit and only rows with at least one TRUE flag.

    Flags are three-valued; the filter keeps a row when any flag is TRUE even
    if another is NULL. The OR-of-ranges filter is pushed into the scan."""
    present = {f: lim for f, lim in limits.items() if f in df.columns}
    flags = breach_flag_columns(present)
    # a reading column the source lacks gives a NULL flag (never a breach)
    for name in breach_flag_columns({f: lim for f, lim in limits.items() if f not in present}):
        flags[name] = F.lit(None).cast("boolean")
    any_breach = None
    for c in flags.values():
        any_breach = c if any_breach is None else (any_breach | c)
    return df.withColumns(flags).filter(any_breach)
