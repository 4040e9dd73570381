"""Canonical hospital-shaped inputs derived from the driver's test tables.

Each binding is a Spark DataFrame over the given parquet tables (its work
grows with them) and has a DuckDB twin in ``BINDING_SQL`` used by the
oracle. Joins are left to Catalyst/AQE: at scale customer, supplier and part
are large tables, so nothing here is force-broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

# Binding configuration (domains of the test tables, SURVEY 7.3).
N_FACILITIES = 25
VISIT_FACILITIES = list(range(N_FACILITIES - 1))   # facility 24 is not onboarded
ALL_FACILITIES = list(range(N_FACILITIES))
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ORDER_STATUSES = ["F", "O", "P"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
EVENT_TYPES_KNOWN = ["click", "view", "purchase", "signup"]      # "error" left out
ID_PATTERN = "[0-9]+"
CUSTOMER_NAME_PATTERN = "Customer#[0-9]{9}"
VITAL_LIMITS = {"heart_rate": (1, 150), "spo2": (5, None),
                "systolic_bp": (70, 180), "temperature_c": (35.0, 40.0)}
VITAL_RANGES = [("heart_rate", 0, 300), ("spo2", 0, 100), ("systolic_bp", 0, 300),
                ("diastolic_bp", 0, 200), ("temperature_c", 20, 45)]
ACCESS_ROWS = [("exec", None), ("north", 1), ("north", 2), ("north", 2), ("south", 3),
               ("strict_null", None)]


# The columns of the test tables, declared so that no footer is read to plan a query.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    prepare(spark)
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{d.rstrip('/')}/{name}.parquet")


def facilities(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("facility_id"),
                                            F.col("n_name").alias("facility_name"))


def _order_lines(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"),
                                        F.min("l_suppkey").alias("first_supplier"))


def _orders_customers(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


def visits(spark, d) -> DataFrame:
    oc = _orders_customers(spark, d)
    li = _order_lines(spark, d)
    j = oc.join(li, oc.o_orderkey == li.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("patient_id"),
        F.col("c_nationkey").alias("facility_id"), F.col("o_orderpriority").alias("department"),
        F.col("o_orderstatus").alias("visit_type"), F.col("first_supplier").alias("attending_staff_id"),
        F.col("o_orderdate").alias("admission_ts"),
        F.when(F.col("o_orderstatus") != "P", F.col("last_ship")).alias("discharge_ts"))


def claims(spark, d) -> DataFrame:
    oc = _orders_customers(spark, d)
    status = (F.when(F.col("o_orderstatus") == "F", "Denied")
              .when(F.col("o_orderstatus") == "O", "Paid").otherwise("Pending"))
    return oc.select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("patient_id"),
        F.col("c_nationkey").alias("facility_id"), F.col("c_mktsegment").alias("payer"),
        status.alias("status"), F.col("o_totalprice").alias("claim_amount"),
        F.col("o_orderdate").alias("service_date"))


def _lines_suppliers(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey, "inner")


def staff_schedules(spark, d) -> DataFrame:
    ls = _lines_suppliers(spark, d)
    role = (F.when(F.col("l_linenumber") % 3 == 0, "Nurse")
            .when(F.col("l_linenumber") % 3 == 1, "Physician").otherwise("Technician"))
    return ls.select(
        F.col("l_suppkey").alias("staff_id"), F.col("s_nationkey").alias("facility_id"),
        F.col("l_returnflag").alias("department"), role.alias("role"),
        F.to_date("l_shipdate").alias("shift_date"), F.col("l_linestatus").alias("shift_name"))


def bed_capacity(spark, d) -> DataFrame:
    ls = _lines_suppliers(spark, d)
    qty = F.col("l_quantity").cast("int")
    return (ls.groupBy(F.col("s_nationkey").alias("facility_id"), F.col("l_returnflag").alias("department"),
                       F.to_date("l_shipdate").alias("snapshot_date"))
            .agg(F.sum(qty).alias("total_beds"),
                 F.sum(F.when(F.col("l_quantity") > 20, qty).otherwise(0)).alias("occupied_beds"))
            .select("facility_id", "department", "total_beds", "occupied_beds", "snapshot_date"))


def pharmacy_inventory(spark, d) -> DataFrame:
    ls = _lines_suppliers(spark, d)
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    j = ls.join(p, ls.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("s_nationkey").alias("facility_id"), F.col("p_name").alias("drug_name"),
        F.col("l_quantity").cast("int").alias("current_stock"), F.col("p_size").alias("reorder_threshold"),
        F.col("p_retailprice").alias("unit_cost"), F.to_date("l_shipdate").alias("snapshot_date"))


def vitals(spark, d) -> DataFrame:
    return vitals_from_events(table(spark, d, "events"))


def vitals_from_events(e: DataFrame) -> DataFrame:
    """Works on batch and streaming event frames alike. Blood pressure and
    temperature follow from the event's ids: mostly normal, some beyond the
    alert limits, a few missing or beyond the physical ranges. Temperatures
    are halves, so both engines print them alike."""
    e_id = F.col("event_id")
    systolic = (F.when(e_id % 89 == 0, F.lit(310)).when(F.col("user_id") % 11 != 0, 60 + e_id * 7 % 140)).cast("double")
    diastolic = F.when(e_id % 97 == 0, F.lit(250)).otherwise(40 + e_id * 3 % 100).cast("double")
    temperature = F.when(e_id % 101 == 0, F.lit(50.0)).otherwise(34 + (e_id % 17) / 2)
    return e.select(
        "event_id", F.col("user_id").alias("patient_id"),
        (F.col("user_id") % N_FACILITIES).cast("int").alias("facility_id"),
        F.col("value").alias("heart_rate"),
        F.get_json_object("props", "$.k").try_cast("double").alias("spo2"),
        systolic.alias("systolic_bp"), diastolic.alias("diastolic_bp"), temperature.alias("temperature_c"),
        F.col("ts").alias("event_ts"))


def prescriptions(spark, d) -> DataFrame:
    ls = _lines_suppliers(spark, d)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    j = ls.join(o, ls.l_orderkey == o.o_orderkey, "inner").join(p, ls.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("event_id"),
        F.col("o_custkey").alias("patient_id"), F.col("s_nationkey").alias("facility_id"),
        F.col("p_name").alias("drug_name"), F.col("l_quantity").cast("int").alias("dosage_mg"),
        F.col("l_shipdate").alias("event_ts"))


def patients(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("full_name"),
                    F.col("c_acctbal").alias("account_balance"), F.col("c_nationkey").alias("facility_id"),
                    F.col("c_mktsegment").alias("segment"))


def staff(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("staff_id"), F.col("s_name").alias("full_name"),
                    F.col("s_acctbal").alias("account_balance"), F.col("s_nationkey").alias("facility_id"))


def access_map(spark) -> DataFrame:
    """Viewer -> facility map (NULL = unrestricted for the BI policy)."""
    return spark.createDataFrame(ACCESS_ROWS, "user_name string, facility_id int")


# DuckDB twins of the bindings (CTE bodies), used by the oracle SQL.
BINDING_SQL = {
    "facilities": "SELECT n_nationkey AS facility_id, n_name AS facility_name FROM nation",
    "visits": """
        SELECT o.o_orderkey AS visit_id, o.o_custkey AS patient_id, c.c_nationkey AS facility_id,
               o.o_orderpriority AS department, o.o_orderstatus AS visit_type,
               li.first_supplier AS attending_staff_id, o.o_orderdate AS admission_ts,
               CASE WHEN o.o_orderstatus <> 'P' THEN li.last_ship END AS discharge_ts
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship, min(l_suppkey) AS first_supplier
                   FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey""",
    "claims": """
        SELECT o.o_orderkey AS claim_id, o.o_custkey AS patient_id, c.c_nationkey AS facility_id,
               c.c_mktsegment AS payer,
               CASE WHEN o.o_orderstatus = 'F' THEN 'Denied' WHEN o.o_orderstatus = 'O' THEN 'Paid'
                    ELSE 'Pending' END AS status,
               o.o_totalprice AS claim_amount, o.o_orderdate AS service_date
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "staff_schedules": """
        SELECT l.l_suppkey AS staff_id, s.s_nationkey AS facility_id, l.l_returnflag AS department,
               CASE WHEN l.l_linenumber % 3 = 0 THEN 'Nurse' WHEN l.l_linenumber % 3 = 1 THEN 'Physician'
                    ELSE 'Technician' END AS role,
               CAST(l.l_shipdate AS DATE) AS shift_date, l.l_linestatus AS shift_name
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "bed_capacity": """
        SELECT s.s_nationkey AS facility_id, l.l_returnflag AS department,
               CAST(sum(CAST(l.l_quantity AS INTEGER)) AS BIGINT) AS total_beds,
               CAST(sum(CASE WHEN l.l_quantity > 20 THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END) AS BIGINT)
                   AS occupied_beds,
               CAST(l.l_shipdate AS DATE) AS snapshot_date
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        GROUP BY s.s_nationkey, l.l_returnflag, CAST(l.l_shipdate AS DATE)""",
    "pharmacy_inventory": """
        SELECT s.s_nationkey AS facility_id, p.p_name AS drug_name,
               CAST(l.l_quantity AS INTEGER) AS current_stock, p.p_size AS reorder_threshold,
               p.p_retailprice AS unit_cost, CAST(l.l_shipdate AS DATE) AS snapshot_date
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "vitals": """
        SELECT event_id, user_id AS patient_id, CAST(user_id % 25 AS INTEGER) AS facility_id,
               value AS heart_rate, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS spo2,
               CAST(CASE WHEN event_id % 89 = 0 THEN 310 WHEN user_id % 11 <> 0 THEN 60 + event_id * 7 % 140 END AS DOUBLE)
                   AS systolic_bp,
               CAST(CASE WHEN event_id % 97 = 0 THEN 250 ELSE 40 + event_id * 3 % 100 END AS DOUBLE) AS diastolic_bp,
               CAST(CASE WHEN event_id % 101 = 0 THEN 50 ELSE 34 + (event_id % 17) / 2 END AS DOUBLE) AS temperature_c,
               ts AS event_ts
        FROM events""",
    "prescriptions": """
        SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
               o.o_custkey AS patient_id, s.s_nationkey AS facility_id, p.p_name AS drug_name,
               CAST(l.l_quantity AS INTEGER) AS dosage_mg, l.l_shipdate AS event_ts
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "patients": """
        SELECT c_custkey AS patient_id, c_name AS full_name, c_acctbal AS account_balance,
               c_nationkey AS facility_id, c_mktsegment AS segment FROM customer""",
    "staff": """
        SELECT s_suppkey AS staff_id, s_name AS full_name, s_acctbal AS account_balance,
               s_nationkey AS facility_id FROM supplier""",
    "access_map": "SELECT * FROM (VALUES " + ", ".join(
        f"('{u}', {'NULL' if f is None else f})" for u, f in ACCESS_ROWS) + ") AS t(user_name, facility_id)",
}


def with_ctes(sql: str, names=(), ctes=()) -> str:
    """Prefix ``sql`` with the named binding CTEs and then extra (name, body) CTEs."""
    parts = [f"{n} AS ({BINDING_SQL[n]})" for n in names] + [f"{n} AS ({b})" for n, b in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + sql
