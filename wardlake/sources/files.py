"""Readers and writers for the raw / cleansed / curated layers.

Layout: ``<root>/<source>/dt=YYYY-MM-DD/`` (Hive-style, so Spark prunes
partitions from a filter on ``dt``). Schemas are always declared, never
inferred: a bad cell becomes NULL (PERMISSIVE) instead of changing a type.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType
from pyspark.errors import AnalysisException

from .versions import _delete, _exists, _record

QUARANTINE_DIR = "_quarantine"
DQ_RESULTS_DIR = "_dq_results"


def default_run_date() -> str:
    """Yesterday in UTC: the last fully landed day."""
    return (_dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(days=1)).strftime("%Y-%m-%d")


ALL_DAYS = "*"


def partition_path(root: str, source: str, run_date: str) -> str:
    """One day's folder; ``run_date="*"`` means the whole source (every day,
    with ``dt`` discovered as a DATE partition column)."""
    if run_date == ALL_DAYS:
        return f"{root.rstrip('/')}/{source}"
    return f"{root.rstrip('/')}/{source}/dt={run_date}"


def _with_dt(schema: StructType) -> StructType:
    """Declare the ``dt`` partition column so header checks see only file columns."""
    if "dt" in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField("dt", DateType())])


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _read_day(spark, path, reader, schema, missing):
    try:
        return reader(path)
    except AnalysisException as e:
        if missing == "empty" and "PATH_NOT_FOUND" in str(e):
            return _empty(spark, schema)
        raise


def read_raw_csv(spark: SparkSession, root: str, source: str, schema: StructType,
                 run_date: str | None = None, missing: str = "error", check_header: bool = True) -> DataFrame:
    """One day of CSV: header row, empty string -> NULL, unparsable cell -> NULL.

    The declared schema binds by position; ``check_header`` additionally makes
    Spark verify the header names against it (a reordered file fails loudly
    instead of silently swapping columns)."""
    run_date = run_date or default_run_date()
    path = partition_path(root, source, run_date)
    schema = _with_dt(schema) if run_date == ALL_DAYS else schema
    reader = (spark.read.schema(schema).option("header", True).option("nullValue", "")
              .option("mode", "PERMISSIVE").option("enforceSchema", not check_header))
    return _read_day(spark, path, reader.csv, schema, missing)


def read_raw_json(spark: SparkSession, root: str, source: str, schema: StructType,
                  run_date: str | None = None, missing: str = "error", split_glued: bool = False) -> DataFrame:
    """One day of newline-delimited JSON with a declared schema.

    ``split_glued=True`` reads lines that hold several ``}{``-concatenated
    records through :func:`split_glued_json` (the plain JSON reader keeps
    only the first object of such a line)."""
    run_date = run_date or default_run_date()
    path = partition_path(root, source, run_date)
    if split_glued:
        if run_date == ALL_DAYS:
            return _read_day(spark, path, lambda p: _glued_all_days(spark, p, schema), schema, missing)
        return _read_day(spark, path, lambda p: split_glued_json(spark, p, schema), schema, missing)
    schema = _with_dt(schema) if run_date == ALL_DAYS else schema
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    return _read_day(spark, path, reader.json, schema, missing)


def _glued_all_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    lines = spark.read.option("basePath", path).text(path)          # dt discovered from the folders
    objs = lines.select(F.explode(_objects(F.col("value"))).alias("obj"), "dt")
    return objs.select(F.from_json("obj", schema, {"mode": "PERMISSIVE"}).alias("r"), "dt").select("r.*", "dt")


#: A run of text without braces (strings whole, braces in them are text), a brace, or a quote that never closes.
_TOKEN = r'(?:[^{}"]++|"(?:[^"\\]++|\\.)*+")++|[{}"]'


def _objects(line: Column) -> Column:
    """The objects of a line, however deep: a scan over its tokens keeps the brace depth and cuts where
    it falls back to zero. What lies outside of objects, or is torn, is one more (corrupt) record."""
    tokens = F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("open"), F.lit("").alias("rest"),
                     F.array().cast("array<string>").alias("done"))

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "{", 1).when((token == "}") & (state["depth"] > 0), -1).otherwise(0)
        inside = (state["depth"] > 0) | (depth > 0)
        grown = F.when(inside, F.concat(state["open"], token)).otherwise(state["open"])
        closes = inside & (depth == 0)
        return F.struct(
            depth.alias("depth"), F.when(closes, F.lit("")).otherwise(grown).alias("open"),
            F.when(inside, state["rest"]).otherwise(F.concat(state["rest"], token)).alias("rest"),
            F.when(closes, F.array_append(state["done"], grown)).otherwise(state["done"]).alias("done"))

    def end(state: Column) -> Column:
        rest = F.trim(F.concat(state["rest"], state["open"]))
        return F.when(F.length(rest) > 0, F.array_append(state["done"], rest)).otherwise(state["done"])
    return F.aggregate(tokens, start, step, end)


def split_glued_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Repair read for delivery that concatenated records without newlines:
    every object of a ``}{``-glued line becomes its own row."""
    lines = spark.read.text(path)
    objs = lines.select(F.explode(_objects(F.col("value"))).alias("obj"))
    return objs.select(F.from_json("obj", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def read_cleansed(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All ``dt`` partitions of a cleansed source, without the ``dt`` column."""
    return spark.read.parquet(f"{root.rstrip('/')}/{source}").drop("dt")


def day_paths(spark: SparkSession, root: str, source: str, start: str, end: str) -> list[str]:
    """Folders of the landed days between ``start`` and ``end`` (inclusive), projected from the
    bounds: one look-up per day, no listing of the source. Days that never landed are left out."""
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    days = [(first + _dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    paths = [partition_path(root, source, day) for day in days]
    with ThreadPoolExecutor(16) as pool:
        return [p for p, there in zip(paths, pool.map(lambda p: _exists(spark, p), paths)) if there]


def read_date_range(spark: SparkSession, root: str, source: str, start: str, end: str,
                    schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Any day between ``start`` and ``end`` (inclusive) of a dt-partitioned source. Only the folders
    of those days are listed and read, whatever else the source holds (see :func:`day_paths`). No such
    day: no rows if ``schema`` is given, else an error."""
    path = f"{root.rstrip('/')}/{source}"
    paths = day_paths(spark, root, source, start, end)
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no day of {path} between {start} and {end}")
        return _empty(spark, _with_dt(schema))
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(_with_dt(schema))
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "")
    df = reader.format(fmt).load(paths)
    return df.filter(F.col("dt").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def read_reference(spark: SparkSession, root: str, source: str, schema: StructType,
                   fixed_date: str = "2025-01-01") -> DataFrame:
    """Static master data: the raw CSV reader at a fixed partition date."""
    return read_raw_csv(spark, root, source, schema, run_date=fixed_date)


SCHEMAS_DIR = "_schemas"


def record_columns(spark: SparkSession, root: str, source: str, schema: StructType) -> None:
    """Note under ``<root>/_schemas/<source>/`` that days with these columns have been written: one
    small record per distinct schema, added once."""
    text = schema.json()
    path = f"{root.rstrip('/')}/{SCHEMAS_DIR}/{source}/{hashlib.sha256(text.encode()).hexdigest()[:16]}"
    if not _exists(spark, f"{path}/record.json"):
        _record(spark, path, {"schema": text})


def recorded_columns(spark: SparkSession, root: str, source: str) -> StructType | None:
    """The columns of all recorded schemas of a source: those of the first, then new ones in the
    order they appeared. None without a record. A column whose type changed raises."""
    path = f"{root.rstrip('/')}/{SCHEMAS_DIR}/{source}"
    if not _exists(spark, path):
        return None
    fields: dict[str, StructField] = {}
    for row in sorted(spark.read.schema("at timestamp, schema string").json(f"{path}/*").collect()):
        for f in StructType.fromJson(json.loads(row.schema)).fields:
            known = fields.setdefault(f.name, f)
            if known.dataType != f.dataType:
                raise ValueError(f"{source}.{f.name}: {known.dataType.simpleString()} and {f.dataType.simpleString()}")
    return StructType(list(fields.values()))


def _write_days(df: DataFrame, base: str, source: str, run_date: str) -> None:
    """One day: overwrite exactly ``dt=<day>``. All days (``"*"``): the rows
    carry a ``dt`` column and the whole source folder is replaced in a static
    overwrite, so days that no longer have rows are cleared as well. The
    columns go to the source's manifest."""
    record_columns(df.sparkSession, base, source, df.drop("dt").schema)
    if run_date == ALL_DAYS:
        (df.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("dt").parquet(f"{base.rstrip('/')}/{source}"))
    else:
        df.drop("dt").write.mode("overwrite").parquet(partition_path(base, source, run_date))


def write_cleansed(df: DataFrame, root: str, source: str, run_date: str) -> None:
    """Overwrite exactly one day directory (idempotent re-run), or every day."""
    _write_days(df, root, source, run_date)


def write_quarantine(df: DataFrame, root: str, source: str, run_date: str) -> None:
    """Overwrite the day's quarantine directory, also when there are no bad
    rows: an empty overwrite clears stale rows from an earlier run (a dynamic
    partition overwrite with no rows would leave them)."""
    _write_days(df, f"{root.rstrip('/')}/{QUARANTINE_DIR}", source, run_date)


WHOLE_RESULTS_DIR = "_dq_results_whole"      # outcomes that hold for a whole backfill, without a day


def write_dq_results(summary: DataFrame, root: str, source: str, run_date: str) -> None:
    """One row per rule under ``_dq_results/source=<s>/dt=<d>/``; the keys live
    in the path only, metrics are serialised to JSON text. With
    ``run_date="*"`` the summary carries a ``dt`` column (per-day outcomes of
    a backfill) and every day gets its folder in one partitioned write."""
    base = f"{root.rstrip('/')}/{DQ_RESULTS_DIR}/source={source}"
    if run_date == ALL_DAYS:
        (summary.select(*_outcome(), "dt").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("dt").parquet(base))
    else:
        _write_outcomes(summary, f"{base}/dt={run_date}")


def _outcome() -> list:
    return ["rule", "outcome", "failure_reason", F.to_json("evaluated_metrics").alias("evaluated_metrics")]


def _write_outcomes(summary: DataFrame, path: str) -> None:
    summary.select(*_outcome()).write.mode("overwrite").parquet(path)


def write_curated(df: DataFrame, root_or_table: str, schema: StructType | None = None) -> None:
    """Full-refresh overwrite of a curated table (path or catalog table). A path is written
    aside and moved into place, so a write that fails leaves the old content."""
    from .warehouse import conform
    out = conform(df, schema) if schema is not None else df
    if "/" in root_or_table:
        aside = f"{root_or_table.rstrip('/')}.{uuid.uuid4().hex[:12]}"
        try:
            out.write.parquet(aside)
            _move(df.sparkSession, aside, root_or_table.rstrip("/"))
        finally:
            _delete(df.sparkSession, aside)
    else:
        out.write.mode("overwrite").saveAsTable(root_or_table)


#: Files that a task of a partitioned write keeps open before it sorts its rows by folder.
OPEN_FILES = 32


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Within, a task that writes few folders keeps a file open in each and does not sort its rows
    (a sort holds the task's rows, or spills them); rows of further folders are sorted as ever."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def land_partitioned(df: DataFrame, root: str, source: str, dt: str, fmt: str = "csv", gather: bool = True) -> str:
    """Write ``df`` as a dt-partitioned raw source (one folder per day, the
    day column dropped from the files; CSV and JSON are compressed with gzip).
    Returns the source folder.

    ``gather`` brings the rows of a day together first, so that a day gets few
    files: a shuffle of all rows. Without it every task writes a file per
    folder it has rows for, which is right for a handful of folders."""
    path = f"{root.rstrip('/')}/{source}"
    out = df.withColumn("dt", F.col(dt))
    if dt != "dt":
        out = out.drop(dt)
    if gather:
        # rebalance (not repartition): AQE splits a day holding a large share of
        # the rows into several tasks/files instead of one.
        out = out.hint("rebalance", "dt")
    w = out.write.mode("overwrite").partitionBy("dt")
    with _unsorted_writes(df.sparkSession):
        if fmt == "csv":
            w.option("header", True).option("compression", "gzip").csv(path)
        elif fmt == "json":
            w.option("compression", "gzip").json(path)
        else:
            w.parquet(path)
    return path


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Replace the folder ``target`` by ``source``; False if there is no ``source``."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, source))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(new):
        return False
    fs.mkdirs(old.getParent())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def write_cleansing_run(df: DataFrame, rules, root: str, source: str, run_date: str, extra=(), by_day: bool = False) -> dict:
    """Cleanse ``df`` into promoted rows, quarantine (always replaced) and rule outcomes. Returns the
    run-log entry.

    The raw rows are read and evaluated once, by one write that is partitioned by the verdict; its two
    halves are then moved into place. Outcomes come from what was written: promoted rows pass every row
    rule, so only quarantined rows are evaluated again, and only (key, count) is shuffled for uniqueness.
    Counts are observed during the write.

    ``by_day``: ``df`` is a plain read of day folders, so a task has rows of few days. All days are then
    written from where they were read, at most two files for each raw file or split of one. Otherwise, and
    with lookup rules (their joins may deal the rows out anew), the rows of a day are brought together first."""
    from ..operators.rules import VALID, DatasetRule, LookupRule, evaluate_rules_rows, summary_of_split
    spark, every = df.sparkSession, run_date == ALL_DAYS
    cols = df.columns if every else [c for c in df.columns if c != "dt"]
    obs = Observation(f"cleanse_{source}_{uuid.uuid4().hex[:8]}")
    ev = evaluate_rules_rows(df, rules, extra).observe(
        obs, F.count_if(F.col(VALID)).alias("promoted"), F.count_if(~F.col(VALID)).alias("quarantined"))
    verdict = F.when(F.col(VALID), "promoted").otherwise("quarantined").alias("__verdict")
    rows = ev.select(*cols, verdict)
    parts = ["__verdict", "dt"] if every else ["__verdict"]
    staged = f"{root.rstrip('/')}/_staging/{source}-{uuid.uuid4().hex[:12]}"
    if every and not (by_day and not any(isinstance(r, LookupRule) for r in [*rules, *extra])):
        rows = rows.hint("rebalance", *parts)
    with _unsorted_writes(spark):
        rows.write.partitionBy(*parts).parquet(staged)

    halves = {}
    schema = StructType([f for f in df.schema.fields if f.name in cols])
    for name, base in (("promoted", root.rstrip("/")), ("quarantined", f"{root.rstrip('/')}/{QUARANTINE_DIR}")):
        target = partition_path(base, source, run_date)
        if not _move(spark, f"{staged}/__verdict={name}", target):
            _write_days(_empty(spark, schema), base, source, run_date)      # clears stale rows, keeps the columns
        record_columns(spark, base, source, StructType([f for f in schema.fields if f.name != "dt"]))
        halves[name] = spark.read.schema(schema).parquet(target).select(*cols)
    _delete(spark, staged)

    good, bad = halves["promoted"], halves["quarantined"]
    if every:
        # per-day outcomes for every rule that has a per-key form; custom-SQL
        # rules are scalar over the whole input and have a folder of their own
        keyed = [r for r in rules if not (isinstance(r, DatasetRule) and not r.unique_column)]
        whole = [r for r in rules if r not in keyed]
        write_dq_results(summary_of_split(good, bad, keyed, extra, keys=["dt"]), root, source, ALL_DAYS)
        if whole:
            _write_outcomes(summary_of_split(good.drop("dt"), bad.drop("dt"), whole),
                            f"{root.rstrip('/')}/{WHOLE_RESULTS_DIR}/source={source}")
    else:
        write_dq_results(summary_of_split(good, bad, rules, extra), root, source, run_date)
    m = obs.get
    return {"source": source, "run_date": run_date, "promoted": int(m.get("promoted", 0)),
            "quarantined": int(m.get("quarantined", 0))}
