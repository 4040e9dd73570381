"""Folders whose readers never meet a half-written state.

A writer fills a folder of its own and then adds one commit record, a one-row JSON file that
appears in one step. Readers only open what a record names. A write that fails leaves a folder
that no record names; the content before it stays as it was.

* Versions: ``publish`` replaces the content of ``root``; the newest record is the content.
* Batches: ``commit_batch`` adds one record per micro-batch over all its outputs;
  ``read_committed`` reads one output of the committed batches.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMMITS_DIR = "_commits"
_VERSION_DDL = "version long, name string, at timestamp, info map<string,string>"
_BATCH_DDL = "at timestamp, info map<string,string>, query string, batch long"


def _records(spark: SparkSession, root: str, ddl: str, depth: str) -> DataFrame:
    base = f"{root.rstrip('/')}/{COMMITS_DIR}"
    if not _exists(spark, base if "*" in depth else f"{base}/{depth}"):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", base).json(f"{base}/{depth}")


def _record(spark: SparkSession, path: str, row: dict) -> None:
    """A one-row JSON file in the folder ``path``, written under a hidden name and renamed: it appears whole."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    hidden, name = paths(f"{path}/_record-{uuid.uuid4().hex}"), paths(f"{path}/record.json")
    fs = name.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(json.dumps({"at": _dt.datetime.now(_dt.timezone.utc).isoformat(), **row}) + "\n", "utf-8"))
    finally:
        out.close()
    fs.delete(name, False)
    if not fs.rename(hidden, name):
        raise OSError(f"{path}/record.json could not be written")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# ------------------------------------------------------------------- versions

def versions(spark: SparkSession, root: str) -> list[Row]:
    """The committed versions of ``root``, newest first (as many as are kept)."""
    return sorted(_records(spark, root, _VERSION_DDL, "*").collect(), key=lambda r: (r.version, r.at), reverse=True)


def publish(spark: SparkSession, root: str, fill: Callable[[str], None], info: Mapping[str, str] | None = None,
            keep: int = 2) -> str:
    """Replace the content of ``root``: ``fill(folder)`` writes a new folder, then one record makes
    it the content. The newest ``keep`` versions stay, so readers underway finish on theirs; older
    ones are deleted. Two writers at once: the record added last is the content. Returns the folder."""
    if keep < 1:
        raise ValueError("at least the new version is kept")
    root = root.rstrip("/")
    before = versions(spark, root)
    version = before[0].version + 1 if before else 1
    name = f"v{version:08d}-{uuid.uuid4().hex[:12]}"
    fill(f"{root}/{name}")
    _record(spark, f"{root}/{COMMITS_DIR}/{name}", {"version": version, "name": name, "info": dict(info or {})})
    for old in before[keep - 1:]:
        _delete(spark, f"{root}/{COMMITS_DIR}/{old.name}")
        _delete(spark, f"{root}/{old.name}")
    return f"{root}/{name}"


def current_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the content of ``root``; None before the first version."""
    done = versions(spark, root)
    return f"{root.rstrip('/')}/{done[0].name}" if done else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    path = current_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    return spark.read.parquet(path)


# -------------------------------------------------------------------- batches

def batch_path(root: str, output: str, query: str, batch: int) -> str:
    """Folder of one output of a micro-batch; the output "" lies in ``root`` itself."""
    base = f"{root.rstrip('/')}/{output}".rstrip("/")
    return f"{base}/query={query}/batch={batch}"


def is_committed(spark: SparkSession, root: str, query: str, batch: int) -> bool:
    return bool(_records(spark, root, "at timestamp", f"query={query}/batch={batch}").take(1))


def commit_batch(spark: SparkSession, root: str, query: str, batch: int, info: Mapping[str, str] | None = None) -> None:
    """Make all outputs of a micro-batch visible at once."""
    _record(spark, f"{root.rstrip('/')}/{COMMITS_DIR}/query={query}/batch={batch}", {"info": dict(info or {})})


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """(query, batch, at, info) of the committed micro-batches."""
    return _records(spark, root, _BATCH_DDL, "*/*").select("query", "batch", "at", "info")


def read_committed(spark: SparkSession, root: str, output: str = "", schema: str | None = None) -> DataFrame | None:
    """Rows of one output of all committed batches; None if there is none. Folders of other
    batches are pruned by the join with the records."""
    base = f"{root.rstrip('/')}/{output}".rstrip("/")
    done = committed_batches(spark, root).select("query", "batch")
    if done.isEmpty():
        return None
    reader = spark.read.option("basePath", base)
    rows = (reader.schema(schema) if schema else reader).parquet(f"{base}/query=*")
    return (rows.join(done.withColumnsRenamed({"query": "__q", "batch": "__b"}),
                      (F.col("query") == F.col("__q")) & (F.col("batch").cast("long") == F.col("__b")), "left_semi")
            .drop("query", "batch"))
