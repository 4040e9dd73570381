"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: The white space of every word and line contract here: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Builder = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/corpus/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, retire: DataFrame | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the
    lineage, and a lost executor costs a re-read, not a recomputation. The copy ``retire``,
    which nothing may need any more, is deleted once the new one stands."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._copy = path
    if retire is not None and "_copy" in vars(retire):
        delete(spark, vars(retire)["_copy"])
    return out


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. All-ASCII strings take the JVM's fast path."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``
    (a lambda variable; a plain expression would be evaluated at each use)."""
    return F.transform(F.array(value), body)[0]


