"""Previous-row lookups per entity (LAG) that survive a hot entity.

A plain ``lag().over(Window.partitionBy(entity))`` sends every row of one
entity to one task; if one patient holds a third of all visits that task
holds a third of the data. By default (``chunk="auto"``) ``lag_by_entity``
cuts such entities, and only those, into chunks:

* heavy entities: one global aggregate with a bounded sketch
  (``approx_top_k``) names those with more than 1 / (2 x shuffle partitions)
  of all rows; there cannot be more than twice as many as partitions;
* their rows are dealt by sampled ranges of (entity, ordering key) and
  written with their range number, the chunk; all other rows have chunk 0;
* one window per (entity, chunk): one shuffle for all rows;
* the first row of a chunk takes the last value of the entity's previous
  chunk, from a table of one row per chunk of a heavy entity, which is
  broadcast (its size is bounded by the ranges).

Without a heavy entity this is the plain window. A table loaded with this
layout (``with_chunks``, then bucketed by entity and chunk) carries the chunk
column and is windowed without any shuffle.

``chunk="day"`` / ``"hour"`` / a Column cut every entity by time and stitch
with a join on never-NULL (entity, chunk) keys; ``"range"`` cuts everything by
sampled ranges; ``None`` is the plain window.

The result is identical to the plain window for every input whose ordering
columns tell the rows of an entity apart (the tests check it against brute
force), including NULL previous values (open stays) and NULL entities and
times. Rows equal in entity and all ordering columns have no order: each
strategy picks one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def _time_chunk(order_col: str, grain: str) -> Column:
    """Monotone, never-NULL chunk of the first ordering column: "day" or
    "hour". A NULL time (sorted first) joins the earliest chunk, which keeps
    chunks contiguous in the ordering."""
    c = F.col(order_col)
    if grain == "day":
        return F.coalesce(F.to_date(c), F.lit("0001-01-01").cast("date"))
    if grain == "hour":
        return F.coalesce(F.date_format(c, "yyyy-MM-dd HH"), F.lit(""))
    raise ValueError("chunk must be 'auto', 'day', 'hour', 'range', a Column or None")


def _non_null_key(df: DataFrame, col: str) -> tuple[Column, Column]:
    """(value with NULL replaced, is-NULL flag): equal for equal values and for
    two NULLs, so plain equi-joins and hash partitioning treat NULL as one
    group, as a window's PARTITION BY does."""
    dt = df.schema[col].dataType
    if isinstance(dt, NumericType):
        filler = F.lit(0).cast(dt)
    elif isinstance(dt, StringType):
        filler = F.lit("")
    else:
        return F.coalesce(F.col(col).cast("string"), F.lit("")), F.col(col).isNull()
    return F.coalesce(F.col(col), filler), F.col(col).isNull()


#: Chunk of a row within its entity: 0 for all rows of an entity that is not cut.
CHUNK = "layout_chunk"
#: No more entities than this are ever cut (bounds the sketch and the broadcast).
MAX_HEAVY = 10_000


def heavy_entities(df: DataFrame, entity: str) -> list[int]:
    """Hashes of the entities (NULL is one) that hold more than a k-th of the rows; k is twice
    the shuffle partitions, ``MAX_HEAVY`` at most, so there are fewer than k of them."""
    k = min(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_HEAVY)
    hashed = df.select(F.xxhash64(entity).alias("h"))
    top, n = hashed.agg(F.expr(f"approx_top_k(h, {k}, {min(64 * k, 1_000_000)})"), F.count(F.lit(1))).first()
    return [t["item"] for t in top or [] if t["count"] * k > n]


def with_chunks(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """``df`` with the column ``CHUNK``: 0, but for rows of heavy entities, which are written once
    to the shared folder, the number of a sampled range of (entity, *order), from 1 and monotone
    in the order. Rows equal in all those columns share a chunk."""
    heavy = heavy_entities(df, entity)
    return _cut(df, entity, order, heavy) if heavy else df.withColumn(CHUNK, F.lit(0))


def _cut(df: DataFrame, entity: str, order: Sequence[str], heavy: list[int]) -> DataFrame:
    from ..session import scratch_path
    light = df.withColumn(CHUNK, F.lit(0))
    is_heavy = F.xxhash64(entity).isin(heavy)
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = (df.where(is_heavy).repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in [entity, *order]])
           .withColumn(CHUNK, F.spark_partition_id() + 1))
    path = scratch_path(spark, "heavy-entities")
    cut.write.parquet(path)
    return light.where(~is_heavy).unionByName(spark.read.schema(cut.schema).parquet(path))


def lag_in_chunks(df: DataFrame, entity: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """LAG over rows that carry ``CHUNK``: a window per (entity, chunk), and the last value of the
    chunk before for the first row of a chunk."""
    w = Window.partitionBy(entity, CHUNK).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = df.withColumns({out: F.lag(value).over(w), "__rn": F.row_number().over(w)})
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    tails = df.where(F.col(CHUNK) > 0).groupBy(entity, CHUNK).agg(last.alias("t"))
    of_entity = Window.partitionBy(entity).orderBy(CHUNK)
    before = tails.select(F.col(entity).alias("__entity"), F.col(CHUNK).alias("__chunk"),
                          F.lag("t").over(of_entity).alias("__before"))
    # one row per chunk of a heavy entity: bounded by MAX_HEAVY and the ranges
    joined = local.join(F.broadcast(before), F.col(entity).eqNullSafe(F.col("__entity")) & (F.col(CHUNK) == F.col("__chunk")), "left")
    fixed = F.when((F.col("__rn") == 1) & (F.col(CHUNK) > 0), F.col("__before.v")).otherwise(F.col(out))
    return joined.withColumn(out, fixed).drop("__rn", "__entity", "__chunk", "__before")


def lag_by_entity(df: DataFrame, entity: str, order: Sequence[str], value: str, out: str,
                  chunk: Column | None | str = "auto", range_partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = ``value`` of the previous row of the same ``entity`` in
    ``order`` (ascending, NULLs first, as Spark's window does).

    ``chunk``: "auto" (default) cuts the heavy entities only (a job names
    them); if ``df`` carries the column ``CHUNK``, from a loaded table, that is
    used as it is. "day" or "hour" chunks every entity by that bucket of
    ``order[0]`` (finer chunks spread a hot entity over more tasks, at the
    price of more chunk tails); a Column must be monotone in ``order`` and
    never NULL;
    ``None`` uses the single plain window; "range" splits by sampled ranges
    of the whole ordering key (see :func:`_lag_by_range`), which bounds every
    task even when one entity-day or one timestamp holds a third of all rows;
    ``range_partitions`` sets its partition count (default: input bytes / 256 MB).
    """
    order = list(order)
    if isinstance(chunk, str) and chunk == "auto":
        if CHUNK in df.columns:
            return lag_in_chunks(df, entity, order, value, out)
        heavy = heavy_entities(df, entity)
        if heavy:
            return lag_in_chunks(_cut(df, entity, order, heavy), entity, order, value, out).drop(CHUNK)
        chunk = None
    if isinstance(chunk, str) and chunk == "range":
        return _lag_by_range(df, entity, order, value, out, range_partitions)
    if chunk is None:
        w = Window.partitionBy(entity).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return df.withColumn(out, F.lag(value).over(w))

    chunk_col = _time_chunk(order[0], chunk) if isinstance(chunk, str) else chunk
    ck, rn = "__chunk", "__rn"
    ek, en = _non_null_key(df, entity)
    base = df.withColumns({"__ek": ek, "__en": en, ck: chunk_col})
    keys = ["__ek", "__en", ck]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    # lag and row_number share one window spec: one shuffle, one sort.
    local = base.withColumns({out: F.lag(value).over(w), rn: F.row_number().over(w)})

    # The last row of every (entity, chunk), by an aggregate that is combined
    # before its shuffle and needs no sort of the rows (a struct orders NULL
    # first, as the window does). An entity has at most one tail per chunk, so
    # the tail window per entity stays small even for a hot entity.
    tails = base.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__t")).select(
        *keys, F.col("__t.v").alias("__v"))
    tw = Window.partitionBy("__ek", "__en").orderBy(F.col(ck).asc())
    prev = tails.select(*keys, F.lag("__v").over(tw).alias("__prev_v"),
                        F.lag(F.lit(True)).over(tw).isNotNull().alias("__has_prev"))

    # Equi-join on the never-NULL (entity, chunk) keys: the big side is
    # already hash partitioned and sorted on them by the window, so only the
    # tails shuffle.
    stitched = local.join(prev, on=keys, how="left")
    fixed = F.when(F.col(rn) == 1, F.when(F.col("__has_prev"), F.col("__prev_v"))).otherwise(F.col(out))
    return stitched.withColumn(out, fixed).drop(*keys, rn, "__prev_v", "__has_prev")


def readmission_flag(df: DataFrame, entity: str = "patient_id", start: str = "admission_time",
                     end: str = "discharge_time", days: int = 30, tie: str | None = "visit_id",
                     out: str = "readmission_flag", prior: str = "prior_discharge_time",
                     chunk: Column | None | str = "auto", keep_prior: bool = False,
                     range_partitions: int | None = None) -> DataFrame:
    """1 when this stay starts no later than ``days`` after the *immediately*
    previous stay of the same entity ended; 0 otherwise (first stay, or the
    previous stay is still open). Overlapping stays count (no lower bound).
    ``tie`` makes the order deterministic for equal start times."""
    order = [start] + ([tie] if tie else [])
    with_prior = lag_by_entity(df, entity, order, end, prior, chunk=chunk, range_partitions=range_partitions)
    flag = F.when(F.col(prior).isNotNull()
                  & (F.col(start) <= F.col(prior) + F.expr(f"INTERVAL {int(days)} DAYS")), 1).otherwise(0)
    res = with_prior.withColumn(out, flag)
    return res if keep_prior else res.drop(prior)


# ------------------------------------------------------ range-split strategy

RANGE_BYTES = 256 << 20


def _lag_by_range(df: DataFrame, entity: str, order: list[str], value: str, out: str,
                  partitions: int | None = None) -> DataFrame:
    """LAG over sampled ranges of (entity, *order).

    ``repartitionByRange`` samples the composite key, so ranges hold about
    equal row counts whatever the key distribution (a hot entity or
    entity-day is cut between ranges; only rows equal in the whole key stay
    together). The rows are written to the shared folder with their range
    number, which fixes the ranges, and are then stitched like any other
    chunk: the range number is monotone in the ordering of an entity. Without
    ``partitions`` their count follows the estimated input bytes, about
    ``RANGE_BYTES`` each.
    """
    from ..session import scratch_path
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:     # no estimate: the session's own partition count
        size = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGE_BYTES
    n = partitions or max(spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    path = scratch_path(spark, "lag-ranges")
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in [entity, *order]]).withColumn(
        "__range", F.spark_partition_id())
    ranged.write.parquet(path)
    fixed = spark.read.schema(ranged.schema).parquet(path)
    return lag_by_entity(fixed, entity, order, value, out, chunk=F.col("__range")).drop("__range")
