"""Joins used by the datasets: dimension lookup, pre-aggregated left join and
access semi-join. Dimension sides are broadcast only behind a size
check; above the bound Spark's own size estimate and AQE pick the join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A facility/department/payer dimension or an access map is a few KB; anything
# whose estimated size is above this bound is joined without a hint.
BROADCAST_MAX_BYTES = 64 << 20
# A side without an estimate (made from driver rows) is small if it has no more rows than this.
UNSIZED_MAX_ROWS = 10_000


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when the optimizer's size estimate is at most ``max_bytes``.

    The estimate comes from the plan's statistics (file sizes below filters),
    an upper bound for the lookups, projections and filters used here; no job
    runs. A side made from driver rows has no estimate: up to
    ``UNSIZED_MAX_ROWS`` + 1 empty rows of it are fetched to tell. Above the bound the side is returned unhinted: Spark then plans a
    shuffle join, or AQE converts it at runtime from real shuffle sizes.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        small = len(df.select(F.lit(1)).take(UNSIZED_MAX_ROWS + 1)) <= UNSIZED_MAX_ROWS
    else:
        small = size <= max_bytes
    return F.broadcast(df) if small else df


def join_facility_name(df: DataFrame, dim: DataFrame, key: str = "facility_id",
                       name: str = "facility_name") -> DataFrame:
    """Inner equi-join to the facility dimension (unknown ids are dropped)."""
    return df.join(broadcast_if_small(dim.select(key, name)), on=key, how="inner")


def join_staffing_beds(shifts: DataFrame, beds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on several keys; rows without a match keep NULL bed columns.

    Both sides are expected to be pre-aggregated to one row per key, so no key
    can be hot on either side and the join output never exceeds the left side.
    """
    return shifts.join(beds, on=list(keys), how="left")


def semi_join_access(df: DataFrame, access: DataFrame, user: str, key: str = "facility_id",
                     user_col: str = "user_name") -> DataFrame:
    """``key IN (SELECT key FROM access WHERE user = :user)`` as a broadcast
    left-semi hash join (NULL mappings never match)."""
    allowed = (access.filter(F.col(user_col) == F.lit(user))
               .filter(F.col(key).isNotNull()).select(key).distinct())
    return df.join(broadcast_if_small(allowed), on=key, how="left_semi")
