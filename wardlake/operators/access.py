"""Row- and column-level access as plain DataFrame transforms.

Row filters are broadcast left-semi *hash* joins on the facility key: the
"NULL mapping means unrestricted" rule is resolved on the tiny access map
(users x facilities) against the facility universe, never as an OR
condition on the big side (that would plan a nested-loop join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small


def pii_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("classification") == "pii"]


def mask_columns(df: DataFrame, role: str, grants: Mapping[str, Sequence[Mapping]],
                 table: str | None = None) -> DataFrame:
    """Project the columns ``role`` may read.

    ``grants[role]`` is a list of grants ``{"tables": [...] or "*",
    "exclude": [...] or "pii"}``. Grants add up: a column is visible when any
    grant applicable to the table exposes it, so a wider grant re-exposes
    columns another grant hides. No applicable grant -> PermissionError.
    """
    applicable = [g for g in grants.get(role, [])
                  if g.get("tables", "*") == "*" or table in g.get("tables", [])]
    if not applicable:
        raise PermissionError(f"role {role!r} has no grant on {table or 'this table'}")
    pii = set(pii_columns(df))
    visible = set()
    for g in applicable:
        excl = g.get("exclude", [])
        hidden = pii if excl == "pii" else set(excl)
        visible |= {c for c in df.columns if c not in hidden}
    return df.select(*[c for c in df.columns if c in visible])


def _allowed_keys(access: DataFrame, user: str, key: str, user_col: str,
                  universe: DataFrame | None, null_means_all: bool) -> DataFrame:
    mine = access.filter(F.col(user_col) == F.lit(user)).select(key)
    explicit = mine.filter(F.col(key).isNotNull())
    if not null_means_all:
        return explicit.distinct()
    if universe is None:
        raise ValueError("row_filter_viewer needs the facility universe to expand NULL mappings")
    # NULL mapping -> every facility of the universe. Expressed as an equi
    # semi-join on a match key ("*" stands for the NULL wildcard), so even on
    # the small tables no cross or nested-loop join is planned.
    wildcard = F.lit("*")
    want = mine.select(F.coalesce(F.col(key).cast("string"), wildcard).alias("__m"))
    offered = universe.select(key, F.explode(F.array(F.col(key).cast("string"), wildcard)).alias("__m"))
    expanded = offered.join(want, on="__m", how="left_semi").select(key)
    return explicit.unionByName(expanded).distinct()


def row_filter_strict(df: DataFrame, access: DataFrame, user, key: str = "facility_id",
                      bypass: bool = False, user_col: str = "user_name", viewer_col: str = "db_user") -> DataFrame:
    """Rows whose facility is mapped to ``user``; NULL mapping or unmapped user
    sees nothing; ``bypass`` (the exempt reader role) sees everything.
    A list of users returns every user's rows in one pass, tagged with
    ``viewer_col``."""
    if bypass:
        return df
    if isinstance(user, str):
        allowed = _allowed_keys(access, user, key, user_col, None, False)
        return df.join(broadcast_if_small(allowed), on=key, how="left_semi")
    pairs = (access.filter(F.col(user_col).isin(list(user)) & F.col(key).isNotNull())
             .select(F.col(user_col).alias(viewer_col), key).distinct())
    return df.join(broadcast_if_small(pairs), on=key, how="inner")


def row_filter_viewer(df: DataFrame, access: DataFrame, user, universe: DataFrame,
                      key: str = "facility_id", user_col: str = "user_name",
                      viewer_col: str = "viewer") -> DataFrame:
    """BI policy: mapped facilities, a NULL mapping means unrestricted, an
    unmapped viewer sees nothing. Viewer mapped twice -> union, no duplicates
    (semi-join never multiplies rows).

    ``user`` may be a list: then every viewer's rows come out in one pass,
    tagged with ``viewer_col`` (one broadcast equi-join against the small
    viewer x facility table instead of one query per viewer)."""
    if isinstance(user, str):
        allowed = _allowed_keys(access, user, key, user_col, universe, True)
        return df.join(broadcast_if_small(allowed), on=key, how="left_semi")
    return df.join(broadcast_if_small(_viewer_pairs(access, user, universe, key, user_col, viewer_col)), on=key, how="inner")


def _viewer_pairs(access: DataFrame, users: Sequence[str], universe: DataFrame, key: str, user_col: str,
                  viewer_col: str) -> DataFrame:
    """(viewer, facility) pairs of the BI policy."""
    mine = access.filter(F.col(user_col).isin(list(users))).select(F.col(user_col).alias(viewer_col), key)
    explicit = mine.filter(F.col(key).isNotNull())
    wildcard = F.lit("*")
    want = mine.select(viewer_col, F.coalesce(F.col(key).cast("string"), wildcard).alias("__m"))
    offered = universe.select(key, F.explode(F.array(F.col(key).cast("string"), wildcard)).alias("__m"))
    expanded = offered.join(want, on="__m", how="inner").select(viewer_col, key)
    return explicit.unionByName(expanded).distinct()


def viewer_counts(df: DataFrame, access: DataFrame, users: Sequence[str], universe: DataFrame | None = None,
                  key: str = "facility_id", user_col: str = "user_name", viewer_col: str = "viewer") -> DataFrame:
    """Rows each viewer sees per facility (``rows_seen``): the rows are counted per facility first, so
    only one row per facility meets the viewers. With ``universe`` the BI policy, without it the strict
    one (a NULL mapping shows nothing)."""
    if universe is not None:
        pairs = _viewer_pairs(access, users, universe, key, user_col, viewer_col)
    else:
        pairs = (access.filter(F.col(user_col).isin(list(users)) & F.col(key).isNotNull())
                 .select(F.col(user_col).alias(viewer_col), key).distinct())
    per_facility = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_seen"))
    return per_facility.join(broadcast_if_small(pairs), on=key, how="inner").select(viewer_col, key, "rows_seen")


def filter_facilities(datasets: Mapping[str, DataFrame], selected: Sequence[str] | None,
                      col: str = "facility_name") -> dict[str, DataFrame]:
    """One facility selection applied to every dataset of a sheet; nothing
    selected keeps all rows."""
    if not selected:
        return dict(datasets)
    return {name: df.filter(F.col(col).isin(list(selected))) for name, df in datasets.items()}
