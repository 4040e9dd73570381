"""Time columns: ISO text or typed timestamps, always via try_* (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(c) -> Column:
    """ISO-8601 text (offset allowed, e.g. ``+00:00``) -> TIMESTAMP; NULL on bad text."""
    return _col(c).try_cast("timestamp")


def as_timestamp(c, dtype: DataType | None = None) -> Column:
    """Text goes through :func:`iso_timestamp`; typed values are used as they are
    (TIMESTAMP and TIMESTAMP_NTZ both keep their wall clock in a UTC session)."""
    if dtype is None or isinstance(dtype, StringType):
        return iso_timestamp(c)
    return _col(c)


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (sub-seconds truncated, as the reference)."""
    return F.unix_timestamp(_col(c))


def hours_between(start, end) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600.0)
