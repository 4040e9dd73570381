"""Vital-sign thresholds shared by the batch alert fact and the stream alerts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values (must equal the reference's clinical thresholds):
# field -> (min, max); None means that end is open.
#   heart_rate     40   150
#   spo2           90   open
#   systolic_bp    70   180
#   temperature_c  35.0 40.0
DEFAULT_VITAL_LIMITS: dict[str, tuple[float | None, float | None]] = {
    "heart_rate": (40, 150),
    "spo2": (90, None),
    "systolic_bp": (70, 180),
    "temperature_c": (35.0, 40.0),
}

# Fixed value: active alerts expire 24 hours after they are raised.
ALERT_TTL_SECONDS = 24 * 60 * 60


def breach_flag(field: str, limits: tuple) -> Column:
    """Three-valued breach test: NULL reading -> NULL flag."""
    lo, hi = limits
    c = F.col(field)
    cond = None
    if lo is not None:
        cond = c < F.lit(lo)
    if hi is not None:
        above = c > F.lit(hi)
        cond = above if cond is None else (cond | above)
    return cond if cond is not None else F.lit(None).cast("boolean")


def _fmt_limit(v) -> str:
    return str(v)


def breach_reasons(limits: Mapping[str, tuple] = DEFAULT_VITAL_LIMITS) -> Column:
    """array<string> of "field below/above limit (was value)" in the order of
    ``limits``; NULL readings are skipped, so an empty array means no breach."""
    parts = []
    for field, (lo, hi) in limits.items():
        c = F.col(field)
        if lo is not None:
            parts.append(F.when(c < F.lit(lo), F.format_string(
                f"{field} below {_fmt_limit(lo)} (was %s)", c.cast("string"))))
        if hi is not None:
            parts.append(F.when(c > F.lit(hi), F.format_string(
                f"{field} above {_fmt_limit(hi)} (was %s)", c.cast("string"))))
    if not parts:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*parts))


def decode_event(payload, schema: StructType, corrupt_column: str | None = None) -> Column:
    """base64 text -> JSON -> struct with ``schema``. Malformed base64 gives a
    NULL struct and malformed JSON NULL fields (PERMISSIVE) instead of failing
    the whole micro-batch."""
    c = F.col(payload) if isinstance(payload, str) else payload
    opts = {"mode": "PERMISSIVE"}
    if corrupt_column:
        opts["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(F.try_to_binary(c, F.lit("base64")).cast("string"), schema, opts)


def alert_expiry(ttl_seconds: int = ALERT_TTL_SECONDS, now: Column | None = None) -> Column:
    """Epoch seconds at which an alert raised ``now`` stops being active."""
    base = now if now is not None else F.current_timestamp()
    return F.unix_timestamp(base) + F.lit(ttl_seconds)
