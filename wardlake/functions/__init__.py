"""Column-level functions (no Python UDFs: every one is a built-in expression)."""

from .timefn import as_timestamp, epoch_seconds, hours_between, iso_timestamp
from .vitals import (
    DEFAULT_VITAL_LIMITS, alert_expiry, breach_flag, breach_reasons, decode_event,
)

__all__ = [
    "as_timestamp", "epoch_seconds", "hours_between", "iso_timestamp",
    "DEFAULT_VITAL_LIMITS", "alert_expiry", "breach_flag", "breach_reasons",
    "decode_event",
]
