"""Monitoring metrics as queries: quarantine volume and stream lag alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def _ts(df: DataFrame, name: str) -> Column:
    """The column itself when it already is a TIMESTAMP (keeps a streaming
    watermark attached to it), else a cast."""
    c = F.col(name)
    return c if isinstance(df.schema[name].dataType, TimestampType) else c.cast("timestamp")


def quarantine_metric(run_log: DataFrame, time_col: str = "run_ts", value: str = "quarantined",
                      window: str = "1 hour", threshold: int = 0) -> DataFrame:
    """Quarantined rows summed over all sources per time window; ``alarm``
    when the sum exceeds ``threshold``."""
    g = run_log.groupBy(F.window(time_col, window).alias("w")).agg(
        F.sum(value).cast("bigint").alias("quarantined_rows"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "quarantined_rows",
                    (F.col("quarantined_rows") > threshold).alias("alarm"))


def stream_lag(df: DataFrame, arrival: str, event_time: str, window: str = "5 minutes",
               threshold_ms: int = 300_000) -> DataFrame:
    """Max consumer delay (arrival - event time, ms) per arrival window;
    ``alarm`` above ``threshold_ms``."""
    lag_ms = F.floor((F.unix_micros(_ts(df, arrival)) - F.unix_micros(_ts(df, event_time))) / 1000).cast("bigint")
    g = df.groupBy(F.window(_ts(df, arrival), window).alias("w")).agg(
        F.max(lag_ms).alias("max_lag_ms"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "max_lag_ms",
                    (F.col("max_lag_ms") > threshold_ms).alias("alarm"))
