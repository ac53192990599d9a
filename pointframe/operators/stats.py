"""Request-log statistics (A6, and the batch twin of T3).

The reference exposes per-endpoint timing (count, avg, min, max). Here that is a
grouped aggregate over any request-log table, plus time-windowed forms
(tumbling, sliding, session) that the streaming operator reuses unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointframe.functions.distance import SCORE_DIGITS


def _aggs(duration: str):
    return [F.count(F.lit(1)).alias("count"),
            F.round(F.avg(duration), SCORE_DIGITS).alias("avg"),
            F.min(duration).alias("min"),
            F.max(duration).alias("max")]


def response_stats(log: DataFrame, endpoint: str, duration: str) -> DataFrame:
    """``endpoint, count, avg, min, max`` per endpoint (partial + final aggregation)."""
    return log.groupBy(F.col(endpoint).alias("endpoint")).agg(*_aggs(duration))


def response_stats_windowed(log: DataFrame, ts: str, endpoint: str, duration: str,
                            window: str = "1 hour", slide: str | None = None,
                            session_gap: str | None = None, key: str | None = None) -> DataFrame:
    """Per time window (tumbling, or sliding with ``slide``; or session windows of
    ``session_gap`` per ``key``): ``window_start, window_end, endpoint|key, count, avg, min, max``."""
    if session_gap is not None:
        k = key or endpoint
        w = F.session_window(F.col(ts), session_gap)
        g = log.groupBy(w.alias("w"), F.col(k).alias("key"))
    else:
        w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
        g = log.groupBy(w.alias("w"), F.col(endpoint).alias("endpoint"))
    out = g.agg(*_aggs(duration))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[c for c in out.columns if c != "w"])
