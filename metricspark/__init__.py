"""Spark jobs over time-stamped metric series and per-entity metric points.

Every operator takes and returns Spark DataFrames. A *series* is a frame
``(zone, ts, <metrics...>)``; *points* are one row per entity with one or more
numeric features.
"""

from metricspark.spec import ELECTRICITY_HOURLY, ELECTRICITY_YEARLY, PointSpec, SeriesSpec

__all__ = ["SeriesSpec", "PointSpec", "ELECTRICITY_HOURLY", "ELECTRICITY_YEARLY"]
