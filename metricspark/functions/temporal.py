"""Calendar parts of a series' time column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIOD_PARTS = {"year": F.year, "month": F.month, "hour": F.hour}


def with_period(
    df: DataFrame, *parts: str, time_col: str = "ts", drop_invalid: bool = False
) -> DataFrame:
    """Add the calendar ``parts`` of ``time_col`` as integer columns.

    Rows whose time could not be read have null parts. They are kept, and so make
    up a group of their own downstream, unless ``drop_invalid``.
    """
    unknown = [p for p in parts if p not in PERIOD_PARTS]
    if unknown:
        raise ValueError(f"unknown period parts {unknown}; have {sorted(PERIOD_PARTS)}")
    if drop_invalid:
        df = df.where(F.col(time_col).isNotNull())
    return df.withColumns({p: PERIOD_PARTS[p](F.col(time_col)) for p in parts})
