"""Reading text as times and numbers, leniently or strictly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricspark.spec import FAILFAST, PERMISSIVE


def _strict(parsed: Column, raw: Column, what: str) -> Column:
    message = F.concat(F.lit(f"not a {what}: "), raw.cast("string"))
    return F.when(raw.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def parse_time(raw: Column, fmt: str | None = None, mode: str = PERMISSIVE) -> Column:
    """Text to timestamp in the session time zone; a timestamp passes through.

    The lenient form does not depend on ANSI mode: unreadable text is null.
    """
    if fmt is None:
        return raw
    parsed = F.try_to_timestamp(raw.cast("string"), F.lit(fmt))
    return _strict(parsed, raw, "time") if mode == FAILFAST else parsed


def to_double(raw: Column, mode: str = PERMISSIVE) -> Column:
    parsed = raw.try_cast("double")
    return _strict(parsed, raw, "number") if mode == FAILFAST else parsed
