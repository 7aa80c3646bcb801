from metricspark.functions.columns import interpolate, null_safe_join, quote, rounded
from metricspark.functions.parsing import parse_time, to_double
from metricspark.functions.temporal import PERIOD_PARTS, with_period

__all__ = [
    "PERIOD_PARTS",
    "interpolate",
    "null_safe_join",
    "parse_time",
    "quote",
    "rounded",
    "to_double",
    "with_period",
]
