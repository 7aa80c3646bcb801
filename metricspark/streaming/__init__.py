from metricspark.streaming.landing import land_csv

__all__ = ["land_csv"]
