from metricspark.plans.reports import (
    cluster_report,
    diurnal_report,
    monthly_extremes_report,
    yearly_report,
)
from metricspark.plans.sql import (
    diurnal_profile_sql,
    diurnal_quantiles_sql,
    period_stats_sql,
    ranked_extremes_sql,
)

__all__ = [
    "cluster_report",
    "diurnal_profile_sql",
    "diurnal_quantiles_sql",
    "diurnal_report",
    "monthly_extremes_report",
    "period_stats_sql",
    "ranked_extremes_sql",
    "yearly_report",
]
