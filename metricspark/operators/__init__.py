from metricspark.operators.clustering import (
    ClusterModel,
    KSweep,
    PreparedPoints,
    assemble_features,
    cluster_profile,
    distance_to_center,
    fit_kmeans,
    prepare_points,
    scale_features,
    silhouette,
    sweep_k,
)
from metricspark.operators.quantiles import quantile_summary, series_quantiles
from metricspark.operators.ranking import ranked_extremes
from metricspark.operators.runlog import consolidate_runs, run_log, run_summary
from metricspark.operators.states import (
    distinct_sketches,
    merged_distinct,
    merged_states,
    merged_stats,
    period_states,
    quantile_sketches,
    sketch_quantiles,
)
from metricspark.operators.stats import diurnal_profile, distinct_points, period_stats, to_long

__all__ = [
    "ClusterModel",
    "KSweep",
    "PreparedPoints",
    "assemble_features",
    "cluster_profile",
    "consolidate_runs",
    "distance_to_center",
    "distinct_points",
    "distinct_sketches",
    "diurnal_profile",
    "fit_kmeans",
    "merged_distinct",
    "merged_states",
    "merged_stats",
    "period_states",
    "period_stats",
    "prepare_points",
    "quantile_sketches",
    "quantile_summary",
    "ranked_extremes",
    "run_log",
    "run_summary",
    "scale_features",
    "series_quantiles",
    "silhouette",
    "sketch_quantiles",
    "sweep_k",
    "to_long",
]
