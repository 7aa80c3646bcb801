"""The four reports on electricity data, as particular calls of the operators.

Each takes a frame as the readers give it and returns the report under its
published column names. The sort columns for writing are in ``REPORT_ORDER``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.functions.columns import col
from metricspark.operators.clustering import MAX_K, SEED, prepare_points, sweep_k
from metricspark.operators.quantiles import quantile_summary
from metricspark.operators.ranking import ranked_extremes
from metricspark.operators.stats import diurnal_profile, metrics_of, period_stats, to_long

# Names and order of the published report columns.
YEARLY_COLUMNS = [
    "year", "country", "carbon-avg", "carbon-min", "carbon-max", "cfe-avg", "cfe-min", "cfe-max",
]
MONTHLY_COLUMNS = ["year", "month", "carbon-avg", "cfe-avg", "label"]
MONTHLY_LABELS = ["highest_carbon", "lowest_carbon", "highest_cfe", "lowest_cfe"]
DIURNAL_COLUMNS = ["country", "metric", "min", "25-perc", "50-perc", "75-perc", "max"]
DIURNAL_METRICS = {"carbon": "carbon_intensity", "cfe": "cfe_percentage"}
CLUSTER_COLUMNS = ["country", "carbon-intensity", "cluster_id", "cluster_center", "distance_from_center"]
QUANTILE_NAMES = {"p25": "25-perc", "p50": "50-perc", "p75": "75-perc"}

REPORT_ORDER = {
    "yearly": ["country", "year"],
    "monthly": ["label_order", "rank"],
    "diurnal": ["country", "metric"],
    "clusters": ["cluster_id", "country"],
}
REPORT_COLUMNS = {
    "yearly": YEARLY_COLUMNS,
    "monthly": MONTHLY_COLUMNS,
    "diurnal": DIURNAL_COLUMNS,
    "clusters": CLUSTER_COLUMNS,
}


def as_yearly(stats: DataFrame) -> DataFrame:
    return stats.withColumnRenamed("zone", "country").select(*(col(c) for c in YEARLY_COLUMNS))


def as_monthly(ranked: DataFrame) -> DataFrame:
    order = F.array_position(F.array(*(F.lit(name) for name in MONTHLY_LABELS)), F.col("label"))
    return ranked.withColumn("label_order", order)


def as_diurnal(summary: DataFrame) -> DataFrame:
    published = F.create_map(*(F.lit(v) for pair in DIURNAL_METRICS.items() for v in pair))
    return (
        summary.withColumn("metric", F.coalesce(published[F.col("metric")], F.col("metric")))
        .withColumnsRenamed({"zone": "country", **QUANTILE_NAMES})
        .select(*(col(c) for c in DIURNAL_COLUMNS))
    )


def yearly_report(series: DataFrame) -> DataFrame:
    """Mean, min and max of both metrics per zone and year."""
    return as_yearly(period_stats(series, ["year"], name="{metric}-{stat}"))


def monthly_extremes_report(series: DataFrame, *, k: int = 5) -> DataFrame:
    """The months of one zone with the highest and lowest mean of each metric."""
    means = period_stats(series, ["year", "month"], stats=["avg"], by=[], name="{metric}-avg")
    metrics = metrics_of(series)
    ranked = ranked_extremes(
        means, [f"{m}-avg" for m in metrics], k=k, labels={f"{m}-avg": m for m in metrics}
    )
    return as_monthly(ranked)


def diurnal_report(series: DataFrame) -> DataFrame:
    """Spread of the hour-of-day means per zone and metric."""
    long = to_long(diurnal_profile(series), ["zone"], metrics_of(series))
    return as_diurnal(quantile_summary(long, ["zone", "metric"]))


def cluster_report(
    points: DataFrame,
    *,
    key: str = "country",
    feature: str = "carbon-intensity",
    max_k: int = MAX_K,
    seed: int = SEED,
    order: str = "input",
) -> DataFrame:
    """Each entity with its cluster, the cluster's center and its distance to it."""
    with prepare_points(points, [feature], order=order) as prepared:
        model = sweep_k(prepared, max_k=max_k, seed=seed).model
    return (
        model.assign(points.select(col(key), col(feature)))
        .withColumnRenamed(f"center_{feature}", "cluster_center")
        .select(col(key), col(feature), "cluster_id", "cluster_center", "distance_from_center")
    )
