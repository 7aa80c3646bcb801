"""The shape of the plans: what they read, exchange and push down."""

import pytest
from pyspark.sql import functions as F

from metricspark import catalog
from metricspark.operators import period_stats, ranked_extremes
from metricspark.sources import read_series

LINES = catalog.LINE_SERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    text = _plan(df)
    return text[: text.index("== Initial Plan ==")]


@pytest.mark.parametrize("name", ["period_stats_month_df", "period_stats_month_sql"])
def test_one_scan_and_one_exchange(spark, sf_dir, name):
    plan = _plan(catalog.QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan
    assert "l_orderkey" not in plan


def test_zones_from_several_datasets_share_one_aggregate(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    series = read_series(spark, {"A": path, "B": path, "C": path}, LINES)
    plan = _plan(period_stats(series, ["year"]))
    assert plan.count("FileScan") == 3
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["diurnal_quantiles_df", "diurnal_quantiles_sql"])
def test_profiles_are_reshaped_after_the_aggregate(spark, sf_dir, name):
    plan = _plan(catalog.QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    # Read from the top: the reshaping is above both steps of the hourly mean.
    assert plan.index("Expand" if "Expand" in plan else "Generate") < plan.index("partial_avg")


def test_global_lists_reuse_one_aggregate(spark, sf_dir):
    plan = _final_plan(catalog.QUERIES["ranked_extremes_sql"](spark, sf_dir))
    assert plan.count("TakeOrderedAndProject") == 4
    assert plan.count("ReusedExchange") == 3


@pytest.mark.parametrize("name", ["ranked_extremes_df", "ranked_extremes_by_zone"])
def test_all_lists_are_ranked_in_one_window(spark, sf_dir, name):
    """One aggregate, one window for all lists, and its limit below its exchange."""
    plan = _plan(catalog.QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    limits = [i for i in range(len(plan)) if plan.startswith("WindowGroupLimit", i)]
    assert len(limits) == 2 and "Partial" in plan[limits[1] :].split("\n")[0]
    assert plan.index("Exchange hashpartitioning") < limits[1]


def test_filters_reach_the_scan(spark, sf_dir):
    series = read_series(spark, f"{sf_dir}/lineitem.parquet", LINES, zones=["A"], start="1996-01-01", end="1997-01-01")
    plan = _plan(period_stats(series, ["year"]))
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(l_returnflag,A)" in pushed
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


QUICK = [n for n in catalog.QUERIES if n not in ("cluster_sweep", "cluster_centers", "cluster_assign", "cluster_nations")]


@pytest.mark.parametrize("name", QUICK)
def test_no_python_and_no_cross_join_in_the_plan(spark, sf_dir, name):
    plan = _plan(catalog.QUERIES[name](spark, sf_dir))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


def test_distinct_points_reads_one_column(spark, sf_dir):
    plan = _plan(catalog.QUERIES["distinct_points"](spark, sf_dir))
    assert "ReadSchema: struct<c_acctbal:double>" in plan


def test_ranking_a_skewed_group_ships_few_rows(spark):
    """All rows in one zone: each task sends on at most k of them per list."""
    limit = "WindowGroupLimit"
    for zone in (F.when(F.col("id") >= 0, "Z"), F.lit("Z")):
        months = spark.range(0, 20_000, 1, 8).select(
            zone.alias("zone"), F.col("id").cast("int").alias("year"), F.lit(1).alias("month"), F.rand(1).alias("m")
        )
        top = ranked_extremes(months, ["m"], by=["zone"])
        assert top.count() == 10
        plan = _plan(top)
        assert limit in plan
        assert plan.rindex(limit) < plan.rindex("Range")


@pytest.mark.parametrize("name", ["run_summary", "period_stats_year_df", "diurnal_profile_df", "cluster_profile"])
def test_aggregates_go_by_hash(spark, sf_dir, name):
    assert "SortAggregate" not in _plan(catalog.QUERIES[name](spark, sf_dir))
