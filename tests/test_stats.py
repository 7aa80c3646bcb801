import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from metricspark import SeriesSpec
from metricspark.operators import (
    distinct_sketches,
    merged_distinct,
    merged_stats,
    period_states,
    quantile_sketches,
    sketch_quantiles,
    distinct_points,
    diurnal_profile,
    period_stats,
    quantile_summary,
    ranked_extremes,
    series_quantiles,
    to_long,
)
from metricspark.plans import (
    diurnal_profile_sql,
    diurnal_quantiles_sql,
    period_stats_sql,
    ranked_extremes_sql,
)
from metricspark.plans.sql import Rows
from metricspark.sources import series_of, union_zones

from frame_rows import rows

SPEC = SeriesSpec(time_col="time", metrics={"c": "c", "f": "f"}, time_format="yyyy-MM-dd HH:mm:ss")


@pytest.fixture(scope="module")
def series(readings):
    return series_of(readings, SPEC, "Z")


def test_by_year(series):
    found = period_stats(series, ["year"])
    assert rows(found.drop("zone")) == [
        (None, 999.0, 999.0, 999.0, 1.0, 1.0, 1.0),
        (2021, 150.0, 100.0, 200.0, 50.0, 40.0, 60.0),
        (2022, 300.0, 300.0, 300.0, 30.0, 30.0, 30.0),
    ]
    assert period_stats(series, ["year"], drop_invalid=True).count() == 2


def test_by_month(series):
    found = period_stats(series, ["year", "month"], stats=["avg"])
    assert rows(found.drop("zone")) == [
        (None, None, 999.0, 1.0),
        (2021, 1, 150.0, 45.0),
        (2021, 12, None, 60.0),
        (2022, 1, 300.0, 30.0),
    ]


def test_by_hour(series):
    assert rows(diurnal_profile(series).drop("zone")) == [
        (None, 999.0, 1.0), (0, 200.0, 40.0), (12, 200.0, 40.0), (23, None, 60.0),
    ]


@pytest.mark.parametrize(
    ("drop", "c", "f"),
    [
        (False, (200.0, 200.0, 200.0, 599.5, 999.0), (1.0, 30.25, 40.0, 45.0, 60.0)),
        (True, (200.0,) * 5, (40.0, 40.0, 40.0, 50.0, 60.0)),
    ],
)
def test_quantiles_of_hour_means(series, drop, c, f):
    long = to_long(diurnal_profile(series, drop_invalid=drop), ["zone"], ["c", "f"])
    assert rows(quantile_summary(long, ["zone", "metric"]).drop("zone")) == [("c", *c), ("f", *f)]


def test_unknown_period_part(series):
    with pytest.raises(ValueError, match="week"):
        period_stats(series, ["week"])


def test_union_then_group_is_group_then_union(readings):
    zones = [series_of(readings, SPEC, "A"), series_of(readings.where("f > 35D"), SPEC, "B")]
    together = period_stats(union_zones(zones), ["year", "month"])
    apart = union_zones(period_stats(z, ["year", "month"]) for z in zones)
    assert rows(together) == rows(apart)


def test_rounding_is_half_up_on_six_digits(spark):
    frame = spark.createDataFrame([("Z", 1.0000005), ("Z", 1.0000005)], "zone string, v double")
    found = period_stats(frame.withColumn("ts", F.to_timestamp(F.lit("2021-01-01"))), ["year"], stats=["avg"])
    assert found.first()["v_avg"] == 1.000001


def test_distinct_points_counts_null_as_a_value(spark):
    frame = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "v double")
    assert distinct_points(frame, ["v"]).first()["n_distinct"] == 3


# --- SQL forms give what the DataFrame forms give -----------------------------------


def test_sql_forms_agree(readings, series):
    zones = {"Z": readings}
    long = to_long(diurnal_profile(series), ["zone"], ["c", "f"])
    means = period_stats(series, ["year", "month"], stats=["avg"], by=[])
    labels = {"c_avg": "c", "f_avg": "f"}
    zone_means = period_stats(series, ["year", "month"], stats=["avg"])
    pairs = [
        (period_stats(series, ["year"]), period_stats_sql(zones, SPEC, ["year"])),
        (diurnal_profile(series), diurnal_profile_sql(zones, SPEC)),
        (quantile_summary(long, ["zone", "metric"]), diurnal_quantiles_sql(zones, SPEC)),
        (ranked_extremes(means, ["c_avg", "f_avg"], labels=labels, k=2), ranked_extremes_sql(zones, SPEC, k=2)),
        (
            ranked_extremes(zone_means, ["c_avg", "f_avg"], labels=labels, k=2, by=["zone"]),
            ranked_extremes_sql(zones, SPEC, k=2, by=["zone"]),
        ),
    ]
    for df, sql in pairs:
        assert df.columns == sql.columns
        assert rows(df) == rows(sql)


def test_sql_with_two_zones_and_a_column_named_like_a_part(readings):
    other = readings.withColumn("year", F.lit(1900))
    found = period_stats_sql({"A": readings, "it's B": other}, SPEC, ["year"])
    expected = period_stats(
        union_zones([series_of(readings, SPEC, "A"), series_of(other, SPEC, "it's B")]), ["year"]
    )
    assert rows(found) == rows(expected)


def test_sql_checks_columns(readings):
    with pytest.raises(ValueError, match="'f'"):
        period_stats_sql({"Z": readings.drop("f")}, SPEC, ["year"])


# --- rankings ---------------------------------------------------------------------------


def _months(spark, values, zone="Z"):
    data = [(zone, 2021 + i // 12, i % 12 + 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "zone string, year int, month int, m double")


def test_ties_go_to_the_earlier_period(spark):
    found = ranked_extremes(_months(spark, [7.0] * 7), ["m"])
    for label in ("highest_m", "lowest_m"):
        assert [r["month"] for r in found.where(F.col("label") == label).orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_fewer_groups_than_k(spark):
    found = ranked_extremes(_months(spark, [1.0, 2.0, 3.0]), ["m"])
    assert rows(found.groupBy("label").count()) == [("highest_m", 3), ("lowest_m", 3)]


def test_nulls_rank_last_unless_asked(spark):
    months = _months(spark, [3.0, None, 1.0, 2.0])
    for by in ([], ["zone"]):
        last = ranked_extremes(months, ["m"], k=4, by=by).where("label = 'lowest_m'").orderBy("rank")
        assert [r["m"] for r in last.collect()] == [1.0, 2.0, 3.0, None]
        first = ranked_extremes(months, ["m"], k=2, by=by, nulls="spark").where("label = 'lowest_m'").orderBy("rank")
        assert [r["m"] for r in first.collect()] == [None, 1.0]
        high = ranked_extremes(months, ["m"], k=4, by=by, nulls="spark").where("label = 'highest_m'").orderBy("rank")
        assert [r["m"] for r in high.collect()] == [3.0, 2.0, 1.0, None]
    with pytest.raises(ValueError, match="sideways"):
        ranked_extremes(months, ["m"], nulls="sideways")


def test_no_outside_row_beats_a_listed_one(spark):
    rng = random.Random(5)
    months = _months(spark, [rng.choice([rng.random(), 0.5]) for _ in range(60)]).unionByName(
        _months(spark, [rng.random() for _ in range(3)], "Y")
    )
    by_zone = ranked_extremes(months, ["m"], by=["zone"]).collect()
    everything = months.collect()
    for zone, size in (("Z", 5), ("Y", 3)):
        for label, sign in (("highest_m", -1), ("lowest_m", 1)):
            listed = [r for r in by_zone if r["zone"] == zone and r["label"] == label]
            order = sorted((r for r in everything if r["zone"] == zone), key=lambda r: (sign * r["m"], r["year"], r["month"]))
            assert len(listed) == size
            got = [(r["year"], r["month"]) for r in sorted(listed, key=lambda r: r["rank"])]
            assert got == [(r["year"], r["month"]) for r in order[:size]]


# --- quantiles of readings ------------------------------------------------------------------


def _percentile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_interpolation(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "value double")
    assert rows(series_quantiles(frame, [], "value")) == [(1.75, 3.0, 5.0)]
    assert rows(quantile_summary(frame, [])) == [(1.0, 1.75, 3.0, 5.0, 8.0)]
    empty = quantile_summary(frame.where("value > 100"), [])
    assert rows(empty) == [(None,) * 5]


@pytest.mark.parametrize("buckets, window_values", [(2, 1_000_000), (2, 3), (7, 20), (64, 1)])
def test_series_quantiles_against_brute_force(spark, buckets, window_values):
    rng = random.Random(buckets)
    data = [("hot", 1.0) for _ in range(400)]  # one value many times over
    data += [("hot", rng.gauss(0, 10)) for _ in range(500)]
    data += [("wide", 10.0 ** rng.randint(-8, 8)) for _ in range(100)]
    data += [(None, rng.random()) for _ in range(37)]
    data += [("one", 3.0), ("empty", None), ("hot", None)]
    frame = spark.createDataFrame(data, "zone string, v double").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r["zone"]: list(r)[1:] for r in series_quantiles(
        frame, ["zone"], "v", probs=probs, buckets=buckets, window_values=window_values, digits=None
    ).collect()}
    assert set(found) == {"hot", "wide", None, "one", "empty"}
    assert found["empty"] == [None] * 6
    for zone in ("hot", "wide", None, "one"):
        values = [v for z, v in data if z == zone and v is not None]
        assert found[zone] == pytest.approx([_percentile(values, p) for p in probs], rel=1e-12)


def test_series_quantiles_equal_the_aggregate(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    exact = series_quantiles(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    plain = lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")
    )
    assert rows(exact) == rows(
        plain.select("l_returnflag", "l_linestatus", *(F.round(F.col("q")[i], 6) for i in range(3)))
    )


def test_series_quantiles_without_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr("metricspark.operators.quantiles.BROADCAST_TARGETS", 0)
    frame = spark.createDataFrame([("a", float(i)) for i in range(11)], "zone string, v double")
    assert rows(series_quantiles(frame, ["zone"], "v")) == [("a", 2.5, 5.0, 7.5)]


def test_nan_sorts_last_and_infinities_hold_their_place(spark):
    values = [float("nan"), float("-inf"), 1.0, 2.0, float("inf")]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = series_quantiles(frame, [], "v", probs=[0.25, 0.5, 0.75], digits=None).first()
    assert tuple(found) == (1.0, 2.0, float("inf"))


def test_approximate_quantiles_come_close(spark):
    frame = spark.range(10_001).selectExpr("cast(id as double) as v")
    found = series_quantiles(frame, [], "v", approx=True, digits=None).first()
    assert tuple(found) == pytest.approx((2500, 5000, 7500), abs=2)
    with pytest.raises(ValueError, match="between 0 and 1"):
        series_quantiles(frame, [], "v", probs=[1.5])


def test_cut_points_do_not_meet_in_one_task_by_scan_task(spark):
    """Sketches of scan tasks are merged in groups; only the groups' sketches meet in one."""
    from metricspark.operators import quantiles

    assert quantiles.SKETCH_GROUPS <= 1_000
    values = spark.range(0, 5_000, 1, 40).selectExpr("cast(id as double) as _v")
    cuts = quantiles._cut_points(values, 8)
    assert len(cuts) == 9
    assert [round(c / 625) for c in cuts[1:-1]] == list(range(1, 8))
    assert quantiles._cut_points(values.where("_v < 0"), 8) == [float("-inf"), 0.0, float("inf")]


def test_ranking_keeps_the_metrics_types(spark):
    """A long beside a double, the smallest long, decimals, dates and text rank by their own values."""
    top, least = 2**53, -(2**63)
    data = [
        (1, 1, top, 1.5, Decimal("0.10"), dt.date(2020, 1, 1), "b"),
        (1, 2, top + 1, float("nan"), Decimal("12345678901234567.01"), None, "a"),
        (1, 3, top + 2, None, Decimal("12345678901234567.02"), dt.date(1999, 1, 1), "c"),
        (1, 4, least, float("-inf"), None, dt.date(2021, 1, 1), None),
    ]
    frame = spark.createDataFrame(data, "year int, month int, a long, x double, d decimal(20,2), t date, s string")
    metrics = {"a": 2, "x": 3, "d": 4, "t": 5, "s": 6}
    found = ranked_extremes(frame, list(metrics), k=4).collect()
    for metric, at in metrics.items():
        for direction in ("highest", "lowest"):
            def key(r, at=at, direction=direction):
                value = r[at]
                if isinstance(value, float) and math.isnan(value):
                    value = math.inf
                return value

            known = sorted((r for r in data if r[at] is not None), key=key, reverse=direction == "highest")
            want = [r[1] for r in known] + [r[1] for r in data if r[at] is None]
            got = sorted((r["rank"], r["month"]) for r in found if r["label"] == f"{direction}_{metric}")
            assert [m for _, m in got] == want, (metric, direction)
    assert [r["a"] for r in found if r["label"] == "lowest_a" and r["rank"] == 2] == [top]


def test_states_of_batches_give_the_stats_of_all(spark, readings):
    series = series_of(readings.withColumn("zone", F.lit("Z")), SeriesSpec(time_col="time", zone_col="zone", metrics={"c": "c", "f": "f"}, time_format="yyyy-MM-dd HH:mm:ss"))
    whole = period_stats(series, ["year", "month"])
    parts = [period_states(series.where(F.col("c") < 150), ["year", "month"]), period_states(series.where("c >= 150 or c is null"), ["year", "month"])]
    states = parts[0].unionByName(parts[1])
    assert rows(merged_stats(states, ["zone", "year", "month"])) == rows(whole)
    assert rows(merged_stats(states, ["zone", "year"])) == rows(period_stats(series, ["year"]))
    assert merged_stats(states.limit(0), ["zone"]).count() == 0


def test_sketches_answer_within_their_error(spark):
    """Ranks of KLL quantiles and HLL counts, merged over days and a zone of most rows."""
    frame = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("zone"), (F.col("id") % 30).alias("day"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 7).alias("v"), (F.col("id") % 20_011).alias("u"),
    )
    stored = quantile_sketches(frame, ["zone", "day"], "v", k=800)
    for r in sketch_quantiles(stored, ["zone"], probs=[0.01, 0.5, 0.99]).collect():
        own = frame.where(F.col("zone") == r["zone"])
        assert r["n_rows"] == own.count()
        for p, name in ((0.01, "p1"), (0.5, "p50"), (0.99, "p99")):
            assert own.where(F.col("v") <= r[name]).count() / r["n_rows"] == pytest.approx(p, abs=0.012)
    exact = distinct_points(frame, ["u"]).first()[0]
    assert distinct_points(frame, ["u"], approx=True).first()[0] == pytest.approx(exact, rel=0.05)
    merged = merged_distinct(distinct_sketches(frame, ["u"], ["zone", "day"]), ["zone"])
    for r in merged.collect():
        assert r["n_distinct"] == pytest.approx(frame.where(F.col("zone") == r["zone"]).select("u").distinct().count(), rel=0.05)
    odd = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("", "c"), (None, None)], "x string, y string")
    assert distinct_points(odd, ["x", "y"], approx=True).first()[0] == distinct_points(odd, ["x", "y"]).first()[0] == 5
    assert distinct_points(odd.limit(0), ["x"], approx=True).first()[0] == 0


def test_sql_form_filters_and_fails_as_the_dataframe_form(spark, readings):
    """Zones, times, unreadable times, strict reading and null order in the SQL form."""
    frame = readings.withColumn("zone", F.when(F.col("c") == "100.0", "A").otherwise("B"))
    spec = SeriesSpec(time_col="time", zone_col="zone", metrics={"c": "c", "f": "f"}, time_format="yyyy-MM-dd HH:mm:ss")
    series = series_of(frame, spec)
    start, end = "2021-01-01 06:00:00", "2022-01-01"
    cases = [
        (Rows(zones=["B"]), series.where("zone = 'B'")),
        (Rows(zones=[]), series.limit(0)),
        (Rows(start=start, end=end), series.where(f"ts >= '{start}' and ts < '{end}'")),
        (Rows(drop_invalid=True, zones=["A", "B"]), series.where("ts is not null")),
    ]
    for only, wanted in cases:
        assert rows(period_stats_sql({None: frame}, spec, ["year"], rows=only)) == rows(period_stats(wanted, ["year"]))
    strict = SeriesSpec(spec.time_col, spec.metrics, spec.time_format, zone_col="zone", mode="failfast")
    assert rows(period_stats_sql({None: frame.where("time <> 'bad'")}, strict, ["year"])) == rows(period_stats(series.where("ts is not null"), ["year"]))
    with pytest.raises(Exception, match="not a time: bad"):
        period_stats_sql({None: frame}, strict, ["year"]).collect()
    means = period_stats(series, ["year", "month"], stats=["avg"], by=["zone"])
    for nulls in ("last", "spark"):
        found = ranked_extremes_sql({None: frame}, spec, by=["zone"], k=2, nulls=nulls)
        want = ranked_extremes(means, ["c_avg", "f_avg"], by=["zone"], k=2, nulls=nulls, labels={"c_avg": "c", "f_avg": "f"})
        assert rows(found, *want.columns) == rows(want)
