import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metricspark import ELECTRICITY_HOURLY, ELECTRICITY_YEARLY, PointSpec, SeriesSpec
from metricspark.functions import with_period
from metricspark.sources import (
    dataset_names,
    published_names,
    read_catalogue,
    read_points,
    read_series,
    register_view,
    series_of,
)

from frame_rows import rows

SPEC = SeriesSpec(time_col="time", metrics={"c": "c", "f": "f"}, time_format="yyyy-MM-dd HH:mm:ss")


def test_unreadable_values_become_null(readings):
    series = series_of(readings, SPEC, "Z")
    assert series.columns == ["zone", "ts", "c", "f"]
    assert series.where("ts is null").count() == 1
    assert dict(series.dtypes) == {"zone": "string", "ts": "timestamp", "c": "double", "f": "double"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_failfast_raises_on_bad_time(spark, readings, ansi):
    strict = SeriesSpec(SPEC.time_col, SPEC.metrics, SPEC.time_format, mode="failfast")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert series_of(readings, SPEC, "Z").where("ts is null").count() == 1
        with pytest.raises(PySparkException, match="not a time: bad"):
            series_of(readings, strict, "Z").collect()
        good = readings.where("time <> 'bad'")
        assert len(series_of(good, strict, "Z").collect()) == 4
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_failfast_raises_on_bad_number(spark):
    raw = spark.createDataFrame([("2021-01-01 00:00:00", "12 g", "1")], "time string, c string, f string")
    with pytest.raises(PySparkException, match="not a number: 12 g"):
        series_of(raw, SeriesSpec(SPEC.time_col, SPEC.metrics, SPEC.time_format, mode="failfast"), "Z").collect()


def test_missing_columns_are_named(spark, readings):
    with pytest.raises(ValueError, match="'f'"):
        series_of(readings.drop("f"), SPEC, "Z")
    with pytest.raises(ValueError, match="Datetime__UTC_"):
        series_of(readings, ELECTRICITY_HOURLY, "IT")
    # The check minds case, unlike column lookup.
    with pytest.raises(ValueError, match="'time'"):
        series_of(readings.withColumnRenamed("time", "Time"), SPEC, "Z")


def test_zone_must_come_from_somewhere(readings):
    with pytest.raises(ValueError, match="zone"):
        series_of(readings, SPEC)


def test_zones_are_one_bag(spark, readings, tmp_path):
    readings.write.parquet(str(tmp_path / "a"))
    readings.write.parquet(str(tmp_path / "b"))
    series = read_series(spark, {"A": str(tmp_path / "a"), "B": str(tmp_path / "b")}, SPEC)
    assert rows(series.groupBy("zone").count()) == [("A", 5), ("B", 5)]
    assert read_series(spark, {"A": str(tmp_path / "a")}, SPEC, start="2021-06-01", end="2022-01-01").count() == 1


def test_zone_filter_drops_other_scans(spark, readings, tmp_path):
    readings.write.parquet(str(tmp_path / "a"))
    readings.write.parquet(str(tmp_path / "b"))
    paths = {"A": str(tmp_path / "a"), "B": str(tmp_path / "b")}
    plan = read_series(spark, paths, SPEC, zones=["A"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_columns_pass_through(readings, kind):
    text = series_of(readings, SPEC, "Z")
    typed = readings.withColumn("time", F.try_to_timestamp("time", F.lit(SPEC.time_format)).cast(kind))
    direct = series_of(typed, SeriesSpec("time", SPEC.metrics), "Z")
    parts = ["year", "month", "hour"]
    assert rows(with_period(direct, *parts).select(*parts)) == rows(with_period(text, *parts).select(*parts))


def test_clock_change_in_utc(spark):
    raw = spark.createDataFrame([("2021-03-28 02:30:00", "1", "1")], "time string, c string, f string")
    series = series_of(raw, SPEC, "Z")
    assert with_period(series, "hour").first()["hour"] == 2
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        assert with_period(series_of(raw, SPEC, "Z"), "hour").first()["hour"] == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_points_from_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(
        "Country,Zone id,Carbon intensity gCO₂eq/kWh (direct)\nItaly,IT,210.41\nNowhere,XX,n/a\n", encoding="utf-8"
    )
    points = read_points(spark, str(path), ELECTRICITY_YEARLY)
    assert points.columns == ["country", "carbon-intensity"]
    assert rows(points) == [("Italy", 210.41), ("Nowhere", None)]
    with pytest.raises(ValueError, match="Total"):
        read_points(spark, str(path), PointSpec("Country", {"t": "Total"}))


def test_points_header_is_checked_against_known_columns(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("Country,Other\nItaly,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_points(spark, str(path), PointSpec("Country", {"v": "Value"}), columns=["Country", "Value"]).collect()


def test_dataset_names():
    assert dataset_names(["IT", "SE"], [2021, 2022])[1:3] == ["IT_2022_hourly.csv", "SE_2021_hourly.csv"]
    everything = published_names("daily")
    assert len(everything) == 2 * 4 + 30
    assert (everything[0], everything[-1]) == ("IT_2021_daily.csv", "EG_2024_yearly.csv")
    with pytest.raises(ValueError, match="weekly"):
        dataset_names(["IT"], [2021], "weekly")


def test_catalogue_reads_zone_and_year_from_names(spark, tmp_path):
    for name, value in (("IT_2021_hourly.csv", 1), ("SE_2021_hourly.csv", 2), ("SE_2022_hourly.csv", 3)):
        (tmp_path / name).write_text(f"t,v\nx,{value}\n", encoding="utf-8")
    base = str(tmp_path)
    found = read_catalogue(spark, base, dataset_names(["IT"], [2021]) + dataset_names(["SE"], [2021, 2022]), ["t", "v"])
    assert rows(found, "zone", "year", "granularity", "v") == [
        ("IT", 2021, "hourly", "1"),
        ("SE", 2021, "hourly", "2"),
        ("SE", 2022, "hourly", "3"),
    ]
    names = dataset_names(["IT", "SE"], [2021, 2022])
    with pytest.raises(PySparkException):
        read_catalogue(spark, base, names, ["t", "v"]).collect()
    assert read_catalogue(spark, base, names, ["t", "v"], allow_missing=True).count() == 3


def test_view_is_visible_to_sql(spark, readings):
    name = register_view(readings, "readings_z")
    assert spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"] == 5


def test_catalogue_query_keeps_every_zone_and_missing_dates(spark, tmp_path):
    from metricspark.catalog import QUERIES

    orders = spark.createDataFrame(
        [(1, "F", "2021-01-05 00:00:00"), (2, "X", "2022-03-01 00:00:00"), (3, "O", None), (4, None, "2021-01-05 00:00:00")],
        "o_custkey int, o_orderstatus string, d string",
    ).selectExpr("o_custkey", "o_orderstatus", "cast(d as timestamp_ntz) as o_orderdate", "o_custkey * 1.5D as o_totalprice")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = {(r["zone"], r["year"], r["price"]) for r in QUERIES["ingest_catalogue"](spark, str(tmp_path)).collect()}
    assert found == {("F", 2021, 1.5), ("X", 2022, 3.0), ("O", None, 4.5), (None, 2021, 6.0)}


def test_zones_that_look_like_numbers_stay_text(spark, tmp_path):
    from metricspark.sources import read_series, write_zoned
    from metricspark.spec import SeriesSpec
    from metricspark.streaming import land_csv
    from metricspark.streaming.landing import landed

    rows = [("007", "2021-01-01 00:00:00", 1.0), ("010", "2021-01-02 00:00:00", 2.0)]
    frame = spark.createDataFrame(rows, "zone string, t string, m double")
    write_zoned(frame, str(tmp_path / "zoned"))
    spec = SeriesSpec(time_col="t", zone_col="zone", metrics={"m": "m"}, time_format="yyyy-MM-dd HH:mm:ss")
    assert {r["zone"] for r in read_series(spark, str(tmp_path / "zoned"), spec).collect()} == {"007", "010"}
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    land_csv(
        spark, str(tmp_path / "csv"), str(tmp_path / "landed"), str(tmp_path / "marks"), ["zone", "t", "m"], partition_by="zone"
    ).awaitTermination()
    assert {r["zone"] for r in landed(spark, str(tmp_path / "landed")).collect()} == {"007", "010"}
