import pytest

from metricspark import jobs
from metricspark.operators import run_summary


@pytest.fixture(scope="module")
def hourly(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs") / "IT_hourly.parquet")
    spark.sql(
        """
        SELECT date_format(timestamp '2021-01-01' + make_dt_interval(0, cast(id AS int)), 'yyyy-MM-dd HH:mm:ss')
                   AS Datetime__UTC_,
               cast(id % 97 AS string) AS Carbon_intensity_gCO_eq_kWh__direct_,
               cast(id % 89 AS string) AS Carbon_free_energy_percentage__CFE__
        FROM range(9000)
        """
    ).write.parquet(path)
    return path


def _text(folder):
    (part,) = folder.glob("*.csv")
    return part.read_text()


@pytest.mark.parametrize("report", ["yearly", "monthly", "diurnal"])
def test_both_forms_write_the_same_file(spark, hourly, tmp_path, report):
    common = [report, "--zone", f"IT={hourly}"]
    jobs.main([*common, "--output", str(tmp_path / "df")])
    jobs.main([*common, "--output", str(tmp_path / "sql"), "--sql"])
    assert _text(tmp_path / "df") == _text(tmp_path / "sql")


def test_runs_go_to_the_log(spark, hourly, tmp_path):
    log = str(tmp_path / "log")
    jobs.main(["yearly", "--zone", f"IT={hourly}", "--output", str(tmp_path / "r"), "--runs", "2", "--run-log", log])
    row = run_summary(spark.read.parquet(log)).first()
    assert (row["query_id"], row["query_type"], row["num_runs"]) == ("yearly", "DF", 2)


def test_clusters_job(spark, tmp_path):
    path = tmp_path / "points.csv"
    body = "".join(f"c{i},{v}\n" for i, v in enumerate([1, 2, 3, 50, 51, 52]))
    path.write_text("Country,Carbon intensity gCO₂eq/kWh (direct)\n" + body, encoding="utf-8")
    jobs.main(["clusters", "--points", str(path), "--output", str(tmp_path / "r")])
    lines = _text(tmp_path / "r").splitlines()
    assert lines[0] == "country,carbon-intensity,cluster_id,cluster_center,distance_from_center"
    assert len(lines) == 7
    assert {line.split(",")[3] for line in lines[1:]} == {"2.0", "51.0"}


def test_a_failing_report_fails_the_job(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="missing columns"):
        jobs.main(["yearly", "--zone", f"IT={tmp_path / 'bad'}", "--output", str(tmp_path / "r"), "--runs", "3"])
    with pytest.raises(ValueError, match="no SQL form"):
        jobs.main(["clusters", "--points", "x", "--output", str(tmp_path / "r"), "--sql"])
