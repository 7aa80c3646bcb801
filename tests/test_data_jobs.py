import pytest

from metricspark import data_jobs
from metricspark.sources import kept_records, rejected_records
from metricspark.streaming.landing import landed

from frame_rows import rows

HEADER = ["--columns", "Zone,Time (UTC),v"]
SELECT = ["--select", "zone=Zone", "--select", "v=try_cast(v as double)"]


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Zone,Time (UTC),v\nIT,2021-01-01,1\nSE,2021-01-02,x\nIT,2021-01-03,3\n")
    return tmp_path


def test_convert_land_and_judge(spark, csv):
    source = ["--source", str(csv / "in")]
    data_jobs.main(["convert", *source, "--target", str(csv / "zoned"), *HEADER, *SELECT, "--zone-col", "zone", "--where", "v <> '3'"])
    assert rows(spark.read.parquet(str(csv / "zoned")), "zone", "v") == [("IT", 1.0), ("SE", None)]
    for _ in range(2):  # the second run finds nothing new
        data_jobs.main(["land", *source, "--target", str(csv / "landed"), "--marks", str(csv / "marks"), *HEADER, *SELECT, "--zone-col", "zone", "--merge-above", "3"])
    assert rows(landed(spark, str(csv / "landed")), "zone", "v") == [("IT", 1.0), ("IT", 3.0), ("SE", None)]
    data_jobs.main(["judge", *source, "--target", str(csv / "judged"), *HEADER, "--rule", "number=try_cast(v as double) is not null"])
    assert kept_records(spark, str(csv / "judged")).count() == 2
    assert rows(rejected_records(spark, str(csv / "judged"))) == [("SE", "2021-01-02", "x", "number")]


def test_export_leaves_out_run_statistics_that_consolidate_takes(spark, tmp_path):
    (tmp_path / "res" / "query1").mkdir(parents=True)
    (tmp_path / "res" / "query1" / "part.csv").write_text("a,b\n1,2\n")
    (tmp_path / "res" / "evaluation_def").mkdir()
    header = ",".join(data_jobs.consolidate_runs.__globals__["RUN_SUMMARY_SCHEMA"].names)
    (tmp_path / "res" / "evaluation_def" / "part.csv").write_text(header + "\nquery1,DF,20,0.5,0.4,2.0,0.3\n")
    for job in ("export", "consolidate"):
        data_jobs.main([job, "--source", str(tmp_path / "res"), "--target", str(tmp_path / job)])
    assert sorted(p.name for p in (tmp_path / "export").iterdir() if p.is_dir()) == ["result=query1"]
    (part,) = (tmp_path / "consolidate").glob("*.csv")
    assert part.read_text().splitlines()[0] == header and "query1,DF,20" in part.read_text()


def test_jobs_say_what_they_need(capsys):
    with pytest.raises(SystemExit):
        data_jobs.main(["land", "--source", "x", "--target", "y", "--columns", "a"])
    assert "needs --marks" in capsys.readouterr().err
