import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from metricspark.operators import consolidate_runs, run_log, run_summary
from metricspark.operators.runlog import RUN_SUMMARY_SCHEMA, append_runs, published_summary
from metricspark.sinks import collect_results, export_results, write_result

from frame_rows import rows


def _runs(query, times, start=0, query_type="DF"):
    base = dt.datetime(2024, 1, 1)
    return [
        {
            "query_id": query,
            "query_type": query_type,
            "run_id": start + i,
            "started_at": base + dt.timedelta(minutes=start + i),
            "seconds": t,
            "succeeded": t is not None,
        }
        for i, t in enumerate(times)
    ]


def test_run_summary_leaves_out_the_first_success(spark):
    times = [None, 9.0, 1.0, 2.0, 4.5]
    log = run_log(spark, _runs("q1", times) + _runs("q2", [3.0]) + _runs("q3", [None, None]))
    found = {r["query_id"]: r for r in run_summary(log).collect()}
    assert set(found) == {"q1", "q2"}
    kept = times[2:]
    assert tuple(found["q1"])[2:] == (
        3, round(statistics.mean(kept), 4), 1.0, 4.5, round(statistics.stdev(kept), 4),
    )
    assert tuple(found["q2"])[2:] == (1, 3.0, 3.0, 3.0, None)


def test_equal_runs_lose_only_one(spark):
    runs = [dict(r, started_at=dt.datetime(2024, 1, 1)) for r in _runs("q", [2.0, 2.0, 2.0])]
    assert run_summary(run_log(spark, runs)).first()["num_runs"] == 2


def test_log_grows_by_appending(spark, tmp_path):
    path = str(tmp_path / "log")
    append_runs(run_log(spark, _runs("q", [1.0, 2.0])), path)
    append_runs(run_log(spark, _runs("q", [4.0], start=2)), path)
    assert run_summary(spark.read.parquet(path)).first()["time_avg"] == 3.0


def test_single_file_is_sorted_and_keeps_hidden_order(spark, tmp_path):
    frame = spark.range(50).selectExpr("id", "-id as backwards", "id % 7 as v").repartition(6)
    path = write_result(
        frame, str(tmp_path / "r"), order_by=["backwards"], columns=["id", "v"], single_file=True
    )
    (part,) = (tmp_path / "r").glob("*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "id,v"
    assert [int(line.split(",")[0]) for line in lines[1:]] == list(range(49, -1, -1))
    write_result(frame, path, single_file=True)
    assert spark.read.option("header", True).csv(path).count() == 50
    write_result(frame.select("id"), str(tmp_path / "p"), order_by=["id"], fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 50


def test_results_are_collected_by_name_and_exported(spark, tmp_path):
    root = tmp_path / "results"
    texts = {"query1": ["a,b", "1,2", "3,4"], "query2": ["x", *map(str, range(500))]}
    for name, lines in texts.items():
        folder = root / "deep" / name
        folder.mkdir(parents=True)
        (folder / "part-0.csv").write_text("\n".join(lines) + "\n")
        (folder / "_SUCCESS").write_text("")
    (root / "query1.txt").write_text("not a result\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # split the files
    try:
        lines = collect_results(spark, str(root))
        assert lines.rdd.getNumPartitions() > 2
        for name, text in texts.items():
            mine = lines.where(F.col("result") == name).orderBy("position")
            assert [r["line"] for r in mine.collect()] == text
        export_results(lines, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in texts.items():
        parts = sorted((tmp_path / "out" / f"result={name}").glob("part-*"))
        assert [line for p in parts for line in p.read_text().splitlines()] == text


def test_all_part_files_are_kept(spark, tmp_path):
    write_result(spark.range(8).repartition(4), str(tmp_path / "r" / "many"))
    lines = collect_results(spark, str(tmp_path / "r"))
    assert lines.select("part").distinct().count() == 4
    assert lines.where("line <> 'id'").count() == 8


def test_consolidation_takes_fitting_files_only(spark, tmp_path):
    root = tmp_path / "r"
    log = run_log(spark, _runs("q1", [9.0, 1.5, 2.5]) + _runs("q2", [3.25], query_type="SQL"))
    summary = run_summary(log)
    for query in ("q1", "q2"):
        mine = published_summary(summary.where(F.col("query_id") == query))
        write_result(mine, str(root / query / f"evaluation_{query}"), mode="append", single_file=True)
    write_result(summary, str(root / "evaluation_wrong"), single_file=True)
    write_result(published_summary(summary), str(root / "query1"), single_file=True)
    empty = root / "evaluation_empty"
    empty.mkdir()
    (empty / "part-0.csv").write_text("")
    found = consolidate_runs(collect_results(spark, str(root)))
    assert found.columns == RUN_SUMMARY_SCHEMA.names
    assert [f.dataType for f in found.schema] == [f.dataType for f in RUN_SUMMARY_SCHEMA]
    assert rows(found) == [
        ("q1", "DF", 2, 2.0, 1.5, 2.5, pytest.approx(0.7071)),
        ("q2", "SQL", 1, 3.25, 3.25, 3.25, None),
    ]
