"""Every registered query against its SQL in DuckDB, and the reports under published names."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from metricspark import ELECTRICITY_HOURLY
from metricspark.plans import diurnal_report, monthly_extremes_report, reports, yearly_report
from metricspark.sinks import write_result
from metricspark.sources import read_series

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _value(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    frame = contract.queries()[name](spark, sf_dir)
    cursor = duck.execute(contract.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: SPARK_TO_SQL[t] for c, t in frame.dtypes} == types
    found = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    assert found == _sorted(list(types), cursor.fetchall())
    assert found


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["cluster_centers", "cluster_assign", "cluster_nations"])
def test_cluster_queries_cover_all_rows(spark, sf_dir, name):
    found = contract.queries()[name](spark, sf_dir).collect()
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    expected = {
        "cluster_assign": customers.count(),
        "cluster_nations": customers.select("c_nationkey").distinct().count(),
    }
    assert len(found) == expected.get(name, len(found))
    assert len({r["cluster_id"] for r in found}) >= 2


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def electricity(spark, tmp_path_factory):
    """Four years of invented hourly readings for two zones, as the published Parquet files look."""
    base = tmp_path_factory.mktemp("hourly")
    paths = {}
    for zone, level in (("IT", 300), ("SE", 5)):
        paths[zone] = str(base / f"{zone}_hourly.parquet")
        spark.sql(
            f"""
            SELECT date_format(timestamp '2021-01-01' + make_dt_interval(0, id), 'yyyy-MM-dd HH:mm:ss') AS Datetime__UTC_,
                   'zone' AS Zone_name,
                   cast({level} + (id * 37 % 101) / 7D + month(timestamp '2021-01-01' + make_dt_interval(0, id)) AS string)
                       AS Carbon_intensity_gCO_eq_kWh__direct_,
                   cast(100 - (id * 13 % 89) / 3D AS string) AS Carbon_free_energy_percentage__CFE__
            FROM range({4 * 365 * 24 + 24}) AS t(id0) LATERAL VIEW explode(array(cast(id0 AS int))) e AS id
            """
        ).write.parquet(paths[zone])
    return paths


def test_published_report_shapes(spark, electricity, tmp_path):
    series = read_series(spark, electricity, ELECTRICITY_HOURLY)
    italy = read_series(spark, {"IT": electricity["IT"]}, ELECTRICITY_HOURLY)
    expected = {
        "yearly": (yearly_report(series), 8),
        "monthly": (monthly_extremes_report(italy), 20),
        "diurnal": (diurnal_report(series), 4),
    }
    for name, (report, size) in expected.items():
        columns = reports.REPORT_COLUMNS[name]
        path = write_result(
            report, str(tmp_path / name), order_by=reports.REPORT_ORDER[name], columns=columns, single_file=True
        )
        (part,) = (tmp_path / name).glob("*.csv")
        lines = part.read_text().splitlines()
        assert lines[0] == ",".join(columns)
        assert len(lines) == size + 1
        assert spark.read.option("header", True).csv(path).count() == size
    labels = [line.rsplit(",", 1)[1] for line in next((tmp_path / "monthly").glob("*.csv")).read_text().splitlines()[1:]]
    assert labels == [label for label in reports.MONTHLY_LABELS for _ in range(5)]
    for line in next((tmp_path / "diurnal").glob("*.csv")).read_text().splitlines()[1:]:
        numbers = [float(v) for v in line.split(",")[2:]]
        assert numbers == sorted(numbers)
