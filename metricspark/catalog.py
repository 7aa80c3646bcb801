"""The registered queries: every operator applied to the given tables, with its SQL check."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions import parse_time, to_double, with_period
from metricspark.operators import (
    assemble_features,
    cluster_profile,
    consolidate_runs,
    distance_to_center,
    distinct_points,
    distinct_sketches,
    diurnal_profile,
    merged_distinct,
    merged_stats,
    period_states,
    period_stats,
    prepare_points,
    quantile_sketches,
    quantile_summary,
    ranked_extremes,
    run_summary,
    scale_features,
    series_quantiles,
    silhouette,
    sketch_quantiles,
    sweep_k,
    to_long,
)
from metricspark.operators.runlog import append_runs, published_summary, run_log
from metricspark.plans import (
    cluster_report,
    diurnal_profile_sql,
    diurnal_quantiles_sql,
    period_stats_sql,
    ranked_extremes_sql,
)
from metricspark.session import work_path
from metricspark.sinks import collect_results, export_results, write_result
from metricspark.sources import (
    clean,
    csv_to_parquet,
    dataset_names,
    kept_records,
    merge,
    merge_latest,
    read_catalogue,
    read_points,
    read_series,
    rejected_records,
    series_of,
    split_records,
)
from metricspark.spec import PointSpec, SeriesSpec
from metricspark.streaming import land_csv
from metricspark.streaming.landing import landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TEXT_TIME = "yyyy-MM-dd HH:mm:ss"

# Stand-ins for the electricity series and points.
LINE_SERIES = SeriesSpec(
    time_col="l_shipdate",
    zone_col="l_returnflag",
    metrics={"price": "l_extendedprice", "discount": "l_discount"},
)
EVENT_SERIES = SeriesSpec(
    time_col="ts", zone_col="event_type", metrics={"value": "value", "k": "k"}
)
BALANCES = PointSpec(key_col="c_custkey", key_name="c_custkey", features={"c_acctbal": "c_acctbal"})


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_series(spark, f"{sf_dir}/lineitem.parquet", LINE_SERIES)


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their JSON as a second metric."""
    return _table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_of(_raw_events(spark, sf_dir), EVENT_SERIES)


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")


_EVENT_K = "cast(props::json->>'k' as double)"


# --- sources --------------------------------------------------------------------


@query(
    "scan_series",
    """
    select l_returnflag as zone, l_shipdate as ts, l_extendedprice as price, l_discount as discount
    from lineitem
    """,
)
def scan_series(spark, sf_dir):
    return _lines(spark, sf_dir)


@query(
    "union_zones",
    """
    select 'orders' as zone, o_orderdate as ts, o_totalprice as amount from orders
    union all
    select 'lines', l_shipdate, l_extendedprice from lineitem
    """,
)
def union_zones(spark, sf_dir):
    return read_series(
        spark,
        {"orders": f"{sf_dir}/orders.parquet", "lines": f"{sf_dir}/lineitem.parquet"},
        {
            "orders": SeriesSpec(time_col="o_orderdate", metrics={"amount": "o_totalprice"}),
            "lines": SeriesSpec(time_col="l_shipdate", metrics={"amount": "l_extendedprice"}),
        },
    )


@query(
    "scan_points_csv",
    """
    select c_custkey::varchar as c_custkey, c_acctbal, c_nationkey::double as c_nationkey from customer
    """,
)
def scan_points_csv(spark, sf_dir):
    path = work_path(spark, "points")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    write_result(customers, path)
    spec = PointSpec(
        key_col="c_custkey",
        key_name="c_custkey",
        features={"c_acctbal": "c_acctbal", "c_nationkey": "c_nationkey"},
    )
    return read_points(spark, path, spec, columns=customers.columns)


# --- ingestion --------------------------------------------------------------------


@query(
    "ingest_clean",
    """
    select cast(o_orderkey as varchar) as Order_id_, o_orderdate as placed,
           o_totalprice as Total_price_gross_, upper(o_orderstatus) as status
    from orders
    where o_totalprice >= 1000 and o_orderpriority <> '5-LOW'
    """,
)
def ingest_clean(spark, sf_dir):
    raw = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order(id)"),
        F.date_format("o_orderdate", TEXT_TIME).alias("Order date"),
        F.col("o_totalprice").cast("string").alias("Total price/gross "),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    return clean(
        raw,
        select={
            "Order_id_": "Order_id_",
            "placed": f"cast(try_to_timestamp(Order_date, '{TEXT_TIME}') as timestamp_ntz)",
            "Total_price_gross_": "try_cast(Total_price_gross_ as double)",
            "status": "upper(status)",
        },
        where="try_cast(Total_price_gross_ as double) >= 1000 and priority <> '5-LOW'",
    )


@query(
    "ingest_merge",
    """
    select l_orderkey as order_key, l_shipdate as ts, l_extendedprice as amount, l_tax as tax,
           cast(null as varchar) as priority
    from lineitem
    union all
    select o_orderkey, o_orderdate, o_totalprice, null, o_orderpriority from orders
    """,
)
def ingest_merge(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as order_key", "l_shipdate as ts", "l_extendedprice as amount", "l_tax as tax"
    )
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as order_key", "o_orderdate as ts", "o_totalprice as amount", "o_orderpriority as priority"
    )
    return merge([lines, orders])


# What stands in a dataset's name for a missing zone or year.
NO_PART = "none"


def _land_orders(spark, sf_dir) -> tuple[str, list[str]]:
    """Orders as header CSV in one folder per zone and year, named as the catalogue names them."""
    base = work_path(spark, "orders-csv")
    orders = _table(spark, sf_dir, "orders").select(
        F.concat_ws(
            "_",
            F.coalesce("o_orderstatus", F.lit(NO_PART)),
            F.coalesce(F.year("o_orderdate").cast("string"), F.lit(NO_PART)),
            F.lit("hourly.csv"),
        ).alias("dataset"),
        F.date_format("o_orderdate", TEXT_TIME).alias("Datetime (UTC)"),
        F.col("o_totalprice").alias("Total price"),
        F.col("o_custkey").alias("Customer"),
    )
    orders.hint("rebalance", "dataset").write.partitionBy("dataset").option("header", True).csv(base)
    return base, orders.columns[1:]


def _order_datasets(spark, sf_dir) -> list[str]:
    """The names of the datasets: one for every zone and year that occur."""
    pairs = _table(spark, sf_dir, "orders").select("o_orderstatus", F.year("o_orderdate").alias("year")).distinct()
    found = {(r["o_orderstatus"] or NO_PART, r["year"] or NO_PART) for r in pairs.collect()}
    return sorted(name for zone, year in found for name in dataset_names([zone], [year]))


@query(
    "ingest_catalogue",
    """
    select o_orderstatus as zone, cast(year(o_orderdate) as integer) as year, 'hourly' as granularity,
           o_orderdate as ts, o_totalprice as price
    from orders
    """,
)
def ingest_catalogue(spark, sf_dir):
    base, columns = _land_orders(spark, sf_dir)
    records = read_catalogue(spark, base, _order_datasets(spark, sf_dir), columns, prefix="dataset=")
    return records.select(
        F.nullif("zone", F.lit(NO_PART)).alias("zone"),
        "year",
        "granularity",
        parse_time(F.col("`Datetime (UTC)`"), TEXT_TIME).cast("timestamp_ntz").alias("ts"),
        to_double(F.col("`Total price`")).alias("price"),
    )


@query(
    "ingest_roundtrip",
    """
    select lpad(cast(o_custkey % 7 as varchar), 3, '0') as zone, o_orderdate as ts, o_totalprice as price,
           o_orderkey as order_key
    from orders
    """,
)
def ingest_roundtrip(spark, sf_dir):
    landing, target = work_path(spark, "raw"), work_path(spark, "zoned")
    raw = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order (key)"),
        F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0").alias("Zone"),
        F.date_format("o_orderdate", TEXT_TIME).alias("Datetime (UTC)"),
        F.col("o_totalprice").alias("Total price"),
    )
    write_result(raw, landing)
    return csv_to_parquet(
        spark,
        landing,
        target,
        raw.columns,
        zone_col="zone",
        select={
            "zone": "Zone",
            "ts": f"cast(try_to_timestamp(Datetime__UTC_, '{TEXT_TIME}') as timestamp_ntz)",
            "price": "try_cast(Total_price as double)",
            "order_key": "try_cast(Order__key_ as bigint)",
        },
        sort_by=["ts"],
    )


@query(
    "ingest_incremental",
    """
    select event_id, lpad(cast(user_id % 7 as varchar), 3, '0') as zone, date_trunc('second', ts) as ts, value
    from events
    """,
)
def ingest_incremental(spark, sf_dir):
    """Half the events arrive, are landed, then the rest; the second run lands only those."""
    source, target, marks = (work_path(spark, n) for n in ("arriving", "landed", "marks"))
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.lpad((F.col("user_id") % 7).cast("string"), 3, "0").alias("zone"),
        F.date_format("ts", TEXT_TIME).alias("Datetime (UTC)"),
        "value",
    )
    for arrival in (events.where("value < 10"), events.where("value >= 10 or value is null")):
        write_result(arrival, source, mode="append")
        land_csv(
            spark,
            source,
            target,
            marks,
            events.columns,
            select={
                "event_id": "try_cast(event_id as bigint)",
                "zone": "zone",
                "ts": f"cast(try_to_timestamp(Datetime__UTC_, '{TEXT_TIME}') as timestamp_ntz)",
                "value": "try_cast(value as double)",
            },
            partition_by="zone",
        ).awaitTermination()
    return landed(spark, target)


def _arriving_events(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.lpad((F.col("user_id") % 7).cast("string"), 3, "0").alias("zone"),
        F.date_format("ts", TEXT_TIME).alias("Datetime (UTC)"),
        "value",
    )


def _land_in_batches(spark, sf_dir) -> tuple[str, str]:
    """Five arrivals of events, landed one by one; each batch's folder is merged and its statistics kept."""
    source, target, marks, states = (work_path(spark, n) for n in ("arriving", "landed", "marks", "states"))
    events = _arriving_events(spark, sf_dir)

    def keep_states(batch: DataFrame, number: int) -> None:
        period_states(batch, ["year", "month"], metrics=["value"]).write.mode("overwrite").parquet(f"{states}/batch={number}")

    for i in range(5):
        write_result(events.where(F.pmod("event_id", F.lit(5)) == i), source, mode="append")
        land_csv(
            spark,
            source,
            target,
            marks,
            events.columns,
            select={
                "event_id": "try_cast(event_id as bigint)",
                "zone": "zone",
                "ts": f"cast(try_to_timestamp(Datetime__UTC_, '{TEXT_TIME}') as timestamp_ntz)",
                "value": "try_cast(value as double)",
            },
            partition_by="zone",
            merge_above=2,
            also=keep_states,
        ).awaitTermination()
    return target, states


@query(
    "ingest_merged_folders",
    """
    select event_id, lpad(cast(user_id % 7 as varchar), 3, '0') as zone, date_trunc('second', ts) as ts, value
    from events
    """,
)
def ingest_merged_folders(spark, sf_dir):
    target, _ = _land_in_batches(spark, sf_dir)
    return landed(spark, target)


@query(
    "period_stats_incremental",
    """
    select lpad(cast(user_id % 7 as varchar), 3, '0') as zone, cast(year(ts) as integer) as year,
           cast(month(ts) as integer) as month, round(avg(value), 6) as value_avg, min(value) as value_min,
           max(value) as value_max
    from events
    group by all
    """,
)
def period_stats_incremental(spark, sf_dir):
    """From the states that each landed batch left; the readings are not read again."""
    _, states = _land_in_batches(spark, sf_dir)
    return merged_stats(spark.read.parquet(states), ["zone", "year", "month"])


@query(
    "ingest_quarantine",
    """
    select o_orderkey as order_key,
           case when o_totalprice >= 1000 and o_orderpriority <> '5-LOW' then o_totalprice end as price,
           case when o_totalprice is null or o_totalprice < 1000 then 'price'
                when o_orderpriority is null or o_orderpriority = '5-LOW' then 'priority' end as reason,
           count(*) over (partition by case when o_totalprice is null or o_totalprice < 1000 then 'price'
                when o_orderpriority is null or o_orderpriority = '5-LOW' then 'priority' end) as counted
    from orders
    """,
)
def ingest_quarantine(spark, sf_dir):
    """All orders: the kept ones cleaned, the others with the rule they broke; ``counted`` while writing."""
    path = work_path(spark, "orders-judged")
    raw = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order (key)"), F.col("o_totalprice").cast("string").alias("Total price"), F.col("o_orderpriority").alias("priority")
    )
    counts = split_records(
        raw,
        path,
        rules={"price": "try_cast(Total_price as double) >= 1000", "priority": "priority <> '5-LOW'"},
        select={"order_key": "Order__key_", "price": "try_cast(Total_price as double)"},
    )
    kept = kept_records(spark, path).select("order_key", "price", F.lit(None).cast("string").alias("reason"))
    rejected = rejected_records(spark, path).select(F.col("Order__key_").alias("order_key"), F.lit(None).cast("double").alias("price"), "reason")
    counted = F.coalesce(*(F.when(F.coalesce("reason", F.lit("kept")) == name, F.lit(n)) for name, n in counts.items()))
    return kept.unionByName(rejected).withColumn("counted", counted.cast("long"))


@query(
    "ingest_merge_latest",
    """
    with united as (
        select event_type as zone, ts, event_id as version, value, 0 as dataset from events
        union all
        select event_type, ts, event_id, case when user_id % 2 = 0 then value + 1 end, 1 from events where user_id % 3 = 0
        union all
        select event_type, date_trunc('hour', ts), event_id, value, 2 from events)
    select zone, ts, version, value from united
    qualify row_number() over (partition by zone, ts order by version desc nulls last, dataset desc) = 1
    """,
)
def ingest_merge_latest(spark, sf_dir):
    """Events, corrections of a third of them and hourly ones, which overlap in zone and time."""
    events = _table(spark, sf_dir, "events").withColumnsRenamed({"event_type": "zone", "event_id": "version"})
    corrected = F.when(F.col("user_id") % 2 == 0, F.col("value") + 1)
    frames = [
        events.select("zone", "ts", "version", "value"),
        events.where("user_id % 3 = 0").select("zone", "ts", "version", corrected.alias("value")),
        events.select("zone", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "version", "value"),
    ]
    return merge_latest(frames, ["zone", "ts"], version="version")


# --- scalar functions ---------------------------------------------------------------


@query(
    "parse_time",
    """
    select event_id,
           case when event_type <> 'error' then date_trunc('second', ts) end as parsed,
           cast(case when event_type <> 'error' then year(ts) else -1 end as integer) as year,
           cast(case when event_type <> 'error' then month(ts) else -1 end as integer) as month,
           cast(case when event_type <> 'error' then hour(ts) else -1 end as integer) as hour
    from events
    """,
)
def parse_time_parts(spark, sf_dir):
    """Event times as text, those of errors spoiled, read back and split; -1 for no time."""
    text = F.date_format("ts", TEXT_TIME)
    spoiled = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), text)).otherwise(text)
    parsed = _table(spark, sf_dir, "events").select(
        "event_id", parse_time(spoiled, TEXT_TIME).cast("timestamp_ntz").alias("parsed")
    )
    return with_period(parsed, "year", "month", "hour", time_col="parsed").fillna(-1)


@query(
    "clean_cast",
    """
    select l_orderkey, l_linenumber, case when l_linestatus = 'O' then l_extendedprice end as price,
           l_discount as discount
    from lineitem
    """,
)
def clean_cast(spark, sf_dir):
    """Prices as text, some with a unit that makes them unreadable, read as numbers."""
    lines = _table(spark, sf_dir, "lineitem")
    text = F.concat(F.col("l_extendedprice").cast("string"), F.when(F.col("l_linestatus") == "O", "").otherwise(" EUR"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        to_double(text).alias("price"),
        to_double(F.col("l_discount").cast("string")).alias("discount"),
    )


# --- statistics by period -------------------------------------------------------------

_YEAR_SQL = """
    select l_returnflag as zone, cast(year(l_shipdate) as integer) as year,
           round(avg(l_extendedprice), 6) as price_avg, min(l_extendedprice) as price_min,
           max(l_extendedprice) as price_max,
           round(avg(l_discount), 6) as discount_avg, min(l_discount) as discount_min,
           max(l_discount) as discount_max
    from lineitem
    group by all
"""


@query("period_stats_year_df", _YEAR_SQL)
def period_stats_year_df(spark, sf_dir):
    return period_stats(_lines(spark, sf_dir), ["year"]).orderBy("zone", "year")


@query("period_stats_year_sql", _YEAR_SQL)
def period_stats_year_sql(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    return period_stats_sql({None: lines}, LINE_SERIES, ["year"]).orderBy("zone", "year")


_MONTH_SQL = """
    select l_returnflag as zone, cast(year(l_shipdate) as integer) as year,
           cast(month(l_shipdate) as integer) as month,
           round(avg(l_extendedprice), 6) as price_avg, round(avg(l_discount), 6) as discount_avg
    from lineitem
    group by all
"""


@query("period_stats_month_df", _MONTH_SQL)
def period_stats_month_df(spark, sf_dir):
    return period_stats(_lines(spark, sf_dir), ["year", "month"], stats=["avg"])


@query("period_stats_month_sql", _MONTH_SQL)
def period_stats_month_sql(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    return period_stats_sql({None: lines}, LINE_SERIES, ["year", "month"], stats=["avg"])


_PROFILE_SQL = f"""
    select event_type as zone, cast(hour(ts) as integer) as hour, round(avg(value), 6) as value,
           round(avg({_EVENT_K}), 6) as k
    from events
    group by all
"""


@query("diurnal_profile_df", _PROFILE_SQL)
def diurnal_profile_df(spark, sf_dir):
    return diurnal_profile(_events(spark, sf_dir))


@query("diurnal_profile_sql", _PROFILE_SQL)
def diurnal_profile_by_sql(spark, sf_dir):
    return diurnal_profile_sql({None: _raw_events(spark, sf_dir)}, EVENT_SERIES)


# Rounding half up on the decimal text of the number, as Spark rounds.
def _round6(expression: str) -> str:
    return f"round(({expression})::varchar::decimal(38, 20), 6)::double"


_QUANTILES = ", ".join(
    f"{_round6(f'quantile_cont(v, {p})')} as p{int(p * 100)}" for p in (0.25, 0.5, 0.75)
)
_DIURNAL_SQL = f"""
    with profile as ({_PROFILE_SQL}),
    long as (
        select zone, 'value' as metric, value as v from profile
        union all
        select zone, 'k', k from profile
    )
    select zone, metric, min(v) as min, {_QUANTILES}, max(v) as max from long group by zone, metric
"""


@query("diurnal_quantiles_df", _DIURNAL_SQL)
def diurnal_quantiles_df(spark, sf_dir):
    profile = diurnal_profile(_events(spark, sf_dir))
    return quantile_summary(to_long(profile, ["zone"], ["value", "k"]), ["zone", "metric"])


@query("diurnal_quantiles_sql", _DIURNAL_SQL)
def diurnal_quantiles_by_sql(spark, sf_dir):
    return diurnal_quantiles_sql({None: _raw_events(spark, sf_dir)}, EVENT_SERIES)


@query(
    "series_quantiles",
    f"""
    select zone, {_QUANTILES}
    from (select l_returnflag as zone, l_extendedprice as v from lineitem) group by zone
    """,
)
def series_quantiles_exact(spark, sf_dir):
    return series_quantiles(_lines(spark, sf_dir), ["zone"], "price")


# --- rankings ---------------------------------------------------------------------------

_METRICS = ("price", "discount")


def _extremes_sql(means: str, partition: str, keys: str) -> str:
    branches = []
    for metric in _METRICS:
        for direction, order in (("highest", "desc"), ("lowest", "asc")):
            branches.append(
                f"""
        select {keys}, price_avg, discount_avg, '{direction}_{metric}' as label, cast(rank as integer) as rank
        from (
            select *, row_number() over ({partition} order by {metric}_avg {order} nulls last, year, month) as rank
            from means
        ) where rank <= 5"""
            )
    return f"with means as ({means})" + " union all ".join(branches)


_EXTREMES_SQL = _extremes_sql(
    """
    select cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month,
           round(avg(l_extendedprice), 6) as price_avg, round(avg(l_discount), 6) as discount_avg
    from lineitem
    group by all
    """,
    "",
    "year, month",
)


@query("ranked_extremes_df", _EXTREMES_SQL)
def ranked_extremes_df(spark, sf_dir):
    means = period_stats(_lines(spark, sf_dir), ["year", "month"], stats=["avg"], by=[])
    return ranked_extremes(
        means, ["price_avg", "discount_avg"], labels={f"{m}_avg": m for m in _METRICS}
    )


@query("ranked_extremes_sql", _EXTREMES_SQL)
def ranked_extremes_by_sql(spark, sf_dir):
    return ranked_extremes_sql({None: _table(spark, sf_dir, "lineitem")}, LINE_SERIES)


_ZONE_EXTREMES_SQL = _extremes_sql(_MONTH_SQL, "partition by zone", "zone, year, month")


@query("ranked_extremes_by_zone", _ZONE_EXTREMES_SQL)
def ranked_extremes_by_zone(spark, sf_dir):
    means = period_stats(_lines(spark, sf_dir), ["year", "month"], stats=["avg"])
    return ranked_extremes(
        means, ["price_avg", "discount_avg"], by=["zone"], labels={f"{m}_avg": m for m in _METRICS}
    )


@query("ranked_extremes_by_zone_sql", _ZONE_EXTREMES_SQL)
def ranked_extremes_by_zone_sql(spark, sf_dir):
    return ranked_extremes_sql({None: _table(spark, sf_dir, "lineitem")}, LINE_SERIES, by=["zone"])


# --- clustering ---------------------------------------------------------------------------


@query("distinct_points", "select count(distinct c_acctbal) as n_distinct from customer")
def distinct_balances(spark, sf_dir):
    return distinct_points(_balances(spark, sf_dir), ["c_acctbal"])


@query(
    "distinct_points_approx",
    """
    select 'all' as part, true as close
    union all select cast(c_nationkey as varchar), true from customer group by c_nationkey
    """,
)
def distinct_points_approx(spark, sf_dir):
    """Whether the merged sketches are within 8 % of the exact numbers, over all and by nation."""
    customers = _table(spark, sf_dir, "customer")
    parts = distinct_sketches(customers.withColumn("day", F.col("c_custkey") % 30), ["c_acctbal", "c_mktsegment"], ["c_nationkey", "day"])
    nations = merged_distinct(parts, ["c_nationkey"]).select(F.col("c_nationkey").cast("string").alias("part"), "n_distinct")
    found = nations.unionByName(merged_distinct(parts).select(F.lit("all").alias("part"), "n_distinct"))
    points = customers.select(F.col("c_nationkey").cast("string").alias("part"), F.array(F.col("c_acctbal").cast("string"), "c_mktsegment").alias("p"))
    exact = points.unionByName(points.withColumn("part", F.lit("all"))).groupBy("part").agg(F.countDistinct("p").alias("n"))
    return found.join(exact, found["part"].eqNullSafe(exact["part"])).select(
        found["part"], (F.abs(F.col("n_distinct") - F.col("n")) <= F.greatest(F.lit(1.0), 0.08 * F.col("n"))).alias("close")
    )


@query(
    "sketch_quantiles",
    """
    select event_type as zone, count(value) as n_rows, true as p25_close, true as p50_close, true as p75_close
    from events group by event_type
    """,
)
def stored_sketch_quantiles(spark, sf_dir):
    """Quartiles by zone from sketches stored by zone and day; whether each lies within 0.5 % of its rank."""
    path = work_path(spark, "sketches")
    events = _events(spark, sf_dir)
    quantile_sketches(events.withColumn("day", F.to_date("ts")), ["zone", "day"], "value").write.parquet(path)
    found = sketch_quantiles(spark.read.parquet(path), ["zone"])
    # the rank that each answer really has among the readings
    met = events.where(F.col("value").isNotNull()).join(F.broadcast(found), "zone")
    ranks = (
        F.struct((F.count_if(F.col("value") < F.col(p)) / F.count(F.lit(1))).alias("low"), (F.count_if(F.col("value") <= F.col(p)) / F.count(F.lit(1))).alias("high")).alias(p)
        for p in ("p25", "p50", "p75")
    )
    placed = met.groupBy("zone", "n_rows").agg(*ranks)
    close = (((F.col(f"{p}.low") <= q + 0.005) & (F.col(f"{p}.high") >= q - 0.005)).alias(f"{p}_close") for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    return placed.select("zone", "n_rows", *close)


@query(
    "cluster_features",
    """
    select c_custkey, round(c_acctbal / (select stddev_samp(c_acctbal) from customer), 6) as balance,
           round(c_nationkey / (select stddev_samp(c_nationkey) from customer), 6) as nation
    from customer
    """,
)
def cluster_features(spark, sf_dir):
    vectors = assemble_features(_table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])
    values = vector_to_array(F.col("features"))
    return scale_features(vectors).select(
        "c_custkey", F.round(values[0], 6).alias("balance"), F.round(values[1], 6).alias("nation")
    )


@query("cluster_sweep")
def cluster_sweep(spark, sf_dir):
    with prepare_points(_balances(spark, sf_dir), ["c_acctbal"], order="value") as points:
        return sweep_k(points).scores


@query("cluster_centers")
def cluster_centers(spark, sf_dir):
    with prepare_points(_balances(spark, sf_dir), ["c_acctbal"], order="value") as points:
        return sweep_k(points).model.centers(spark)


@query("cluster_assign")
def cluster_assign(spark, sf_dir):
    """Every customer with its cluster; k by silhouette over the whole range."""
    return cluster_report(
        _balances(spark, sf_dir), key="c_custkey", feature="c_acctbal", order="value"
    ).orderBy("cluster_id", "c_custkey")


@query("cluster_nations")
def cluster_nations(spark, sf_dir):
    """Nations by the mean balance of their customers, as countries by their yearly value."""
    nations = (
        _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.round(F.avg("c_acctbal"), 2).alias("balance"))
    )
    return cluster_report(nations, key="c_nationkey", feature="balance", order="value").orderBy(
        "cluster_id", "c_nationkey"
    )


@query(
    "cluster_scaling",
    """
    select round(1 / stddev_samp(c_acctbal), 12) as balance, round(1 / stddev_samp(c_nationkey), 12) as nation,
           count(*) as n_rows
    from customer
    """,
)
def cluster_scaling(spark, sf_dir):
    """The factors that every fit uses, from the distinct points with their repeats."""
    customers = _table(spark, sf_dir, "customer")
    with prepare_points(customers, ["c_acctbal", "c_nationkey"], order="value") as points:
        balance, nation = points.factors
        found = spark.createDataFrame([(balance, nation, points.n_rows)], "balance double, nation double, n_rows long")
    return found.select(F.round("balance", 12).alias("balance"), F.round("nation", 12).alias("nation"), "n_rows")


@query(
    "cluster_sweep_bounds",
    """
    select cast(k as integer) as k, true as enough, true as in_range
    from range(2, (select least(30, count(distinct c_acctbal)) from customer) + 1) r(k)
    """,
)
def cluster_sweep_bounds(spark, sf_dir):
    """Every k that the sweep tries, no more clusters than k, scores within their range."""
    return cluster_sweep(spark, sf_dir).select(
        "k", (F.col("n_clusters") <= F.col("k")).alias("enough"), F.col("silhouette").between(-1, 1).alias("in_range")
    )


@query("cluster_assign_check", "select count(*) as n_rows, 0 as not_nearest, 0.0::double as largest_gap from customer")
def cluster_assign_check(spark, sf_dir):
    """Over all customers: rows away from their nearest center, and the largest error of a distance."""
    with prepare_points(_balances(spark, sf_dir), ["c_acctbal"], order="value") as points:
        model = sweep_k(points).model
    assigned = model.assign(_balances(spark, sf_dir))
    held = F.lit([float(c[0]) for c in model.kmeans.clusterCenters()])
    scaled = F.col("c_acctbal") * F.lit(model.factors[0])
    nearest = F.array_min(F.transform(held, lambda c: F.abs(c - scaled)))
    own = F.abs(F.element_at(held, F.col("cluster_id") + 1) - scaled)
    gap = F.abs(F.round(F.abs(F.col("c_acctbal") - F.col("center_c_acctbal")), 2) - F.col("distance_from_center"))
    return assigned.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(own > nearest + 1e-12, 1)).cast("int").alias("not_nearest"),
        F.round(F.max(gap), 6).alias("largest_gap"),
    )


@query("cluster_centers_check", "select 0 as away_from_mean, 0 as without_members")
def cluster_centers_check(spark, sf_dir):
    """Centers that are not the mean of their members, within a hundredth of a deviation, or have none.

    A fit may stop at its limit of rounds before the last centers have settled.
    """
    with prepare_points(_balances(spark, sf_dir), ["c_acctbal"], order="value") as points:
        model = sweep_k(points).model
    means = model.predict(_balances(spark, sf_dir)).groupBy("cluster_id").agg(F.avg("c_acctbal").alias("mean"))
    joined = model.centers(spark).join(means, "cluster_id", "left")
    away = F.abs(F.col("center_c_acctbal") - F.col("mean")) * F.lit(model.factors[0]) > 0.01
    return joined.agg(
        F.count(F.when(away, 1)).cast("int").alias("away_from_mean"),
        F.count(F.when(F.col("mean").isNull(), 1)).cast("int").alias("without_members"),
    )


@query(
    "center_lookup",
    """
    with centers as (
        select c_nationkey, avg(c_acctbal) as center from customer where c_nationkey % 5 > 0 group by c_nationkey
    ),
    located as (
        select c_custkey, c_acctbal, c.c_nationkey as cluster_id,
               round(coalesce(center, 0)::varchar::decimal(38, 20), 2)::double as center_c_acctbal
        from customer c left join centers using (c_nationkey)
    )
    select *, round(abs(c_acctbal - center_c_acctbal)::varchar::decimal(38, 20), 2)::double as distance_from_center
    from located
    """,
)
def center_lookup(spark, sf_dir):
    """Nations as clusters: the distance of each customer to its nation's mean, some nations having none."""
    customers = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").alias("cluster_id")
    )
    centers = (
        customers.where(F.col("cluster_id") % 5 > 0)
        .groupBy("cluster_id")
        .agg(F.avg("c_acctbal").alias("center_c_acctbal"))
    )
    return distance_to_center(customers, centers, ["c_acctbal"])


@query(
    "cluster_silhouette",
    """
    with points as (
        select c_custkey as id, c_mktsegment as c, c_acctbal / 1000.0 as x, c_nationkey / 10.0 as y from customer
    ),
    clusters as (
        select c, count(*) as n, avg(x * x + y * y) as norm, avg(x) as mx, avg(y) as my from points group by c
    ),
    distances as (
        select p.id, p.c = k.c as own, k.n,
               p.x * p.x + p.y * p.y + k.norm - 2 * (p.x * k.mx + p.y * k.my) as d
        from points p, clusters k
    ),
    scored as (
        select id, max(case when own then d * n / (n - 1) end) as a, min(case when not own then d end) as b
        from distances group by id
    )
    select cast((select count(*) from clusters) as integer) as n_clusters,
           round(avg((b - a) / greatest(a, b)), 6) as silhouette
    from scored
    """,
)
def cluster_silhouette(spark, sf_dir):
    """Market segments scored as a clustering of the customers."""
    points = _table(spark, sf_dir, "customer").select(
        "c_mktsegment", (F.col("c_acctbal") / 1000.0).alias("x"), (F.col("c_nationkey") / 10.0).alias("y")
    )
    return silhouette(points, ["x", "y"], "c_mktsegment").withColumn("silhouette", F.round("silhouette", 6))


@query(
    "cluster_profile",
    """
    select l_linenumber as cluster_id, count(*) as n, min(l_extendedprice) as min,
           round(avg(l_extendedprice), 6) as mean, max(l_extendedprice) as max
    from lineitem
    group by l_linenumber
    """,
)
def cluster_profiles(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "cluster_id")
    return cluster_profile(lines, "l_extendedprice")


# --- sinks and run log -----------------------------------------------------------------


@query("sink_roundtrip", _YEAR_SQL)
def sink_roundtrip(spark, sf_dir):
    report = period_stats(_lines(spark, sf_dir), ["year"])
    path = write_result(report, work_path(spark, "report"), order_by=["zone", "year"], single_file=True)
    return spark.read.schema(report.schema).option("header", True).csv(path)


_REPORT_LINES_SQL = f"""
    select 'by_year' as result, count(*) as lines, count(*) - 1 as records
    from (select 1 union all select 1 from ({_YEAR_SQL}))
    union all
    select 'by_month', count(*), count(*) - 1 from (select 1 union all select 1 from ({_MONTH_SQL}))
"""


@query("collect_results", _REPORT_LINES_SQL)
def collect_report_lines(spark, sf_dir):
    """Reports written in folders of one root, collected by name, with their number of lines."""
    root = work_path(spark, "results")
    series = _lines(spark, sf_dir)
    write_result(period_stats(series, ["year"]), f"{root}/by_year", single_file=True)
    write_result(period_stats(series, ["year", "month"], stats=["avg"]), f"{root}/nested/by_month", single_file=True)
    return (
        collect_results(spark, root)
        .groupBy("result")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(F.when(~F.col("line").startswith("zone,"), 1)).alias("records"),
        )
    )


@query("export_roundtrip", _REPORT_LINES_SQL)
def export_roundtrip(spark, sf_dir):
    """Collected reports exported as text, read back by result."""
    root, exported = work_path(spark, "results"), work_path(spark, "exported")
    series = _lines(spark, sf_dir)
    write_result(period_stats(series, ["year"]), f"{root}/by_year", single_file=True)
    write_result(period_stats(series, ["year", "month"], stats=["avg"]), f"{root}/by_month", single_file=True)
    export_results(collect_results(spark, root), exported)
    return (
        spark.read.text(exported)
        .groupBy("result")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(F.when(~F.col("value").startswith("zone,"), 1)).alias("records"),
        )
    )


@query(
    "run_log_append",
    """
    with runs as (
        select c_mktsegment as query_id, c_nationkey as run_id, max(c_acctbal) / 7 as seconds
        from customer group by all
    ),
    kept as (
        select *, row_number() over (partition by query_id order by run_id) as i,
               count(*) over (partition by query_id) as n
        from runs
    )
    select query_id, 'DF' as query_type, cast(count(*) as integer) as num_runs, round(avg(seconds), 4) as time_avg,
           round(min(seconds), 4) as time_min, round(max(seconds), 4) as time_max,
           round(stddev_samp(seconds), 4) as std_dev
    from kept where i > 1 or n = 1 group by query_id
    """,
)
def run_log_append(spark, sf_dir):
    """Segments as queries and nations as their runs, logged in two appends and summed up."""
    runs = (
        _table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment", "c_nationkey")
        .agg((F.max("c_acctbal") / 7).alias("seconds"))
    )
    # as many rows as segments x nations
    measured = [
        {
            "query_id": r["c_mktsegment"],
            "query_type": "DF",
            "run_id": r["c_nationkey"],
            "started_at": dt.datetime(2024, 1, 1) + dt.timedelta(hours=r["c_nationkey"]),
            "seconds": r["seconds"],
            "succeeded": True,
        }
        for r in runs.collect()
    ]
    path = work_path(spark, "run-log")
    for part in (measured[::2], measured[1::2]):
        append_runs(run_log(spark, part), path)
    return run_summary(spark.read.parquet(path))


def _event_runs(spark, sf_dir) -> DataFrame:
    """Events as benchmark runs: type = query, value = seconds, some failed."""
    return _raw_events(spark, sf_dir).select(
        F.col("event_type").alias("query_id"),
        F.when(F.col("user_id") % 2 == 0, "DF").otherwise("SQL").alias("query_type"),
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("started_at"),
        F.col("value").alias("seconds"),
        (F.col("k").cast("int") % 10 != 0).alias("succeeded"),
    )


_RUNS_SQL = """
    with runs as (
        select event_type as query_id, case when user_id % 2 = 0 then 'DF' else 'SQL' end as query_type,
               event_id as run_id, ts as started_at, value as seconds,
               cast(props::json->>'k' as integer) % 10 <> 0 as succeeded
        from events
    ),
    numbered as (
        select *, row_number() over (partition by query_id, query_type order by started_at, run_id) as i,
               count(*) over (partition by query_id, query_type) as n
        from runs where succeeded
    )
    select query_id, query_type, cast(count(*) as integer) as num_runs, round(avg(seconds), 4) as time_avg,
           round(min(seconds), 4) as time_min, round(max(seconds), 4) as time_max,
           round(stddev_samp(seconds), 4) as std_dev
    from numbered where i > 1 or n = 1
    group by query_id, query_type
"""


@query("run_summary", _RUNS_SQL)
def run_summaries(spark, sf_dir):
    return run_summary(_event_runs(spark, sf_dir))


@query("run_consolidate", _RUNS_SQL)
def run_consolidation(spark, sf_dir):
    """Run statistics written per query type among other results, gathered again in one table."""
    root = work_path(spark, "runs")
    write_result(run_summary(_event_runs(spark, sf_dir)), f"{root}/summary", fmt="parquet")
    summary = spark.read.parquet(f"{root}/summary")
    for query_type in ("DF", "SQL"):
        mine = summary.where(F.col("query_type") == query_type)
        write_result(published_summary(mine), f"{root}/{query_type}/evaluation_{query_type}", mode="append", single_file=True)
    write_result(summary, f"{root}/evaluation_other_header", single_file=True)
    table = write_result(consolidate_runs(collect_results(spark, root)), work_path(spark, "all-runs"), fmt="parquet")
    gathered = spark.read.parquet(table)
    # The published times are single precision; four digits bring back the doubles.
    numbers = gathered.toDF(*summary.columns)
    times = ["time_avg", "time_min", "time_max", "std_dev"]
    return numbers.withColumns({c: F.round(F.col(c).cast("string").cast("double"), 4) for c in times})
