"""The series reports as parameterised SQL text over raw tables.

Each function takes ``{zone: raw frame}`` (``{None: frame}`` when the zone is a
column of it) and builds one statement. Values go in as parameters and frames by
reference; only column names are spliced in, quoted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from metricspark.functions.columns import quote
from metricspark.functions.temporal import PERIOD_PARTS
from metricspark.operators.quantiles import QUARTILES, quantile_name
from metricspark.operators.ranking import DIRECTIONS
from metricspark.operators.stats import STATS
from metricspark.sources.series import require_columns
from metricspark.spec import FAILFAST, SeriesSpec

Zones = Mapping[str | None, DataFrame]


@dataclass(frozen=True)
class Rows:
    """Which readings count: of some zones, from ``start`` (inclusive) to ``end`` (exclusive), with a readable time."""

    zones: Sequence[str] | None = None
    start: str | None = None
    end: str | None = None
    drop_invalid: bool = False

    def where(self, values: dict) -> str:
        tests = []
        if self.zones is not None:
            names = {f"only{i}": zone for i, zone in enumerate(self.zones)}
            values |= names
            tests.append(f"zone IN ({', '.join(f':{n}' for n in names)})" if names else "false")
        for bound, sign in ((self.start, ">="), (self.end, "<")):
            if bound is not None:
                values[f"time{len(tests)}"] = bound
                tests.append(f"ts {sign} CAST(:time{len(tests)} AS TIMESTAMP)")
        if self.drop_invalid:
            tests.append("ts IS NOT NULL")
        return " WHERE " + " AND ".join(tests) if tests else ""


ALL_ROWS = Rows()


def _strict(parsed: str, raw: str, what: str) -> str:
    message = f"concat('not a {what}: ', CAST({raw} AS STRING))"
    return f"CASE WHEN {raw} IS NOT NULL AND {parsed} IS NULL THEN raise_error({message}) ELSE {parsed} END"


def _run(zones: Zones, spec: SeriesSpec, body: str, args: Mapping, rows: Rows = ALL_ROWS) -> DataFrame:
    """Run ``body`` with the union of all zones in scope as the CTE ``series``.

    A spec with ``mode="failfast"`` raises on the first time or number that cannot be read.
    """
    strict = spec.mode == FAILFAST
    selects, frames, values = [], {}, dict(args)
    for i, (zone, frame) in enumerate(zones.items()):
        require_columns(frame, spec.required)
        frames[f"raw{i}"] = frame
        if zone is None:
            zone_sql = quote(spec.zone_col)
        else:
            zone_sql, values[f"zone{i}"] = f":zone{i}", zone
        if spec.time_format is None:
            time_sql = quote(spec.time_col)
        else:
            time_sql = f"try_to_timestamp(CAST({quote(spec.time_col)} AS STRING), :time_format)"
            values["time_format"] = spec.time_format
            time_sql = _strict(time_sql, quote(spec.time_col), "time") if strict else time_sql
        numbers = {m: (f"TRY_CAST({quote(c)} AS DOUBLE)", quote(c)) for m, c in spec.metrics.items()}
        metrics = "".join(f", {_strict(n, c, 'number') if strict else n} AS {quote(m)}" for m, (n, c) in numbers.items())
        selects.append(f"SELECT {zone_sql} AS zone, {time_sql} AS ts{metrics} FROM {{raw{i}}}")
    spark: SparkSession = next(iter(zones.values())).sparkSession
    union = "\n  UNION ALL\n  ".join(selects)
    text = f"WITH readings AS (\n  {union}\n),\nseries AS (\n  SELECT * FROM readings{rows.where(values)}\n)" + body
    return spark.sql(text, args=values, **frames)


def _grouped(
    spec: SeriesSpec, parts: Sequence[str], stats: Sequence[str], by: Sequence[str], name: str
) -> str:
    """Group by expression, not by alias: a raw column may be called ``year`` too."""
    keys = [*by, *(f"{p}(ts)" for p in parts)]
    if any(p not in PERIOD_PARTS for p in parts) or any(s not in STATS for s in stats):
        raise ValueError(f"unknown period parts or statistics in {parts}, {stats}")
    named = [*by, *(f"{p}(ts) AS {p}" for p in parts)]
    for metric in spec.metrics:
        for stat in stats:
            value = f"{stat}({quote(metric)})"
            value = f"round({value}, :digits)" if stat == "avg" else value
            named.append(f"{value} AS {quote(name.format(metric=metric, stat=stat))}")
    return f"SELECT {', '.join(named)}\n  FROM series\n  GROUP BY {', '.join(keys)}"


def period_stats_sql(
    zones: Zones,
    spec: SeriesSpec,
    parts: Sequence[str],
    *,
    stats: Sequence[str] = ("avg", "min", "max"),
    by: Sequence[str] = ("zone",),
    digits: int = 6,
    name: str = "{metric}_{stat}",
    rows: Rows = ALL_ROWS,
) -> DataFrame:
    return _run(zones, spec, "\n" + _grouped(spec, parts, stats, by, name), {"digits": digits}, rows)


def diurnal_profile_sql(zones: Zones, spec: SeriesSpec, *, digits: int = 6, rows: Rows = ALL_ROWS) -> DataFrame:
    return period_stats_sql(zones, spec, ["hour"], stats=["avg"], digits=digits, name="{metric}", rows=rows)


def diurnal_quantiles_sql(
    zones: Zones, spec: SeriesSpec, *, probs: Sequence[float] = QUARTILES, digits: int = 6, rows: Rows = ALL_ROWS
) -> DataFrame:
    metrics = ", ".join(quote(m) for m in spec.metrics)
    quantiles = ",\n       ".join(
        f"round(percentile(value, :p{i}), :digits) AS {quote(quantile_name(p))}" for i, p in enumerate(probs)
    )
    body = f""",
profile AS (
  {_grouped(spec, ["hour"], ["avg"], ["zone"], "{metric}")}
),
long AS (
  SELECT zone, metric, value FROM profile UNPIVOT INCLUDE NULLS (value FOR metric IN ({metrics}))
)
SELECT zone, metric, min(value) AS min,
       {quantiles},
       max(value) AS max
FROM long
GROUP BY zone, metric"""
    return _run(zones, spec, body, {"digits": digits, **{f"p{i}": float(p) for i, p in enumerate(probs)}}, rows)


def ranked_extremes_sql(
    zones: Zones,
    spec: SeriesSpec,
    parts: Sequence[str] = ("year", "month"),
    *,
    k: int = 5,
    digits: int = 6,
    by: Sequence[str] = (),
    name: str = "{metric}_avg",
    nulls: str = "last",
    rows: Rows = ALL_ROWS,
) -> DataFrame:
    """Period means and their labelled extremes; ties go to the earlier period.

    Nulls rank last; ``nulls="spark"`` puts them first in the ``lowest`` lists.
    """
    if nulls not in ("last", "spark"):
        raise ValueError(f"unknown null order {nulls!r}")
    over = f"PARTITION BY {', '.join(by)} " if by else ""
    ties = ", ".join(f"{p} ASC NULLS LAST" for p in parts)
    lists, args = [], {"digits": digits, "k": k}
    for i, metric in enumerate(spec.metrics):
        value = quote(name.format(metric=metric))
        for direction, order in zip(DIRECTIONS, ("DESC", "ASC"), strict=True):
            label = f"label_{direction}{i}"
            args[label] = f"{direction}_{metric}"
            place = "FIRST" if nulls == "spark" and order == "ASC" else "LAST"
            ordering = f"{value} {order} NULLS {place}, {ties}"
            if by:
                ranked = f"SELECT *, row_number() OVER ({over}ORDER BY {ordering}) AS rank FROM means"
                lists.append(f"SELECT * EXCEPT (rank), :{label} AS label, rank FROM ({ranked}) WHERE rank <= :k")
            else:
                top = f"SELECT *, :{label} AS label FROM means ORDER BY {ordering} LIMIT :k"
                lists.append(
                    f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY {ordering}) AS rank FROM ({top})"
                )
    union = "\nUNION ALL\n".join(lists)
    body = f",\nmeans AS (\n  {_grouped(spec, parts, ['avg'], by, name)}\n)\n{union}"
    return _run(zones, spec, body, args, rows)
