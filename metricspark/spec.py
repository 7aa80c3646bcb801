"""Descriptions of the input tables, so that no operator hard-codes a column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

PERMISSIVE = "permissive"
FAILFAST = "failfast"


@dataclass(frozen=True)
class SeriesSpec:
    """How to read a series out of a raw table.

    ``metrics`` maps the output metric name to the raw column. ``time_format``
    is the pattern of a text time column, or ``None`` when the column already is
    a timestamp. ``zone_col`` is the raw zone column, or ``None`` when the zone
    is known from which dataset is read. ``mode`` says what an unreadable time
    or number becomes: a null (``permissive``) or an error (``failfast``).
    """

    time_col: str
    metrics: Mapping[str, str]
    time_format: str | None = None
    zone_col: str | None = None
    mode: str = PERMISSIVE

    def __post_init__(self) -> None:
        if self.mode not in (PERMISSIVE, FAILFAST):
            raise ValueError(f"unknown mode {self.mode!r}")

    @property
    def required(self) -> list[str]:
        zone = [self.zone_col] if self.zone_col else []
        return [*zone, self.time_col, *self.metrics.values()]


@dataclass(frozen=True)
class PointSpec:
    """How to read per-entity points: a key column and numeric features."""

    key_col: str
    features: Mapping[str, str]
    key_name: str = "key"
    mode: str = PERMISSIVE

    @property
    def required(self) -> list[str]:
        return [self.key_col, *self.features.values()]


# Column names and time pattern of the published electricity
# datasets (hourly readings per zone, yearly values per country).
ELECTRICITY_HOURLY = SeriesSpec(
    time_col="Datetime__UTC_",
    metrics={
        "carbon": "Carbon_intensity_gCO_eq_kWh__direct_",
        "cfe": "Carbon_free_energy_percentage__CFE__",
    },
    time_format="yyyy-MM-dd HH:mm:ss",
)
ELECTRICITY_YEARLY = PointSpec(
    key_col="Country",
    key_name="country",
    features={"carbon-intensity": "Carbon intensity gCO₂eq/kWh (direct)"},
)
