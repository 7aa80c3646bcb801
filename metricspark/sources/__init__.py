from metricspark.sources.catalogue import dataset_names, published_names, read_catalogue
from metricspark.sources.ingest import (
    clean,
    csv_to_parquet,
    kept_records,
    merge,
    merge_latest,
    normalise_names,
    rejected_records,
    split_records,
    write_zoned,
)
from metricspark.sources.points import points_of, read_points
from metricspark.sources.series import read_series, register_view, require_columns, series_of, union_zones

__all__ = [
    "clean",
    "csv_to_parquet",
    "dataset_names",
    "kept_records",
    "merge",
    "merge_latest",
    "normalise_names",
    "points_of",
    "published_names",
    "read_catalogue",
    "read_points",
    "read_series",
    "register_view",
    "rejected_records",
    "require_columns",
    "series_of",
    "split_records",
    "union_zones",
    "write_zoned",
]
