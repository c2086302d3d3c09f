from urbanstats.sources.csv_files import read_csv, read_csv_by_name, rejected_lines
from urbanstats.sources.features import feature_properties, read_features
from urbanstats.sources.scratch import scratch_path
from urbanstats.sources.sinks import csv_to_parquet, preview, write_csv

__all__ = [
    "csv_to_parquet",
    "feature_properties",
    "preview",
    "read_csv",
    "read_csv_by_name",
    "read_features",
    "rejected_lines",
    "scratch_path",
    "write_csv",
]
