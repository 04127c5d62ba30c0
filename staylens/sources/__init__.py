"""Batch readers and writers."""

from staylens.sources.csv_files import CsvRows, read_csv_folder
from staylens.sources.tables import read_bookings, read_features, read_table, register
from staylens.sources.sinks import replace_partitions, write_bucketed, write_csv, write_parquet

__all__ = [
    "CsvRows", "read_bookings", "read_csv_folder", "read_features", "read_table", "register", "replace_partitions",
    "write_bucketed", "write_csv", "write_parquet",
]
