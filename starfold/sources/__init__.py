"""Reading warehouse tables and CSV; writing the CSV extract and the partitioned mart."""

from starfold.sources.buckets import write_bucketed
from starfold.sources.deltas import DeltaMart
from starfold.sources.extract import export_csv, failed_values, read_csv, read_reporting_csv, sort_out_csv
from starfold.sources.mart import latest_partition, read_mart, write_mart
from starfold.sources.shared import shared_folder
from starfold.sources.warehouse import open_warehouse, require_tables

__all__ = [
    "DeltaMart", "export_csv", "failed_values", "latest_partition", "open_warehouse", "read_csv",
    "read_mart", "read_reporting_csv", "require_tables", "shared_folder", "sort_out_csv",
    "write_bucketed", "write_mart",
]
