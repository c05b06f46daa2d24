"""Readers and writers."""
from clickrev.sources.readers import read_all_hits, read_hits_tsv, read_product_level
from clickrev.sources.writers import publish_report, report_file_name, write_csv, write_parquet

__all__ = [
    "publish_report",
    "read_all_hits",
    "read_hits_tsv",
    "read_product_level",
    "report_file_name",
    "write_csv",
    "write_parquet",
]
