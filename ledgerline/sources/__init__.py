"""Sources: report pages (JSON), Parquet, inline rows, driver-table fixtures."""

from ledgerline.sources.report import (
    flat_driver_report, land_documents, land_driver_fetches, land_driver_report, land_pages, read_report,
)
from ledgerline.sources.tables import inline_rows, read_parquet

__all__ = [
    "flat_driver_report", "inline_rows", "land_documents", "land_driver_fetches", "land_driver_report", "land_pages",
    "read_parquet", "read_report",
]
