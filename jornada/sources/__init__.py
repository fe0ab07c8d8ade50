"""Sources: raw delimited text (per day, backfill, legacy layout) and curated tables."""

from .raw import (DELIMITER, csv_reader, date_range, scan_curated, scan_legacy_backfill,
                  scan_raw, scan_raw_backfill, scan_raw_day, scan_raw_days, scan_table)

__all__ = ["DELIMITER", "csv_reader", "date_range", "scan_curated", "scan_legacy_backfill",
           "scan_raw", "scan_raw_backfill", "scan_raw_day", "scan_raw_days", "scan_table"]
