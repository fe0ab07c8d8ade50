"""Plans: whole jobs and the saved query, composed from operators."""

from .jobs import CurateResult, curate, curate_all, curate_backfill, land_drop
from .queries import (HYDRO_COLUMNS, HYDRO_SALES_SQL, hydro_sales, hydro_sales_sql)

__all__ = ["CurateResult", "HYDRO_COLUMNS", "HYDRO_SALES_SQL", "curate", "curate_all", "curate_backfill",
           "hydro_sales", "hydro_sales_sql", "land_drop"]
