"""DataFrame -> DataFrame operators: curation steps, predicates, landing."""

from .filters import all_of, energy_is, is_empty, kind_is, on_day, price_above
from .landing import land, landing_report, list_drop, parse_batch_date, route
from .transforms import (add_partition_columns, add_surrogate_key, cast_columns,
                         curate_frame, fill_zero, row_key,
                         surrogate_key, upper_column, upper_columns)

__all__ = [
    "add_partition_columns", "add_surrogate_key", "all_of", "cast_columns", "curate_frame",
    "energy_is", "fill_zero", "is_empty", "kind_is", "land", "landing_report", "list_drop",
    "on_day", "parse_batch_date", "price_above", "route", "row_key",
    "surrogate_key", "upper_column", "upper_columns",
]
