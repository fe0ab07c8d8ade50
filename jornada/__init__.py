"""jornada: daily curation of dated delimited files into partitioned tables on Spark.

Every step is a DataFrame -> DataFrame function built from Spark's own
expressions, driven by a declarative :class:`TableSpec` per dataset.
"""

from .config import BatchDate, Zone, catalog_database, normalize_env, table_options
from .spec import CUSTOMERS, DATASETS, PROVIDERS, TRANSACTIONS, TableSpec, spec_for

__all__ = ["BatchDate", "CUSTOMERS", "DATASETS", "PROVIDERS", "TRANSACTIONS", "TableSpec",
           "Zone", "catalog_database", "normalize_env", "spec_for", "table_options"]
