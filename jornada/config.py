"""Job parameters: batch date, zone naming and table options.

Driver-side plumbing only; no data work happens here.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from .spec import PARTITION_COLUMNS, TableSpec

# Naming parts of buckets and catalog databases.
COUNTRY = "co"
CAPACITY = "energy"
DOMAIN = "marketer"

_EIGHT_DIGITS = re.compile(r"^[0-9]{8}$")


@dataclass(frozen=True)
class BatchDate:
    """A process date ``yyyyMMdd``: exactly eight digits and a real calendar day."""

    text: str

    def __post_init__(self):
        if not isinstance(self.text, str) or not _EIGHT_DIGITS.match(self.text):
            raise ValueError(f"process date must be yyyyMMdd (8 digits), got {self.text!r}")
        try:
            _dt.datetime.strptime(self.text, "%Y%m%d")
        except ValueError as exc:
            raise ValueError(f"process date is not a calendar day: {self.text!r}") from exc

    @property
    def year(self) -> str:
        return self.text[:4]

    @property
    def month(self) -> str:
        return self.text[4:6]

    @property
    def day(self) -> str:
        return self.text[6:8]

    def partition(self) -> dict[str, str]:
        return dict(zip(PARTITION_COLUMNS, (self.year, self.month, self.day)))

    def __str__(self) -> str:
        return self.text


def normalize_env(env: str) -> str:
    """``qa`` is spelled ``qc`` in every name; other environments pass through."""
    return "qc" if env == "qa" else env


def bucket_name(zone: str, account: str, env: str) -> str:
    """Bucket naming rule: ``<country>-<capacity>-<domain>-<zone>-<account>-<env>``."""
    return f"{COUNTRY}-{CAPACITY}-{DOMAIN}-{zone}-{account}-{normalize_env(env)}"


def catalog_database(env: str) -> str:
    return f"{COUNTRY}_{CAPACITY}_{DOMAIN}_curated_{normalize_env(env)}_rl"


@dataclass(frozen=True)
class Zone:
    """Where raw and curated data live for one environment.

    ``raw_root`` and ``curated_root`` are any Hadoop-compatible URIs (a shared
    file system on a cluster, a local folder in tests).
    """

    raw_root: str
    curated_root: str
    env: str = "pdn"

    @classmethod
    def named(cls, account: str, env: str, scheme: str = "s3a") -> "Zone":
        return cls(
            raw_root=f"{scheme}://{bucket_name('raw', account, env)}",
            curated_root=f"{scheme}://{bucket_name('curated', account, env)}",
            env=normalize_env(env),
        )

    @property
    def database(self) -> str:
        return catalog_database(self.env)

    def raw_dataset_path(self, spec: TableSpec) -> str:
        return f"{self.raw_root.rstrip('/')}/{spec.name}"

    def raw_day_path(self, spec: TableSpec, batch: BatchDate) -> str:
        """Raw zone folder of one dataset and day (hive-style date folders)."""
        return (f"{self.raw_dataset_path(spec)}/year={batch.year}"
                f"/month={batch.month}/day={batch.day}")

    def legacy_raw_file(self, spec: TableSpec, batch: BatchDate) -> str:
        """Per-file raw layout ``<Dataset>/yyyy/MM/dd/<Dataset>_yyyyMMdd.csv``."""
        return (f"{self.raw_dataset_path(spec)}/{batch.year}/{batch.month}/{batch.day}"
                f"/{spec.name}_{batch.text}.csv")

    def curated_path(self, spec: TableSpec) -> str:
        return f"{self.curated_root.rstrip('/')}/table-catalog/{spec.table}"

    def table_name(self, spec: TableSpec) -> str:
        return f"`{self.database}`.`{spec.table}`"


def table_options(database: str, table: str) -> dict[str, str]:
    """Write options for a keyed, partitioned, catalog-synced Hudi table.

    Passed through unchanged when the sink format is ``hudi``; the parquet sink
    ignores them and gets the same effect from ``partitionBy``/append/catalog sync.
    """
    name = table.lower()
    # Hudi option keys and values of the curated tables.
    return {
        "hoodie.table.name": name,
        "hoodie.datasource.write.storage.type": "COPY_ON_WRITE",
        "hoodie.datasource.write.operation": "bulk_insert",
        "hoodie.datasource.write.recordkey.field": "primary_key",
        "hoodie.datasource.write.precombine.field": "primary_key",
        "hoodie.datasource.write.hive_style_partitioning": "true",
        "hoodie.metadata.enable": "false",
        "hoodie.datasource.hive_sync.enable": "true",
        "hoodie.datasource.hive_sync.database": database,
        "hoodie.datasource.hive_sync.table": name,
        "hoodie.datasource.hive_sync.support_timestamp": "true",
        "hoodie.datasource.hive_sync.partition_extractor_class":
            "org.apache.hudi.hive.MultiPartKeysValueExtractor",
        "hoodie.datasource.hive_sync.use_jdbc": "false",
        "hoodie.datasource.hive_sync.mode": "hms",
        "mode": "append",
        "hoodie.datasource.hive_sync.partition_fields": "year,month,day",
        "hoodie.datasource.write.partitionpath.field": "year,month,day",
    }
