"""Raw inputs derived from the shared test tables (see FIXTURES.md, section 4).

These build raw text frames and stage them as delimited files with Spark's own
writers, so every test and registered query reads data whose size follows
the tables'.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import BatchDate, Zone
from .sources.raw import DELIMITER
from .spec import CUSTOMERS, PARTITION_COLUMNS, TRANSACTIONS, TableSpec

FLAGSHIP_DATE = BatchDate("20231204")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_name").alias("nombre_proveedor"),
        F.expr("CASE s_nationkey % 3 WHEN 0 THEN 'hidroelectrica' WHEN 1 THEN 'solar' "
               "ELSE 'eolica' END").alias("tipo_energia"))


def _customer_columns() -> list:
    return [
        F.expr("CASE c_custkey % 2 WHEN 0 THEN 'CC' ELSE 'NIT' END").alias("tipo_identificacion"),
        F.col("c_custkey").cast("string").alias("identificacion"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("ciudad"),
    ]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(*_customer_columns())


def customers_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers with a column that the dataset doesn't name."""
    return table(spark, sf_dir, "customer").select(*_customer_columns(), F.col("c_nationkey").cast("string").alias("Pais"))


def _transaction_columns() -> list:
    return [
        F.expr("CASE WHEN l_returnflag = 'R' THEN 'compra' ELSE 'venta' END")
         .alias("tipo_transaccion"),
        F.concat(F.lit("proveedor "), F.col("l_suppkey").cast("string")).alias("nombre"),
        F.col("l_quantity").cast("string").alias("cantidad_comprada"),
        F.expr("CASE WHEN l_linenumber % 5 = 0 THEN NULL "
               "ELSE CAST(l_extendedprice AS STRING) END").alias("precio"),
        F.expr("CASE WHEN l_linestatus = 'O' THEN 'hidroelectrica' ELSE 'solar' END")
         .alias("tipo_energia"),
    ]


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; line numbers divisible by 5 carry no price."""
    return table(spark, sf_dir, "lineitem").select(*_transaction_columns())


def dated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions over 30 days (one per event); error events carry no price."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("tipo_transaccion"),
        F.col("user_id").cast("string").alias("nombre"),
        F.col("event_id").cast("string").alias("cantidad_comprada"),
        F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS STRING) END")
         .alias("precio"),
        F.expr("CASE WHEN user_id % 2 = 0 THEN 'hidroelectrica' ELSE 'solar' END")
         .alias("tipo_energia"),
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"))


def monthly_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line-item transactions, dated by the first day of their ship month."""
    month = F.trunc("l_shipdate", "MM")
    return table(spark, sf_dir, "lineitem").select(
        *_transaction_columns(),
        F.date_format(month, "yyyy").alias("year"),
        F.date_format(month, "MM").alias("month"),
        F.date_format(month, "dd").alias("day"))


def _csv_writer(df: DataFrame):
    return df.write.option("header", "true").option("delimiter", DELIMITER)


def stage_raw_day(df: DataFrame, zone: Zone, spec: TableSpec, batch: BatchDate) -> str:
    """Write one day's raw rows into the raw zone folder of that day."""
    path = zone.raw_day_path(spec, batch)
    _csv_writer(df.select(*spec.columns)).mode("overwrite").csv(path)
    return path


def stage_raw_zone(df: DataFrame, zone: Zone, spec: TableSpec) -> str:
    """Write many days' raw rows (with year/month/day columns) in one job."""
    path = zone.raw_dataset_path(spec)
    (_csv_writer(df.select(*spec.columns, *PARTITION_COLUMNS)).mode("overwrite")
     .partitionBy(*PARTITION_COLUMNS).csv(path))
    return path


def stage_legacy_days(df: DataFrame, raw_root: str, spec: TableSpec) -> list[str]:
    """Write each day's rows to the per-file layout
    ``<Dataset>/yyyy/MM/dd/<Dataset>_yyyyMMdd.csv`` (one write per day, in parallel)."""
    day = F.concat(*PARTITION_COLUMNS)
    days = [r.d for r in df.select(day.alias("d")).distinct().collect()]
    root = raw_root.rstrip("/")

    def write(d: str) -> str:
        path = f"{root}/{spec.name}/{d[:4]}/{d[4:6]}/{d[6:]}/{spec.name}_{d}.csv"
        _csv_writer(df.where(day == d).select(*spec.columns)).mode("overwrite").csv(path)
        return path

    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(write, days))


def stage_object(df: DataFrame, drop_dir: str, name: str) -> str:
    """One drop object (a folder of part files, each with a header line)."""
    path = f"{drop_dir.rstrip('/')}/{name}"
    _csv_writer(df).mode("overwrite").csv(path)
    return path


def stage_lines(lines: DataFrame, header: str, drop_dir: str, name: str) -> str:
    """One drop object from ready-made text lines (used for malformed rows).

    Every part file starts with the header line, as a CSV writer would do.
    """
    path = f"{drop_dir.rstrip('/')}/{name}"
    # One column named like the header line, without quotes or a delimiter of its own.
    (lines.select(F.col("value").alias(header)).write.mode("overwrite").option("header", "true")
     .option("sep", "\u0001").option("quote", "").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


def stage_drop(spark: SparkSession, sf_dir: str, drop_dir: str) -> dict[str, str]:
    """A drop folder: one Transactions object per event day, providers and
    customers for 2023-12-04, objects with bad names, an unknown dataset, one
    customers object with surplus fields, one with missing fields, one with its
    columns reordered, one without one of them, one with a further one, one with
    quotes inside fields and lines of spaces, and one without a byte."""
    dated = dated_transactions(spark, sf_dir)
    providers = raw_providers(spark, sf_dir)
    customers = raw_customers(spark, sf_dir)
    days = [r.d for r in dated.select(F.concat(*PARTITION_COLUMNS).alias("d"))
            .distinct().collect()]
    jobs = {f"Transactions_{d}.csv": dated.where(F.concat(*PARTITION_COLUMNS) == d)
            .select(*TRANSACTIONS.columns) for d in days}
    for name in ("Providers_20231204.csv", "Providers_20231204_v2.csv", "bad.csv",
                 "Providers_20231304.csv", "Providers_20230229.csv", "Providers_2023124.csv",
                 "Ventas_20231204.csv"):
        jobs[name] = providers
    jobs["Customers_20231204.csv"] = customers
    # Same rows, columns in another order: they go by name.
    jobs["Customers_20231207.csv"] = customers.select(*reversed(CUSTOMERS.columns))
    jobs["Customers_20231208.csv"] = customers.select(*CUSTOMERS.columns[:-1])
    jobs["Customers_20231209.csv"] = customers_with_segment(spark, sf_dir)
    header = DELIMITER.join(CUSTOMERS.columns)
    cust = table(spark, sf_dir, "customer").select(
        (F.col("c_acctbal") < 0).alias("negative"), *_customer_columns())
    full = F.concat_ws(DELIMITER, *CUSTOMERS.columns)
    # Customers with a negative balance get a surplus field in one object and
    # lose their last field in the other.
    long_lines = cust.select(F.when(
        F.col("negative"), F.concat_ws(DELIMITER, *CUSTOMERS.columns, "identificacion"))
        .otherwise(full).alias("value"))
    short_lines = cust.select(F.when(
        F.col("negative"), F.concat_ws(DELIMITER, *CUSTOMERS.columns[:-1]))
        .otherwise(full).alias("value"))

    def write(item):
        name, df = item
        return stage_object(df, drop_dir, name)

    with ThreadPoolExecutor(max_workers=8) as pool:
        paths = dict(zip(jobs, pool.map(write, jobs.items())))
    paths["Customers_20231205.csv"] = stage_lines(long_lines, header, drop_dir,
                                                  "Customers_20231205.csv")
    paths["Customers_20231206.csv"] = stage_lines(short_lines, header, drop_dir,
                                                  "Customers_20231206.csv")
    # A quote inside a field, a backslash before one, and a line of spaces.
    odd = cust.select(F.explode(F.when(F.col("negative"), F.array(
        F.concat_ws(DELIMITER, "tipo_identificacion", "identificacion", F.lit('TUBO 5"'), F.lit('a \\" b')),
        F.lit("   "))).otherwise(F.array(full))).alias("value"))
    paths["Customers_20231210.csv"] = stage_lines(odd, header, drop_dir, "Customers_20231210.csv")
    path = f"{drop_dir.rstrip('/')}/Customers_20231211.csv"
    spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    paths["Customers_20231211.csv"] = path
    return paths
