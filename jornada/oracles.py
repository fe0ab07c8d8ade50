"""DuckDB statements equal to each registered query, over the shared test tables.

DuckDB rounds when casting a fraction to INTEGER, so every int column is
written ``CAST(trunc(x) AS INTEGER)`` to match the truncating cast.
"""

from __future__ import annotations

_RAW_TX = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'compra' ELSE 'venta' END AS tipo_transaccion,
       concat('proveedor ', CAST(l_suppkey AS VARCHAR)) AS nombre,
       CAST(l_quantity AS VARCHAR) AS cantidad_comprada,
       CASE WHEN l_linenumber % 5 = 0 THEN NULL
            ELSE CAST(l_extendedprice AS VARCHAR) END AS precio,
       CASE WHEN l_linestatus = 'O' THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia
FROM lineitem"""

_CAST_TX = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'compra' ELSE 'venta' END AS tipo_transaccion,
       concat('proveedor ', CAST(l_suppkey AS VARCHAR)) AS nombre,
       CAST(trunc(l_quantity) AS INTEGER) AS cantidad_comprada,
       CASE WHEN l_linenumber % 5 = 0 THEN NULL
            ELSE CAST(trunc(l_extendedprice) AS INTEGER) END AS precio,
       CASE WHEN l_linestatus = 'O' THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia
FROM lineitem"""

_CURATED_TX = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'compra' ELSE 'venta' END AS tipo_transaccion,
       upper(concat('proveedor ', CAST(l_suppkey AS VARCHAR))) AS nombre,
       CAST(trunc(l_quantity) AS INTEGER) AS cantidad_comprada,
       CASE WHEN l_linenumber % 5 = 0 THEN 0
            ELSE CAST(trunc(l_extendedprice) AS INTEGER) END AS precio,
       CASE WHEN l_linestatus = 'O' THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia,
       '2023' AS year, '12' AS month, '04' AS day
FROM lineitem"""

_RAW_PROVIDERS = """
SELECT s_name AS nombre_proveedor,
       CASE s_nationkey % 3 WHEN 0 THEN 'hidroelectrica' WHEN 1 THEN 'solar' ELSE 'eolica' END
         AS tipo_energia
FROM supplier"""

_RAW_CUSTOMERS = """
SELECT CASE c_custkey % 2 WHEN 0 THEN 'CC' ELSE 'NIT' END AS tipo_identificacion,
       CAST(c_custkey AS VARCHAR) AS identificacion,
       c_name AS nombre,
       c_mktsegment AS ciudad
FROM customer"""

_DATED_RAW = """
SELECT event_type AS tipo_transaccion,
       CAST(user_id AS VARCHAR) AS nombre,
       CAST(event_id AS VARCHAR) AS cantidad_comprada,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS VARCHAR) END AS precio,
       CASE WHEN user_id % 2 = 0 THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events"""

_DATED_CURATED = """
SELECT event_type AS tipo_transaccion,
       CAST(user_id AS VARCHAR) AS nombre,
       CAST(event_id AS INTEGER) AS cantidad_comprada,
       CASE WHEN event_type = 'error' THEN 0 ELSE CAST(trunc(value) AS INTEGER) END AS precio,
       CASE WHEN user_id % 2 = 0 THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events"""

_HYDRO = """
SELECT tipo_transaccion AS Tipo_transaccion, nombre AS Nombre,
       cantidad_comprada AS Cantidad_comprada, precio AS Precio, tipo_energia AS Tipo_energia
FROM ({inner}) t
WHERE tipo_energia = 'hidroelectrica' AND tipo_transaccion = 'venta' AND precio > 1000"""

_MONTH_CURATED = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'compra' ELSE 'venta' END AS tipo_transaccion,
       upper(concat('proveedor ', CAST(l_suppkey AS VARCHAR))) AS nombre,
       CAST(trunc(l_quantity) AS INTEGER) AS cantidad_comprada,
       CASE WHEN l_linenumber % 5 = 0 THEN 0
            ELSE CAST(trunc(l_extendedprice) AS INTEGER) END AS precio,
       CASE WHEN l_linestatus = 'O' THEN 'hidroelectrica' ELSE 'solar' END AS tipo_energia
FROM lineitem
WHERE date_trunc('month', l_shipdate) = DATE '1998-06-01'"""

_EVENT_OBJECTS = """
SELECT DISTINCT 'Transactions_' || strftime(ts, '%Y%m%d') || '.csv' AS object,
       'Transactions' AS dataset, strftime(ts, '%Y-%m-%d') AS batch_date
FROM events"""

_NAMED_OBJECTS = """
SELECT * FROM (VALUES
  ('Providers_20231204.csv',    'Providers', '2023-12-04'),
  ('Providers_20231204_v2.csv', 'Providers', '2023-12-04'),
  ('bad.csv',                   NULL,        NULL),
  ('Providers_20231304.csv',    'Providers', NULL),
  ('Providers_20230229.csv',    'Providers', NULL),
  ('Providers_2023124.csv',     'Providers', NULL),
  ('Ventas_20231204.csv',       NULL,        '2023-12-04'),
  ('Customers_20231204.csv',    'Customers', '2023-12-04'),
  ('Customers_20231205.csv',    'Customers', '2023-12-05'),
  ('Customers_20231206.csv',    'Customers', '2023-12-06'),
  ('Customers_20231207.csv',    'Customers', '2023-12-07'),
  ('Customers_20231208.csv',    'Customers', '2023-12-08'),
  ('Customers_20231209.csv',    'Customers', '2023-12-09'),
  ('Customers_20231210.csv',    'Customers', '2023-12-10'),
  ('Customers_20231211.csv',    'Customers', '2023-12-11')
) v(object, dataset, batch_date)"""

_QUALITY = """
WITH neg AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0),
     sup AS (SELECT count(*) AS n FROM supplier),
     cus AS (SELECT count(*) AS n FROM customer)
SELECT 'Transactions_' || strftime(ts, '%Y%m%d') || '.csv' AS object, count(*) AS rows,
       CAST(0 AS BIGINT) AS long_rows, CAST(0 AS BIGINT) AS short_rows, 'ok' AS status
FROM events GROUP BY 1
UNION ALL
SELECT o, sup.n, 0, 0, 'ok' FROM sup, (VALUES
  ('Providers_20231204.csv'), ('Providers_20231204_v2.csv')) v(o)
UNION ALL
SELECT o, NULL, NULL, NULL, s FROM (VALUES
  ('Providers_20231304.csv', 'rejected_name'), ('Providers_20230229.csv', 'rejected_name'),
  ('Providers_2023124.csv', 'rejected_name'), ('bad.csv', 'rejected_name'),
  ('Ventas_20231204.csv', 'rejected_dataset'), ('Customers_20231208.csv', 'rejected_header'),
  ('Customers_20231211.csv', 'rejected_empty')) v(o, s)
UNION ALL
SELECT o, cus.n, 0, 0, 'ok' FROM cus, (VALUES
  ('Customers_20231204.csv'), ('Customers_20231207.csv'), ('Customers_20231209.csv'),
  ('Customers_20231210.csv')) v(o)
UNION ALL
SELECT 'Customers_20231205.csv', cus.n, neg.n, 0,
       CASE WHEN neg.n > 0 THEN 'rejected_malformed' ELSE 'ok' END FROM cus, neg
UNION ALL
SELECT 'Customers_20231206.csv', cus.n, 0, neg.n, 'ok' FROM cus, neg"""

ORACLE_SQL: dict[str, str] = {
    "query_hydro_sales": _HYDRO.format(inner=_CURATED_TX),
    "query_hydro_sales_day": _HYDRO.format(inner=_MONTH_CURATED),
    "scan_raw_csv": _RAW_TX,
    "scan_raw_backfill": _DATED_RAW,
    "scan_raw_legacy_backfill": _DATED_RAW,
    "cast_providers": _RAW_PROVIDERS,
    "cast_customers": _RAW_CUSTOMERS,
    "cast_transactions": _CAST_TX,
    "upper_name": f"SELECT tipo_transaccion, upper(nombre) AS nombre, cantidad_comprada, "
                  f"precio, tipo_energia FROM ({_RAW_TX}) t",
    "fill_null_zero": f"SELECT tipo_transaccion, nombre, cantidad_comprada, "
                      f"coalesce(precio, 0) AS precio, tipo_energia FROM ({_CAST_TX}) t",
    "surrogate_key": "SELECT count(*) AS n_rows, count(*) AS n_keys, "
                     "count(*) AS n_distinct_keys, CAST(1 AS BIGINT) AS min_key FROM lineitem",
    "row_key": "SELECT tipo_transaccion, nombre, cantidad_comprada, precio, tipo_energia, "
               "sha256(concat_ws('|', "
               "coalesce(length(tipo_transaccion)::VARCHAR || ':' || tipo_transaccion, 'n'), "
               "coalesce(length(nombre)::VARCHAR || ':' || nombre, 'n'), "
               "coalesce(length(CAST(cantidad_comprada AS VARCHAR))::VARCHAR || ':' || CAST(cantidad_comprada AS VARCHAR), 'n'), "
               "coalesce(length(CAST(precio AS VARCHAR))::VARCHAR || ':' || CAST(precio AS VARCHAR), 'n'), "
               "coalesce(length(tipo_energia)::VARCHAR || ':' || tipo_energia, 'n'))) "
               f"AS row_key FROM ({_CURATED_TX}) t",
    "partition_columns": f"SELECT *, '2023' AS year, '12' AS month, '04' AS day FROM ({_RAW_TX}) t",
    "curate_providers": f"SELECT upper(nombre_proveedor) AS nombre_proveedor, tipo_energia, "
                        f"'2023' AS year, '12' AS month, '04' AS day FROM ({_RAW_PROVIDERS}) t",
    "curate_customers": f"SELECT tipo_identificacion, identificacion, upper(nombre) AS nombre, "
                        f"ciudad, '2023' AS year, '12' AS month, '04' AS day "
                        f"FROM ({_RAW_CUSTOMERS}) t",
    "curate_transactions": _CURATED_TX,
    "filter_equality": f"SELECT * FROM ({_CURATED_TX}) t "
                       f"WHERE tipo_energia = 'hidroelectrica' AND tipo_transaccion = 'venta'",
    "filter_range": f"SELECT * FROM ({_CURATED_TX}) t WHERE precio > 1000",
    "partitioned_write": _DATED_CURATED,
    "curate_incremental": _DATED_CURATED,
    "append_batch": "SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
                    "strftime(ts, '%d') AS day, count(*) AS rows_after_first, "
                    "2 * count(*) AS rows_after_second, count(*) AS rows_after_replace "
                    "FROM events GROUP BY 1, 2, 3",
    "catalog_sync": "SELECT DISTINCT 'year=' || strftime(ts, '%Y') || '/month=' || "
                    "strftime(ts, '%m') || '/day=' || strftime(ts, '%d') AS partition FROM events",
    "empty_batch": "SELECT count(*) AS rows_before, count(*) AS rows_after, "
                   "CAST(0 AS BIGINT) AS rows_in_batch FROM events",
    "landing_parse_date": f"{_EVENT_OBJECTS} UNION ALL {_NAMED_OBJECTS}",
    "landing_reject": f"SELECT object, status FROM ({_QUALITY}) q WHERE status <> 'ok'",
    "landing_route": f"""
SELECT object, dataset,
       dataset || '/year=' || substr(batch_date, 1, 4) || '/month=' || substr(batch_date, 6, 2)
         || '/day=' || substr(batch_date, 9, 2) || '/object=' || object AS destination
FROM ({_EVENT_OBJECTS} UNION ALL {_NAMED_OBJECTS}) o
WHERE object IN (SELECT object FROM ({_QUALITY}) q WHERE status = 'ok')""",
    "landing_quality": _QUALITY,
    "landing_write": f"""
SELECT dataset, q.object, substr(batch_date, 1, 4) AS year, substr(batch_date, 6, 2) AS month,
       substr(batch_date, 9, 2) AS day, rows AS n_rows
FROM ({_QUALITY}) q JOIN ({_EVENT_OBJECTS} UNION ALL {_NAMED_OBJECTS}) o ON o.object = q.object
WHERE status = 'ok' AND rows > 0""",
    "landing_quarantine": f"""
SELECT object, status, status <> 'rejected_empty' AS has_bytes FROM ({_QUALITY}) q WHERE status <> 'ok'""",
    "landing_two_drops": f"""
WITH p AS ({_RAW_PROVIDERS})
SELECT o AS object, (SELECT count(*) FROM p WHERE e IS NULL OR tipo_energia = e) AS n_rows,
       (SELECT count(*) FROM p) AS curated_rows
FROM (VALUES ('Providers_20231204.csv', NULL), ('Providers_20231204_v2.csv', 'solar'),
             ('Providers_20231205.csv', 'eolica')) v(o, e)
WHERE n_rows > 0""",
    "landing_reland_empty": """
SELECT 'Providers_20231205.csv' AS object, '2023' AS year, '12' AS month, '05' AS day,
       count(*) AS n_rows, count(*) AS curated_rows FROM supplier""",
    "curate_extra_column": f"""
SELECT tipo_identificacion, identificacion, upper(nombre) AS nombre, ciudad, NULL::VARCHAR AS "Pais",
       '2023' AS year, '12' AS month, '07' AS day FROM ({_RAW_CUSTOMERS}) t
UNION ALL
SELECT CASE c_custkey % 2 WHEN 0 THEN 'CC' ELSE 'NIT' END, CAST(c_custkey AS VARCHAR), upper(c_name), c_mktsegment,
       CAST(c_nationkey AS VARCHAR), '2023', '12', '09' FROM customer""",
    "replace_empty_range": "SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
                           "strftime(ts, '%d') AS day, count(*) AS n_rows FROM events "
                           "WHERE extract(day FROM ts) % 2 = 0 GROUP BY 1, 2, 3",
}
