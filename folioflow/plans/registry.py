"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Star-schema tables in the roles of documents, lines and runs, spelled once for all queries.
ROLES = {
    "docs": """docs AS (
      SELECT o_orderkey AS header_id, o_orderkey AS file_id,
        CASE o_orderstatus WHEN 'F' THEN 33 WHEN 'O' THEN 39 ELSE 61 END AS tipo_dte, o_orderkey AS folio,
        CAST(o_orderdate AS DATE) AS fecha_emision, CAST(o_custkey AS VARCHAR) AS rut_emisor,
        c_name AS razon_social_emisor, CAST(c_nationkey AS VARCHAR) AS rut_receptor, n_name AS razon_social_receptor,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.84 AS DECIMAL(18,2)) AS mnt_neto,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.84 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS iva,
        CAST(o_totalprice AS DECIMAL(18,2)) AS mnt_total
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)""",
    "lins": """lins AS (
      SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS line_id, l_orderkey AS header_id,
        l_linenumber AS nro_linea, l_returnflag AS tipo_codigo, p_brand AS codigo, p_name AS nombre_item,
        p_type AS descripcion, CAST(l_quantity AS DECIMAL(18,6)) AS cantidad,
        CAST(p_retailprice AS DECIMAL(18,6)) AS precio_unitario, CAST(l_extendedprice AS DECIMAL(18,2)) AS monto_item
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)""",
    "rules": """rules AS (
      SELECT * FROM (VALUES (1,'DQ1','ERROR','detail','cantidad<=0 o precio<0'), (2,'DQ2','WARN','detail','monto != qty*precio'),
        (3,'DQ4','WARN','header','fecha_emision fuera de rango'), (4,'DQ3','ERROR','header','suma(detalle) != total'))
      AS r(rule_id, rule_code, rule_level, entity, description))""",
    "runs": """runs AS (
      SELECT concat_ws('-', user_id, strftime(d, '%Y%m%d')) AS run_id,
        CASE WHEN last_kind = 'view' THEN 'etl_daily' ELSE 'manual_parse' END AS job, source, started_at,
        CASE WHEN ended = started_at THEN NULL ELSE ended END AS ended_at,
        CASE WHEN crashed THEN 'ERROR' WHEN files_failed > 0 THEN 'PARTIAL' ELSE 'OK' END AS status,
        files_total, files_total - files_failed AS files_ok, files_failed, headers_inserted, details_inserted, dq_violations
      FROM (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS started_at, max(ts) AS ended, count(*) AS files_total,
          count(*) FILTER (event_type = 'error') AS files_failed,
          count(*) FILTER (event_type IN ('view','click','purchase')) AS headers_inserted,
          CAST(sum(floor(value)) AS BIGINT) AS details_inserted,
          count(*) FILTER (event_type = 'signup' AND value > 25) AS dq_violations,
          bool_or(value > 150) AS crashed, min(event_type) AS source, max(event_type) AS last_kind
        FROM events GROUP BY user_id, CAST(ts AS DATE)))""",
    "files": """files AS (
      SELECT o_orderkey AS file_id, 'F' || o_orderkey || '.xml' AS filename, o_orderdate AS created_at FROM orders
      UNION ALL SELECT -page_id - 1, 'P' || page_id || '.xml', TIMESTAMP '2024-01-01' FROM pages)""",
    "audit": """audit AS (
      SELECT event_id AS id, ts, CAST(user_id AS VARCHAR) AS "user", '/action/' || event_type AS path,
        CASE WHEN event_type IN ('view','click') THEN 'GET' ELSE 'POST' END AS method,
        CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, event_type AS action, props AS extra,
        CAST(timezone('America/Santiago', timezone('UTC', ts)) AS DATE) AS ts_on
      FROM events)""",
}


def with_roles(roles: str, body: str, *more: str) -> str:
    """``body`` over the roles named, and over further CTEs given as text."""
    return "WITH " + ",\n".join([*(ROLES[r] for r in roles.split()), *more]) + "\n" + body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name`` with the SQL of the same result."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
