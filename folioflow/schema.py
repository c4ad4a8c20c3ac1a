"""Table schemas, the rule catalogue and the limits that decide whether a document is storable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
AMOUNT = T.DecimalType(18, 6)

ATTRS = "struct<dimension:struct<w:int,h:int,d:int>,color:string,material:string>"

HEADER_COLUMNS = [
    "tipo_dte", "folio", "fecha_emision", "rut_emisor", "razon_social_emisor",
    "rut_receptor", "razon_social_receptor", "mnt_neto", "iva", "mnt_total",
]
LINE_COLUMNS = [
    "nro_linea", "tipo_codigo", "nombre_item", "codigo", "descripcion",
    "cantidad", "precio_unitario", "monto_item",
]

#: A document is the same document whenever these agree.
BUSINESS_KEY = ["tipo_dte", "folio", "rut_emisor"]

# Columns that may not be NULL, and the longest text each column takes.
HEADER_REQUIRED = ["tipo_dte", "folio", "fecha_emision", "rut_emisor", "rut_receptor",
                   "mnt_neto", "iva", "mnt_total"]
PRINTED_REQUIRED = [c for c in HEADER_REQUIRED if c not in ("mnt_neto", "iva")]  # printed documents name neither
HEADER_TEXT_LIMITS = {"rut_emisor": 16, "razon_social_emisor": 255,
                      "rut_receptor": 16, "razon_social_receptor": 255}
LINE_TEXT_LIMITS = {"tipo_codigo": 20, "nombre_item": 255, "codigo": 50, "descripcion": 500}

# Rule id, code, level, entity, message.
RULE_CATALOGUE = [
    (1, "DQ1", "ERROR", "detail", "cantidad<=0 o precio<0"),
    (2, "DQ2", "WARN", "detail", "monto != qty*precio"),
    (3, "DQ4", "WARN", "header", "fecha_emision fuera de rango"),
    (4, "DQ3", "ERROR", "header", "suma(detalle) != total"),
]

VIOLATIONS = (
    "violation_id string, run_id string, rule_id bigint, entity string, entity_id string, "
    "header_id string, message string, created_at timestamp"
)
RUN_LOGS = (
    "run_id string, job string, source string, started_at timestamp, ended_at timestamp, "
    "status string, files_total bigint, files_ok bigint, files_failed bigint, "
    "headers_inserted bigint, headers_already_present bigint, details_inserted bigint, "
    "dq_violations bigint, errors array<struct<where:string,message:string,file:string>>, note string"
)
AUDIT_LOG = (
    "ts timestamp, user string, path string, method string, status int, action string, "
    "resource string, resource_id string, extra string"
)


def rule_catalogue(spark: SparkSession) -> DataFrame:
    """The built-in rules. Always complete, so no rule can go missing silently."""
    rows = ", ".join(f"({i}L, '{code}', '{level}', '{entity}', '{text}')" for i, code, level, entity, text in RULE_CATALOGUE)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(rule_id, rule_code, rule_level, entity, description)")


def missing_rules(rules: DataFrame) -> DataFrame:
    """Catalogue rows whose code a stored rule table does not have yet."""
    return rule_catalogue(rules.sparkSession).join(rules.select("rule_code"), "rule_code", "left_anti")
