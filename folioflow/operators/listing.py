"""List reports: lenient filters, stable pages, pick lists, one document, CSV rows.

Argument handling is forgiving: an unreadable date or number drops its filter, swapped date bounds
are put right, empty text means no filter. ``%`` and ``_`` in search text act as wildcards.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.scalars import LOCAL_ZONE, local_day, within_days

MAX_DOCUMENTS = 5000


def day_argument(text: str | date | None) -> date | None:
    if not text:
        return None
    if isinstance(text, date):
        return text
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        return None


def number_argument(text: str | int | None) -> int | None:
    try:
        return int(str(text).strip())
    except ValueError:
        return None


def day_range(first, last) -> tuple[date | None, date | None]:
    first, last = day_argument(first), day_argument(last)
    return (last, first) if first and last and first > last else (first, last)


def between_days(df: DataFrame, day: Column, first, last) -> DataFrame:
    low, high = day_range(first, last)
    if low:
        df = df.filter(day >= F.lit(low))
    if high:
        df = df.filter(day <= F.lit(high))
    return df


def between_local_days(df: DataFrame, ts: str, first, last, zone: str, stored_zone: str | None) -> DataFrame:
    low, high = day_range(first, last)
    return df.filter(within_days(F.col(ts), low, high, zone, stored_zone)) if low or high else df


def _equal(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value:
            df = df.filter(F.col(name) == value)
    return df


def _like(df: DataFrame, term: str | None, *names: str) -> DataFrame:
    if not term:
        return df
    found = F.lit(False)
    for name in names:
        found = found | F.col(name).ilike(f"%{term}%")
    return df.filter(found)


def page_of(df: DataFrame, newest: str, tie: str, page: int = 1, page_size: int = 50) -> DataFrame:
    """One page, newest first; the tie-break keeps pages from overlapping."""
    return df.orderBy(F.desc_nulls_first(newest), F.desc_nulls_first(tie)).offset((page - 1) * page_size).limit(page_size)


def total_rows(df: DataFrame) -> DataFrame:
    """Size of the filtered set, to show beside a page."""
    return df.agg(F.count("*").alias("total"))


def pick_list(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_last(column))


def documents(headers: DataFrame, *, tipo=None, folio=None, date_from=None, date_to=None,
              issuer: str | None = None, receiver: str | None = None) -> DataFrame:
    """Documents by type, number, day range, and issuer or receiver (tax id or name)."""
    out = headers
    for name, value in (("tipo_dte", number_argument(tipo)), ("folio", number_argument(folio))):
        if value is not None:
            out = out.filter(F.col(name) == value)
    out = between_days(out, F.col("fecha_emision"), date_from, date_to)
    out = _like(out, (issuer or "").strip(), "rut_emisor", "razon_social_emisor")
    return _like(out, (receiver or "").strip(), "rut_receptor", "razon_social_receptor")


def _newest_first(headers: DataFrame) -> list[Column]:
    """By load time where it is known, else by id."""
    loaded = [F.desc("created_at")] if "created_at" in headers.columns else []
    return [*loaded, F.desc("header_id")]


def latest_documents(headers: DataFrame, limit: int = 500, **filters) -> DataFrame:
    if not 1 <= limit <= MAX_DOCUMENTS:
        raise ValueError(f"limit is 1 to {MAX_DOCUMENTS}")
    return documents(headers, **filters).orderBy(*_newest_first(headers)).limit(limit)


def export_rows(headers: DataFrame, **filters) -> DataFrame:
    """All matching documents with the export's column titles, newest first."""
    return documents(headers, **filters).orderBy(*_newest_first(headers)).select(
        F.col("header_id").alias("ID"), F.col("tipo_dte").alias("Tipo"), F.col("folio").alias("Folio"),
        F.col("fecha_emision").alias("Fecha"), F.col("rut_emisor").alias("Emisor"),
        F.col("rut_receptor").alias("Receptor"), F.col("mnt_total").alias("Monto Total"))


def listed_documents(headers: DataFrame) -> DataFrame:
    """Short list form: parties as ``id - name``, newest first."""
    def party(rut: str, name: str) -> Column:
        return F.concat(F.col(rut), F.lit(" - "), F.coalesce(name, F.lit("")))

    return headers.orderBy(*_newest_first(headers)).select(
        F.col("header_id").alias("id"), F.col("tipo_dte").alias("tipo"), "folio", F.col("fecha_emision").alias("fecha"),
        party("rut_emisor", "razon_social_emisor").alias("emisor"),
        party("rut_receptor", "razon_social_receptor").alias("receptor"),
        F.col("mnt_total").cast("string").alias("total"))


def one_document(headers: DataFrame, lines: DataFrame, header_id) -> DataFrame:
    """A document and its lines in order, one row per line; a document without lines keeps a row.

    Rows, not one nested record: no task has to hold all lines of a document.
    """
    head = headers.filter(F.col("header_id") == header_id)
    body = lines.filter(F.col("header_id") == header_id)
    return head.join(body, "header_id", "left").orderBy(F.asc_nulls_last("nro_linea"), "line_id")


def violations(enriched: DataFrame, *, code: str | None = None, level: str | None = None, entity: str | None = None,
               header_id=None, date_from=None, date_to=None, zone: str = LOCAL_ZONE,
               stored_zone: str | None = None) -> DataFrame:
    """Violations (with rule and owning document) by rule, level, entity, document and local day."""
    out = enriched.withColumn("created_on", local_day(F.col("created_at"), zone, stored_zone))
    out = _equal(out, rule_code=code, rule_level=level, entity=entity)
    wanted = str(header_id).strip() if header_id is not None else ""
    if wanted:
        out = out.filter(F.col("header_id") == wanted)
    return between_local_days(out, "created_at", date_from, date_to, zone, stored_zone)


def audit_entries(log: DataFrame, *, user: str | None = None, path: str | None = None, method: str | None = None,
                  status=None, date_from=None, date_to=None, zone: str = LOCAL_ZONE,
                  stored_zone: str | None = None) -> DataFrame:
    out = log.withColumn("ts_on", local_day(F.col("ts"), zone, stored_zone))
    out = _like(_equal(out, user=user, method=method), path, "path")
    code = number_argument(status)
    if code is not None:
        out = out.filter(F.col("status") == code)
    return between_local_days(out, "ts", date_from, date_to, zone, stored_zone)


def runs(log: DataFrame, *, job: str | None = None, status: str | None = None, source: str | None = None,
         started_from=None, started_to=None, zone: str = LOCAL_ZONE, stored_zone: str | None = None) -> DataFrame:
    out = log.withColumn("started_on", local_day(F.col("started_at"), zone, stored_zone))
    out = _like(_equal(out, job=job, status=status), source, "source")
    return between_local_days(out, "started_at", started_from, started_to, zone, stored_zone)


def run_by_id(log: DataFrame, run_id: str) -> DataFrame:
    return log.filter(F.col("run_id") == run_id)


def files_newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.desc_nulls_first("created_at"), F.desc("file_id"))


NO_SUBCATEGORY = (None, "", "-", "null", "__none__")


def items_of_category(lines: DataFrame, category: str, subcategory: str | None, limit: int = 200) -> DataFrame:
    """The dearest lines of a category; a blank subcategory means lines that have none."""
    sub = F.col("ai_subcategory")
    wanted = sub.isNull() if subcategory in NO_SUBCATEGORY else sub == subcategory
    return lines.filter((F.col("ai_category") == category) & wanted).orderBy(
        F.desc_nulls_last("monto_item"), "line_id").limit(limit)
