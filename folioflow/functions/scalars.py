"""Lenient casts, derived amounts, RUT, dates, money, local days."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from functools import reduce
from operator import and_
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Santiago"


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def present(text: Column) -> Column:
    """Trimmed text; absent and empty elements are both NULL."""
    return F.nullif(F.btrim(text, F.lit(" \t\r\n")), F.lit(""))


def whole(text: Column) -> Column:
    """``'5'`` -> 5; anything that is no whole number, ``'1190.50'`` too, is NULL."""
    return F.trim(text).try_cast("bigint")


def number(text: Column) -> Column:
    return F.trim(text).try_cast("decimal(18,6)")


def iso_day(text: Column) -> Column:
    return F.try_to_date(F.trim(text), "yyyy-M-d")


def fill_price(price: Column, quantity: Column, amount: Column) -> Column:
    """A missing unit price follows from amount and quantity, to 2 places."""
    known = price.isNull() & (quantity != 0) & amount.isNotNull()
    return F.when(known, F.round(F.try_divide(amount, quantity), 2)).otherwise(price).cast("decimal(18,6)")


def fill_quantity(quantity: Column, price: Column, amount: Column) -> Column:
    """A missing quantity follows from amount and unit price, to 6 places."""
    known = quantity.isNull() & (price != 0) & amount.isNotNull()
    return F.when(known, F.round(F.try_divide(amount, price), 6)).otherwise(quantity).cast("decimal(18,6)")


def peso_amount(text: Column) -> Column:
    """``'$ 1.190,50'`` -> 1190: dots group thousands, the comma is decimal, halves go to even."""
    plain = F.replace(F.translate(text, "$ .", ""), F.lit(","), F.lit("."))
    return F.bround(plain.try_cast("decimal(38,10)"), 0).cast("bigint")


def written_day(text: Column) -> Column:
    """Day-first, ISO and two-digit-year dates with ``-``, ``/`` or ``\\`` between the parts.

    Two-digit years from 69 on belong to the 1900s.
    """
    dashed = F.translate(text, "/\\", "--")
    short = F.try_to_date(dashed, "d-M-yy")
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(F.try_to_date(dashed, "d-M-yyyy"), F.try_to_date(dashed, "yyyy-M-d"), short)


def clean_rut(text: Column) -> Column:
    """Canonical ``digits-check`` form of a tax id as people type it."""
    kept = F.regexp_replace(F.upper(text), r"[^0-9K\-]", "")
    size = F.length(kept)
    dashed = F.when(
        ~F.contains(kept, F.lit("-")) & (size > 1),
        F.concat(F.substring(kept, F.lit(1), size - 1), F.lit("-"), F.right(kept, F.lit(1))),
    ).otherwise(kept)
    body = F.regexp_replace(F.split_part(dashed, F.lit("-"), F.lit(1)), r"\D", "")
    check = F.split_part(dashed, F.lit("-"), F.lit(2))
    tail = F.when(check != "", F.concat(F.lit("-"), check)).otherwise(F.lit(""))
    return F.when(F.contains(dashed, F.lit("-")), F.concat(body, tail)).otherwise(dashed)


def is_rut(text: Column) -> Column:
    return text.rlike(r"^\d{7,9}-[\dkK]$")


def local_day(ts: Column, zone: str = LOCAL_ZONE, stored_zone: str | None = "UTC") -> Column:
    """Calendar day in ``zone`` of a zoneless timestamp kept in ``stored_zone``.

    For a zoned TIMESTAMP pass ``stored_zone=None``: the session zone is then the source.
    """
    source = F.lit(stored_zone) if stored_zone else None
    return F.to_date(F.convert_timezone(source, F.lit(zone), ts.cast("timestamp_ntz")))


def within_days(ts: Column, first: date | None, last: date | None, zone: str = LOCAL_ZONE,
                stored_zone: str | None = "UTC") -> Column:
    """True where ``local_day(ts)`` lies in ``first``..``last``; a missing bound is open.

    For times kept in UTC, and for zoned ones, the bounds are turned into instants once and the bare
    column is compared, so that the scan can skip row groups.
    """
    if stored_zone not in (None, "UTC"):
        day = local_day(ts, zone, stored_zone)
        low, high = (day >= F.lit(first), day <= F.lit(last))
    else:
        def midnight(day: date) -> Column:
            instant = datetime.combine(day, time(), ZoneInfo(zone)).astimezone(timezone.utc)
            if stored_zone is None:
                return F.lit(instant)
            return F.lit(instant.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")

        stored = ts if stored_zone is None else ts.cast("timestamp_ntz")
        low = stored >= midnight(first) if first else None
        high = stored < midnight(last + timedelta(days=1)) if last else None
    tests = [t for t, bound in ((low, first), (high, last)) if bound]
    return reduce(and_, tests, F.lit(True))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000)


def health_score(violations: Column, headers: Column) -> Column:
    """100 minus violations per 100 documents, kept in 0..100; 100 without documents.

    Violations are mostly per line while the base is documents: the published formula, kept.
    """
    rate = F.lit(100.0) - F.lit(100.0) * violations / F.nullif(headers, F.lit(0))
    held = F.greatest(F.lit(0.0), F.least(F.lit(100.0), rate))
    return F.when(headers <= 0, F.lit(100.0)).otherwise(F.round(held, 2)).cast("decimal(5,2)")


def score_band(score: Column) -> Column:
    return F.when(score >= 95, F.lit("ok")).when(score >= 80, F.lit("warn")).otherwise(F.lit("bad"))


def run_status(crashed: Column, files_failed: Column, n_errors: Column) -> Column:
    return (
        F.when(crashed, F.lit("ERROR"))
        .when((files_failed > 0) | (n_errors > 0), F.lit("PARTIAL"))
        .otherwise(F.lit("OK"))
    )


def per_hundred(violations: Column, lines: Column) -> Column:
    """Violations per 100 lines; no lines count as one."""
    return (violations * F.lit(100.0) / F.greatest(F.coalesce(lines, F.lit(0)), F.lit(1)))
