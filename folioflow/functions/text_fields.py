"""Document fields read from free text, and visible text of HTML."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.scalars import peso_amount, squeeze, whole, written_day

# Labels and value shapes of the printed document. The date value ends in four
# digits or in one or two, so that 14-10-2025 is read whole.
FOLIO = r"\b(?:Folio|N[°º]|Nro\.?)\s*[:#]?\s*(\d{3,12})"
RUT_ISSUER = r"RUT\s*(?:Emisor|Empresa)\s*[:#]?\s*([\dkK\.\-]+)"
RUT_RECEIVER = r"RUT\s*(?:Receptor|Cliente)\s*[:#]?\s*([\dkK\.\-]+)"
RUT_ADDRESSEE = r"RUT\s*(?:Destinatario)\s*[:#]?\s*([\dkK\.\-]+)"
ISSUE_DATE = (
    r"(?:Fecha(?:\s*Emisi[oó]n)?|FchEmis)\s*[:#]?\s*"
    r"([0-9]{2,4}[/\-][0-9]{1,2}[/\-](?:[0-9]{4}|[0-9]{1,2}))"
)
TOTAL = r"(?:Monto\s*Total|Total\s*(?:a\s*Pagar)?|MntTotal)\s*[:#]?\s*\$?\s*([\d\.\,]+)"


def labelled(pattern: str, text: Column) -> Column:
    """First group of the first match, case-insensitive over all letters; else NULL."""
    return F.nullif(F.trim(F.regexp_extract(text, "(?iuU)" + pattern, 1)), F.lit(""))


def document_type(text: Column) -> Column:
    """Type code from the words used; notes come before receipts, receipts before invoices."""
    t = F.lower(text)

    def says(*words: str) -> Column:
        return reduce(or_, [F.contains(t, F.lit(w)) for w in words])

    return (
        F.when(says("nota de crédito", "nota de credito"), 61)
        .when(says("nota de débito", "nota de debito"), 56)
        .when(says("boleta"), 39)
        .when(says("factura") & t.rlike(r"(?s)factura.*exenta|exenta.*factura"), 34)
        .when(says("factura"), 33)
    )


def header_fields(text: Column) -> list[Column]:
    """The six header fields free text can give."""
    return [
        document_type(text).alias("tipo_dte"),
        whole(labelled(FOLIO, text)).alias("folio"),
        labelled(RUT_ISSUER, text).alias("rut_emisor"),
        F.coalesce(labelled(RUT_RECEIVER, text), labelled(RUT_ADDRESSEE, text)).alias("rut_receptor"),
        written_day(labelled(ISSUE_DATE, text)).alias("fecha_emision"),
        peso_amount(labelled(TOTAL, text)).alias("mnt_total"),
    ]


def _named_entities() -> Column:
    # One expression text instead of one call per entry; characters as code points, free of quoting.
    pairs = ", ".join(f"'{name}', decode(unhex('{code:08X}'), 'UTF-32')" for name, code in name2codepoint.items())
    return F.expr(f"map({pairs})")


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references. Unknown ones stay as written."""

    def resolve(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#([0-9]{1,7});$", 1)
        hexes = F.regexp_extract(part, r"^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
        name = F.regexp_extract(part, r"^&([A-Za-z][A-Za-z0-9]*);$", 1)
        code = F.coalesce(
            F.nullif(digits, F.lit("")).try_cast("int"),
            F.conv(F.nullif(hexes, F.lit("")), 16, 10).try_cast("int"),
        )
        legal = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(~F.startswith(part, F.lit("&")), part).otherwise(
            F.coalesce(F.when(legal, char), F.try_element_at(_named_entities(), name), part)
        )

    parts = F.regexp_extract_all(text, F.lit(r"(&#?[A-Za-z0-9]+;|[^&]+|&)"), F.lit(1))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, resolve), "")).otherwise(text)


def visible_text(html: Column) -> Column:
    """Text nodes in order, one space between, without scripts, styles and comments."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(shown, r"(?s)<[^>]*>", " ")
    return squeeze(decode_entities(bare))
