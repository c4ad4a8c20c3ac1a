"""Rule taxonomy of line items: code prefixes, keywords, brands, measures, colours, materials."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Taxonomy:
    """Ordered tables; the first entry that fits wins."""

    version: str
    prefixes: dict[str, tuple[str, str | None, str | None]]
    keywords: list[tuple[str, tuple[str, str]]]
    brands: list[str]
    colors: list[str]
    materials: list[str]
    incident: str
    incident_class: tuple[str, str] = ("No Merch", "Ajuste/Incidencia")
    unclassified: str = "Sin Clasificar"

    def subcategories(self) -> list[str]:
        """Every subcategory a line can get; the closed vocabulary of basket pairs."""
        found = {sub for _, sub, _ in self.prefixes.values() if sub}
        found |= {sub for _, (_, sub) in self.keywords} | {self.incident_class[1]}
        return sorted(found)


# The bathroom and kitchen fittings taxonomy.
FITTINGS = Taxonomy(
    version="v0.2",
    prefixes={
        "60AR": ("Sanitarios", "WC Suite / Repuestos", "Ares"),
        "60AU": ("Sanitarios", "Lavamanos / Pedestales", "Aura"),
        "60PB": ("Muebles", "Mueble Vanitorio", None),
        "60PZ": ("Muebles", "Cubierta Vanitorio", None),
        "66ES": ("Accesorios", "Espejo", None),
        "65PB": ("Ducha", "Mampara", None),
        "21BE": ("Accesorios", "Set / Barras / Perchas", "Benton"),
        "21ST": ("Ducha", "Columna de Ducha", "Venti"),
        "20AA": ("Grifería", "Monomando (Línea Arona)", "Arona"),
        "20VT": ("Grifería", "Monomando (Línea Vermont)", "Vermont"),
        "20PL": ("Grifería", "Llaves (Plumber)", "Plumber"),
        "20SX": ("Grifería", "Monomando (Sibel)", "Sibel"),
        "20ZZ": ("Grifería", "Monomando (Arezzo)", "Arezzo"),
        "22PB": ("Ducha", "Desagüe / Receptáculo", None),
    },
    keywords=[
        (r"\b(taza\s*wc|estanque\s*wc|asiento\s*y\s*tapa)\b", ("Sanitarios", "WC Suite / Repuestos")),
        (r"\b(lavamanos|lavatorio)\b", ("Sanitarios", "Lavamanos / Lavatorio")),
        (r"\b(mueble\s+\w+\s*60x46|mueble\s+vanitorio|vanitorio)\b", ("Muebles", "Mueble Vanitorio")),
        (r"\b(cubierta\s+vanitorio)\b", ("Muebles", "Cubierta Vanitorio")),
        (r"\b(mampara|corredera\s+\d+\s*x\s*\d+)\b", ("Ducha", "Mampara")),
        (r"\b(columna\s+de\s+ducha)\b", ("Ducha", "Columna de Ducha")),
        (r"\b(monomando)\b", ("Grifería", "Monomando")),
        (r"\b(llave\s+lavatorio|llave\s+lavaplato|combinacion\s+lavaplato)\b", ("Grifería", "Llaves")),
        (r"\b(espejo)\b", ("Accesorios", "Espejo")),
        (r"\b(daño\s+en\s+ruta|aver[ií]a|merma)\b", ("No Merch", "Ajuste/Incidencia")),
    ],
    brands=["Ares", "Aura", "Arona", "Vermont", "Sibel", "Arezzo", "Benton", "Plumber",
            "Zoé", "Amélie", "Renèe", "Óptima"],
    colors=["Cromo", "Gris Grafito", "Ulmo", "Acácia", "Inox Satinado"],
    materials=["Inox", "Urea", "P.P.", "Acrílico", "Urea Soft Close", "Soft Close"],
    incident=r"\bdaño\s+en\s+ruta\b",
)

# Score parts, cap, incident score, measures.
BASE, PREFIX_PART, KEYWORD_PART, BRAND_PART, ATTRIBUTE_PART = "0.40", "0.40", "0.15", "0.05", "0.02"
SCORE_CAP, INCIDENT_SCORE = "0.99", "0.95"
MEASURES = r"(\d{2,3})\s*x\s*(\d{2,3})(?:\s*x\s*(\d{2,3}))?"
INCIDENT_CODE = "."

UNICODE = "(?iuU)"


def _score(text: str) -> Column:
    return F.lit(text).cast("decimal(5,2)")


def _first(tests: list[tuple[Column, object]]) -> Column:
    """Value of the first test that holds, else NULL."""
    out = F.lit(None)
    for test, value in reversed(tests):
        out = F.when(test, F.lit(value)).otherwise(out)
    return out


def code_prefix(code: Column) -> Column:
    """First four characters of the code when all are letters or digits."""
    return F.nullif(F.regexp_extract(F.upper(F.trim(code)), r"^([A-Z0-9]{4})", 1), F.lit(""))


def item_text(name: Column, description: Column) -> Column:
    """Name (or else description) and description, joined by a space."""
    shown = F.coalesce(F.nullif(name, F.lit("")), F.nullif(description, F.lit("")))
    return F.trim(F.concat_ws(" ", shown, F.nullif(description, F.lit(""))))


def measures(text: Column) -> Column:
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(text, UNICODE + MEASURES, i), F.lit("")).try_cast("int")

    size = F.struct(part(1).alias("w"), part(2).alias("h"), part(3).alias("d"))
    return F.when(text.rlike(UNICODE + MEASURES), size)


def item_facts(taxonomy: Taxonomy, text: Column, prefix: Column, code: Column) -> dict[str, Column]:
    """What the tables say about an item: prefix entry, keyword entry, brand, measures, colour, material."""
    entry = "struct<cat:string,sub:string,brand:string>"
    by_prefix = F.create_map(*[
        x for key, (cat, sub, brand) in taxonomy.prefixes.items()
        for x in (F.lit(key), F.struct(F.lit(cat).alias("cat"), F.lit(sub).cast("string").alias("sub"),
                                       F.lit(brand).cast("string").alias("brand")))])
    known = F.try_element_at(by_prefix, prefix) if taxonomy.prefixes else F.lit(None).cast(entry)
    lower = F.lower(text)
    return {
        "known": known,
        "rule": _first([(text.rlike(UNICODE + p), i) for i, (p, _) in enumerate(taxonomy.keywords)]).cast("int"),
        "brand": _first([(text.rlike(UNICODE + r"\b" + re.escape(b) + r"\b"), b) for b in taxonomy.brands]).cast("string"),
        "dimension": measures(text),
        "color": _first([(F.contains(lower, F.lit(c.lower())), c) for c in taxonomy.colors]).cast("string"),
        "material": _first([(F.contains(lower, F.lit(m.lower())), m) for m in taxonomy.materials]).cast("string"),
        "incident": text.rlike(UNICODE + taxonomy.incident) | F.coalesce(code == INCIDENT_CODE, F.lit(False)),
    }


def item_verdict(taxonomy: Taxonomy, f: dict[str, Column]) -> Column:
    """The six enrichment columns as one struct, from the facts."""
    known, rule, incident = f["known"], f["rule"], f["incident"]
    cats = F.array(*[F.lit(c) for _, (c, _) in taxonomy.keywords]).cast("array<string>")
    subs = F.array(*[F.lit(s) for _, (_, s) in taxonomy.keywords]).cast("array<string>")
    category = F.coalesce(known.getField("cat"), F.get(cats, rule))
    # A prefix without subcategory takes the keyword's.
    sub = F.coalesce(known.getField("sub"), F.get(subs, rule))

    def part(test: Column, points: str) -> Column:
        return F.when(test, _score(points)).otherwise(_score("0"))

    score = (
        _score(BASE) + part(known.isNotNull(), PREFIX_PART) + part(rule.isNotNull(), KEYWORD_PART)
        + part(f["brand"].isNotNull(), BRAND_PART) + part(f["color"].isNotNull(), ATTRIBUTE_PART)
        + part(f["material"].isNotNull(), ATTRIBUTE_PART)
    )
    some = f["dimension"].isNotNull() | f["color"].isNotNull() | f["material"].isNotNull()
    inc_cat, inc_sub = taxonomy.incident_class
    return F.struct(
        F.when(incident, inc_cat).otherwise(F.coalesce(category, F.lit(taxonomy.unclassified))).alias("ai_category"),
        F.when(incident, inc_sub).when(category.isNotNull(), sub).alias("ai_subcategory"),
        F.coalesce(F.when(~incident, f["brand"]), known.getField("brand")).alias("ai_brand"),
        F.when(some, F.struct(*[f[n].alias(n) for n in ("dimension", "color", "material")])).alias("ai_attrs"),
        F.when(incident, _score(INCIDENT_SCORE)).otherwise(F.least(score, _score(SCORE_CAP)))
        .cast("decimal(5,2)").alias("ai_confidence"),
        F.lit(taxonomy.version).alias("ai_version"),
    )
