"""Registered queries: item enrichment and the reports over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions.taxonomy import FITTINGS, Taxonomy
from folioflow.operators import enrichment, listing
from folioflow.plans.registry import query, with_roles
from folioflow.sources.tables import line_id, table

# A taxonomy for the given part names and types.
PARTS = Taxonomy(
    version="parts-1",
    prefixes={"PROM": ("Promotion", "Promo line", "Promax"), "ECON": ("Budget", "Economy line", None),
              "LARG": ("Bulk", None, "Bulko")},
    keywords=[(r"\b(widget|gizmo)\b", ("Devices", "Gadgets")), (r"\b(bolt|rod)\b", ("Hardware", "Fasteners")),
              (r"\b(gear)\b", ("Hardware", "Drive")), (r"\b(ring|plate)\b", ("Hardware", "Flat parts"))],
    brands=["hot", "cold", "old"], colors=["red", "blue", "green"], materials=["rod", "plate"],
    incident=r"\bcold\s+ring\b", incident_class=("Set aside", "Incident"), unclassified="Unplaced")

# The same judgement in SQL, over a relation src(text, code) with the columns of KEYS.
ENRICH = """judged AS (
  SELECT *, upper(trim(code)) AS ucode, lower(text) AS low, substr(regexp_extract(upper(trim(code)), '^[A-Z0-9]{{4}}'), 1, 4) AS px FROM src),
facts AS (
  SELECT *, {prefix} AS known, {rule} AS rule, {brand} AS brand, {color} AS color, {material} AS material,
    regexp_matches(text, '(?i)\\d{{2,3}}\\s*x\\s*\\d{{2,3}}') AS has_dim,
    regexp_extract(text, '(?i)(\\d{{2,3}})\\s*x\\s*(\\d{{2,3}})(?:\\s*x\\s*(\\d{{2,3}}))?', 1) AS w,
    regexp_extract(text, '(?i)(\\d{{2,3}})\\s*x\\s*(\\d{{2,3}})(?:\\s*x\\s*(\\d{{2,3}}))?', 2) AS h,
    regexp_extract(text, '(?i)(\\d{{2,3}})\\s*x\\s*(\\d{{2,3}})(?:\\s*x\\s*(\\d{{2,3}}))?', 3) AS d,
    regexp_matches(text, '(?i){incident}') OR coalesce(code = '.', false) AS incident FROM judged),
enriched AS (
  SELECT *,
    CASE WHEN incident THEN '{inc_cat}' ELSE coalesce(known.cat, rule.cat, '{unplaced}') END AS ai_category,
    CASE WHEN incident THEN '{inc_sub}' ELSE coalesce(known.sub, rule.sub) END AS ai_subcategory,
    coalesce(CASE WHEN incident THEN NULL ELSE brand END, known.brand) AS ai_brand,
    CASE WHEN has_dim THEN w || 'x' || h || CASE WHEN d <> '' THEN 'x' || d ELSE '' END ELSE '' END AS dimension,
    coalesce(color, '') AS ai_color, coalesce(material, '') AS ai_material,
    CAST(CASE WHEN incident THEN 0.95 ELSE least(0.99, 0.40 + CASE WHEN known IS NOT NULL THEN 0.40 ELSE 0 END
      + CASE WHEN rule IS NOT NULL THEN 0.15 ELSE 0 END + CASE WHEN brand IS NOT NULL THEN 0.05 ELSE 0 END
      + CASE WHEN color IS NOT NULL THEN 0.02 ELSE 0 END + CASE WHEN material IS NOT NULL THEN 0.02 ELSE 0 END) END AS DECIMAL(5,2)) AS ai_confidence,
    '{version}' AS ai_version FROM facts)"""


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _cases(tests: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in tests) + " ELSE NULL END"


def enrich_sql(t: Taxonomy) -> str:
    def place(cat, sub, brand):
        return f"{{'cat': {_text(cat)}, 'sub': CAST({_text(sub)} AS VARCHAR), 'brand': CAST({_text(brand)} AS VARCHAR)}}"

    return ENRICH.format(
        prefix=_cases([(f"px = '{p}'", place(*v)) for p, v in t.prefixes.items()]),
        rule=_cases([(f"regexp_matches(text, '(?i){p}')", place(c, s, None)) for p, (c, s) in t.keywords]),
        brand=_cases([(f"regexp_matches(text, '(?i)\\b{b}\\b')", _text(b)) for b in t.brands]),
        color=_cases([(f"contains(low, '{c.lower()}')", _text(c)) for c in t.colors]),
        material=_cases([(f"contains(low, '{m.lower()}')", _text(m)) for m in t.materials]),
        incident=t.incident, inc_cat=t.incident_class[0], inc_sub=t.incident_class[1], unplaced=t.unclassified,
        version=t.version)


def flat(enriched, *keys):
    """Enriched rows with the attributes as text."""
    dim = F.col("ai_attrs.dimension")
    return enriched.select(
        *keys, "ai_category", "ai_subcategory", "ai_brand",
        F.concat_ws("x", dim.getField("w"), dim.getField("h"), dim.getField("d")).alias("dimension"),
        F.coalesce("ai_attrs.color", F.lit("")).alias("ai_color"),
        F.coalesce("ai_attrs.material", F.lit("")).alias("ai_material"), "ai_confidence", "ai_version")


OUT = "ai_category, ai_subcategory, ai_brand, dimension, ai_color, ai_material, ai_confidence, ai_version"

# Items: the part name with measures from its size; one size carries the incident code.
ITEMS = """src AS (
  SELECT p_partkey, CASE WHEN p_size = 13 THEN '.' ELSE p_type END AS code,
    p_name || ' ' || (p_size + 9) || 'x' || (p_size + 30) || CASE WHEN p_size > 25 THEN ' x ' || (p_size + 60) ELSE '' END || ' ' || p_brand AS text FROM part)"""


def items(spark, sf):
    size = F.col("p_size")
    depth = F.when(size > 25, F.concat(F.lit(" x "), size + 60)).otherwise("")
    return table(spark, sf, "part").select(
        "p_partkey", F.when(size == 13, ".").otherwise(F.col("p_type")).alias("codigo"),
        F.concat("p_name", F.lit(" "), size + 9, F.lit("x"), size + 30, depth).alias("nombre_item"),
        F.col("p_brand").alias("descripcion"))


@query("enrich_items", with_roles("", f"SELECT p_partkey, {OUT} FROM enriched", ITEMS, enrich_sql(PARTS)))
def enrich_items(spark, sf):
    return flat(enrichment.classify(items(spark, sf), PARTS), "p_partkey")


# The same names in the language of the fittings taxonomy, with its codes.
WORDS = {"widget": "Mampara", "gizmo": "Espejo", "bolt": "monomando", "rod": "taza wc", "gear": "MUEBLE vanitorio",
         "ring": "avería", "plate": "llave lavaplato", "red": "Ares", "hot": "Vermont", "small": "Cromo", "blue": "Soft Close",
         "large": "Inox Satinado", "old": "daño  en ruta"}
CODES = {"PROMO": " 60ar-7", "ECONOMY": "20ZZ99", "SMALL": "66-ES", "LARGE": "22PBX", "MEDIUM": "99ZZ"}


def _replaced(column: str) -> str:
    for word, other in WORDS.items():
        column = f"replace({column}, '{word}', '{other}')"
    return column


FITTING_ITEMS = f"""src AS (
  SELECT p_partkey, {_cases([(f"p_type = '{k}'", _text(v)) for k, v in CODES.items()])} AS code,
    {_replaced('p_name')} || ' ' || p_brand AS text FROM part)"""


@query("enrich_fittings", with_roles("", f"SELECT p_partkey, {OUT} FROM enriched", FITTING_ITEMS, enrich_sql(
    # The checking engine finds word ends by ASCII letters only; no given item has these brands.
    Taxonomy(**{**FITTINGS.__dict__, "brands": [b for b in FITTINGS.brands if b.isascii()]}))))
def enrich_fittings(spark, sf):
    name = F.col("p_name")
    for word, other in WORDS.items():
        name = F.replace(name, F.lit(word), F.lit(other))
    code = F.lit(None).cast("string")
    for key, value in CODES.items():
        code = F.when(F.col("p_type") == key, value).otherwise(code)
    rows = table(spark, sf, "part").select(
        "p_partkey", code.alias("codigo"), name.alias("nombre_item"), F.col("p_brand").alias("descripcion"))
    return flat(enrichment.classify(rows, FITTINGS), "p_partkey")


# Lines with their items judged; the item text is the part's name and type.
LINE_ITEMS = "src AS (SELECT line_id, header_id, monto_item, descripcion AS code, nombre_item || ' ' || codigo AS text FROM lins)"


def line_items(spark, sf):
    """Lines with items judged. Items are judged once per part, before the join, not once per line."""
    judged = enrichment.classify(table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("codigo"), F.col("p_name").alias("nombre_item"),
        F.col("p_brand").alias("descripcion")), PARTS).drop("codigo", "nombre_item", "descripcion")
    rows = table(spark, sf, "lineitem").select(
        line_id().alias("line_id"), F.col("l_orderkey").alias("header_id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("monto_item"),
        "l_partkey")
    return rows.join(judged, F.col("l_partkey") == F.col("p_partkey"), "left").drop("l_partkey", "p_partkey")


LINES = (LINE_ITEMS, enrich_sql(PARTS))


@query("category_mix", with_roles("lins", """
  SELECT ai_category, ai_subcategory, count(*) AS n, CAST(sum(monto_item) AS DECIMAL(38,2)) AS rev FROM enriched
  WHERE ai_category IS NOT NULL GROUP BY ALL ORDER BY rev DESC NULLS FIRST, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 30""", *LINES))
def category_mix(spark, sf):
    return enrichment.category_mix(line_items(spark, sf))


@query("brand_ranking", with_roles("lins", """
  SELECT ai_brand, count(*) AS n, CAST(sum(monto_item) AS DECIMAL(38,2)) AS rev FROM enriched
  WHERE ai_brand IS NOT NULL GROUP BY ALL ORDER BY rev DESC NULLS FIRST, 1 NULLS FIRST LIMIT 20""", *LINES))
def brand_ranking(spark, sf):
    return enrichment.brand_ranking(line_items(spark, sf))


@query("subcategory_pairs", with_roles("lins", """
  SELECT least(a.ai_subcategory, b.ai_subcategory) AS s1, greatest(a.ai_subcategory, b.ai_subcategory) AS s2, count(*) AS n
  FROM enriched a JOIN enriched b ON a.header_id = b.header_id AND a.line_id < b.line_id
  WHERE a.ai_subcategory IS NOT NULL AND b.ai_subcategory IS NOT NULL
  GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY n DESC, s1, s2 LIMIT 20""", *LINES))
def subcategory_pairs(spark, sf):
    pairs = enrichment.subcategory_pairs(line_items(spark, sf))
    return pairs.withColumn("n", F.col("n").cast("bigint"))


@query("items_of_category", with_roles("lins", """
  SELECT line_id, ai_category, monto_item FROM enriched WHERE ai_category = 'Budget' AND ai_subcategory = 'Economy line'
  ORDER BY monto_item DESC NULLS LAST, line_id LIMIT 200""", *LINES))
def items_of_category(spark, sf):
    return listing.items_of_category(line_items(spark, sf), "Budget", "Economy line").select(
        "line_id", "ai_category", "monto_item")


# Stored items of which the larger ones were judged before: by this version, or by an older one.
STORED = """stored AS (
  SELECT p_partkey AS line_id, p_type AS codigo, p_name AS nombre_item, p_brand AS descripcion,
    CASE WHEN p_size > 20 THEN 'As stored' END AS ai_category,
    CASE WHEN p_size > 35 THEN 'parts-1' WHEN p_size > 20 THEN 'parts-0' END AS ai_version FROM part)"""


def stored_items(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("line_id"), F.col("p_type").alias("codigo"), F.col("p_name").alias("nombre_item"),
        F.col("p_brand").alias("descripcion"), F.when(size > 20, "As stored").alias("ai_category"),
        F.lit(None).cast("string").alias("ai_subcategory"), F.lit(None).cast("string").alias("ai_brand"),
        F.lit(None).cast("struct<dimension:struct<w:int,h:int,d:int>,color:string,material:string>").alias("ai_attrs"),
        F.lit(None).cast("decimal(5,2)").alias("ai_confidence"),
        F.when(size > 35, "parts-1").when(size > 20, "parts-0").alias("ai_version"))


@query("enrichment_candidates", with_roles("", """
  SELECT line_id, ai_version FROM stored WHERE ai_version IS DISTINCT FROM 'parts-1'""", STORED))
def enrichment_candidates(spark, sf):
    return enrichment.candidates(stored_items(spark, sf), "parts-1").select("line_id", "ai_version")


@query("re_enriched_items", with_roles("", """
  SELECT line_id, ai_category, ai_version FROM stored WHERE ai_version = 'parts-1'
  UNION ALL SELECT line_id, ai_category, ai_version FROM enriched""", STORED,
    "src AS (SELECT line_id, codigo AS code, nombre_item || ' ' || descripcion AS text FROM stored WHERE ai_version IS DISTINCT FROM 'parts-1')",
    enrich_sql(PARTS)))
def re_enriched_items(spark, sf):
    return enrichment.enrich(stored_items(spark, sf), PARTS).select("line_id", "ai_category", "ai_version")


@query("unenriched_rate", with_roles("", """
  SELECT count(*) AS lines, CAST(round(count(*) FILTER (ai_category IS NULL) * 100.0 / greatest(count(*), 1), 2) AS DECIMAL(5,2)) AS unenriched_rate,
    CAST(round(count(*) FILTER (ai_category = 'As stored') * 100.0 / greatest(count(*), 1), 2) AS DECIMAL(5,2)) AS unclassified_rate FROM stored""", STORED))
def unenriched_rate(spark, sf):
    as_stored = Taxonomy(**{**PARTS.__dict__, "unclassified": "As stored"})
    return enrichment.unenriched_rate(stored_items(spark, sf), as_stored)
