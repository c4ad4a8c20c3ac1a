import itertools
import random
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folioflow.functions.taxonomy import FITTINGS, Taxonomy
from folioflow.operators import enrichment, listing


def classify(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "line_id int, codigo string, nombre_item string, descripcion string")
    return [r for r in enrichment.classify(df).orderBy("line_id").collect()]


def short(r):
    return (r.ai_category, r.ai_subcategory, r.ai_brand, r.ai_confidence)


def test_fittings(spark):
    got = classify(
        spark, ("60ar-1", "nada", None), ("60PB12", "nada", None), ("60A", "TAZA WC", None), (None, "Llave Arona", "cromo INOX"),
        (None, "DAÑO EN RUTA", None), ("60AR", "daño  en ruta Vermont", None), (".", "espejo", None), (None, None, None),
        (None, "grifo ÓPTIMA", None), ("20ZZ", "Monomando Arezzo cromo urea", None), (None, None, "espejo"), (" 66es9", "", "x"))
    assert [short(r) for r in got] == [
        ("Sanitarios", "WC Suite / Repuestos", "Ares", D("0.80")), ("Muebles", "Mueble Vanitorio", None, D("0.80")),
        ("Sanitarios", "WC Suite / Repuestos", None, D("0.55")), ("Sin Clasificar", None, "Arona", D("0.49")),
        ("No Merch", "Ajuste/Incidencia", None, D("0.95")), ("No Merch", "Ajuste/Incidencia", "Ares", D("0.95")),
        ("No Merch", "Ajuste/Incidencia", None, D("0.95")), ("Sin Clasificar", None, None, D("0.40")),
        ("Sin Clasificar", None, "Óptima", D("0.45")), ("Grifería", "Monomando (Arezzo)", "Arezzo", D("0.99")),
        ("Accesorios", "Espejo", None, D("0.55")), ("Accesorios", "Espejo", None, D("0.80"))]
    assert {r.ai_version for r in got} == {"v0.2"}


def test_attributes(spark):
    got = classify(spark, (None, "mueble 60x46", None), (None, "80 X 46 x 90 Inox Satinado", None), (None, "urea soft close", None), (None, "5x5", None))
    assert tuple(got[0].ai_attrs.dimension) == (60, 46, None) and got[0].ai_attrs.color is None
    assert tuple(got[1].ai_attrs.dimension) == (80, 46, 90)
    assert (got[1].ai_attrs.color, got[1].ai_attrs.material) == ("Inox Satinado", "Inox"), "list order decides"
    assert got[2].ai_attrs.material == "Urea"
    assert got[3].ai_attrs is None


def test_words_end_at_accents_too(spark):
    got = classify(spark, (None, "Zoé", None), (None, "Zoéx", None), (None, "espejoñ", None))
    assert [r.ai_brand for r in got] == ["Zoé", None, None]
    assert got[2].ai_category == "Sin Clasificar"


def test_prefix_without_subcategory_takes_the_keywords(spark):
    t = Taxonomy("v", {"AAAA": ("Cat", None, None)}, [(r"\bnut\b", ("Other", "Nuts"))], [], [], [], r"\bnever\b")
    df = spark.createDataFrame([(1, "AAAA", "nut", None)], "line_id int, codigo string, nombre_item string, descripcion string")
    assert short(enrichment.classify(df, t).first()) == ("Cat", "Nuts", None, D("0.95"))


def test_only_other_versions_are_judged(spark):
    df = spark.createDataFrame([(1, None, "espejo", None, "Kept", "v0.2"), (2, None, "espejo", None, "Old", "v0.1"), (3, None, "espejo", None, None, None)],
                               "line_id int, codigo string, nombre_item string, descripcion string, ai_category string, ai_version string")
    for c, t in (("ai_subcategory", "string"), ("ai_brand", "string"), ("ai_confidence", "decimal(5,2)"),
                 ("ai_attrs", "struct<dimension:struct<w:int,h:int,d:int>,color:string,material:string>")):
        df = df.withColumn(c, F.lit(None).cast(t))
    assert {r.line_id: r.ai_category for r in enrichment.enrich(df).collect()} == {1: "Kept", 2: "Accesorios", 3: "Accesorios"}
    assert {r.ai_category for r in enrichment.enrich(df, force=True).collect()} == {"Accesorios"}
    assert [r.line_id for r in enrichment.candidates(df, "v0.2", limit=1).collect()] == [3]
    assert enrichment.candidates(df, "v0.2", force=True).count() == 3


def brute_pairs(rows, include_self=True):
    n = Counter()
    by_doc = {}
    for doc, sub in rows:
        if sub is not None:
            by_doc.setdefault(doc, []).append(sub)
    for subs in by_doc.values():
        for a, b in itertools.combinations(subs, 2):
            if include_self or a != b:
                n[(min(a, b), max(a, b))] += 1
    return n


def test_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    names = [f"s{i}" for i in range(9)]
    rows = [("hot" if rng.random() < 0.33 else f"d{rng.randrange(60)}", rng.choice([*names, None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "header_id string, ai_subcategory string").repartition(5)
    got = {(r.s1, r.s2): int(r.n) for r in enrichment.subcategory_pairs(df, top=None).collect()}
    assert got == {k: v for k, v in brute_pairs(rows).items() if v >= 3}
    top = enrichment.subcategory_pairs(df, min_count=1, top=4, include_self=False).collect()
    want = sorted(brute_pairs(rows, False).items(), key=lambda e: (-e[1], e[0]))[:4]
    assert [((r.s1, r.s2), int(r.n)) for r in top] == want


def test_reports(spark):
    rows = [(1, "A", None, "b", 10), (2, "A", "x", "b", None), (3, "B", "y", None, 5), (4, None, None, None, 100), (5, "Sin Clasificar", None, None, 1)]
    df = spark.createDataFrame([(i, c, s, b, None if m is None else D(m)) for i, c, s, b, m in rows],
                               "line_id int, ai_category string, ai_subcategory string, ai_brand string, monto_item decimal(18,2)")
    assert [(r.ai_category, r.ai_subcategory, r.n) for r in enrichment.category_mix(df).collect()] == [
        ("A", "x", 1), ("A", None, 1), ("B", "y", 1), ("Sin Clasificar", None, 1)], "unknown revenue first"
    assert [(r.ai_brand, r.n, r.rev) for r in enrichment.brand_ranking(df).collect()] == [("b", 2, D("10.00"))]
    assert tuple(enrichment.unenriched_rate(df).first()) == (5, D("20.00"), D("20.00"))
    assert [r.line_id for r in listing.items_of_category(df, "A", "none").collect()] == []
    assert [r.line_id for r in listing.items_of_category(df, "A", "-").collect()] == [1]
    assert [r.line_id for r in listing.items_of_category(df, "A", "x").collect()] == [2]


def test_subcategories_cover_what_the_classifier_gives(spark):
    assert "Ajuste/Incidencia" in FITTINGS.subcategories() and len(FITTINGS.subcategories()) == len(set(FITTINGS.subcategories()))
