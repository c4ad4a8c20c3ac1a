import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folioflow.functions import scalars as s
from folioflow.functions.text_fields import decode_entities, document_type, header_fields, visible_text


def values(spark, column, *texts, schema="t string"):
    df = spark.createDataFrame([(t,) if not isinstance(t, tuple) else t for t in texts], schema)
    return [r[0] for r in df.select(column).collect()]


def test_lenient_casts(spark):
    t = F.col("t")
    assert values(spark, s.whole(t), "1190.50", " 5 ", "", "+7", "x", None) == [None, 5, None, 7, None, None]
    assert values(spark, s.number(t), "2.000000", " 1e3 ", "NaN", "", "1,5") == [D("2.000000"), D("1000.000000"), None, None, None]
    assert values(spark, s.iso_day(t), "2025-1-5", "2025-02-30", "05-01-2025", "") == [dt.date(2025, 1, 5), None, None, None]
    assert values(spark, s.present(t), " a\n", "", "  ", None) == ["a", None, None, None]
    assert values(spark, s.squeeze(t), " a \n\t b ") == ["a b"]


def test_missing_price_and_quantity(spark):
    df = spark.createDataFrame(
        [("3", None, "100"), ("0", None, "100"), (None, None, "100"), (None, "30", "100"), (None, "0", "100"), ("2", None, None)],
        "q string, p string, m string")
    q, p, m = s.number(F.col("q")), s.number(F.col("p")), F.col("m").cast("decimal(18,2)")
    got = [tuple(r) for r in df.select(s.fill_price(p, q, m), s.fill_quantity(q, p, m)).collect()]
    zero = D("0.000000")
    assert got == [(D("33.33"), D(3)), (None, zero), (None, None), (D(30), D("3.333333")), (zero, None), (None, D(2))]


def test_money_halves_go_to_even(spark):
    assert values(spark, s.peso_amount(F.col("t")), "$ 1.190,50", "1.191,50", "2.500,51", "1.190", "", "abc", None) == [
        1190, 1192, 2501, 1190, None, None, None]


def test_written_days(spark):
    got = values(spark, s.written_day(F.col("t")), "14-10-2025", "14/10/2025", "2025\\10\\14", "5-1-25", "14-10-99", "14/10/68", "31-02-2025", None)
    day = dt.date(2025, 10, 14)
    assert got == [day, day, day, dt.date(2025, 1, 5), dt.date(1999, 10, 14), dt.date(2068, 10, 14), None, None]


def test_tax_ids(spark):
    rut = s.clean_rut(F.col("t"))
    assert values(spark, rut, " 11.111.111-k", "111111111", "1-2-3", "-", "1", "", None) == [
        "11111111-K", "11111111-1", "1-2", "", "1", "", None]
    assert values(spark, s.is_rut(rut), "11.111.111-k", "123-4", "1234567890-1") == [True, False, False]


def test_local_day_is_independent_of_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-07-01 02:30:00' AS a, TIMESTAMP '2024-07-01 02:30:00Z' AS b")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(s.local_day(F.col("a"))).first()[0] == dt.date(2024, 6, 30)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert df.select(s.local_day(F.col("b"), stored_zone=None)).first()[0] == dt.date(2024, 6, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scores_and_status(spark):
    df = spark.createDataFrame([(1, 10), (0, 0), (50, 10), (1, 3)], "v bigint, h bigint")
    score = s.health_score(F.col("v"), F.col("h"))
    assert [r[0] for r in df.select(score).collect()] == [D("90.00"), D("100.00"), D("0.00"), D("66.67")]
    assert [r[0] for r in df.select(s.score_band(score)).collect()] == ["warn", "ok", "bad", "bad"]
    st = spark.createDataFrame([(True, 0, 0), (False, 1, 0), (False, 0, 1), (False, 0, 0)], "c boolean, f int, e int")
    assert [r[0] for r in st.select(s.run_status(F.col("c"), F.col("f"), F.col("e"))).collect()] == ["ERROR", "PARTIAL", "PARTIAL", "OK"]
    assert [r[0] for r in df.select(s.per_hundred(F.col("v"), F.col("h"))).collect()] == [10.0, 0.0, 500.0, 100 / 3]


def test_document_types(spark):
    got = values(spark, document_type(F.col("t")), "Nota de Crédito de factura", "NOTA DE DÉBITO", "Boleta o factura",
                 "Factura\nno afecta o EXENTA", "exenta: factura", "Factura", "recibo")
    assert got == [61, 56, 39, 34, 34, 33, None]


def test_header_fields_from_text(spark):
    text = ("Factura Electrónica EXENTA N° 12345 RUT Emisor: 11.111.111-1 RUT Cliente: 22222222-2 "
            "Fecha Emisión: 14-10-2025 Monto Total: $ 1.190,50")
    other = "NOTA DE CREDITO folio #999 Fecha: 2025/10/14 total 2.500,51 rut destinatario 1-k"
    df = spark.createDataFrame([(text,), (other,), ("",)], "t string").select(*header_fields(F.col("t")))
    day = dt.date(2025, 10, 14)
    assert [tuple(r) for r in df.collect()] == [
        (34, 12345, "11.111.111-1", "22222222-2", day, 1190), (61, 999, None, "1-k", day, 2501), (None,) * 6]


def test_html_text(spark):
    html = "<html><title>T</title><style>p{}</style><script>var a='<p>';</script><p>a&nbsp;b<b>c</b>d<!-- x\n --> &lt;e&gt; &#233;&#xE9; &zz; & &#0;</p>"
    assert values(spark, visible_text(F.col("t")), html) == ["T a b c d <e> éé &zz; & &#0;"]
    assert values(spark, decode_entities(F.col("t")), "&amp;lt; &Oacute;", "none") == ["&lt; Ó", "none"]


@pytest.mark.parametrize("stored", ["UTC", None, "America/Lima"])
def test_day_bounds_agree_with_local_days(spark, stored):
    # Hours around both clock changes of the zone, which happen at midnight, and around plain midnights.
    hours = [dt.datetime(*d) + dt.timedelta(minutes=30 * i) for d in ((2024, 4, 6), (2024, 9, 7), (2024, 12, 31)) for i in range(96)]
    kind = "timestamp" if stored is None else "timestamp_ntz"
    df = spark.createDataFrame([(h.isoformat(" "),) for h in hours], "t string").select(F.col("t").cast(kind).alias("t"))
    day = s.local_day(F.col("t"), stored_zone=stored)
    bounds = [(dt.date(2024, 4, 6), dt.date(2024, 4, 7)), (dt.date(2024, 9, 8), dt.date(2024, 9, 8)), (None, dt.date(2024, 9, 7)), (dt.date(2025, 1, 1), None)]
    for first, last in bounds:
        want = (day >= F.lit(first) if first else F.lit(True)) & (day <= F.lit(last) if last else F.lit(True))
        got = s.within_days(F.col("t"), first, last, stored_zone=stored)
        assert df.filter(want != got).count() == 0 and 0 < df.filter(got).count() < df.count()
