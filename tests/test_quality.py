import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folioflow.operators import consistency, curated, dedupe, quality
from folioflow.schema import missing_rules, rule_catalogue
from folioflow.sources import xml_documents as xml
from samples import BARE, FAULTY, VALID, document, envelope, line

AS_OF = dt.date(2025, 10, 31)
LINES = "line_id string, header_id string, nro_linea int, cantidad decimal(18,6), precio_unitario decimal(18,6), monto_item decimal(18,2)"
HEADERS = "header_id string, file_id string, tipo_dte int, folio bigint, rut_emisor string, fecha_emision date, mnt_neto decimal(18,2), mnt_total decimal(18,2)"


def parsed(spark, *texts):
    files = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string")
    docs = xml.parsed_documents(xml.whole_file_documents(files))
    return docs.withColumn("file_id", F.col("file")), xml.document_lines(docs)


def lines_of(spark, *rows):
    return spark.createDataFrame([(f"l{i}", h, i, *[None if v is None else D(str(v)) for v in values])
                                  for i, (h, *values) in enumerate(rows)], LINES)


def codes(df):
    return sorted((r.rule_id, r.entity_id) for r in df.collect())


def test_published_samples(spark):
    headers, lines = parsed(spark, VALID, FAULTY, BARE)
    found = quality.find_violations(headers, lines, as_of=AS_OF, run_id="r")
    assert codes(found) == [(2, "33:10002:11111111-1#2"), (2, "33:1001:11111111-1#1")]
    off = {r.header_id: (r.mnt_total, r.sumdet) for r in consistency.totals_mismatch(headers, lines).collect()}
    assert off == {"33:10001:11111111-1": (D("29750.00"), D("25000.00")), "33:10002:11111111-1": (D("28200.00"), D("25500.00"))}
    net = consistency.totals_mismatch(headers, lines, compare_to="mnt_neto")
    assert {r.header_id for r in net.collect()} == {"33:1001:11111111-1", "33:10002:11111111-1"}
    assert quality.find_violations(headers, lines, as_of=AS_OF, check_totals=True).filter("rule_id = 4").count() == 2


def test_null_and_edge_values(spark):
    lines = lines_of(spark, ("h", None, 5, 0), ("h", 0, 5, 0), ("h", -1, 1, -1), ("h", 1, -1, -1), ("h", 1, None, 0), ("h", 1, None, None),
                     ("h", 2, 50, 101), ("h", 2, 50, "101.01"), ("h", 1, None, 2))
    got = {}
    for r in quality.broken_rules(lines, quality.line_rules(), F.col("line_id")).collect():
        got.setdefault(r.line_id, set()).add(r.rule_code)
    assert got == {"l0": {"DQ1"}, "l1": {"DQ1"}, "l2": {"DQ1"}, "l3": {"DQ1"}, "l7": {"DQ2"}, "l8": {"DQ2"}}


def test_issue_day(spark):
    days = [dt.date(1999, 12, 31), dt.date(2000, 1, 1), AS_OF + dt.timedelta(1), AS_OF + dt.timedelta(2), None]
    df = spark.createDataFrame([(d,) for d in days], "fecha_emision date")
    assert [r[0] for r in df.select(quality.day_out_of_range(AS_OF)).collect()] == [True, False, False, True, False]


def test_rule_results_count_every_row(spark):
    lines = lines_of(spark, ("h", 0, 1, 0), ("h", 1, 1, 1), ("h", None, None, None))
    got = {r.rule_code: (r.passed, r.failed) for r in quality.rule_results(lines, quality.line_rules()).collect()}
    assert got == {"DQ1": (1, 2), "DQ2": (3, 0)}


def test_a_catalogue_without_a_rule_yields_nothing_for_it(spark):
    headers, lines = parsed(spark, FAULTY)
    some = rule_catalogue(spark).filter("rule_code <> 'DQ2'")
    assert quality.find_violations(headers, lines, as_of=AS_OF, rules=some).count() == 0
    assert sorted(r.rule_code for r in missing_rules(some).collect()) == ["DQ2"]


def violations(spark):
    rows = [("v1", "r", 1, "detail", "l1"), ("v2", "r", 2, "detail", "l1"), ("v3", "r", 2, "detail", "l2"), ("v4", "r", 3, "header", "h2"),
            ("v5", "r", 2, "detail", "gone")]
    return spark.createDataFrame([(*r, "m", dt.datetime(2025, 10, 20, 2)) for r in rows],
                                 "violation_id string, run_id string, rule_id bigint, entity string, entity_id string, message string, created_at timestamp")


def test_flags_and_owner(spark):
    headers = spark.createDataFrame([("h1", "f1", 33, 1, "1-9", AS_OF, D(1), D(1)), ("h2", "f1", 33, 2, "1-9", AS_OF, D(1), D(1))], HEADERS)
    for c in ("razon_social_emisor", "rut_receptor", "razon_social_receptor", "iva"):
        headers = headers.withColumn(c, F.lit(None).cast("string"))
    lines = lines_of(spark, ("h1", 1, 1, 1), ("h1", 1, 1, 1), ("h2", 1, 1, 1), ("h2", 1, 1, 1))
    for c in ("tipo_codigo", "codigo", "nombre_item", "descripcion"):
        lines = lines.withColumn(c, F.lit(None).cast("string"))
    rules = rule_catalogue(spark)
    fact = curated.fact_lines(headers, lines, violations(spark), rules)
    assert len(fact.columns) == 22
    assert sorted((r.detail_id, r.dq_has_error, r.dq_has_warn) for r in fact.collect()) == [
        ("l0", False, False), ("l1", True, True), ("l2", False, True), ("l3", False, False)]
    owned = curated.violations_enriched(violations(spark), rules, lines)
    assert {r.violation_id: r.header_id for r in owned.collect()} == {"v1": "h1", "v2": "h1", "v3": "h2", "v4": "h2", "v5": None}
    of_h2 = quality.of_documents(owned, headers.filter("header_id = 'h2'"))
    assert sorted(r.violation_id for r in of_h2.collect()) == ["v3", "v4"]
    assert len(curated.line_detail(headers, lines).columns) == 20


def test_summary(spark):
    rules = rule_catalogue(spark)
    got = {(r.section, r.item): r.n for r in quality.quality_summary(violations(spark), rules).collect()}
    assert got == {("by_level", "ERROR"): 1, ("by_level", "WARN"): 4, ("by_rule", "DQ1"): 1, ("by_rule", "DQ2"): 3,
                   ("by_rule", "DQ4"): 1, ("by_day", "2025-10-19"): 5}
    assert {r.rule_level: r.n for r in quality.by_level(violations(spark), rules).collect()} == {"ERROR": 1, "WARN": 4}
    utc = quality.by_day(violations(spark), zone="UTC").collect()
    assert [(r.day, r.n) for r in utc] == [(dt.date(2025, 10, 20), 5)]


def test_alert_threshold(spark):
    runs = spark.createDataFrame([("r", 500), ("quiet", 1000), ("empty", None)], "run_id string, details_inserted bigint")
    got = {r.run_id: (r.violations, r.lines, r.viol_x_100, r.alert) for r in quality.violations_per_hundred(violations(spark), runs).collect()}
    assert got == {"r": (5, 500, D("1.0000"), True), "quiet": (0, 1000, D("0.0000"), False), "empty": (0, 1, D("0.0000"), False)}


def test_consistency(spark):
    headers = spark.createDataFrame(
        [("h1", "f1", 33, 1, "1-9", AS_OF, D(10), D(10)), ("h2", "f1", 33, 1, "1-9", AS_OF, D(5), None), ("h3", "f2", 33, 3, "1-9", AS_OF, D(5), D(5))], HEADERS)
    lines = lines_of(spark, ("h1", 1, 1, 6), ("h1", 1, 1, 3), ("h2", 1, 1, None), ("lost", 1, 1, 9))
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "file_id string")
    got = {r.metric: r.value for r in consistency.consistency_report(files, headers, lines, violations(spark), rule_catalogue(spark)).collect()}
    assert got == {"files.total": 3, "files.with_headers": 2, "headers.total": 3, "details.total": 4, "dq.violations_total": 5,
                   "headers.without_details": 1, "headers.duplicate_groups_count": 1, "details.orphans": 1,
                   "totals_check.mismatch_count": 1, "dq.by_level.ERROR": 1, "dq.by_level.WARN": 4}
    assert [r.header_id for r in consistency.totals_mismatch(headers, lines).collect()] == ["h3"]
    assert consistency.backlog(files, headers).first()[0] == 1
    assert [r.file_id for r in consistency.unparsed_files(files, headers).collect()] == ["f3"]
    assert consistency.duplicate_sample(headers).first().n == 2


def test_first_wins_with_a_hot_key(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    (9000 - F.col("id")).alias("at"), F.col("id").alias("v")).repartition(7)
    got = dedupe.first_wins(rows, ["k"], ["at"])
    assert got.count() == 6001 and got.filter("k = 'hot'").first().v == 8997
    nulls = spark.createDataFrame([(None, 2, "b"), (None, 1, "a")], "k string, at int, v string")
    assert [r.v for r in dedupe.first_wins(nulls, ["k"], ["at"]).collect()] == ["a"]


def test_only_new(spark):
    schema = "tipo_dte int, folio bigint, rut_emisor string"
    new = spark.createDataFrame([(33, 1, "a"), (33, 2, "a"), (39, 1, "a")], schema)
    old = spark.createDataFrame([(33, 1, "a"), (33, 2, "b")], schema)
    assert sorted((r.tipo_dte, r.folio) for r in dedupe.only_new(new, old).collect()) == [(33, 2), (39, 1)]


def test_reject_reasons(spark):
    docs = [document(1, [line()], net=None), document(2, [line(1), line(1)]), document(3, [line(1, "x" * 256)]),
            document(4, [line("", "a"), line("", "b")]), document(5, [line()], issuer="1" * 17), document(6, [line()], day="")]
    headers, _ = parsed(spark, *[envelope(d) for d in docs])
    kept, rejected = dedupe.split_rejects(headers)
    assert {r.folio: r.reason for r in rejected.collect()} == {
        1: "missing mnt_neto", 2: "repeated nro_linea", 3: "line text too long", 5: "header text too long", 6: "missing fecha_emision"}
    assert [r.folio for r in kept.collect()] == [4], "line numbers may be absent"


def test_file_scope_rejects_every_document_of_the_file(spark):
    headers, _ = parsed(spark, envelope(document(1, [line()]), document(2, [line()], net=None)), envelope(document(3, [line()])))
    kept, rejected = dedupe.split_rejects(headers, "file")
    assert [r.folio for r in kept.collect()] == [3]
    assert {r.folio: r.reason for r in rejected.collect()} == {1: "file: missing mnt_neto", 2: "missing mnt_neto"}
    with pytest.raises(ValueError):
        dedupe.split_rejects(headers, "row")


def test_repeated_lines(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None)], "header_id string, nro_linea int")
    assert [tuple(r) for r in dedupe.repeated_lines(lines).collect()] == [("a", 1, 2)]


def test_unparsed_files_holds_no_set_of_ids(spark):
    """A task that reads many documents keeps no table of their files; files with many documents and repeated or null ids count as before."""
    files = spark.createDataFrame([("f1", "a"), ("f2", "b"), ("f2", "b"), ("f3", "c"), (None, "d")], "file_id string, filename string")
    headers = spark.createDataFrame([("f1",)] * 50 + [(None,), ("f9",)], "file_id string")
    got = consistency.unparsed_files(files, headers)
    assert sorted((r.file_id or "-", r.filename) for r in got.collect()) == [("-", "d"), ("f2", "b"), ("f2", "b"), ("f3", "c")]
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
