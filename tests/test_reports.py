import datetime as dt
from decimal import Decimal as D

import pytest

from folioflow.operators import health, listing

RUNS = ("run_id string, job string, source string, started_at timestamp, ended_at timestamp, status string, headers_inserted bigint, "
        "details_inserted bigint, dq_violations bigint")


def runs(spark):
    at = dt.datetime
    return spark.createDataFrame([
        ("a", "etl_daily", "box", at(2025, 10, 20, 2), at(2025, 10, 20, 2, 0, 10), "OK", 10, 20, 1),
        ("b", "etl_daily", "box", at(2025, 10, 20, 12), at(2025, 10, 20, 12, 0, 20), "PARTIAL", 10, None, 4),
        ("c", "etl_daily", "ui", at(2025, 10, 20, 13), None, "RUNNING", 0, 0, 0),
        ("d", "manual_parse", "UI", at(2025, 10, 21, 12), at(2025, 10, 21, 12, 1), "OK", 5, 5, 5),
        ("e", "etl_daily", "box", at(2025, 8, 1), at(2025, 8, 1, 1), "OK", 0, 0, 3)], RUNS)


def test_daily_health(spark):
    got = {r.day: (r.headers, r.details, r.violations_total, r.score) for r in health.daily_health(runs(spark)).collect()}
    assert got == {dt.date(2025, 10, 19): (10, 20, 1, D("90.00")), dt.date(2025, 10, 20): (10, 0, 4, D("60.00")),
                   dt.date(2025, 7, 31): (0, 0, 3, D("100.00"))}
    assert tuple(health.daily_health(runs(spark), day=dt.date(2020, 1, 1)).first()) == (dt.date(2020, 1, 1), 0, 0, 0, D("100.00"))
    assert health.daily_health(runs(spark), zone="UTC").count() == 2


def days(spark, *scores):
    rows = [(dt.date(2025, 1, 1) + dt.timedelta(i), 1, 1, int(s), D(str(s))) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "day date, headers bigint, details bigint, violations_total bigint, score decimal(5,2)").repartition(3)


def test_trend_uses_rows_not_calendar_days(spark):
    df = days(spark, *range(40)).filter("day <> DATE '2025-02-05'")
    rows = health.health_trend(df).orderBy("day").collect()
    assert len(rows) == 30 and rows[0].delta1 is None and rows[0].avg7 == rows[0].score
    assert rows[-1].avg7 == D("35.57") and rows[-1].delta1 == D("1.00") and rows[-1].band == "bad"
    assert rows[-1].avg30 == D(str(round(sum([*range(9, 35), *range(36, 40)]) / 30, 2)))


def test_best_and_worst_day_prefer_the_latest(spark):
    got = health.best_and_worst_day(days(spark, 90, 50, 90, 50, 70)).first()
    assert tuple(got) == (dt.date(2025, 1, 3), D("90.00"), dt.date(2025, 1, 4), D("50.00"))


def test_spark_line(spark):
    got = [(r.x, r.y) for r in health.spark_line(days(spark, 10, 20, 30), "score").orderBy("day").collect()]
    assert got == [(D("2.0"), D("38.0")), (D("120.0"), D("20.0")), (D("238.0"), D("2.0"))]
    flat = health.spark_line(days(spark, 10, 10), "score").orderBy("day").collect()
    assert [r.y for r in flat] == [D("38.0"), D("38.0")]
    assert [(r.x, r.y) for r in health.spark_line(days(spark, 10), "score").collect()] == [(D("120.0"), D("38.0"))]


def test_run_statistics(spark):
    got = health.run_statistics(runs(spark), dt.date(2025, 10, 31)).first()
    assert tuple(got) == (D("15.00"), D("20.00"), 2, 1, D("50.00"))
    none = health.run_statistics(runs(spark), dt.date(2030, 1, 1)).first()
    assert tuple(none) == (D("0.00"), D("0.00"), 0, 0, None)


def test_snapshot(spark):
    files = spark.createDataFrame([("f1",), ("f2",)], "file_id string")
    headers = spark.createDataFrame([("f1",), ("f1",)], "file_id string")
    got = health.service_snapshot(runs(spark), files, headers).first()
    assert (got.backlog_unparsed_files, got.run_id, got.status) == (1, "d", "OK")
    none = health.service_snapshot(runs(spark).limit(0), files, headers).first()
    assert (none.backlog_unparsed_files, none.run_id) == (1, None)


def documents(spark):
    rows = [(i, 33 if i < 3 else 61, 100 + i, dt.date(2025, 1, i), "1111-1", "Emisor SA" if i % 2 else "Otro", "2222-2", "Recep SpA", D(i)) for i in range(1, 6)]
    return spark.createDataFrame(rows, "header_id bigint, tipo_dte int, folio bigint, fecha_emision date, rut_emisor string, razon_social_emisor string, "
                                       "rut_receptor string, razon_social_receptor string, mnt_total decimal(18,2)")


@pytest.mark.parametrize("filters, ids", [
    (dict(), [5, 4, 3, 2, 1]), (dict(tipo="33"), [2, 1]), (dict(tipo="x", folio=""), [5, 4, 3, 2, 1]), (dict(folio=" 104 "), [4]),
    (dict(date_from="2025-01-04", date_to="2025-01-02"), [4, 3, 2]), (dict(date_from="2025-13-01", date_to="2025-01-01"), [1]),
    (dict(issuer=" emisor "), [5, 3, 1]), (dict(issuer="1111"), [5, 4, 3, 2, 1]), (dict(issuer="o_ro"), [4, 2]),
    (dict(receiver="spa", tipo=61), [5, 4, 3]), (dict(receiver="nobody"), [])])
def test_document_filters(spark, filters, ids):
    assert [r.header_id for r in listing.latest_documents(documents(spark), **filters).collect()] == ids


def test_document_limit_and_export(spark):
    assert [r.header_id for r in listing.latest_documents(documents(spark), limit=2).collect()] == [5, 4]
    with pytest.raises(ValueError):
        listing.latest_documents(documents(spark), limit=5001)
    export = listing.export_rows(documents(spark), tipo=33)
    assert export.columns == ["ID", "Tipo", "Folio", "Fecha", "Emisor", "Receptor", "Monto Total"]
    assert [r.ID for r in export.collect()] == [2, 1]
    assert listing.listed_documents(documents(spark)).first().emisor == "1111-1 - Emisor SA"
    assert [r[0] for r in listing.pick_list(documents(spark), "tipo_dte").collect()] == [33, 61]


def test_one_document(spark):
    lines = spark.createDataFrame([("l2", 1, 2), ("l1", 1, 1), ("l0", 1, None), ("x", 9, 1)], "line_id string, header_id bigint, nro_linea int")
    assert [r.line_id for r in listing.one_document(documents(spark), lines, 1).collect()] == ["l1", "l2", "l0"]
    assert [r.line_id for r in listing.one_document(documents(spark), lines, 2).collect()] == [None]
    assert listing.one_document(documents(spark), lines, 9).count() == 0


def test_violation_filters(spark):
    at = dt.datetime
    rows = [("v1", "DQ2", "WARN", "detail", "7", at(2025, 10, 20, 2)), ("v2", "DQ1", "ERROR", "detail", "7", at(2025, 10, 20, 5)),
            ("v3", "DQ4", "WARN", "header", "8", at(2025, 10, 22))]
    df = spark.createDataFrame(rows, "violation_id string, rule_code string, rule_level string, entity string, header_id string, created_at timestamp")

    def ids(**f):
        return sorted(r.violation_id for r in listing.violations(df, **f).collect())

    assert ids() == ["v1", "v2", "v3"] and ids(code="DQ2") == ["v1"] and ids(code="DQ2", header_id="") == ["v1"]
    assert ids(level="WARN", entity="header") == ["v3"] and ids(header_id=7) == ["v1", "v2"]
    assert ids(date_from="2025-10-19", date_to="2025-10-19") == ["v1"]
    page = listing.page_of(listing.violations(df), "created_at", "violation_id", page=2, page_size=2)
    assert [r.violation_id for r in page.collect()] == ["v1"]
    assert listing.total_rows(listing.violations(df, code="DQ2")).first().total == 1


def test_audit_and_run_filters(spark):
    log = spark.createDataFrame([(1, dt.datetime(2025, 10, 20, 2), "u@x", "/etl/Parse", "POST", 303), (2, dt.datetime(2025, 10, 20, 9), "-", "/home", "GET", 200)],
                                "id int, ts timestamp, user string, path string, method string, status int")

    def ids(**f):
        return sorted(r.id for r in listing.audit_entries(log, **f).collect())

    assert ids(status="") == [1, 2] and ids(status="abc") == [1, 2] and ids(status="303") == [1]
    assert ids(path="parse") == [1] and ids(user="-") == [2] and ids(method="GET") == [2] and ids(date_to="2025-10-19") == [1]

    def run_ids(**f):
        return sorted(r.run_id for r in listing.runs(runs(spark), **f).collect())

    assert run_ids(job="etl_daily", status="OK") == ["a", "e"] and run_ids(source="ui") == ["c", "d"]
    assert run_ids(started_from="2025-10-20", started_to="2025-10-19") == ["a", "b", "c"]
    assert listing.run_by_id(runs(spark), "b").first().status == "PARTIAL"
