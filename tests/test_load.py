import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folioflow.functions.taxonomy import FITTINGS
from folioflow.operators import consistency, curated, listing
from folioflow.plans import ingest
from folioflow.plans.enrich import enrich_store, lines_with_enrichment
from folioflow.plans.ingest import Run, alert, ingest_folder, ingest_texts, initial_load
from folioflow.plans.reports import enrichment_overview, publish_curated
from folioflow.schema import rule_catalogue
from folioflow.sources.store import Store, append_violations, publish, write_export
from folioflow.sources.text_documents import headers_from_text, text_files
from folioflow.streaming import events
from folioflow.streaming.ingest import stream_ingest
from samples import BARE, FAULTY, VALID, document, envelope, line

AS_OF = dt.date(2025, 10, 31)


def run(name, day=20, job="etl_daily"):
    return Run(run_id=name, job=job, source="test", started_at=dt.datetime(2025, 10, day, 12, tzinfo=dt.timezone.utc))


def counters(row):
    return (row.status, row.files_total, row.files_ok, row.files_failed, row.headers_inserted, row.headers_already_present,
            row.details_inserted, row.dq_violations)


def contents(store):
    def rows(table, *columns):
        return sorted(tuple(r) for r in store.read(table).select(*columns).collect())

    return (rows("headers", "header_id", "mnt_total"), rows("lines", "line_id", "monto_item"),
            rows("violations", "rule_id", "entity_id"), rows("rejects", "header_id", "reason"))


def test_load_repeat_retry(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a [1] b.xml").write_text(VALID)
    (folder / "b.xml").write_text(FAULTY)
    (folder / "c.xml").write_text(VALID[:-30])
    first = ingest_folder(store, str(folder), run("one"), as_of=AS_OF).first()
    assert counters(first) == ("PARTIAL", 3, 2, 1, 2, 0, 4, 1)
    assert [(e.where, e.message) for e in first.errors] == [("parse", "malformed XML: 1")]
    assert first.ended_at is not None and first.job == "etl_daily"
    before = contents(store)
    assert len(before[1]) == 4 and before[2] == [(2, "33:10002:11111111-1#2")]

    again = ingest_folder(store, str(folder), run("two"), as_of=AS_OF).first()
    assert counters(again) == ("OK", 0, 0, 0, 0, 0, 0, 0), "all names are known, the failed one too"
    assert contents(store) == before

    same = ingest_folder(store, str(folder), run("one"), as_of=AS_OF).first()
    assert counters(same) == counters(first), "the same id replaces its own rows"
    assert contents(store) == before

    # The copy under a new name brings nothing new, a mended file comes in on request.
    (folder / "copy.xml").write_text(VALID)
    (folder / "c.xml").write_text(envelope(document(7, [line()])))
    third = ingest_folder(store, str(folder), run("three", 21), retry_failed=True, as_of=AS_OF).first()
    assert counters(third) == ("OK", 2, 2, 0, 1, 1, 1, 0)
    assert {r.filename: r.status for r in store.read("files").filter("load_id = 'three'").collect()} == {"copy.xml": "OK", "c.xml": "OK"}

    health = {r.day: (r.headers, r.details, r.violations_total, r.score) for r in store.health().collect()}
    assert health == {dt.date(2025, 10, 20): (2, 4, 1, D("50.00")), dt.date(2025, 10, 21): (1, 1, 0, D("100.00"))}
    assert alert(store, "one").first().alert and alert(store, "one").first().viol_x_100 == D("25.0000")
    assert not alert(store, "three").first().alert


def test_unfinished_loads_are_not_read(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(VALID)
    ingest_folder(store, str(folder), run("one"), as_of=AS_OF)
    # As after a crash before the run log was written.
    store.write("headers", "crashed", store.read("headers").drop("load_id"))
    store.write("lines", "crashed", store.read("lines").drop("load_id"))
    assert store.read("headers").count() == 1 and store.read("lines").count() == 2
    (folder / "b.xml").write_text(FAULTY)
    assert ingest_folder(store, str(folder), run("crashed"), as_of=AS_OF).first().headers_inserted == 1
    assert store.read("headers").count() == 2 and store.read("lines").count() == 4


def test_first_document_wins_and_rejects(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "b.xml").write_text(envelope(document(1, [line(name="from b")])))
    (folder / "a.xml").write_text(envelope(
        document(1, [line(name="first")]), document(1, [line(name="second"), line(2)]), document(2, [line()], net=None), document(3, [line(1), line(1)])))
    (folder / "none.xml").write_text("<EnvioDTE/>")
    row = initial_load(store, str(folder), as_of=AS_OF).first()
    assert counters(row) == ("PARTIAL", 3, 3, 0, 1, 2, 1, 0) and (row.job, row.source) == ("initial_load", "bootstrap")
    assert [r.nombre_item for r in store.read("lines").collect()] == ["first"]
    assert contents(store)[3] == [("33:2:11111111-1", "missing mnt_neto"), ("33:3:11111111-1", "repeated nro_linea")]
    assert store.health().count() == 0, "only the daily job feeds the health table"


def test_file_scope(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(envelope(document(1, [line()]), document(2, [line()], net=None)))
    (folder / "b.xml").write_text(envelope(document(3, [line()])))
    row = ingest_folder(store, str(folder), run("one"), scope="file", as_of=AS_OF).first()
    assert counters(row) == ("PARTIAL", 2, 1, 1, 1, 0, 1, 0)


def test_xsd_bars_files(spark, folder, tmp_path):
    schema = tmp_path / "dte.xsd"
    schema.write_text('<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="DTE"><xs:complexType><xs:sequence>'
                      '<xs:element name="Documento" maxOccurs="1"><xs:complexType><xs:sequence><xs:any maxOccurs="unbounded" processContents="skip"/></xs:sequence>'
                      '</xs:complexType></xs:element></xs:sequence><xs:attribute name="s"/></xs:complexType></xs:element></xs:schema>')
    doc = document(1, [line()], attr="")
    (folder / "a.xml").write_text(f'<DTE s="EnvioDTE_v10.xsd">{doc}</DTE>')
    (folder / "b.xml").write_text(f'<DTE s="EnvioDTE_v10.xsd">{document(2, [line()], attr="")}{doc}</DTE>')
    store = Store(spark, str(tmp_path / "store"))
    row = ingest_folder(store, str(folder), run("one"), xsd_paths={"dte": str(schema)}, as_of=AS_OF).first()
    assert counters(row) == ("PARTIAL", 2, 1, 1, 1, 0, 1, 0)
    assert [e.message for e in row.errors] == ["xsd dte: 1"]


def test_many_new_files_are_loaded_in_slices(spark, folder, tmp_path, monkeypatch):
    opened = []
    scan = ingest.scan_documents
    monkeypatch.setattr(ingest, "scan_documents", lambda spark, paths, **more: (opened.append(paths), scan(spark, paths, **more))[1])
    store = Store(spark, str(tmp_path / "store"))
    for i in range(5):
        (folder / f"{i}.xml").write_text(envelope(document(i + 1, [line()])))
    rows = ingest_folder(store, str(folder), run("one"), files_per_load=2, as_of=AS_OF).collect()
    assert sum(r.headers_inserted for r in rows) == 5 and {r.run_id[:4] for r in rows} == {"one."} and len(rows) == len(opened) > 1
    assert sorted(p.rsplit("/", 1)[1] for paths in opened for p in paths) == [f"{i}.xml" for i in range(5)]
    before = contents(store)
    (folder / "6.xml").write_text(envelope(document(6, [line()])))
    opened.clear()
    assert ingest_folder(store, str(folder), run("two"), files_per_load=2, as_of=AS_OF).first().headers_inserted == 1
    assert [p.rsplit("/", 1)[1] for paths in opened for p in paths] == ["6.xml"], "old files are not opened"
    (folder / "6.xml").unlink()
    ingest_folder(store, str(folder), run("one"), files_per_load=2, as_of=AS_OF)
    assert [x for x in contents(store)[0] if ":6:" not in x[0]] == before[0], "the same id takes the same slices"


def test_printed_documents_are_loaded(spark, folder, tmp_path):
    def page(folio, total="5.000", more=""):
        return f"<p>Factura</p><b>Folio: {folio}</b> RUT Emisor: 76.123.456-7 RUT Receptor: 11.222.333-4 Fecha: 14-10-2025 Total $ {total}{more}"

    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.HTML").write_text(page(1001))
    (folder / "b.txt").write_text(page(1002, "7.500"))
    (folder / "c.htm").write_text("<p>nothing to read</p>")
    (folder / "d.xml").write_text(VALID)
    row = ingest_texts(store, str(folder), run("one", job="text_ingest"), as_of=AS_OF).first()
    assert counters(row)[:7] == ("PARTIAL", 3, 3, 0, 2, 0, 0)
    assert [(r.folio, r.mnt_total, r.mnt_neto) for r in store.read("headers").orderBy("folio").collect()] == [(1001, D("5000.00"), None), (1002, D("7500.00"), None)]
    assert [(r.file.rsplit("/", 1)[1], r.message) for r in store.read("errors").collect()] == [("c.htm", "missing tipo_dte")]
    assert ingest_texts(store, str(folder), run("two", job="text_ingest"), as_of=AS_OF).first().files_total == 0
    streamed = Store(spark, str(tmp_path / "streamed"))
    stream_ingest(streamed, str(folder), str(tmp_path / "checkpoint"), texts=True, as_of=AS_OF).awaitTermination()
    assert contents(streamed)[0] == contents(store)[0]


def test_compaction_changes_no_rows(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.compact() is None
    for i in range(3):
        docs = [document(10 * i + j, [line(), line(2)], issuer=f"{i}{j}-K") for j in range(4)]
        (folder / f"{i}.xml").write_text(envelope(*docs))
        ingest_folder(store, str(folder), run(f"r{i}"), as_of=AS_OF)
    before, old_reader = contents(store), store.read("headers")
    assert store.compact() is not None
    assert contents(store) == before and old_reader.count() == 12
    assert store.sweep() == 3 and contents(store) == before
    text = store.history(store.read("headers").filter("rut_emisor = '00-K'").select("rut_emisor"))._jdf.queryExecution().executedPlan().toString()
    assert "key_range" in text.split("PartitionFilters: [")[-1].split("PushedFilters")[0] or "key_range#" in text
    (folder / "again.xml").write_text((folder / "0.xml").read_text())
    (folder / "new.xml").write_text(envelope(document(77, [line()], issuer="99-K")))
    row = ingest_folder(store, str(folder), run("r3"), as_of=AS_OF).first()
    assert (row.headers_inserted, row.headers_already_present) == (1, 4), "compacted headers are found by their range"
    ingest_folder(store, str(folder), run("r4"), as_of=AS_OF)
    assert store.compact() is not None and len(contents(store)[0]) == 13
    (folder / "1.xml").write_text(envelope(document(500, [line()])))
    ingest_folder(store, str(folder), run("r1"), as_of=AS_OF)
    heads = {h for h, _ in contents(store)[0]}
    assert "33:500:11111111-1" in heads and "33:10:10-K" not in heads, "a load that is written again counts from its own folder"


def test_one_error_per_failed_file(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for i in range(3):
        (folder / f"{i}.xml").write_text(VALID[:-9 - i])
    row = ingest_folder(store, str(folder), run("one"), as_of=AS_OF).first()
    assert [(e.where, e.message) for e in row.errors] == [("parse", "malformed XML: 3")]
    assert sorted((r.file.rsplit("/", 1)[1], r.where, r.message) for r in store.read("errors").collect()) == [(f"{i}.xml", "parse", "malformed XML") for i in range(3)]


def test_schemas_hold_for_files_of_any_size(spark, folder, tmp_path, monkeypatch):
    schema = tmp_path / "dte.xsd"
    schema.write_text('<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="DTE" type="xs:int"/></xs:schema>')
    (folder / "a.xml").write_text(f'<DTE s="EnvioDTE_v10.xsd">{document(1, [line()])}</DTE>')
    (folder / "b.xml").write_text(VALID)
    store = Store(spark, str(tmp_path / "store"))
    ingest_folder(store, str(folder), run("one"), xsd_paths={"dte": str(schema)}, whole_file_bytes=1, as_of=AS_OF)
    assert [(r.file.rsplit("/", 1)[1], r.message) for r in store.read("errors").collect()] == [("a.xml", "xsd dte")]
    found = ingest.refused(spark, str(folder), {"dte": str(schema)}, most_bytes=600).collect()
    assert {(r.file.rsplit("/", 1)[1], r.reason) for r in found} >= {("b.xml", "xsd not checked: file too large")}


def test_sinks(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(VALID)
    (folder / "b.xml").write_text(FAULTY)
    ingest_folder(store, str(folder), run("one"), as_of=AS_OF)
    heads, lines = store.read("headers").drop("load_id"), store.read("lines").drop("load_id")
    out = str(tmp_path / "csv")
    write_export(listing.export_rows(heads), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns[0] == "ID" and [r.Folio for r in back.collect()] == ["10002", "10001"]
    fact = curated.fact_lines(heads, lines, store.read("violations").drop("load_id"), rule_catalogue(spark))
    publish(fact, str(tmp_path / "fact"), "fecha_emision")
    assert spark.read.parquet(str(tmp_path / "fact")).filter("month = '2025-10' AND dq_has_warn").count() == 1
    publish(curated.dim_issuer(heads), str(tmp_path / "dim"))
    assert spark.read.parquet(str(tmp_path / "dim")).count() == 1
    paths = publish_curated(store, rule_catalogue(spark))
    assert {p.rsplit("/", 1)[1]: spark.read.parquet(p).count() for p in paths} == {
        "fact_dte_lines": 4, "dim_emisor": 1, "dim_receptor": 1, "fct_dte_daily_totals": 1, "dq_violations_enriched": 1,
        "v_dte_detail": 4, "v_dte_kpi_daily": 1}
    append_violations(store.read("violations"), str(tmp_path / "v"))
    append_violations(store.read("violations"), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2
    store.append_audit(spark.createDataFrame([("xml_parse", "file", '{"n": 1}')], "action string, resource string, extra string"))
    store.append_audit(spark.createDataFrame([("u@x", "xsd_invalid", 422)], "user string, action string, status int"))
    got = sorted((r.user, r.path, r.method, r.status, r.extra) for r in store.audit().collect())
    assert got == [("-", "/action/xml_parse", "POST", 0, '{"n": 1}'), ("u@x", "/action/xsd_invalid", "POST", 422, "{}")]


def test_text_ingest(spark, folder):
    (folder / "a.HTML").write_text("<p>Factura</p><b>Folio: 123</b> Total $ 5.000", encoding="utf-8")
    (folder / "b.txt").write_bytes("Boleta N° 456 \xff Fecha: 2025-1-5".encode("utf-8").replace("ÿ".encode(), b"\xff"))
    got = {r.tipo_dte: (r.folio, r.mnt_total, r.fecha_emision) for r in headers_from_text(text_files(spark, str(folder))).collect()}
    assert got == {33: (123, 5000, None), 39: (456, None, dt.date(2025, 1, 5))}


def test_stream_equals_batch_and_sees_new_files_only(spark, folder, tmp_path):
    batch, stream = Store(spark, str(tmp_path / "batch")), Store(spark, str(tmp_path / "stream"))
    (folder / "a b.xml").write_text(VALID)
    (folder / "c[1].xml").write_text(FAULTY)
    (folder / "cut.xml").write_text(VALID[:-9])

    def pump():
        stream_ingest(stream, str(folder), str(tmp_path / "checkpoint"), files_per_batch=2, as_of=AS_OF).awaitTermination()

    pump()
    assert stream.runs().count() == 2 and {r.job for r in stream.runs().collect()} == {"etl_daily"}
    (folder / "bare.xml").write_bytes(BARE.encode("latin-1"))
    pump()
    pump()
    assert stream.runs().count() == 3
    ingest_folder(batch, str(folder), run("one"), as_of=AS_OF)
    assert contents(stream) == contents(batch)
    assert contents(stream)[0] == [("33:10001:11111111-1", D("29750.00")), ("33:10002:11111111-1", D("28200.00")), ("33:1001:11111111-1", D("119.00"))]


def feed(spark, path):
    return spark.readStream.schema("event_id bigint, ts timestamp_ntz, kind string").json(str(path))


def test_event_streams(spark, folder, tmp_path):
    def arrive(name, *rows):
        (folder / name).write_text("\n".join(f'{{"event_id": {i}, "ts": "{t}", "kind": "{k}"}}' for i, t, k in rows))

    def pump():
        unique = events.drop_repeats(feed(spark, folder), ["event_id"])
        events.append_to(unique, str(tmp_path / "u"), str(tmp_path / "cu")).awaitTermination()
        counts = events.daily_counts(feed(spark, folder), ["kind"])
        events.upsert_days(counts, str(tmp_path / "d"), str(tmp_path / "cd")).awaitTermination()

    arrive("1.json", (1, "2025-01-01T10:00:00", "a"), (1, "2025-01-01T10:00:00", "a"), (2, "2025-01-02T00:00:00", "b"))
    pump()
    arrive("2.json", (1, "2025-01-01T10:00:00", "a"), (3, "2025-01-02T23:59:59", "a"))
    pump()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "u")).collect()) == [1, 2, 3]
    got = sorted((str(r.day), r.kind, r.n) for r in spark.read.parquet(str(tmp_path / "d")).collect())
    assert got == [("2025-01-01", "a", 3), ("2025-01-02", "a", 1), ("2025-01-02", "b", 1)]


def test_manual_parse_is_audited(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    schema = tmp_path / "dte.xsd"
    schema.write_text('<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="DTE" type="xs:int"/></xs:schema>')
    (folder / "a.xml").write_text(f'<DTE s="EnvioDTE_v10.xsd">{document(1, [line()])}</DTE>')
    (folder / "b.xml").write_text(VALID)
    refused = ingest.parse_file(store, str(folder / "a.xml"), "u@x", xsd_paths={"dte": str(schema)}, as_of=AS_OF).first()
    assert counters(refused)[:5] == ("PARTIAL", 1, 0, 1, 0)
    assert ingest.parse_file(store, str(folder / "a.xml"), "u@x", as_of=AS_OF).first().headers_inserted == 1
    assert ingest.parse_all(store, str(folder), as_of=AS_OF).first().files_total == 1
    got = sorted((r.action, r.user, r.status) for r in store.audit().collect())
    assert got == [("parse_all", "-", 0), ("xml_parse", "u@x", 303), ("xsd_invalid", "u@x", 422)]
    assert '"total_headers_now":2' in store.audit().filter("action = 'parse_all'").first().extra


def test_a_failed_load_leaves_an_error_row_and_no_data(spark, folder, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(VALID)

    def fail(*args, **kwargs):
        raise RuntimeError("rules are down")

    monkeypatch.setattr(ingest, "find_violations", fail)
    with pytest.raises(RuntimeError):
        ingest_folder(store, str(folder), run("bad"), as_of=AS_OF)
    row = store.runs().first()
    assert (row.run_id, row.status, row.errors[0].message) == ("bad", "ERROR", "rules are down")
    assert store.read("headers").count() == 0 and store.read("files").count() == 0
    monkeypatch.undo()
    assert ingest_folder(store, str(folder), run("good"), as_of=AS_OF).first().headers_inserted == 1
    assert {r.run_id: r.status for r in store.runs().collect()} == {"bad": "ERROR", "good": "OK"}


def test_stored_lines_are_enriched_load_by_load(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    code = "<CdgItem><VlrCodigo>60AR1</VlrCodigo></CdgItem>"
    (folder / "a.xml").write_text(envelope(document(1, [line(1, "x", more=code), line(2, "espejo")])))
    ingest_folder(store, str(folder), run("one"), as_of=AS_OF)
    assert lines_with_enrichment(store).filter("ai_version IS NULL").count() == 2
    assert enrich_store(store) == 2 and enrich_store(store) == 0
    (folder / "b.xml").write_text(envelope(document(2, [line(1, "Zoé")])))
    ingest_folder(store, str(folder), run("two"), as_of=AS_OF)
    rows = {r.line_id: (r.ai_category, r.ai_version) for r in lines_with_enrichment(store).collect()}
    assert rows == {"33:1:11111111-1#1": ("Sanitarios", "v0.2"), "33:1:11111111-1#2": ("Accesorios", "v0.2"), "33:2:11111111-1#1": (None, None)}
    assert enrich_store(store) == 1 and enrich_store(store, force=True) == 3
    other = replace(FITTINGS, version="v9")
    assert enrich_store(store, other) == 3 and store.enriched("v9").count() == 3 and store.enriched("v0.2").count() == 3
    overview = enrichment_overview(lines_with_enrichment(store))
    assert overview["rates"].first().unenriched_rate == D("0.00") and overview["mix"].count() == 3 and overview["pairs"].count() == 0


def test_equal_names_in_two_folders_and_a_retried_file(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for sub in ("x", "y"):
        (folder / sub).mkdir()
    (folder / "x" / "f.xml").write_text(VALID)
    ingest_folder(store, str(folder), run("one"), as_of=AS_OF)
    (folder / "y" / "f.xml").write_text(FAULTY)
    (folder / "y" / "g.xml").write_text(BARE[:-30])
    ingest_folder(store, str(folder), run("two"), as_of=AS_OF)
    assert store.read("headers").count() == 2
    (folder / "y" / "g.xml").write_text(BARE)
    ingest_folder(store, str(folder), run("three"), as_of=AS_OF, retry_failed=True)
    files, headers = store.read("files"), store.read("headers")
    assert headers.count() == 3 and files.count() == 4
    assert consistency.backlog(files, headers).first()[0] == 0
    totals = {r.metric: r.value for r in consistency.inventory(files, headers, store.read("lines"), store.read("violations")).collect()}
    assert totals["files.total"] == 3


def test_a_new_checkpoint_does_not_replace_an_earlier_stream(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(VALID)
    stream_ingest(store, str(folder), str(tmp_path / "c1"), as_of=AS_OF).awaitTermination()
    (folder / "b.xml").write_text(FAULTY)
    stream_ingest(store, str(folder), str(tmp_path / "c2"), as_of=AS_OF).awaitTermination()
    assert {r.folio for r in store.read("headers").collect()} == {10001, 10002}
    assert store.read("files").count() == 2, "the second stream leaves out what the first registered"


def test_a_replaced_load_takes_its_enrichment_along(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(VALID)
    ingest_folder(store, str(folder), run("r"), as_of=AS_OF)
    enrich_store(store)
    assert store.enriched(FITTINGS.version).count() == 2
    (folder / "a.xml").write_text(BARE)
    ingest_folder(store, str(folder), run("r"), as_of=AS_OF)
    assert store.enriched(FITTINGS.version).count() == 0
    assert lines_with_enrichment(store).count() == store.read("lines").count() == 1


def test_a_day_has_few_files_whatever_its_keys(spark, folder, tmp_path):
    for part in range(2):
        (folder / f"{part}.json").write_text("\n".join(f'{{"event_id": {i}, "ts": "2025-01-01T10:00:00", "kind": "k{i % 10000}"}}' for i in range(part * 10000, 10000 + part * 5000 + 5000)))
        counts = events.daily_counts(feed(spark, folder), ["kind"])
        events.upsert_days(counts, str(tmp_path / "d"), str(tmp_path / "c")).awaitTermination()
        events.upsert_days(counts, str(tmp_path / "d"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema("kind string, n bigint, day date").parquet(str(tmp_path / "d"))
    assert got.count() == 10000 and got.agg(F.sum("n")).first()[0] == 25000
    assert len(list((tmp_path / "d").glob("day=*"))) == 1 and len(list((tmp_path / "d").glob("day=*/*.parquet"))) <= 4


def test_event_state_ends_with_the_watermark(spark, folder, tmp_path):
    def removed(day):
        (folder / f"{day}.json").write_text(f'{{"event_id": {day}, "ts": "2025-01-{day:02}T10:00:00", "kind": "a"}}')
        counts = events.daily_counts(feed(spark, folder), ["kind"])
        query = events.upsert_days(counts, str(tmp_path / "d"), str(tmp_path / "c"))
        query.awaitTermination()
        return sum(o["numRowsRemoved"] for p in query.recentProgress for o in p["stateOperators"])

    assert [removed(d) > 0 for d in (1, 10, 20)][1:] == [True, True]
    got = spark.read.schema("n bigint, day date, kind string").parquet(str(tmp_path / "d"))
    assert sorted((str(r.day), r.kind, r.n) for r in got.collect()) == [("2025-01-01", "a", 1), ("2025-01-10", "a", 1), ("2025-01-20", "a", 1)]


def test_files_are_judged_once_and_new_documents_are_not_moved(spark, folder, tmp_path, monkeypatch):
    """What a first load stores is read as it was staged: no step groups, joins or sorts the documents' files again."""
    plans, write = {}, Store.write
    monkeypatch.setattr(Store, "write", lambda self, table, load_id, rows: (
        plans.__setitem__(table, rows._jdf.queryExecution().executedPlan().toString()), write(self, table, load_id, rows))[1])
    (folder / "a.xml").write_text(VALID)
    (folder / "b.xml").write_text(VALID[:-30])
    store = Store(spark, str(tmp_path / "store"))
    assert counters(ingest_folder(store, str(folder), run("one"), as_of=AS_OF).first()) == ("PARTIAL", 2, 1, 1, 1, 0, 2, 0)
    for table in ("files", "rejects", "errors", "headers", "lines"):
        assert "Exchange" not in plans[table] and "Join" not in plans[table], table


def test_first_of_a_key_wins_in_a_load_that_repeats_stored_ones(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (folder / "a.xml").write_text(envelope(document(1, [line(name="stored")])))
    ingest_folder(store, str(folder), run("one"), as_of=AS_OF)
    (folder / "d.xml").write_text(envelope(document(1, [line(name="late")]) + document(2, [line(name="from d")]) + document(3, [line(name="only")])))
    (folder / "c.xml").write_text(envelope(document(2, [line(name="from c")]) + document(2, [line(name="after")])))
    (folder / "b.xml").write_text(envelope(document(2, [line(name="broken file")]) + document(4, [line()]))[:-20])
    row = ingest_folder(store, str(folder), run("two"), as_of=AS_OF).first()
    assert counters(row)[:6] == ("PARTIAL", 3, 2, 1, 2, 3)
    assert {r.nombre_item for r in store.read("lines").filter("load_id = 'two'").collect()} == {"from c", "only"}


def test_large_files_are_looked_through_without_a_sort(spark, folder):
    from folioflow.sources import xml_documents as xml

    (folder / "a.xml").write_text(VALID)
    looked = xml.large_files(spark, str(folder), min_bytes=1)
    partial = looked._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "SortAggregate" not in partial and "HashAggregate" in partial
    assert [(r.charset, r.whole, r.broken) for r in looked.collect()] == [("UTF-8", False, False)]
