"""Files that are read whole beyond the size at which a task would hold too much, and what a load leaves on disk."""

import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioflow.plans import load_queries
from folioflow.plans.ingest import Run, load_documents
from folioflow.session import passing_shuffles
from folioflow.sources import xml_documents as xml
from folioflow.sources import xml_text
from folioflow.sources.store import Store
from folioflow.sources.tables import SCHEMAS
from samples import document, envelope, line
from test_xml_files import FILES, expected


def read(spark, folder, **how):
    pieces = xml.scan_documents(spark, str(folder), **how)
    verdicts = {r.file.rsplit("/", 1)[1][:-4]: not r.malformed for r in xml.file_verdicts(pieces).collect()}
    found = xml.parsed_documents(xml.sound_documents(pieces)).select(xml.file_name(F.col("file")).alias("f"), "folio", "razon_social_emisor").collect()
    docs = {}
    for r in found:
        docs.setdefault(r.f[:-4], {})[r.folio] = r.razon_social_emisor
    return pieces, verdicts, docs


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_files_read_whole_are_cut_alike(spark, folder, monkeypatch, chunk):
    """Cut by the task that holds the text, every file has the verdict and the values that the standard library's parser tells."""
    monkeypatch.setattr(xml, "CUT_BYTES", 0)
    monkeypatch.setattr(xml_text, "CHUNK_BYTES", chunk)
    for name, raw in FILES.items():
        (folder / f"{name}.xml").write_bytes(raw)
    want = {name: expected(raw) for name, raw in FILES.items()} | {"utf16_lost_half": (False, {})}
    pieces, verdicts, docs = read(spark, folder, whole_file_bytes=1 << 20)
    verdicts.setdefault("empty", False)  # a file without bytes has no row
    assert verdicts == {name: good for name, (good, _) in want.items()}
    assert docs == {name: d for name, (_, d) in want.items() if d}
    assert pieces.filter("position.block IS NULL AND file NOT LIKE '%/empty.xml'").isEmpty()


def test_long_file_is_no_single_text(spark, folder):
    """A file of many documents gives pieces with shapes of their own, none of which spans the file."""
    body = [document(i, [line()], name="Peña €") for i in range(4000)]
    (folder / "long.xml").write_text(envelope(*body))
    (folder / "wide.xml").write_bytes(envelope(*body, prolog='<?xml version="1.0" encoding="UTF-16"?>').encode("utf-16"))
    (folder / "cut.xml").write_text(envelope(*body)[:-20])
    pieces, verdicts, docs = read(spark, folder, whole_file_bytes=1 << 30)
    assert verdicts == {"long": True, "wide": True, "cut": False}
    assert {k: len(v) for k, v in docs.items()} == {"long": 4000, "wide": 4000} and set(docs["wide"].values()) == {"Peña €"}
    kept = pieces.groupBy("file").agg(F.count_if(F.col("shape").isNotNull()).alias("n"), F.count_if(F.col("position.block").isNull()).alias("whole"))
    assert all(r.n >= 4000 and r.whole == 0 for r in kept.collect())


def test_long_pieces_are_passed_over(spark, folder):
    """A large file that holds a piece beyond the bound, or nothing else, is read whole by a task and not as one record."""
    (folder / "a.xml").write_text(envelope(*[document(i, [line()]) for i in range(20)]))
    (folder / "b.xml").write_text(envelope(document(1, [line(i) for i in range(100)]), document(2, [line()])))
    (folder / "c.xml").write_bytes(envelope(*[document(i, [line()]) for i in range(20)], prolog="").encode("utf-16"))
    looked = {r.file[-5:]: r.whole for r in xml.large_files(spark, str(folder), min_bytes=1, piece_bytes=2000).collect()}
    assert not looked["a.xml"] and looked["b.xml"] and looked.get("c.xml", True)


def test_longest_files_are_read_by_few_tasks(spark, folder, monkeypatch):
    """Of four cores one reads the longest of the files that are read whole, and the rows are the same."""
    for i in range(6):
        (folder / f"{i}.xml").write_text(envelope(document(i, [line()], name="x" * (200 if i < 4 else 2))))
    files = xml.sized_files(spark, str(folder)).collect()
    every = [xml.parsed_documents(xml.cut_file_documents(spark, files)).select("file", "folio").orderBy("folio").collect()]
    monkeypatch.setattr(xml, "LONG_BYTES", sorted(r.length for r in files)[1])
    assert xml._of_contents(spark, [r for r in files if r.length > xml.LONG_BYTES], F.explode(F.array("content"))).rdd.getNumPartitions() == 1
    every.append(xml.parsed_documents(xml.cut_file_documents(spark, files)).select("file", "folio").orderBy("folio").collect())
    assert every[0] == every[1] and len(every[0]) == 6


@pytest.mark.parametrize("end", ["</Documento>", "</sii:Documento>"])
def test_stretches_end_at_documents(spark, monkeypatch, end):
    monkeypatch.setattr(xml_text, "CHUNK_BYTES", 40)
    texts = ["", "x", "ñ€" * 60, *("ab€" * k + f"<Documento>{'é' * k}{end}" * 30 + "z" * 3 * k for k in range(12))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", xml_text.stretches(F.col("t")).alias("s")).collect()
    for r in rows:
        assert "".join(r.s) == r.t and all(s.endswith(end) for s in r.s[:-1])
    assert max(len(r.s) for r in rows) > 5


# ---- what a load leaves on disk

@pytest.fixture
def tables(spark, tmp_path):
    rows = {
        "nation": [(0, "NATION_0", 0)], "customer": [(i, f"Customer {i}", 0, 1.0, "x") for i in range(5)],
        "orders": [(i, i % 5, "FOP"[i % 3], 100.0 + i, datetime(1996, 1, 1 + i % 28), "1-URGENT") for i in range(200)],
    }
    for name, some in rows.items():
        spark.createDataFrame(some, SCHEMAS[name]).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


@pytest.mark.parametrize("name", ["stream_load", "two_streams_load"])
def test_streams_keep_no_envelopes_that_are_loaded(spark, tables, tmp_path, monkeypatch, name):
    """All documents are in the store, and of the files made for them none is left."""
    written = []
    write = load_queries.write_envelopes
    monkeypatch.setattr(load_queries, "work_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(load_queries, "write_envelopes", lambda spark, sf, folder, *only: (write(spark, sf, folder, *only), written.extend(
        (p, p.read_text()) for p in Path(folder).glob("*.xml"))))
    rows = entry.queries()[name](spark, tables)
    assert rows.count() == 200 and rows.select("header_id").distinct().count() == 200
    assert written and not any(p.exists() for p, _ in written)
    # Values and tags, no indentation.
    assert not any(row.startswith(" ") for _, text in written for row in text.splitlines())


def shuffle_files(spark):
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in top for p in Path(d.getPath()).rglob("shuffle_*.data")}


def test_load_leaves_no_shuffle_files(spark, folder):
    """Once a load has returned, the files of its shuffles go, without waiting for the driver's garbage."""
    for i in range(3):
        (folder / f"{i}.xml").write_text(envelope(*[document(100 * i + k, [line()]) for k in range(5)]))
    store, pieces = Store(spark, f"{folder}/../store"), xml.scan_documents(spark, str(folder))
    before = shuffle_files(spark)
    load_documents(store, pieces, Run(run_id="one"), as_of=date(2026, 1, 1))
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert store.read("headers").count() == 15


def test_results_outlive_their_shuffle_files(spark):
    """A plan whose shuffle files are gone gives the same rows when it is run again, and the setting ends with the block."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    with passing_shuffles(spark):
        counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        first = sorted(counts.collect())
        time.sleep(0.5)
        assert sorted(counts.collect()) == first
    assert spark.conf.get(key) == was
