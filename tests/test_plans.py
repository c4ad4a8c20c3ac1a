"""Plans: what is pushed down, what is shuffled, and how hot keys fare."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioflow.operators import consistency, curated, dedupe, enrichment, quality
from folioflow.plans import reports
from folioflow.schema import VIOLATIONS, rule_catalogue
from folioflow.session import work_folder
from folioflow.sources.store import HEADERS, LINES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    """Stored tables in which one document holds a third of all lines; joins by shuffle."""
    hot = F.when(F.col("id") % 3 == 0, "33:0:1-9").otherwise(F.concat(F.lit("33:"), (F.col("id") % 500 + 1).cast("string"), F.lit(":1-9")))
    def filled(schema, df):
        fields = [f.strip().split(" ") for f in schema.split(", ")]
        return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])

    ids = spark.range(0, 30000, 1, 4)
    lines = filled(LINES, ids.select(F.concat(F.lit("l"), "id").alias("line_id"), hot.alias("header_id"), F.lit(1).alias("cantidad"),
                                     F.lit(2).alias("precio_unitario"), (F.col("id") % 7).alias("monto_item"),
                                     F.repeat(F.lit("x"), F.lit(200)).alias("descripcion")))
    heads = filled(HEADERS, spark.range(501).select(F.concat(F.lit("33:"), "id", F.lit(":1-9")).alias("header_id"), F.lit(33).alias("tipo_dte"),
                                                    F.col("id").alias("folio"), F.lit("1-9").alias("rut_emisor"), F.lit(5).alias("mnt_total")))
    found = filled(VIOLATIONS, ids.filter("id % 10 = 0").select(
        F.concat(F.lit("l"), "id").alias("entity_id"), hot.alias("header_id"), F.lit("detail").alias("entity"), (F.col("id") % 20 / 10 + 1).alias("rule_id")))
    for name, df in (("h", heads), ("l", lines), ("v", found)):
        df.write.parquet(f"{tmp_path}/{name}")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield tuple(spark.read.parquet(f"{tmp_path}/{n}") for n in "hlv")
    for k in settings:
        spark.conf.unset(k)


def test_fact_shuffles_lines_once_and_splits_the_hot_document(spark, store):
    headers, lines, violations = store
    fact = curated.fact_lines(headers, lines, violations, rule_catalogue(spark))
    assert plan(fact).count("Exchange hashpartitioning") == 4, "lines, headers, and the flags twice"
    rows = fact.agg(F.count("*"), F.count_if("dq_has_error"), F.count_if("dq_has_warn")).first()
    assert tuple(rows) == (30000, 1500, 1500)
    joined = lines.join(headers, "header_id").select("line_id", "descripcion", "folio")
    assert len(joined.collect()) == 30000
    assert "isSkew=true" in plan(joined) or "skew=true" in plan(joined)


def test_aggregates_before_joins(spark, store):
    headers, lines, violations = store
    off = plan(consistency.totals_mismatch(headers, lines))
    assert off.index("Join") < off.index("HashAggregate") < off.index("Exchange", off.index("HashAggregate"))
    report = consistency.consistency_report(headers.withColumn("x", F.lit(1)), headers, lines, violations, rule_catalogue(spark))
    assert plan(report).count("[header_id#") > 0
    got = {r.metric: r.value for r in report.collect()}
    assert got["details.total"] == 30000 and got["headers.without_details"] == 0 and got["details.orphans"] == 0


def test_rules_need_no_shuffle(spark, store):
    import datetime as dt

    headers, lines, _ = store
    found = quality.find_violations(headers, lines, as_of=dt.date(2025, 1, 1))
    assert "Exchange hashpartitioning" not in plan(found) and "CartesianProduct" not in plan(found)
    assert found.filter("rule_id = 2").count() == lines.filter("abs(monto_item - 2) > 1").count()


def test_history_is_not_rescanned_for_new_keys(spark, store):
    headers, _, _ = store
    text = plan(dedupe.only_new(dedupe.elected(headers, ["tipo_dte", "folio", "rut_emisor"], ["file_id"]), headers))
    assert text.count("Exchange hashpartitioning") == 3, "the anti join uses the partitioning of the election"


def test_winners_are_elected_without_their_payload(spark, store):
    _, lines, _ = store
    text = plan(dedupe.first_wins(lines, ["header_id"], ["line_id"]))
    election = text[text.index("HashAggregate" if "HashAggregate" in text else "SortAggregate"):]
    assert "descripcion" not in election and "ShuffledHashJoin" in text
    assert not any("descripcion" in x for x in text.split("\n") if " Sort [" in x or "Aggregate(" in x)
    assert dedupe.first_wins(lines, ["header_id"], ["line_id"]).count() == lines.select("header_id").distinct().count()


def test_pairs_of_a_hot_document(spark, store):
    _, lines, _ = store
    named = lines.withColumn("ai_subcategory", F.concat(F.lit("s"), (F.substring("line_id", 2, 9).cast("int") % 4).cast("string")))
    pairs = enrichment.subcategory_pairs(named, top=None)
    counts = named.groupBy("header_id", "ai_subcategory").count().collect()
    total = sum(int(r.n) for r in pairs.collect())
    per_doc = {}
    for r in counts:
        per_doc[r.header_id] = per_doc.get(r.header_id, 0) + r["count"]
    assert total == sum(n * (n - 1) // 2 for n in per_doc.values())
    assert "partial_count" in plan(pairs), "lines are counted per document and name before the shuffle"


def test_scans_read_only_what_is_needed(spark):
    text = entry.queries()["type_stats"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text
    text = entry.queries()["one_document"](spark, SMALL)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderkey,42)" in text and "EqualTo(l_orderkey,42)" in text


def test_listing_reads_no_contents(spark, tmp_path):
    from folioflow.sources import xml_documents as xml

    (tmp_path / "a.xml").write_text("<x/>")
    assert "ReadSchema: struct<path:string>" in plan(xml.listed_files(spark, str(tmp_path)))
    assert "LessThanOrEqual(length,100)" in plan(xml.xml_files(spark, str(tmp_path), max_bytes=100))


def test_reports_are_whole(spark, store):
    headers, lines, violations = store
    rules = rule_catalogue(spark)
    enriched = quality.with_rules(violations, rules)
    page = reports.violations_list(enriched, rules, page=2, page_size=10, level="WARN")
    assert page["total"].first().total == 1500 and page["page"].count() == 10 and page["codes"].count() == 4
    assert set(reports.quality_report(violations, rules)) == {"by_level", "by_rule", "by_day"}
    found = reports.consistency_page(headers, headers, lines, violations, rules)
    assert found["mismatch_examples"].count() == 50 and found["duplicate_groups"].count() == 0
    assert reports.documents_list(headers, limit=3)["documents"].count() == 3


def test_work_folder_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    base = base or spark.sparkContext.getCheckpointDir()
    assert first.startswith(base.rstrip("/")) and first != second


def test_fact_shuffles_lines_once_where_ids_are_numbers(spark, store):
    headers, lines, violations = store
    number = F.element_at(F.split("header_id", ":"), 2).cast("bigint")
    headers, lines = headers.withColumn("header_id", number), lines.withColumn("header_id", number)
    violations = violations.withColumn("header_id", number.cast("string"))
    fact = curated.fact_lines(headers, lines, violations, rule_catalogue(spark))
    exchanged = [x for x in plan(fact).split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanged) == 4 and not any("line_id#" in x.split("hashpartitioning")[1] for x in exchanged), "joined lines stay where their document is"
    rows = fact.agg(F.count("*"), F.count_if("dq_has_error"), F.count_if("dq_has_warn"), F.max("header_id")).first()
    assert tuple(rows) == (30000, 1500, 1500, headers.agg(F.max("header_id")).first()[0])
    assert dict(fact.dtypes)["header_id"] == "bigint"
