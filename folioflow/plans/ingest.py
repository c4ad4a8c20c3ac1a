"""Ingest: parse, reject, dedupe, load, check, log. Batch jobs; the streaming form calls the same load."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone
from uuid import uuid4
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.scalars import LOCAL_ZONE, run_status
from folioflow.operators.dedupe import elected, matching, present_keys, reject_reason, split_judged
from folioflow.operators.health import DAILY_JOB, daily_health
from folioflow.operators.quality import Limits, find_violations, violations_per_hundred
from folioflow.schema import BUSINESS_KEY, HEADER_COLUMNS, HEADER_REQUIRED, PRINTED_REQUIRED, RUN_LOGS
from folioflow.session import bounded, discard, passing_shuffles, work_folder
from folioflow.sources.store import REJECTS, Store
from folioflow.sources.text_documents import headers_from_text, listed_texts, text_files
from folioflow.sources.xml_documents import (
    STAGED_LINES, WHOLE_FILE_BYTES, document_lines, file_name, file_verdicts, header_key, header_projection,
    line_projection, listed_files, literal_path, scan_documents, sized_files, unseen, whole_file_documents, xsd_invalid_files,
)
from folioflow.sources.xml_text import SHAPE

#: About as many new files make a load; more are loaded in slices, each committed by itself.
FILES_PER_LOAD = 50_000
#: Larger files are refused where a schema is asked for: a schema needs the file whole.
SCHEMA_BYTES = 256 * 1024 * 1024


#: Length of a failure's message in the run log.
MESSAGE_CHARS = 2_000


@dataclass(frozen=True)
class Run:
    """What identifies a load. The same id again replaces that load's rows."""

    job: str = DAILY_JOB
    source: str | None = None
    note: str | None = None
    run_id: str = field(default_factory=lambda: uuid4().hex)
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def staged_documents(pieces: DataFrame) -> DataFrame:
    """Pieces with their header columns and line arrays; rows that only stand for a file stay."""
    doc = F.col("doc")
    rows = pieces.select(
        "file", "position", "malformed", "shape", doc.getField("Encabezado").isNotNull().alias("has_header"),
        *header_projection(doc), F.transform(doc.getField("Detalle"), line_projection).alias("lines"))
    return rows.withColumn("header_id", header_key(F.col("tipo_dte"), F.col("folio"), F.col("rut_emisor")))


def staged_texts(files: DataFrame) -> DataFrame:
    """The same columns for (file, text) of printed documents: what their labels tell, no net amount, tax or names, and no lines."""
    found = headers_from_text(files.select("file", "text"))
    money = {n: F.col(n).cast("decimal(18,2)") if n in found.columns else F.lit(None).cast("decimal(18,2)") for n in ("mnt_neto", "iva", "mnt_total")}
    told = {n: F.col(n) if n in found.columns else F.lit(None).cast("string") for n in HEADER_COLUMNS if n not in money} | money
    nothing = F.lit(None).cast("bigint")
    rows = found.select(
        "file", F.struct(nothing.alias("block"), nothing.alias("row"), F.lit(0).cast("bigint").alias("at")).alias("position"), F.lit(False).alias("malformed"),
        F.lit(None).cast(SHAPE).alias("shape"), F.lit(True).alias("has_header"), *[told[n].alias(n) for n in HEADER_COLUMNS],
        F.array().cast(STAGED_LINES).alias("lines"))
    return rows.withColumn("header_id", header_key(F.col("tipo_dte"), F.col("folio"), F.col("rut_emisor")))


def load_documents(store: Store, pieces: DataFrame, run: Run, **options) -> DataFrame:
    """Loads parsed pieces and returns the run log row; takes the options of ``_load``."""
    return load_staged(store, staged_documents(pieces), run, **options)


def load_staged(store: Store, rows: DataFrame, run: Run, **options) -> DataFrame:
    """Loads staged documents and returns the run log row.

    A load that fails leaves an ERROR row and no visible data. Its files stay unregistered, so the
    next load takes them up.
    """
    work = work_folder(store.spark, "load")
    try:
        with passing_shuffles(store.spark):
            return _load(store, rows, run, work, **options)
    except Exception as failure:
        store.write("run_logs", run.run_id, store.spark.createDataFrame([(
            run.run_id, run.job, run.source, run.started_at, datetime.now(timezone.utc), "ERROR", 0, 0, 0, 0, 0, 0, 0,
            [("load", str(failure)[:MESSAGE_CHARS], None)], run.note)], RUN_LOGS))
        raise
    finally:
        discard(store.spark, work)


def _load(store: Store, rows: DataFrame, run: Run, work: str, *, as_of: date | None = None, limits: Limits = Limits(),
          scope: str = "document", rules: DataFrame | None = None, zone: str = LOCAL_ZONE,
          barred: DataFrame | None = None, required: list[str] = HEADER_REQUIRED) -> DataFrame:
    """Writes one load, its run log row last.

    The parse result, with why a document is rejected, the files' verdicts and the business keys are each written once in the shared work
    folder and read from there, so nothing is parsed, judged or matched twice, and a lost executor costs its tasks only. Documents move
    to be matched only where a key is stored already or repeats; without either they go from the parse result to the store.
    ``barred`` holds (file, reason) of files that must not load, ``required`` the columns without which a document is rejected. Headers, lines and rejects of all
    files are stored; a failure of the rules leaves the load without violations and an entry in its run log.
    """
    spark, load_id = store.spark, run.run_id
    started = F.lit(run.started_at).cast("timestamp")

    store.reopen(load_id)
    def kept(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    staged = kept("staged", rows.withColumn("reason", F.when(F.col("has_header"), reject_reason(required=required))))
    verdicts = kept("verdicts", file_verdicts(staged, F.col("has_header") & ~F.col("malformed")))
    failed_files = verdicts.filter("malformed").select("file", F.lit("malformed XML").alias("reason"))
    # Files that fail although documents were read from them; all others' documents are told by their own row.
    failing = verdicts.filter("malformed AND held").select("file")
    if barred is not None:
        barred = kept("barred", barred.select("file", "reason"))
        failed_files = failed_files.unionByName(barred)
        failing = failing.unionByName(barred.select("file"))
    failing = kept("failing", failing)
    n_failing = failing.count()

    candidates = staged.filter("has_header AND (NOT malformed OR file IS NULL)").drop("has_header", "malformed", "shape")
    if n_failing:
        candidates = candidates.join(bounded(failing, n_failing), "file", "left_anti")
    storable, rejected = split_judged(candidates, scope)
    # Keys are counted and compared with the history by themselves; only documents of a repeated key are elected among.
    keys = kept("keys", storable.groupBy(*BUSINESS_KEY).agg(F.count("*").alias("n")))
    present = kept("present", present_keys(keys, store.history(keys, but=load_id)))
    n_present = present.count()
    fresh, repeated = storable.filter("file IS NOT NULL"), keys.filter("n > 1").select(*BUSINESS_KEY)
    if n_present:
        fresh = fresh.join(bounded(present, n_present), BUSINESS_KEY, "left_anti")
        repeated = repeated.join(bounded(present, n_present), BUSINESS_KEY, "left_anti")
    repeated = kept("repeated", repeated)
    n_repeated = repeated.count()
    if n_repeated:
        place = ["file", "position"]
        rivals = kept("rivals", matching(storable.select(*BUSINESS_KEY, *place), bounded(repeated, n_repeated), BUSINESS_KEY, "left_semi"))
        beaten = kept("beaten", matching(rivals, elected(rivals, BUSINESS_KEY, place), [*BUSINESS_KEY, *place], "left_anti"))
        fresh = matching(fresh, bounded(beaten, beaten.count()), [*BUSINESS_KEY, *place], "left_anti")
    if n_failing or n_present or n_repeated or scope == "file":
        fresh = kept("fresh", fresh)

    store.write("rejects", load_id, failed_files.select("file", F.lit(None).cast("string").alias("header_id"), "reason").unionByName(
        rejected.select("file", "header_id", "reason")))
    rejects = spark.read.schema(REJECTS).parquet(f"{store.path('rejects')}/load_id={load_id}")
    # One row per failed file or document, however many; the run log row keeps a summary by reason.
    store.write("errors", load_id, rejects.select("file", F.lit("parse").alias("where"), F.col("reason").alias("message"), "header_id"))

    def observed(table: str, rows: DataFrame) -> int:
        seen = Observation()
        store.write(table, load_id, rows.observe(seen, F.count("*").alias("n")))
        return seen.get["n"]

    store.drop_enriched(load_id)
    n_lines = observed("lines", document_lines(fresh))
    # Sorted within files, so that day filters skip row groups.
    n_headers = observed("headers", fresh.select(
        "header_id", F.col("file").alias("file_id"), *HEADER_COLUMNS, started.alias("created_at")
    ).sortWithinPartitions("fecha_emision", "header_id"))

    lines = spark.read.parquet(f"{store.path('lines')}/load_id={load_id}")
    headers = spark.read.parquet(f"{store.path('headers')}/load_id={load_id}")
    judge = dict(as_of=as_of or run.started_at.date(), run_id=load_id, limits=limits, created_at=run.started_at)
    rule_failure = None
    try:
        n_violations = observed("violations", find_violations(headers, lines, rules=rules, **judge))
    except Exception as failure:  # noqa: BLE001  rules may not cost the documents; the run log tells of it
        rule_failure = str(failure)[:MESSAGE_CHARS]
        n_violations = observed("violations", find_violations(headers.limit(0), lines.limit(0), **judge))

    files = verdicts.select("file", (F.col("malformed") & F.col("file").isNotNull()).alias("bad"))
    if barred is not None or scope == "file":
        spoils = F.lit(True) if scope == "file" else F.col("header_id").isNull()
        every = files.select("file")
        if barred is not None:
            every = every.unionByName(barred.select("file")).distinct()
        files = every.join(rejects.filter(spoils).select("file").distinct().withColumn("bad", F.lit(True)), "file", "left")
    files = files.select(
        F.col("file").alias("file_id"), file_name(F.col("file")).alias("filename"),
        F.when(F.col("bad"), "FAILED").otherwise("OK").alias("status"), started.alias("created_at"))
    tally = Observation()
    store.write("files", load_id, files.observe(
        tally, F.count("*").alias("n"), F.count_if(F.col("status") == "FAILED").alias("bad")))
    n_files, n_bad = tally.get["n"], tally.get["bad"]

    n_storable = storable.count()
    by_reason = rejects.groupBy("reason").agg(F.count("*").alias("n"), F.min("file").alias("file"))
    rule_error = F.array() if rule_failure is None else F.array(F.struct(
        F.lit("rules").alias("where"), F.lit(rule_failure).alias("message"), F.lit(None).cast("string").alias("file")))
    errors = by_reason.agg(F.sort_array(F.collect_list(F.struct(
        F.lit("parse").alias("where"), F.concat("reason", F.lit(": "), F.col("n").cast("string")).alias("message"),
        "file"))).alias("errors")).withColumn(
            "errors", F.concat("errors", rule_error.cast("array<struct<where:string,message:string,file:string>>")))
    log = errors.select(
        F.lit(load_id).alias("run_id"), F.lit(run.job).alias("job"), F.lit(run.source).cast("string").alias("source"),
        started.alias("started_at"), F.current_timestamp().alias("ended_at"),
        run_status(F.lit(False), F.lit(n_bad), F.size("errors")).alias("status"),
        *[F.lit(v).cast("bigint").alias(k) for k, v in {
            "files_total": n_files, "files_ok": n_files - n_bad, "files_failed": n_bad,
            "headers_inserted": n_headers, "headers_already_present": n_storable - n_headers,
            "details_inserted": n_lines, "dq_violations": n_violations}.items()],
        F.when(F.size("errors") > 0, F.col("errors")).alias("errors"),
        F.lit(run.note).cast("string").alias("note"))
    store.write("run_logs", load_id, log.select(*spark.createDataFrame([], RUN_LOGS).columns))

    # After the run is closed, so that the day includes it.
    if run.job == DAILY_JOB:
        day = run.started_at.astimezone(ZoneInfo(zone)).date()
        store.upsert_health(daily_health(store.runs(), zone=zone, day=day))
    return store.runs().filter(F.col("load_id") == load_id)


def refused(spark: SparkSession, paths: str | list[str], xsd_paths: dict[str, str], most_bytes: int = SCHEMA_BYTES) -> DataFrame:
    """(file, reason) of files that break the schema they name, whatever their size; of those too large to tell."""
    sized = sized_files(spark, paths)
    broken = xsd_invalid_files(spark, sized.filter(F.col("length") <= most_bytes).collect(), xsd_paths).select("file", F.concat(F.lit("xsd "), "kind").alias("reason"))
    large = sized.filter(F.col("length") > most_bytes)
    return broken.unionByName(large.select("file", F.lit("xsd not checked: file too large").alias("reason")))


def _slices(store: Store, listed: DataFrame, run: Run, retry_failed: bool, files_per_load: int) -> Iterator[tuple[Run, list[str]]]:
    """(run, paths) of the loads that take up all new files.

    The names of new files are written once, dealt into slices by a hash, so that a load holds about ``files_per_load`` of
    them and every file is opened by name, by one load. A run that is repeated under its id takes the same slices.
    """
    own = F.col("load_id").startswith(f"{run.run_id}.") | (F.col("load_id") == run.run_id)
    fresh = unseen(listed, store.read("files").filter(~own), retry_failed=retry_failed).select("file", "path").distinct()
    work = work_folder(store.spark, "new-files")
    n = -(-fresh.count() // files_per_load)
    if n <= 1:
        yield run, [literal_path(r.path) for r in fresh.collect()]
        return
    try:
        fresh.withColumn("slice", F.pmod(F.xxhash64("file"), F.lit(n))).repartition("slice").write.partitionBy("slice").parquet(work)
        names = store.spark.read.schema("file string, path string, slice bigint").parquet(work)
        for i in range(n):
            paths = [literal_path(r.path) for r in names.filter(F.col("slice") == i).collect()]
            if paths:
                yield replace(run, run_id=f"{run.run_id}.{i}"), paths
    finally:
        discard(store.spark, work)


def _load_slices(store: Store, listed: DataFrame, run: Run, load: Callable[[Run, list[str]], DataFrame], retry_failed: bool, files_per_load: int) -> DataFrame:
    """The run log rows of all slices."""
    done = []
    for part, paths in _slices(store, listed, run, retry_failed, files_per_load):
        load(part, paths)
        done.append(part.run_id)
    return store.runs().filter(F.col("load_id").isin(done))


def ingest_folder(store: Store, path: str, run: Run | None = None, *, whole_file_bytes: int = WHOLE_FILE_BYTES,
                  modified_after: str | None = None, retry_failed: bool = False, files_per_load: int = FILES_PER_LOAD,
                  xsd_paths: dict[str, str] | None = None, **load) -> DataFrame:
    """Loads the files below ``path`` that no earlier load has seen, by path, and returns the run log rows: one, or one per slice.

    Names are compared before any content is read, and only new files are opened. ``modified_after`` keeps the listing short once
    the folder holds history. If a slice fails, those before it stay, and the next run takes up the rest.
    """
    spark = store.spark

    def load_slice(part: Run, paths: list[str]) -> DataFrame:
        pieces = scan_documents(spark, paths, whole_file_bytes=whole_file_bytes) if paths else whole_file_documents(spark.createDataFrame([], "file string, text string"))
        barred = refused(spark, paths, xsd_paths) if xsd_paths and paths else None
        return load_documents(store, pieces, part, barred=barred, **load)

    return _load_slices(store, listed_files(spark, path, modified_after), run or Run(), load_slice, retry_failed, files_per_load)


def ingest_texts(store: Store, path: str, run: Run | None = None, *, modified_after: str | None = None, retry_failed: bool = False,
                 files_per_load: int = FILES_PER_LOAD, **load) -> DataFrame:
    """The same for printed documents, HTML or text: rejects, first-wins, commit and run log as for XML."""
    spark = store.spark

    def load_slice(part: Run, paths: list[str]) -> DataFrame:
        files = text_files(spark, paths) if paths else spark.createDataFrame([], "file string, text string")
        return load_texts(store, files, part, **load)

    return _load_slices(store, listed_texts(spark, path, modified_after), run or Run(job="text_ingest"), load_slice, retry_failed, files_per_load)


def load_texts(store: Store, files: DataFrame, run: Run, **load) -> DataFrame:
    """Loads (file, text) of printed documents, which name neither net amount nor tax."""
    return load_staged(store, staged_texts(files), run, **{"required": PRINTED_REQUIRED, **load})


def initial_load(store: Store, path: str, **options) -> DataFrame:
    return ingest_folder(store, path, Run(job="initial_load", source="bootstrap", note="carga inicial"), **options)


def parse_all(store: Store, path: str, user: str | None = None, **options) -> DataFrame:
    """Loads all unseen files on a user's behalf and records it in the audit log."""
    run = Run(job="manual_parse_all", source="ui")
    row = ingest_folder(store, path, run, **options)
    total = store.read("headers").count()
    store.append_audit(row.select(
        F.lit(user).cast("string").alias("user"), F.lit("parse_all").alias("action"), F.lit("file").alias("resource"),
        F.to_json(F.struct(F.col("files_total").alias("created_files"), F.lit(total).alias("total_headers_now"))).alias("extra")))
    return row


def parse_file(store: Store, file: str, user: str | None = None, *, xsd_paths: dict[str, str] | None = None,
               whole_file_bytes: int = WHOLE_FILE_BYTES, **load) -> DataFrame:
    """Loads one file, seen before or not, and records the parse, or what its schema refuses."""
    spark, run = store.spark, Run(job="manual_parse", source="ui", note=f"file={file}")
    barred = refused(spark, literal_path(file), xsd_paths) if xsd_paths else None
    row = load_documents(store, scan_documents(spark, literal_path(file), whole_file_bytes=whole_file_bytes), run, barred=barred, **load)
    broken = F.exists(F.coalesce("errors", F.array().cast("array<struct<where:string,message:string,file:string>>")),
                       lambda e: F.startswith(e.getField("message"), F.lit("xsd ")))
    store.append_audit(row.select(
        F.lit(user).cast("string").alias("user"), F.when(broken, "xsd_invalid").otherwise("xml_parse").alias("action"),
        F.lit("file").alias("resource"), F.when(broken, 422).otherwise(303).alias("status"),
        F.to_json(F.struct(F.lit(file).alias("filename"), F.col("headers_inserted").alias("n_headers"))).alias("extra")))
    return row


def alert(store: Store, run_id: str, threshold: float = 1.0) -> DataFrame:
    """Violations of a run per 100 lines loaded, with the alert flag."""
    runs = store.runs().filter(F.col("run_id") == run_id)
    return violations_per_hundred(store.read("violations").filter(F.col("load_id") == run_id), runs, threshold)
