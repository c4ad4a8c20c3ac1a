"""The Parquet store: one folder per table, one ``load_id`` partition per load.

A load overwrites its own partitions and writes its run log row last. That row is the commit
marker: readers skip loads without one, and repeating a load under the same id changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import discard
from folioflow.schema import ATTRS, AUDIT_LOG, RUN_LOGS, VIOLATIONS

HEADERS = (
    "header_id string, file_id string, tipo_dte int, folio bigint, fecha_emision date, rut_emisor string, "
    "razon_social_emisor string, rut_receptor string, razon_social_receptor string, mnt_neto decimal(18,2), "
    "iva decimal(18,2), mnt_total decimal(18,2), created_at timestamp"
)
LINES = (
    "line_id string, header_id string, nro_linea int, tipo_codigo string, nombre_item string, codigo string, "
    "descripcion string, cantidad decimal(18,6), precio_unitario decimal(18,6), monto_item decimal(18,2)"
)
ENRICHMENT = f"ai_category string, ai_subcategory string, ai_brand string, ai_attrs {ATTRS}, ai_confidence decimal(5,2)"
FILES = "file_id string, filename string, status string, created_at timestamp"
REJECTS = "file string, header_id string, reason string"
ERRORS = "file string, `where` string, message string, header_id string"
HEALTH = "headers bigint, details bigint, violations_total bigint, score decimal(5,2)"

TABLES = {
    "headers": HEADERS, "lines": LINES, "files": FILES, "violations": VIOLATIONS,
    "rejects": REJECTS, "errors": ERRORS, "run_logs": RUN_LOGS,
}


MANIFEST = "load_id string, generation string, at timestamp"

#: Folders of a generation's headers.
KEY_RANGES = 64


def key_range() -> Column:
    """Folder of a header: by the issuer in its business key, so that a load of few issuers meets few folders."""
    return F.pmod(F.xxhash64(F.coalesce("rut_emisor", F.lit(""))), F.lit(KEY_RANGES)).cast("int").alias("key_range")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def runs(self) -> DataFrame:
        return self._read("run_logs", RUN_LOGS + ", load_id string")

    def read(self, table: str, but: str | None = None) -> DataFrame:
        """Rows of committed loads, without load ``but``. A load that ended in ERROR is not committed.

        The list of loads is short, so this is a broadcast filter on the partition column. Loads that the manifest names as
        compacted are read from their generation, all others from their own folders.
        """
        return self._committed(table, but, None)

    def _committed(self, table: str, but: str | None, ranges: list[int] | None) -> DataFrame:
        columns = f"{TABLES[table]}, load_id string"
        rows = self._read(table, columns)
        done = self.runs().filter("status <> 'ERROR'").select("load_id").distinct()
        if but is not None:
            rows, done = rows.filter(F.col("load_id") != but), done.filter(F.col("load_id") != but)
        if not self._exists("manifest"):
            return rows.join(done, "load_id", "left_semi")
        held = self._generations()
        compacted = self._read(f"compacted_{table}", f"{columns}, generation string, key_range int")
        if ranges is not None:
            compacted = compacted.filter(F.col("key_range").isin(ranges))
        inside = compacted.join(done, "load_id", "left_semi").join(held, ["load_id", "generation"], "left_semi").drop("generation", "key_range")
        return rows.join(done.join(held, "load_id", "left_anti"), "load_id", "left_semi").unionByName(inside)

    def write(self, table: str, load_id: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/load_id={load_id}")

    def history(self, keys: DataFrame, but: str | None = None) -> DataFrame:
        """Stored headers that can have the business keys given.

        Compacted headers lie in ``KEY_RANGES`` folders by their issuer, of which only those of the keys' issuers are opened.
        """
        if not self._exists("manifest"):
            return self.read("headers", but)
        ranges = [r[0] for r in keys.select(key_range()).distinct().collect()]  # KEY_RANGES at most
        return self._committed("headers", but, ranges)

    # ---- compaction: many load folders become one generation

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _generations(self) -> DataFrame:
        """(load_id, generation) of compacted loads: each load's latest manifest entry, if that names one."""
        latest = self._read("manifest", MANIFEST).groupBy("load_id").agg(F.max_by("generation", "at").alias("generation"))
        return latest.filter("generation IS NOT NULL")

    def compact(self) -> str | None:
        """Writes all loads that lie in folders of their own as one generation, and returns its name; None if there is at most one.

        The generation counts from the moment its manifest entry is there, one file with a row per load. Readers that planned before read the
        folders, later ones the generation; the rows are the same. ``sweep`` removes the folders when no such reader is left.
        """
        done = self.runs().filter("status <> 'ERROR'").select("load_id").distinct()
        if self._exists("manifest"):
            done = done.join(self._generations(), "load_id", "left_anti")
        loads = [r.load_id for r in done.collect()]
        if len(loads) < 2:
            return None
        name = uuid4().hex
        for table, columns in TABLES.items():
            if table == "run_logs":
                continue
            rows = self._read(table, f"{columns}, load_id string").filter(F.col("load_id").isin(loads))
            # A document's range is its issuer's; other tables have one.
            rows = rows.withColumn("key_range", key_range() if table == "headers" else F.lit(0)).hint("rebalance", "key_range")
            rows.sortWithinPartitions("key_range", "load_id").write.mode("overwrite").partitionBy("key_range").parquet(f"{self.path(f'compacted_{table}')}/generation={name}")
        self._note(loads, name)
        return name

    def _note(self, loads: list[str], generation: str | None) -> None:
        entry = self.spark.createDataFrame([(load, generation, datetime.now(timezone.utc)) for load in loads], MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(self.path("manifest"))

    def reopen(self, load_id: str) -> None:
        """A load that is written again is read from its own folder from now on."""
        if self._exists("manifest") and not self._generations().filter(F.col("load_id") == load_id).isEmpty():
            self._note([load_id], None)

    def sweep(self) -> int:
        """Removes the folders of compacted loads and returns their number."""
        loads = [r.load_id for r in self._generations().collect()] if self._exists("manifest") else []
        for load in loads:
            for table in TABLES:
                if table != "run_logs":
                    discard(self.spark, f"{self.path(table)}/load_id={load}")
        return len(loads)

    # ---- enrichment: one folder per taxonomy version and load

    def enriched(self, version: str) -> DataFrame:
        rows = self._read("enriched_lines", f"{LINES}, {ENRICHMENT}, ai_version string, load_id string")
        return rows.filter(F.col("ai_version") == version)

    def write_enriched(self, lines: DataFrame) -> None:
        """Replaces the (version, load) folders given and leaves the others; appears only when complete.

        Rows are rebalanced by load first: a load gets files of even size, not one from every task.
        """
        lines.hint("rebalance", "ai_version", "load_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "ai_version", "load_id").parquet(self.path("enriched_lines"))

    def drop_enriched(self, load_id: str) -> None:
        """Forgets what was judged of a load, as before the load is replaced by other documents."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path('enriched_lines')}/ai_version=*/load_id={load_id}")
        for found in pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
            discard(self.spark, found.getPath().toString())

    # ---- health: one row per day, replaced by key

    def health(self) -> DataFrame:
        return self._read("health", HEALTH + ", day date")

    def upsert_health(self, days: DataFrame) -> None:
        """Replaces the days given and leaves the others."""
        rows = days.select("headers", "details", "violations_total", "score", "day")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(
            self.path("health"))

    # ---- audit: append only

    def audit(self) -> DataFrame:
        return self._read("audit_log", AUDIT_LOG)

    def append_audit(self, events: DataFrame) -> None:
        """Appends events; columns an event lacks get the usual defaults."""
        defaults = {
            "ts": F.current_timestamp(), "user": F.lit("-"), "path": F.concat(F.lit("/action/"), F.col("action")),
            "method": F.lit("POST"), "status": F.lit(0), "resource": F.lit(None), "resource_id": F.lit(None),
            "extra": F.lit("{}"),
        }
        fields = [f.strip().split(" ", 1) for f in AUDIT_LOG.split(",")]

        def value(name: str):
            if name not in events.columns:
                return defaults[name]
            return F.coalesce(F.col(name), defaults[name]) if name in defaults else F.col(name)

        events.select(*[value(n).cast(t).alias(n) for n, t in fields]).write.mode("append").parquet(
            self.path("audit_log"))


def append_violations(violations: DataFrame, path: str) -> None:
    violations.write.mode("append").parquet(path)


def write_export(rows: DataFrame, path: str) -> None:
    """CSV with titles; the rows' order is kept across the part files."""
    rows.write.mode("overwrite").option("header", "true").csv(path)


def publish(view: DataFrame, path: str, month_of: str | None = None, table: str | None = None) -> None:
    """A curated view as Parquet for BI, by month where it has a date, as a catalog table if named.

    Rows are rebalanced by month first: a month gets files of even size, not one from every task.
    """
    if month_of is not None:
        view = view.select("*", F.date_format(month_of, "yyyy-MM").alias("month")).hint("rebalance", "month")
    writer = view.write.mode("overwrite")
    writer = writer.partitionBy("month") if month_of is not None else writer
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)
