"""Composite reports: the frames of one page, by name, each still lazy."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from folioflow.functions.scalars import LOCAL_ZONE
from folioflow.functions.taxonomy import FITTINGS, Taxonomy
from folioflow.operators import consistency, curated, enrichment, health, listing, quality
from folioflow.sources.store import Store, publish


def health_report(days: DataFrame, runs: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """Trend of the last days, extremes, scaled series and run statistics."""
    return {
        "trend": health.health_trend(days),
        "extremes": health.best_and_worst_day(days),
        "score_line": health.spark_line(days, "score"),
        "violations_line": health.spark_line(days, "violations_total"),
        "operations": health.run_statistics(runs, as_of),
    }


def enrichment_overview(lines: DataFrame, taxonomy: Taxonomy = FITTINGS) -> dict[str, DataFrame]:
    """Category mix, brands, rates and pairs."""
    return {
        "mix": enrichment.category_mix(lines),
        "brands": enrichment.brand_ranking(lines),
        "rates": enrichment.unenriched_rate(lines, taxonomy),
        "pairs": enrichment.subcategory_pairs(lines),
    }


def quality_report(violations: DataFrame, rules: DataFrame, zone: str = LOCAL_ZONE, stored_zone: str | None = None) -> dict[str, DataFrame]:
    return {
        "by_level": quality.by_level(violations, rules),
        "by_rule": quality.by_rule(violations, rules),
        "by_day": quality.by_day(violations, zone, stored_zone),
    }


def consistency_page(files: DataFrame, headers: DataFrame, lines: DataFrame, violations: DataFrame,
                     rules: DataFrame) -> dict[str, DataFrame]:
    """True counts, and samples beside them."""
    return {
        "counts": consistency.consistency_report(files, headers, lines, violations, rules),
        "duplicate_groups": consistency.duplicate_sample(headers),
        "mismatch_examples": consistency.mismatch_sample(headers, lines),
    }


def violations_list(enriched: DataFrame, rules: DataFrame, page: int = 1, page_size: int = 50, **filters) -> dict[str, DataFrame]:
    """A page of violations, the size of the whole set, and the rule codes to choose from."""
    found = listing.violations(enriched, **filters)
    return {
        "page": listing.page_of(found, "created_at", "violation_id", page, page_size),
        "total": listing.total_rows(found), "codes": listing.pick_list(rules, "rule_code"),
    }


def runs_list(log: DataFrame, page: int = 1, page_size: int = 50, **filters) -> dict[str, DataFrame]:
    found = listing.runs(log, **filters)
    return {
        "page": listing.page_of(found, "started_at", "run_id", page, page_size),
        "total": listing.total_rows(found), "jobs": listing.pick_list(log, "job"),
    }


def audit_list(log: DataFrame, page: int = 1, page_size: int = 50, **filters) -> dict[str, DataFrame]:
    found = listing.audit_entries(log, **filters)
    return {"page": listing.page_of(found, "ts", "path", page, page_size), "total": listing.total_rows(found)}


def documents_list(headers: DataFrame, limit: int = 500, **filters) -> dict[str, DataFrame]:
    return {
        "documents": listing.latest_documents(headers, limit, **filters),
        "types": listing.pick_list(headers, "tipo_dte"),
    }


def curated_views(headers: DataFrame, lines: DataFrame, violations: DataFrame, rules: DataFrame) -> dict[str, tuple[DataFrame, str | None]]:
    """Every curated view by the name it is queried by, with the date its months come from."""
    return {
        "fact_dte_lines": (curated.fact_lines(headers, lines, violations, rules), "fecha_emision"),
        "dim_emisor": (curated.dim_issuer(headers), None),
        "dim_receptor": (curated.dim_receiver(headers), None),
        "fct_dte_daily_totals": (curated.daily_totals(headers), "fecha_emision"),
        "dq_violations_enriched": (curated.violations_enriched(violations, rules), None),
        "v_dte_detail": (curated.line_detail(headers, lines), "fecha_emision"),
        "v_dte_kpi_daily": (curated.daily_kpi(headers), None),
    }


def publish_curated(store: Store, rules: DataFrame, zone: str = "curated") -> list[str]:
    """Writes the curated views below the store and returns their paths."""
    headers, lines, violations = (store.read(t).drop("load_id") for t in ("headers", "lines", "violations"))
    paths = []
    for name, (view, month_of) in curated_views(headers, lines, violations, rules).items():
        paths.append(f"{store.path(zone)}/{name}")
        publish(view, paths[-1], month_of)
    return paths
