"""Read queries over gold: six table reports, an overview, a top list and fifteen dashboard cards."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

DOMAINS = "sra_domain_summary"
CONTEXTS = "sra_context_summary"
STRATEGIES = "sra_domain_library_strategy_summary"
ORGANISMS = "sra_top_organisms_by_domain"
CATEGORIES = "sra_attribute_category_by_domain"
QUALITY = "sra_quality_summary"


def _ordered(df: DataFrame, down: str | None, *up: str) -> DataFrame:
    """Sorted by one measure, largest first, and then by names, missing ones last."""
    return df.orderBy(*([F.desc(down)] if down else []), *map(F.asc_nulls_last, up))


def _listing(
    table: str, down: str | None, *up: str, columns: list[str] | None = None
) -> Callable[[Tables], DataFrame]:
    return lambda gold: _ordered(gold[table].select(*(columns or gold[table].columns)), down, *up)


def _single(table: str, column: str) -> Callable[[Tables], DataFrame]:
    return lambda gold: gold[table].select(column)


def _top(table: str, label: str, measure: str, k: int) -> Callable[[Tables], DataFrame]:
    def report(gold: Tables) -> DataFrame:
        summed = gold[table].groupBy(label).agg(F.sum(measure).alias(measure))
        return _ordered(summed, measure, label).limit(k)
    return report


def overview(gold: Tables) -> DataFrame:
    """Domain rows with their share of all samples; the total is a scalar subquery."""
    total = gold[QUALITY].select("sample_count").scalar().cast("decimal(20,0)")
    share = F.try_divide(F.col("sample_count").cast("decimal(20,0)"), total)
    return gold[DOMAINS].select(
        "sample_domain", "sample_count", "run_count", "attribute_count",
        F.round(share * 100, 2).cast("double").alias("sample_pct"),
        "host_present_sample_count", "environment_present_sample_count",
        "clinical_present_sample_count", "metagenome_present_sample_count",
    ).orderBy(F.desc("sample_count"), "sample_domain")


def top_library_strategies(gold: Tables, k: int = 25) -> DataFrame:
    return (
        gold[STRATEGIES].where(F.col("library_strategy").isNotNull())
        .select("sample_domain", "library_strategy", "run_count", "sample_count",
                "experiment_count", "total_bases")
        .orderBy(F.desc("run_count"), "sample_domain", "library_strategy").limit(k)
    )


def _reports() -> dict[str, Callable[[Tables], DataFrame]]:
    counts = ["sample_domain", "sample_count", "run_count", "attribute_count"]
    flags = ["host_present_sample_count", "environment_present_sample_count",
             "clinical_present_sample_count"]
    return {
        "domain_summary": _listing(
            DOMAINS, "sample_count", "sample_domain", columns=counts + flags),
        "context_summary": _listing(CONTEXTS, "sample_count", "sample_context"),
        "domain_library_strategy_summary": _listing(
            STRATEGIES, "run_count", "sample_domain", "library_strategy"),
        "top_organisms_by_domain": _listing(ORGANISMS, None, "sample_domain", "organism_rank"),
        "attribute_category_by_domain": lambda gold: gold[CATEGORIES].orderBy(
            "sample_domain", F.desc("attribute_count"), F.asc_nulls_last("attribute_category")),
        "quality_summary": lambda gold: gold[QUALITY],
    }


def _cards() -> dict[str, Callable[[Tables], DataFrame]]:
    def by_domain(measure: str) -> Callable[[Tables], DataFrame]:
        return _listing(DOMAINS, measure, "sample_domain", columns=["sample_domain", measure])

    reports = _reports()
    return {
        "total_samples": _single(QUALITY, "sample_count"),
        "total_runs": _single(QUALITY, "run_count"),
        "unknown_pct": _single(QUALITY, "unknown_sample_pct"),
        "total_attributes": _single(QUALITY, "attribute_count"),
        "samples_by_domain": by_domain("sample_count"),
        "runs_by_domain": by_domain("run_count"),
        "domain_summary": lambda gold: _ordered(
            gold[DOMAINS].drop("organism_group_count"), "sample_count", "sample_domain"),
        "top_organisms": reports["top_organisms_by_domain"],
        # A sum over the per-domain top lists, as published: not an exact overall ranking.
        "top_organisms_overall": _top(ORGANISMS, "organism", "sample_count", 20),
        "domains_by_samples": by_domain("sample_count"),
        "domains_by_attributes": by_domain("attribute_count"),
        "domain_strategy": reports["domain_library_strategy_summary"],
        "top_strategies": _top(STRATEGIES, "library_strategy", "run_count", 15),
        "attribute_categories": _top(CATEGORIES, "attribute_category", "attribute_count", 20),
        "categories_by_domain": reports["attribute_category_by_domain"],
    }


def report_names() -> list[str]:
    return [*_reports(), "overview", "top_library_strategies"]


def card_names() -> list[str]:
    return list(_cards())


def report(name: str, gold: Tables) -> DataFrame:
    special = {"overview": overview, "top_library_strategies": top_library_strategies}
    return {**_reports(), **special}[name](gold)


def card(name: str, gold: Tables) -> DataFrame:
    return _cards()[name](gold)
