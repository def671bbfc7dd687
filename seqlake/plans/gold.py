"""Gold: six aggregates over silver. Silver columns are NULL where a value is missing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlake.functions.text import or_else
from seqlake.operators.distinct import count_state, distinct_state, merge_states, number_values
from seqlake.operators.skew import key_or_spread
from seqlake.schemas import GOLD
from seqlake.session import materialize
from seqlake.vocab import MISSING

TOP_ORGANISMS = 10


def _flagged(column: str) -> Column:
    return F.count_if(F.col(column) == "True")


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _bigint(column: str) -> Column:
    return F.nullif(F.col(column), F.lit("")).cast("bigint")


def _rows_per_sample(df: DataFrame, name: str) -> DataFrame:
    return (
        df.where(F.col("sample_accession").isNotNull())
        .groupBy(F.col("sample_accession").alias("__key")).agg(F.count("*").alias(name))
    )


def sample_facts(classification: DataFrame, runs: DataFrame, attributes: DataFrame) -> DataFrame:
    """Classified samples with their run and attribute counts, counted before the join."""
    return (
        classification
        .withColumn("__key", key_or_spread("sample_accession", "biosample_accession"))
        .join(_rows_per_sample(runs, "run_count"), "__key", "left")
        .join(_rows_per_sample(attributes, "attribute_count"), "__key", "left")
        .drop("__key")
    )


def domain_summary(facts: DataFrame) -> DataFrame:
    return facts.groupBy("sample_domain").agg(
        F.count("*").alias("sample_count"),
        _total("run_count").alias("run_count"),
        _total("attribute_count").alias("attribute_count"),
        F.count_distinct("organism_group").alias("organism_group_count"),
        _flagged("host_present").alias("host_present_sample_count"),
        _flagged("environment_present").alias("environment_present_sample_count"),
        _flagged("clinical_present").alias("clinical_present_sample_count"),
        _flagged("metagenome_present").alias("metagenome_present_sample_count"),
    ).orderBy(F.desc("sample_count"), "sample_domain")


def context_summary(facts: DataFrame) -> DataFrame:
    return facts.groupBy("sample_context").agg(
        F.count("*").alias("sample_count"),
        _total("run_count").alias("run_count"),
        _total("attribute_count").alias("attribute_count"),
        F.count_distinct("sample_domain").alias("sample_domain_count"),
    ).orderBy(F.desc("sample_count"), "sample_context")


def _sample_domains(classification: DataFrame) -> DataFrame:
    return classification.where(F.col("sample_accession").isNotNull()).select(
        "sample_accession", "sample_domain")


STRATEGY_GROUP = ["sample_domain", "library_strategy"]


def strategy_rows(runs: DataFrame, classification: DataFrame) -> DataFrame:
    """Runs reduced to (sample, strategy, experiment), with the domain of their sample. Runs of one
    sample may be any share of the table: they are reduced first, and the join of what is left
    is split at run time where a sample is still hot."""
    reduced = (
        runs.where(F.col("sample_accession").isNotNull())
        .groupBy("sample_accession", "library_strategy", "experiment_accession")
        .agg(F.count("*").alias("n"), F.sum(_bigint("total_spots")).alias("spots"),
             F.sum(_bigint("total_bases")).alias("bases"))
    )
    return reduced.join(_sample_domains(classification), "sample_accession")


def domain_library_strategy(runs: DataFrame, classification: DataFrame) -> DataFrame:
    """Runs by domain and strategy. The two distinct counts are counts of groups: experiments from the
    groups that carry the sums, samples from groups of two columns, so no row is multiplied."""
    per_experiment = strategy_rows(runs, classification) \
        .groupBy(*STRATEGY_GROUP, "experiment_accession") \
        .agg(F.sum("n").alias("n"), F.sum("spots").alias("spots"), F.sum("bases").alias("bases"))
    sums = per_experiment.groupBy(*STRATEGY_GROUP).agg(
        F.sum("n").alias("run_count"),
        F.count("experiment_accession").alias("experiment_count"),
        F.sum("spots").alias("total_spots"), F.sum("bases").alias("total_bases"))
    per_sample = (
        runs.where(F.col("sample_accession").isNotNull())
        .select("sample_accession", "library_strategy").distinct()
        .join(_sample_domains(classification), "sample_accession")
        .select("sample_accession", *STRATEGY_GROUP).distinct()
    )
    samples = per_sample.groupBy(*STRATEGY_GROUP).agg(F.count("*").alias("sample_count"))
    # a few rows of either kind meet by group, a missing strategy included
    both = sums.unionByName(samples, allowMissingColumns=True)
    columns = list(GOLD["sra_domain_library_strategy_summary"])
    return both.groupBy(*STRATEGY_GROUP).agg(
        *[F.max(c).alias(c) for c in columns if c not in STRATEGY_GROUP]
    ).select(*columns).orderBy(
        F.desc("run_count"), "sample_domain", F.asc_nulls_last("library_strategy"))


@dataclass(frozen=True)
class StrategyState:
    """What one or more snapshots of runs add to the summary by domain and strategy: sums, and
    the samples and experiments seen as bitmaps. `numbers` holds the value numbers by column."""

    sums: DataFrame
    seen: dict[str, DataFrame]
    numbers: dict[str, DataFrame]


COUNTED = {"sample_accession": "sample_count", "experiment_accession": "experiment_count"}


def strategy_state(
    runs: DataFrame, classification: DataFrame, before: StrategyState | None = None
) -> StrategyState:
    """The state of the runs of a snapshot, merged with the state before it. Only the snapshot's runs
    are read; a sample or experiment that was seen before is not counted again."""
    rows = materialize(strategy_rows(runs, classification), "strategy-rows")
    sums = rows.groupBy(*STRATEGY_GROUP).agg(
        F.sum("n").alias("run_count"), F.sum("spots").alias("total_spots"),
        F.sum("bases").alias("total_bases"))
    numbers = {c: number_values(rows, c, before.numbers[c] if before else None) for c in COUNTED}
    seen = {c: distinct_state(rows, STRATEGY_GROUP, c, numbers[c]) for c in COUNTED}
    if before:
        sums = sums.unionByName(before.sums).groupBy(*STRATEGY_GROUP).agg(
            *[F.sum(c).alias(c) for c in ("run_count", "total_spots", "total_bases")])
        seen = {c: merge_states(seen[c].unionByName(before.seen[c]), STRATEGY_GROUP) for c in COUNTED}
    return StrategyState(
        materialize(sums, "strategy-sums"),
        {c: materialize(words, "strategy-seen") for c, words in seen.items()}, numbers)


def strategy_summary(state: StrategyState) -> DataFrame:
    """The gold table from a state."""
    parts = [state.sums, *[
        count_state(state.seen[c], STRATEGY_GROUP, name) for c, name in COUNTED.items()]]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = list(GOLD["sra_domain_library_strategy_summary"])
    return both.groupBy(*STRATEGY_GROUP).agg(*[
        F.coalesce(F.max(c), F.lit(0)).alias(c) if c in COUNTED.values() else F.max(c).alias(c)
        for c in columns if c not in STRATEGY_GROUP]).select(*columns)


def top_organisms(
    samples: DataFrame, classification: DataFrame, k: int = TOP_ORGANISMS
) -> DataFrame:
    """The k most frequent organisms of each domain. Groups are formed on the stored values, so
    a missing name and a literal 'missing' stay apart; ties go by name, then taxon id."""
    domains = classification.select("sample_accession", "sample_domain")
    counted = (
        samples.join(domains, "sample_accession")
        .groupBy("sample_domain", "organism", "taxon_id").agg(F.count("*").alias("sample_count"))
        .select(
            "sample_domain", "sample_count",
            or_else(F.col("organism"), MISSING).alias("organism"),
            or_else(F.col("taxon_id"), MISSING).alias("taxon_id"),
        )
    )
    by_count = Window.partitionBy("sample_domain").orderBy(
        F.desc("sample_count"), "organism", "taxon_id"
    )
    return (
        counted.withColumn("organism_rank", F.row_number().over(by_count))
        .where(F.col("organism_rank") <= k)
        .withColumn("organism_rank", F.col("organism_rank").cast("bigint"))
        .select(*GOLD["sra_top_organisms_by_domain"])
        .orderBy("sample_domain", "organism_rank")
    )


def attribute_category_by_domain(attributes: DataFrame, classification: DataFrame) -> DataFrame:
    """Attributes by domain and category. Each sample joins with one row per category it has,
    and since a sample has one domain, counting those rows counts distinct samples."""
    per_sample = (
        attributes.where(F.col("sample_accession").isNotNull())
        .groupBy("sample_accession", "attribute_category").agg(F.count("*").alias("n"))
    )
    domains = classification.select("sample_accession", "sample_domain")
    return per_sample.join(domains, "sample_accession").groupBy(
        "sample_domain", "attribute_category"
    ).agg(
        F.sum("n").alias("attribute_count"), F.count("*").alias("sample_count")
    ).orderBy("sample_domain", F.desc("attribute_count"), F.asc_nulls_last("attribute_category"))


def quality_summary(
    classification: DataFrame, runs: DataFrame, attributes: DataFrame
) -> DataFrame:
    """Totals in one row. The three tables are stacked as counters, so nothing is cross joined."""
    def counters(df: DataFrame, kind: str, unknown: Column | None = None) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"),
                         (F.lit(False) if unknown is None else unknown).alias("unknown"))

    stacked = (
        counters(classification, "sample", F.col("sample_domain") == "unknown")
        .unionAll(counters(runs, "run")).unionAll(counters(attributes, "attribute"))
    )
    totals = stacked.agg(
        F.count_if(F.col("kind") == "sample").alias("sample_count"),
        F.count_if(F.col("kind") == "run").alias("run_count"),
        F.count_if(F.col("kind") == "attribute").alias("attribute_count"),
        F.count_if("unknown").alias("unknown_sample_count"),
    )
    share = F.try_divide(F.col("unknown_sample_count").cast("double"), F.col("sample_count"))
    return totals.withColumn("unknown_sample_pct", F.round(share * 100, 4))


# Gold table: how it is built from the silver tables and the sample facts.
BUILDERS = {
    "sra_domain_summary": lambda silver, facts: domain_summary(facts),
    "sra_context_summary": lambda silver, facts: context_summary(facts),
    "sra_domain_library_strategy_summary": lambda silver, facts: domain_library_strategy(
        silver["sra_run"], silver["sra_sample_classification"]),
    "sra_top_organisms_by_domain": lambda silver, facts: top_organisms(
        silver["sra_sample"], silver["sra_sample_classification"]),
    "sra_attribute_category_by_domain": lambda silver, facts: attribute_category_by_domain(
        silver["sra_sample_attribute"], silver["sra_sample_classification"]),
    "sra_quality_summary": lambda silver, facts: quality_summary(
        silver["sra_sample_classification"], silver["sra_run"], silver["sra_sample_attribute"]),
}


def build_gold(silver: Mapping[str, DataFrame], facts: DataFrame) -> dict[str, DataFrame]:
    """All gold tables; `facts` are the (stored) sample facts of the same silver tables."""
    return {name: build(silver, facts) for name, build in BUILDERS.items()}
