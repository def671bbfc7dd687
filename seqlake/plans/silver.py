"""Silver: one row per run, sample and sample attribute, and the classification of each sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions import classify
from seqlake.functions.text import is_blank, null_to_blank, or_else
from seqlake.operators.attributes import SIGNAL_FLAGS, attribute_signals
from seqlake.operators.dedupe import ORDER, keep_first, keep_first_of_few
from seqlake.operators.skew import key_or_spread, lookup_join
from seqlake.sources.files import project_fields


def silver_runs(bronze_runs: DataFrame) -> DataFrame:
    """First row per run id. Bronze has each run of an experiment once, so few ids repeat."""
    named = bronze_runs.where(~is_blank(F.col("run_accession")))
    return project_fields(keep_first_of_few(named, ["run_accession"]), schemas.SILVER["sra_run"])


def silver_samples(bronze_runs: DataFrame) -> DataFrame:
    """First row per sample id, or per BioSample id where the sample id is blank."""
    keyed = project_fields(bronze_runs, [*schemas.SILVER["sra_sample"], ORDER]).withColumn(
        "__key", or_else(F.col("sample_accession"), "")
    )
    keyed = keyed.withColumn(
        "__key", F.when(F.col("__key") != "", F.col("__key"))
        .otherwise(null_to_blank(F.col("biosample_accession"))),
    ).where("__key <> ''")
    return keep_first(keyed, ["__key"]).select(*schemas.SILVER["sra_sample"])


def silver_attributes(bronze_attributes: DataFrame) -> DataFrame:
    """First row per attribute key; rows whose key is blank in every part are dropped."""
    keys = [null_to_blank(F.col(c)) for c in schemas.ATTRIBUTE_KEY]
    some = bronze_attributes.where(F.concat(*keys) != "")
    return project_fields(
        keep_first_of_few(some, schemas.ATTRIBUTE_KEY), schemas.SILVER["sra_sample_attribute"]
    )


def _with_term_rules(samples: DataFrame) -> DataFrame:
    key = F.struct(*classify.TERM_KEY)
    ruled = classify.term_rules(samples.select(*classify.TERM_KEY).distinct())
    return lookup_join(
        samples.withColumn("__terms", key),
        ruled.withColumn("__terms", key).drop(*classify.TERM_KEY), "__terms",
        ["sample_accession", "biosample_accession"]).drop("__terms")


def classify_samples(
    samples: DataFrame, attributes: DataFrame, taxonomy: DataFrame | None = None
) -> DataFrame:
    """Classification of every sample; a complete taxonomy row overrides the heuristic rules.

    The rules look for some hundred terms in name and datasets. They run once per distinct value of
    those, of which there are far fewer than samples, and their result is looked up.
    """
    rows = _with_term_rules(samples.fillna(""))
    if taxonomy is None:
        unknown = F.lit(None).cast("string")
        rows = rows.withColumns({"__group": unknown, "__domain": unknown})
    else:
        complete = taxonomy.where(
            ~is_blank(F.col("organism_group")) & ~is_blank(F.col("sample_domain"))
            & ~is_blank(F.col("taxon_id"))
        ).select("taxon_id", F.col("organism_group").alias("__group"),
                 F.col("sample_domain").alias("__domain"))
        rows = lookup_join(rows, complete, "taxon_id",
                           ["sample_accession", "biosample_accession"])
    key = key_or_spread("sample_accession", "biosample_accession")
    signals = attribute_signals(attributes).withColumnRenamed("sample_accession", "__key")
    rows = rows.withColumn("__key", key).join(signals, "__key", "left").drop("__key")

    organism, taxon_id, dataset = F.col("organism"), F.col("taxon_id"), F.col("source_dataset")
    flag = {name: F.coalesce(name, F.lit(False)) for name in SIGNAL_FLAGS.values()}
    counts = F.coalesce("category_counts", F.array().cast("array<struct<category:string,n:bigint>>"))
    group, domain, context = map(F.col, ("organism_group", "sample_domain", "sample_context"))
    by_terms = F.when(F.col("metagenome_present"), F.col("term_domain_metagenome")) \
        .otherwise(F.col("term_domain"))
    # A reference row has both group and domain, so the rules for domains never meet its group.
    return (
        rows.withColumns(flag)
        .withColumn("category_counts", counts)
        .withColumn("organism_group", F.coalesce("__group", "term_group"))
        .withColumn("sample_domain", F.coalesce(F.col("__domain"), by_terms))
        .withColumn("sample_context", classify.context_rules(
            domain, F.col("host_present"), F.col("environment_present"), F.col("clinical_present"),
            F.col("category_counts.category"), F.col("environmental_terms"),
            F.col("experimental_terms")))
        .withColumn("attribute_category_summary", classify.category_summary(F.col("category_counts")))
        .withColumn("classification_basis", classify.classification_basis(
            organism, taxon_id, dataset, group, domain, context,
            F.col("host_present"), F.col("environment_present"), F.col("clinical_present"),
            F.col("metagenome_present"), F.col("__group").isNotNull()))
        # Stored booleans are spelled True and False.
        .withColumns({name: F.initcap(F.col(name).cast("string")) for name in flag})
        .select(*schemas.SILVER["sra_sample_classification"])
    )
