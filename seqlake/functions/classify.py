"""Ordered classification rules as chained conditions: the first that holds decides."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlake import vocab
from seqlake.functions.text import or_else


TERM_KEY = ["organism", "taxon_id", "source_dataset"]


def _mentions(text: Column, *terms: str) -> Column:
    return text.rlike("|".join(re.escape(t) for t in terms))


def _first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    chain = F
    for condition, label in rules:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def _is_human(name: Column, taxon_id: Column) -> Column:
    return (taxon_id == "9606") | (name == "homo sapiens")


def organism_group(organism: Column, taxon_id: Column, dataset: Column) -> Column:
    """Group guessed from the organism name, its taxon id and the (merged) query names."""
    name, source = F.lower(organism), F.lower(dataset)
    animal = taxon_id.isin("10090", *vocab.ANIMAL_TAXA) | (name == "mus musculus")
    insect = taxon_id.isin(vocab.INSECT_TAXA) | _mentions(name, "drosophila")
    return _first_match(
        [
            (_is_human(name, taxon_id) | animal | insect, "Eukaryota"),
            (taxon_id.isin(vocab.PLANT_TAXA) | _mentions(source, "viridiplantae", "plant-wgs"),
             "Viridiplantae"),
            (taxon_id.isin(vocab.FUNGAL_TAXA) | _mentions(source, "fungi")
             | _mentions(name, *vocab.FUNGAL_TERMS), "Fungi"),
            (taxon_id.isin(vocab.ALGAL_TAXA), "Viridiplantae"),
            (taxon_id.isin(vocab.PROTIST_TAXA) | _mentions(name, *vocab.PROTIST_TERMS), "Protists"),
            (_mentions(source, "archaea") | _mentions(name, *vocab.ARCHAEAL_TERMS), "Archaea"),
            (_mentions(name, "virus") | _mentions(source, "viruses-organism"), "Viruses"),
            (_mentions(source, "bacteria") | _mentions(name, *vocab.BACTERIAL_TERMS), "Bacteria"),
            (_mentions(name, "metagenome") | _mentions(source, "metagenomic"), "Metagenome"),
            (_mentions(source, "long-read") & (name != "") & ~name.isin(vocab.UNNAMED_SAMPLES),
             "Eukaryota"),
        ],
        "unknown",
    )


def sample_domain(
    organism: Column, taxon_id: Column, dataset: Column, group: Column, metagenome: Column
) -> Column:
    name, source = F.lower(organism), F.lower(dataset)
    return _first_match(
        [
            (_is_human(name, taxon_id), "human"),
            (_mentions(source, "viridiplantae") | (group == "Viridiplantae"), "plant"),
            (group == "Fungi", "fungi"),
            (group == "Viruses", "virus"),
            (group.isin("Bacteria", "Archaea"), "microorganism"),
            (group == "Protists", "protist"),
            (_mentions(name, "metagenome") | _mentions(source, "metagenomic") | metagenome,
             "metagenome"),
            (group == "Eukaryota", "animal"),
        ],
        "unknown",
    )


def context_terms(organism: Column, dataset: Column) -> tuple[Column, Column]:
    """Whether name or dataset speak of the environment, and of an experiment."""
    return (_mentions(F.lower(organism), "wastewater", "soil"),
            _mentions(F.lower(dataset), "single-cell"))


def context_rules(
    domain: Column, host: Column, environment: Column, clinical: Column, categories: Column,
    environmental_terms: Column, experimental_terms: Column,
) -> Column:
    has = lambda category: F.array_contains(categories, category)
    return _first_match(
        [
            ((domain == "human") & clinical, "clinical"),
            (host, "host-associated"),
            (environment | environmental_terms, "environmental"),
            (domain == "metagenome", "metagenomic"),
            (has("host_material"), "tissue"),
            (has("experimental_design") | experimental_terms, "experimental"),
        ],
        "unknown",
    )


def sample_context(
    organism: Column, dataset: Column, domain: Column,
    host: Column, environment: Column, clinical: Column, categories: Column,
) -> Column:
    """`categories` is the array of attribute categories the sample has."""
    return context_rules(domain, host, environment, clinical, categories,
                         *context_terms(organism, dataset))


def term_rules(values: DataFrame) -> DataFrame:
    """All that is decided by the text of (organism, taxon_id, source_dataset) alone: the group, the
    domain with and without metagenome attributes, and the terms that contexts look for."""
    organism, taxon_id, dataset = map(F.col, TERM_KEY)
    group = F.col("term_group")
    domain = lambda metagenome: sample_domain(
        organism, taxon_id, dataset, group, F.lit(metagenome))
    environmental, experimental = context_terms(organism, dataset)
    return values.withColumn("term_group", organism_group(organism, taxon_id, dataset)).withColumns({
        "term_domain": domain(False), "term_domain_metagenome": domain(True),
        "environmental_terms": environmental, "experimental_terms": experimental})


def lineage_group(taxon_id: Column, scientific_name: Column, lineage_names: Column) -> Column:
    """Group read off a taxonomic lineage (array of names)."""
    name = F.lower(scientific_name)
    clades = F.transform(lineage_names, lambda n: F.lower(n))
    within = lambda clade: F.array_contains(clades, clade)
    return _first_match(
        [
            (_is_human(name, taxon_id), "Eukaryota"),
            (_mentions(name, *vocab.UNNAMED_SAMPLES), "unknown"),
            (within("metagenomes") | _mentions(name, "metagenome"), "Metagenome"),
            (within("viruses"), "Viruses"),
            (within("bacteria"), "Bacteria"),
            (within("archaea"), "Archaea"),
            (within("viridiplantae"), "Viridiplantae"),
            (within("fungi"), "Fungi"),
            (F.arrays_overlap(clades, F.array(*map(F.lit, vocab.PROTIST_CLADES))), "Protists"),
            (within("metazoa"), "Eukaryota"),
            (within("eukaryota"), "Protists"),
        ],
        "unknown",
    )


def lineage_domain(taxon_id: Column, scientific_name: Column, group: Column) -> Column:
    return _first_match(
        [
            (_is_human(F.lower(scientific_name), taxon_id), "human"),
            (group == "Viridiplantae", "plant"),
            (group == "Fungi", "fungi"),
            (group == "Protists", "protist"),
            (group.isin("Bacteria", "Archaea"), "microorganism"),
            (group == "Viruses", "virus"),
            (group == "Metagenome", "metagenome"),
            (group == "Eukaryota", "animal"),
        ],
        "unknown",
    )


def category_summary(counts: Column) -> Column:
    """`category:count` list, most frequent first; input is array<struct<category, n>>."""
    ranked = F.array_sort(F.transform(counts, lambda s: F.struct(-s["n"], s["category"])))
    return F.array_join(
        F.transform(ranked, lambda s: F.concat(s["category"], F.lit(":"), -s["col1"])),
        vocab.LIST_SEPARATOR,
    )


def classification_basis(
    organism: Column, taxon_id: Column, dataset: Column, group: Column, domain: Column,
    context: Column, host: Column, environment: Column, clinical: Column, metagenome: Column,
    from_taxonomy: Column,
) -> Column:
    # The key names and flag names of the basis text.
    facts = {
        "organism": or_else(organism, vocab.MISSING),
        "taxon_id": or_else(taxon_id, vocab.MISSING),
        "source_dataset": or_else(dataset, vocab.MISSING),
        "organism_group": group,
        "sample_domain": domain,
        "sample_context": context,
    }
    flags = {
        "host_attribute_present": host,
        "environment_attribute_present": environment,
        "clinical_attribute_present": clinical,
        "metagenome_assembly_attribute_present": metagenome,
        "taxonomy_reference_present": from_taxonomy,
    }
    return F.concat_ws(
        "; ",
        *[F.concat(F.lit(f"{key}="), value) for key, value in facts.items()],
        *[F.when(flag, F.lit(text)) for text, flag in flags.items()],
    )
