import pytest
from pyspark.sql import functions as F

from seqlake.functions import classify
from seqlake.plans.silver import classify_samples

# What each case is for: organism, taxon id, query names, expected group, expected domain. One case
# per rule, then one for each pair of rules that could both hold (the earlier one decides).
SAMPLES = {
    "person by id": ("donor 14", "9606", "q", "Eukaryota", "human"),
    "person by name": ("HOMO SAPIENS", "", "q", "Eukaryota", "human"),
    "mouse by id": ("strain B6", "10090", "q", "Eukaryota", "animal"),
    "mouse by name": ("Mus Musculus", "0", "q", "Eukaryota", "animal"),
    "animal by id": ("Ovis aries", "9940", "q", "Eukaryota", "animal"),
    "insect by id": ("leafhopper", "108931", "q", "Eukaryota", "animal"),
    "insect by name": ("Drosophila virilis", "7244", "q", "Eukaryota", "animal"),
    "plant by id": ("rice relative", "188998", "q", "Viridiplantae", "plant"),
    "plant by query": ("x", "1", "my-plant-wgs-set", "Viridiplantae", "plant"),
    "plant clade in query": ("x", "1", "all-viridiplantae", "Viridiplantae", "plant"),
    "fungus by id": ("baker's yeast", "4932", "q", "Fungi", "fungi"),
    "fungus by query": ("x", "1", "soil-fungi-2", "Fungi", "fungi"),
    "fungus by name": ("Unnamed fungus 7", "1", "q", "Fungi", "fungi"),
    "alga by id": ("red cysts", "44745", "q", "Viridiplantae", "plant"),
    "protist by id": ("P. vivax", "5855", "q", "Protists", "protist"),
    "protist by name": ("Theileria orientalis", "1", "q", "Protists", "protist"),
    "archaeon by query": ("x", "1", "deep-archaea", "Archaea", "microorganism"),
    "archaeon by name": ("Methanococcus aeolicus", "1", "q", "Archaea", "microorganism"),
    "virus by name": ("Gull parvovirus", "1", "q", "Viruses", "virus"),
    "virus by query": ("x", "1", "viruses-organism-9", "Viruses", "virus"),
    "bacterium by query": ("x", "1", "bacteria-3", "Bacteria", "microorganism"),
    "bacterium by name": ("Vibrio furnissii", "1", "q", "Bacteria", "microorganism"),
    "metagenome by name": ("glacier metagenome", "1", "q", "Metagenome", "metagenome"),
    "metagenome by query": ("x", "1", "metagenomic-77", "Metagenome", "metagenome"),
    "named long read": ("Salvelinus alpinus", "1", "long-read-1", "Eukaryota", "animal"),
    "unnamed long read": ("Synthetic Construct", "1", "long-read-1", "unknown", "unknown"),
    "blank long read": ("", "", "long-read-1", "unknown", "unknown"),
    "no rule": ("something", "1", "q", "unknown", "unknown"),
    "animal id before plant query": ("x", "9913", "plant-wgs", "Eukaryota", "animal"),
    "clade in query sets the domain": ("x", "9913", "viridiplantae", "Eukaryota", "plant"),
    "plant query before fungus name": ("plant fungus", "1", "plant-wgs", "Viridiplantae", "plant"),
    "fungus before protist": ("fungus on Babesia", "1", "q", "Fungi", "fungi"),
    "protist before archaea query": ("Toxoplasma", "1", "archaea", "Protists", "protist"),
    "archaeon before virus": ("archaeal virus", "1", "q", "Archaea", "microorganism"),
    "virus before bacteria query": ("phage virus", "1", "bacteria", "Viruses", "virus"),
    "bacterium before metagenome": ("Listeria metagenome", "1", "q", "Bacteria", "microorganism"),
    "metagenome before long read": ("x", "1", "metagenomic | long-read", "Metagenome", "metagenome"),
    "candida needs its blank": ("Candidatus x", "1", "q", "unknown", "unknown"),
}


def samples(rows, names=SAMPLES):
    return rows([{
        "sample_accession": n, "biosample_accession": f"B-{n}", "organism": SAMPLES[n][0],
        "taxon_id": SAMPLES[n][1], "source_dataset": SAMPLES[n][2], "source_file": "runs.csv",
    } for n in names])


def attribute(sample, category):
    return {"sample_accession": sample, "attribute_category": category}


def by_sample(df):
    return {r.sample_accession: r for r in df.collect()}


def test_groups_and_domains(rows):
    found = by_sample(classify_samples(samples(rows), rows([attribute("none", "other")])))
    assert {n: (r.organism_group, r.sample_domain) for n, r in found.items()} == {
        n: s[3:] for n, s in SAMPLES.items()}


def test_contexts_and_flags(rows):
    signals = {
        "person by id": ["clinical", "host"], "person by name": ["host"],
        "bacterium by name": ["host", "host", "other"], "animal by id": ["host_material"],
        "fungus by id": ["environment"], "named long read": ["metagenome_assembly"],
        "virus by name": ["clinical"], "insect by name": ["experimental_design"],
        "insect by id": ["experimental_design", "host_material"],
    }
    found = by_sample(classify_samples(samples(rows), rows(
        [attribute(sample, c) for sample, given in signals.items() for c in given])))
    expected = {
        "person by id": "clinical", "person by name": "host-associated",
        "bacterium by name": "host-associated", "animal by id": "tissue",
        "fungus by id": "environmental", "named long read": "metagenomic",
        "virus by name": "unknown", "insect by name": "experimental", "insect by id": "tissue",
        "metagenome by name": "metagenomic", "fungus by query": "unknown",
    }
    assert {n: found[n].sample_context for n in expected} == expected
    assert found["named long read"].sample_domain == "metagenome"
    assert found["bacterium by name"].attribute_category_summary == "host:2 | other:1"
    flags = found["bacterium by name"]
    assert (flags.host_present, flags.clinical_present) == ("True", "False")
    assert found["metagenome by name"].attribute_category_summary == ""
    assert found["person by id"].classification_basis == (
        "organism=donor 14; taxon_id=9606; source_dataset=q; organism_group=Eukaryota; "
        "sample_domain=human; sample_context=clinical; host_attribute_present; "
        "clinical_attribute_present")
    assert found["blank long read"].classification_basis.startswith(
        "organism=missing; taxon_id=missing; ")


@pytest.mark.parametrize("organism, dataset, expected", [
    ("lake wastewater", "q", "environmental"), ("forest SOIL", "q", "environmental"),
    ("x", "my-single-cell-set", "experimental"), ("x", "q", "unknown"),
])
def test_contexts_from_names(rows, organism, dataset, expected):
    df = rows([{"sample_accession": "a", "biosample_accession": "b", "organism": organism,
                "taxon_id": "1", "source_dataset": dataset, "source_file": "f"}])
    found = classify_samples(df, rows([attribute("none", "other")])).first()
    assert found.sample_context == expected


@pytest.mark.parametrize("max_rows", [100, 0])
def test_taxonomy_overrides_the_rules(rows, monkeypatch, max_rows):
    from seqlake.operators import skew
    from seqlake.plans import silver

    monkeypatch.setattr(silver, "lookup_join", lambda *a: skew.lookup_join(
        *a, max_rows=max_rows, hot_rows=2))
    reference = rows([
        {"taxon_id": "188998", "organism_group": "Protists", "sample_domain": "protist"},
        {"taxon_id": "9606", "organism_group": "Eukaryota", "sample_domain": ""},
        {"taxon_id": "", "organism_group": "Fungi", "sample_domain": "fungi"},
    ])
    found = by_sample(classify_samples(samples(rows), rows([attribute("x", "y")]), reference))
    moved = found["plant by id"]
    assert (moved.organism_group, moved.sample_domain) == ("Protists", "protist")
    assert moved.classification_basis.endswith("; taxonomy_reference_present")
    assert "taxonomy_reference" not in found["person by id"].classification_basis
    assert found["blank long read"].sample_domain == "unknown"
    assert len(found) == len(SAMPLES)


def test_samples_without_an_accession_get_no_signal(rows):
    df = rows([
        {"sample_accession": "", "biosample_accession": "S1", "organism": "x", "taxon_id": "1",
         "source_dataset": "d", "source_file": "f"},
        {"sample_accession": "S1", "biosample_accession": "B", "organism": "x", "taxon_id": "1",
         "source_dataset": "d", "source_file": "f"},
    ])
    found = classify_samples(df, rows([attribute("S1", "host"), attribute("", "clinical")]))
    assert {(r.biosample_accession, r.host_present, r.clinical_present) for r in found.collect()} == {
        ("S1", "False", "False"), ("B", "True", "False")}


@pytest.mark.parametrize("taxon, name, lineage, group, domain", [
    ("9606", "donor", [], "Eukaryota", "human"),
    ("1", "ciliate", ["Eukaryota", "Alveolata"], "Protists", "protist"),
    ("1", "a blank sample here", ["Bacteria"], "unknown", "unknown"),
    ("1", "glacier metagenome", ["Bacteria"], "Metagenome", "metagenome"),
    ("1", "x", ["unclassified", "Metagenomes"], "Metagenome", "metagenome"),
    ("1", "x", ["Viruses"], "Viruses", "virus"), ("1", "x", ["Bacteria"], "Bacteria", "microorganism"),
    ("1", "x", ["Archaea"], "Archaea", "microorganism"),
    ("1", "x", ["Eukaryota", "Viridiplantae"], "Viridiplantae", "plant"),
    ("1", "x", ["Eukaryota", "Fungi"], "Fungi", "fungi"),
    ("1", "x", ["Eukaryota", "Metazoa"], "Eukaryota", "animal"),
    ("1", "x", ["Eukaryota"], "Protists", "protist"), ("1", "x", ["other"], "unknown", "unknown"),
])
def test_lineage_rules(spark, taxon, name, lineage, group, domain):
    df = spark.createDataFrame([(taxon, name, lineage)], "t string, n string, l array<string>")
    found = df.withColumn("g", classify.lineage_group(F.col("t"), F.col("n"), F.col("l"))).withColumn(
        "d", classify.lineage_domain(F.col("t"), F.col("n"), F.col("g"))).first()
    assert (found.g, found.d) == (group, domain)
