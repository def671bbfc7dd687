from collections import defaultdict

import pytest

from seqlake import vocab
from seqlake.operators import attributes

CASES = {
    "env_biome": "environment", "env_broad_scale": "environment", "host": "host",
    "host_raw_meat_feeding": "host", "source_type": "source_material", "source": "source_material",
    "sample_name": "sample_identifier", "sequenced_by": "submission_metadata",
    "purpose_of_sampling": "public_health_surveillance", "food_origin": "food_metadata",
    "mic_meropenem": "antimicrobial_resistance", "sequence_type": "molecular_typing",
    "depth": "environmental_measurement", "location_in_facility": "facility_metadata",
    "estimated_size": "genome_metadata", "environmental_medium": "environment",
    "environment_biome": "environment", "ww_sample_type": "wastewater_surveillance",
    "bowel_movement_frequency": "human_survey", "covid_anxious": "human_survey",
    "samp_collect_device": "sample_processing", "sample_lysis_method": "sample_processing",
    "study_disease": "clinical", "clinical_status": "clinical", "body_site": "host_material",
    "metagenome_source": "metagenome_assembly", "replicate_number": "experimental_design",
    "chip_antibody": "experimental_design", "bmi_cat": "human_survey", "mfd_hab1": "environment",
    "local_scale_environmental_context": "environment", "unexpected": "other", "": "other",
}


def test_categories(spark, rows):
    df = rows([{"normalized_attribute_name": n, "sample_accession": n} for n in CASES])
    dictionary = attributes.attribute_dictionary(spark)
    found = attributes.categorize(df, dictionary, ["sample_accession"]).collect()
    assert {r.normalized_attribute_name: r.attribute_category for r in found} == CASES


def test_dictionary_beyond_the_broadcast_limit_gives_the_same(spark, rows, monkeypatch):
    from seqlake.operators import skew

    df = rows([{"normalized_attribute_name": n, "sample_accession": str(i)}
               for n in CASES for i in range(20)])
    dictionary = attributes.attribute_dictionary(spark)
    joined = skew.lookup_join(
        df, dictionary.withColumnRenamed("name", "normalized_attribute_name"),
        "normalized_attribute_name", ["sample_accession"], max_rows=10, hot_rows=5)
    plain = df.join(dictionary.withColumnRenamed("name", "normalized_attribute_name"),
                    "normalized_attribute_name", "left")
    assert sorted(map(tuple, joined.select(plain.columns).collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str)


def test_core_dictionary_has_one_category_per_name():
    names = [name for name, _ in vocab.core_dictionary()]
    assert len(names) == len(set(names))
    assert {"age", "env_broad_scale", "source_type"} <= set(names)
    assert sum(c == "host" for _, c in vocab.core_dictionary()) == 29


def test_dictionary_from_a_table(spark, tmp_path, rows):
    path = tmp_path / "dictionary.csv"
    path.write_text("name,category\nstrain,organism_identity\nhost,custom\n")
    dictionary = attributes.attribute_dictionary(spark, str(path))
    df = rows([{"attribute_name": "Strain", "sample_accession": "1", "attribute_value": "x"},
               {"attribute_name": "HOST", "sample_accession": "1", "attribute_value": "x"}])
    found = attributes.renormalize(df, dictionary).collect()
    assert {r.attribute_name: r.attribute_category for r in found} == {
        "Strain": "organism_identity", "HOST": "custom"}


def test_renormalize_overrides_stale_values(spark, rows):
    df = rows([{"attribute_name": "Geo Loc-Name", "normalized_attribute_name": "old",
                "attribute_category": "old", "sample_accession": "S", "attribute_value": "v"}])
    row = attributes.renormalize(df, attributes.attribute_dictionary(spark)).first()
    assert (row.normalized_attribute_name, row.attribute_category) == ("geo_loc_name", "spatiotemporal")


def test_signals_ignore_blank_samples(rows):
    df = rows([
        {"sample_accession": "S1", "attribute_category": "host"},
        {"sample_accession": "S1", "attribute_category": "host"},
        {"sample_accession": "S1", "attribute_category": "metagenome_assembly"},
        {"sample_accession": "S2", "attribute_category": "other"},
        {"sample_accession": "", "attribute_category": "clinical"},
    ])
    found = {r.sample_accession: r for r in attributes.attribute_signals(df).collect()}
    assert set(found) == {"S1", "S2"}
    assert {c.category: c.n for c in found["S1"].category_counts} == {
        "host": 2, "metagenome_assembly": 1}
    assert found["S1"].host_present and found["S1"].metagenome_present
    assert not (found["S2"].host_present or found["S2"].clinical_present)


def test_profile_matches_brute_force(spark, rows):
    names = ["Host", " host ", "geo loc name", "Odd", "", "age cat"]
    data = [{"attribute_name": names[(i * i) % 6 if i % 3 else 0],
             "attribute_value": "" if i % 7 == 0 else f"v{i % 23:02d}"} for i in range(600)]
    counts, values, spellings = defaultdict(int), defaultdict(set), defaultdict(set)
    for row in data:
        key = "_".join(row["attribute_name"].lower().split())
        if key:
            counts[key] += 1
            spellings[key].add(row["attribute_name"])
            values[key] |= {row["attribute_value"]} - {""}
    profile = attributes.profile_attributes(rows(data), attributes.attribute_dictionary(spark), 3)
    found = {r.normalized_attribute_name: r for r in profile.collect()}
    assert set(found) == set(counts)
    for key, row in found.items():
        assert row["count"] == counts[key]
        assert row.distinct_value_count == len(values[key])
        assert row.original_attribute_names == " | ".join(sorted(spellings[key]))
        assert row.example_values == " | ".join(sorted(values[key])[:3])
    ordered = [r.normalized_attribute_name for r in profile.collect()]
    assert ordered == sorted(counts, key=lambda k: (-counts[k], k))


def test_profile_needs_a_positive_example_count(spark, rows):
    with pytest.raises(ValueError, match="max_examples"):
        attributes.profile_attributes(rows([{"attribute_name": "a", "attribute_value": "b"}]),
                                      attributes.attribute_dictionary(spark), 0)
