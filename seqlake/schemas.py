"""Column layouts of every stored table. Text columns are strings; nothing is ever inferred.

Fixed values: names, order and types of the columns are those that readers of the tables know.
"""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = ["source_dataset", "source_file"]

BRONZE_RUN = [
    "experiment_accession", "run_accession", "study_accession", "bioproject_accession",
    "sample_accession", "biosample_accession", "organism", "taxon_id",
    "library_strategy", "library_source", "library_selection", "library_layout",
    "platform", "instrument_model", "total_spots", "total_bases",
]
BRONZE_ATTRIBUTE = [
    "sample_accession", "biosample_accession", "attribute_name", "attribute_value",
    "normalized_attribute_name", "attribute_category",
]
RUN_KEY = ["experiment_accession", "run_accession"]
ATTRIBUTE_KEY = [
    "sample_accession", "biosample_accession", "normalized_attribute_name", "attribute_value",
]

SILVER = {
    "sra_run": [
        "run_accession", "experiment_accession", "study_accession", "sample_accession",
        "biosample_accession", "library_strategy", "library_source", "library_selection",
        "library_layout", "platform", "instrument_model", "total_spots", "total_bases", *LINEAGE,
    ],
    "sra_sample": ["sample_accession", "biosample_accession", "organism", "taxon_id", *LINEAGE],
    "sra_sample_attribute": [*BRONZE_ATTRIBUTE, *LINEAGE],
    "sra_sample_classification": [
        "sample_accession", "biosample_accession", "sample_domain", "organism_group",
        "sample_context", "host_present", "environment_present", "clinical_present",
        "metagenome_present", "attribute_category_summary", "classification_basis", *LINEAGE,
    ],
}

# Serving types: name, then the columns in their published order.
GOLD = {
    "sra_domain_summary": {
        "sample_domain": "string", "sample_count": "bigint", "run_count": "bigint",
        "attribute_count": "bigint", "organism_group_count": "bigint",
        "host_present_sample_count": "bigint", "environment_present_sample_count": "bigint",
        "clinical_present_sample_count": "bigint", "metagenome_present_sample_count": "bigint",
    },
    "sra_context_summary": {
        "sample_context": "string", "sample_count": "bigint", "run_count": "bigint",
        "attribute_count": "bigint", "sample_domain_count": "bigint",
    },
    "sra_domain_library_strategy_summary": {
        "sample_domain": "string", "library_strategy": "string", "run_count": "bigint",
        "sample_count": "bigint", "experiment_count": "bigint", "total_spots": "bigint",
        "total_bases": "bigint",
    },
    "sra_top_organisms_by_domain": {
        "sample_domain": "string", "organism_rank": "bigint", "organism": "string",
        "taxon_id": "string", "sample_count": "bigint",
    },
    "sra_attribute_category_by_domain": {
        "sample_domain": "string", "attribute_category": "string", "attribute_count": "bigint",
        "sample_count": "bigint",
    },
    "sra_quality_summary": {
        "sample_count": "bigint", "run_count": "bigint", "attribute_count": "bigint",
        "unknown_sample_count": "bigint", "unknown_sample_pct": "double",
    },
}

TAXONOMY = [
    "taxon_id", "scientific_name", "rank", "parent_taxon_id", "lineage", "lineage_taxon_ids",
    "superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species",
    "organism_group", "sample_domain",
]

QUALITY_CHECK = ["name", "status", "observed", "expected", "message"]

LANDING = T.StructType([
    T.StructField("source_path", T.StringType()),
    T.StructField("utility", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("body", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("batch_number", T.LongType()),
    T.StructField("retstart", T.LongType()),
    T.StructField("retmax", T.LongType()),
    T.StructField("run_rows", T.LongType()),
    T.StructField("sample_attribute_rows", T.LongType()),
    T.StructField("ingest_id", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("raw_xml_path", T.StringType()),
    T.StructField("bronze_path", T.StringType()),
    T.StructField("sample_attributes_path", T.StringType()),
    T.StructField("error", T.StringType()),
])


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
