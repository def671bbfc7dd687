"""Inputs that stand in for landed data, written in SQL that Spark and DuckDB read alike.

Spark fills the braces with DataFrames; the oracle fills them with table names.
"""

from __future__ import annotations

from seqlake.vocab import core_dictionary

ORGANISMS = [
    (0, "Homo sapiens", "9606"), (1, "Mus musculus", "10090"), (2, "Bos taurus", "9913"),
    (3, "Bombyx mori", "7091"), (4, "Drosophila simulans", "7240"), (5, "Zea mays", "4577"),
    (6, "Haematococcus lacustris", "44745"), (7, "Saccharomyces cerevisiae", "4932"),
    (8, "Candida albicans", "5476"), (9, "Plasmodium falciparum", "5833"),
    (10, "Lankesteria ascidiae", "1134081"), (11, "Methanosarcina mazei", "2209"),
    (12, "Measles virus", "11234"), (13, "Escherichia coli", "562"),
    (14, "Klebsiella pneumoniae", "573"), (15, "soil metagenome", "410658"),
    (16, "wastewater metagenome", "527639"), (17, "Podarcis muralis", "64176"),
    (18, "unidentified", "32644"), (19, "synthetic construct", "32630"), (20, "", ""),
    (21, "", "12908"), (22, "Homo sapiens", "63221"), (23, "Rattus norvegicus", "10116"),
    (24, "Jakoba libera", "143017"),
]

# nation key: lineage names below, ranks and ids are positional (see taxon_payload)
LINEAGES = {
    0: ["Eukaryota", "Metazoa", "Chordata", "Mammalia"], 1: ["Eukaryota", "Metazoa", "Chordata"],
    2: ["Eukaryota", "Metazoa"], 3: ["Eukaryota", "Metazoa", "Arthropoda"],
    4: ["Eukaryota", "Metazoa", "Arthropoda", "Insecta"],
    5: ["Eukaryota", "Viridiplantae", "Streptophyta"], 6: ["Eukaryota", "Viridiplantae"],
    7: ["Eukaryota", "Fungi", "Ascomycota"], 8: ["Eukaryota", "Fungi"],
    9: ["Eukaryota", "Alveolata", "Apicomplexa"], 10: ["Eukaryota", "Apicomplexa"],
    11: ["Archaea", "Methanobacteriati"], 12: ["Viruses", "Orthornavirae"],
    13: ["Bacteria", "Pseudomonadati", "Pseudomonadota"], 14: ["Bacteria"],
    15: ["unclassified entries", "metagenomes"], 16: ["unclassified entries", "metagenomes"],
    17: ["Eukaryota", "Metazoa", "Chordata", "Lepidosauria"], 18: ["unclassified entries"],
    19: ["other entries"], 20: [], 21: [], 22: ["Eukaryota", "Metazoa"],
    23: ["Eukaryota", "Metazoa", "Chordata", "Mammalia"], 24: ["Eukaryota", "Discoba"],
}
RANKS = ["superkingdom", "kingdom", "phylum", "class"]

ATTRIBUTE_NAMES = [
    "geo loc name", " Host ", "env/broad scale", "sex", "Assembly Method", "cell-line",
    "Clinical Status", "IFSAC+ Category", "covid_anxious", "bowel movement frequency", "treatment",
    "Unmapped Thing", "", "host-body-site", "Host", "GEO_LOC_NAME", "ww sample type",
    "samp collect device", "geographic location (country and/or sea)", "environment_zone",
    "BioSampleModel", "tissue", "diagnosis", "age cat",
]

# (taxon_id, organism_group, sample_domain); some sample taxa are left out on purpose.
TAXONOMY = [
    ("9606", "Eukaryota", "human"), ("10090", "Eukaryota", "animal"),
    ("9913", "Eukaryota", "animal"), ("7091", "Eukaryota", "animal"),
    ("7240", "Eukaryota", "animal"), ("4577", "Viridiplantae", "plant"),
    ("44745", "Viridiplantae", "plant"), ("4932", "Fungi", "fungi"), ("5476", "Fungi", "fungi"),
    ("5833", "Protists", "protist"), ("11234", "Viruses", "virus"),
    ("562", "Bacteria", "microorganism"), ("573", "Bacteria", ""),
    ("410658", "Metagenome", "metagenome"), ("143017", "Protists", "protist"),
]


def _quote(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows: list[tuple], alias: str) -> str:
    listed = ", ".join("(" + ", ".join(map(_quote, row)) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {listed}) AS {alias})"


ORGANISM_DIM = values(ORGANISMS, "organism_dim(k, organism, taxon_id)")
NAME_DIM = values(list(enumerate(ATTRIBUTE_NAMES)), "name_dim(name_idx, attribute_name)")
TAXONOMY_DIM = values(TAXONOMY, "taxonomy_dim(taxon_id, organism_group, sample_domain)")

RUN_RAW = f"""
SELECT
  CASE WHEN l_suppkey % 5 = 0 THEN 'single-cell-rnaseq'
       WHEN o_custkey % 6 = 0 THEN 'bacteria-wgs'
       WHEN o_custkey % 6 = 1 THEN 'human-rnaseq'
       WHEN o_custkey % 6 = 2 THEN 'long-read-5000'
       WHEN o_custkey % 6 = 3 THEN 'metagenomic-5000'
       WHEN o_custkey % 6 = 4 THEN 'plant-wgs-500'
       ELSE 'amplicon-16s' END AS source_dataset,
  concat('sra-bronze-batch-00000', cast(l_partkey % 4 AS string), '.csv') AS source_file,
  concat('SRX', cast(l_orderkey AS string)) AS experiment_accession,
  CASE WHEN l_quantity = 50 THEN ''
       ELSE concat('SRR', cast(l_orderkey AS string), '-', cast(l_linenumber AS string))
       END AS run_accession,
  concat('SRP', cast(o_custkey % 20 AS string)) AS study_accession,
  concat('PRJNA', cast(o_custkey % 20 AS string)) AS bioproject_accession,
  CASE WHEN o_custkey % 97 = 0 THEN ''
       ELSE concat('SRS', cast(o_custkey AS string)) END AS sample_accession,
  concat('SAMN', cast(o_custkey AS string)) AS biosample_accession,
  organism,
  taxon_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'WGS' WHEN '2-HIGH' THEN 'RNA-Seq'
       WHEN '3-MEDIUM' THEN 'AMPLICON' WHEN '5-LOW' THEN 'ChIP-Seq' ELSE '' END
       AS library_strategy,
  CASE WHEN l_returnflag = 'R' THEN 'GENOMIC' WHEN l_returnflag = 'A' THEN 'TRANSCRIPTOMIC'
       ELSE 'METAGENOMIC' END AS library_source,
  CASE WHEN l_linestatus = 'O' THEN 'RANDOM' ELSE 'cDNA' END AS library_selection,
  CASE WHEN l_linenumber % 2 = 0 THEN 'PAIRED' ELSE 'SINGLE' END AS library_layout,
  CASE WHEN l_suppkey % 3 = 0 THEN 'OXFORD_NANOPORE' ELSE 'ILLUMINA' END AS platform,
  concat('Model ', cast(l_suppkey % 4 AS string)) AS instrument_model,
  CASE WHEN l_linenumber = 7 THEN '' ELSE cast(cast(floor(l_quantity) AS bigint) AS string) END
       AS total_spots,
  cast(cast(floor(l_extendedprice) AS bigint) AS string) AS total_bases,
  l_partkey AS ord1, l_suppkey AS ord2, l_shipdate AS ord3, l_extendedprice AS ord4
FROM {{lineitem}}
JOIN {{orders}} ON l_orderkey = o_orderkey
JOIN {{customer}} ON o_custkey = c_custkey
JOIN {ORGANISM_DIM} AS organism_rows ON c_nationkey = k
"""

ATTRIBUTE_RAW = f"""
SELECT source_dataset, source_file, sample_accession, biosample_accession, attribute_name,
       attribute_value, ord1
FROM (
  SELECT
    CASE WHEN event_id % 3 = 0 THEN 'single-cell-rnaseq' ELSE 'human-rnaseq' END AS source_dataset,
    concat('sra-sample-attributes-batch-00000', cast(event_id % 4 AS string), '.csv') AS source_file,
    CASE WHEN (user_id * 10 + event_id % 10) % 97 = 0 THEN ''
         ELSE concat('SRS', cast(user_id * 10 + event_id % 10 AS string)) END AS sample_accession,
    concat('SAMN', cast(user_id * 10 + event_id % 10 AS string)) AS biosample_accession,
    (user_id * 3 + cast(floor(value) AS bigint) % 4) % 24 AS wanted_name,
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS attribute_value,
    event_id AS ord1
  FROM {{events}}
) AS flat
JOIN {NAME_DIM} AS name_rows ON wanted_name = name_idx
"""

# The columns of lineitem that RUN_RAW reads.
RUN_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_returnflag", "l_linestatus", "l_shipdate"]
RUN_ORDER = ["source_dataset", "source_file", "ord1", "ord2", "ord3", "ord4"]
ATTRIBUTE_ORDER = ["source_dataset", "source_file", "ord1"]

# Landed XML: one package per lineitem, landed in batches of 200 in this order. Text is padded, and
# escapes occur in it.
PACKAGES_PER_BATCH = 200
PACKAGE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_quantity", "l_returnflag", "l_linestatus"]
PACKAGE = """concat(
    '<EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX',
    cast(l_orderkey AS string), '">',
    CASE WHEN l_suppkey % 2 = 0 THEN concat('<STUDY_REF accession="SRP-ref',
      cast(l_suppkey AS string), '"/>') ELSE '' END,
    '<DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY> ', l_returnflag, '-Seq\n</LIBRARY_STRATEGY>',
    '<LIBRARY_SOURCE>GENOMIC &amp; other</LIBRARY_SOURCE>',
    CASE WHEN l_linenumber = 7 THEN '' ELSE CASE WHEN l_linenumber % 2 = 0
      THEN '<LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH="300"/></LIBRARY_LAYOUT>'
      ELSE '<LIBRARY_LAYOUT><SINGLE/></LIBRARY_LAYOUT>' END END,
    '</LIBRARY_DESCRIPTOR></DESIGN>',
    CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE concat(
      '<PLATFORM><ILLUMINA><INSTRUMENT_MODEL>Model ', cast(l_suppkey % 4 AS string),
      '</INSTRUMENT_MODEL></ILLUMINA></PLATFORM>') END,
    '</EXPERIMENT>',
    CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE concat('<STUDY accession="SRP',
      cast(l_suppkey AS string), '"><IDENTIFIERS><EXTERNAL_ID namespace="Other">x</EXTERNAL_ID>',
      '<EXTERNAL_ID namespace="BioProject"> PRJNA', cast(l_suppkey AS string),
      ' </EXTERNAL_ID></IDENTIFIERS></STUDY>') END,
    '<SAMPLE accession="SRS', cast(l_partkey AS string), '"><IDENTIFIERS>',
    '<EXTERNAL_ID namespace="BioSample">SAMN', cast(l_partkey AS string),
    '</EXTERNAL_ID></IDENTIFIERS><SAMPLE_NAME><TAXON_ID>', cast(l_partkey % 100 AS string),
    '</TAXON_ID><SCIENTIFIC_NAME>A &lt;b&gt; c</SCIENTIFIC_NAME></SAMPLE_NAME>',
    '<SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG> Host </TAG><VALUE>', l_linestatus,
    '</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>geo loc name</TAG></SAMPLE_ATTRIBUTE>',
    CASE WHEN l_linenumber = 1 THEN
      '<SAMPLE_ATTRIBUTE><TAG>Dose &amp; time</TAG><VALUE>5 &gt; 4</VALUE></SAMPLE_ATTRIBUTE>'
      ELSE '' END,
    '</SAMPLE_ATTRIBUTES></SAMPLE>',
    CASE WHEN l_quantity = 50 THEN '' ELSE concat(
      '<RUN_SET><RUN accession="SRR', cast(l_orderkey AS string), '-',
      cast(l_linenumber AS string), '" total_spots="', cast(cast(floor(l_quantity) AS bigint) AS string),
      '" total_bases="', cast(cast(floor(l_extendedprice) AS bigint) AS string), '"/>',
      CASE WHEN l_linenumber = 2 THEN concat('<RUN accession="SRR', cast(l_orderkey AS string),
        '-again"/>') ELSE '' END, '</RUN_SET>') END,
    '</EXPERIMENT_PACKAGE>')"""
PACKAGES = f"""
SELECT
  {", ".join(PACKAGE_ORDER)},
  {PACKAGE} AS package
FROM {{lineitem}}
"""

# Landed taxonomy XML, one payload per customer: its nation's organism, or a strain of it.
_LINEAGE_ROWS = [
    (
        k,
        "; ".join(names),
        "".join(
            f"<Taxon><TaxId>{1000 * k + i}</TaxId><ScientificName>{n}</ScientificName>"
            f"<Rank>{RANKS[i]}</Rank></Taxon>" for i, n in enumerate(names)
        ),
        " | ".join(str(1000 * k + i) for i in range(len(names))),
        *[names[i] if i < len(names) else "" for i in range(4)],
    )
    for k, names in LINEAGES.items()
]
LINEAGE_DIM = values(
    _LINEAGE_ROWS,
    "lineage_dim(lk, lineage, lineage_xml, lineage_ids, superkingdom, kingdom, phylum, class_name)",
)
TAXON_SOURCE = f"""
SELECT c_custkey, k AS nation_key, lineage, lineage_xml, lineage_ids,
  superkingdom, kingdom, phylum, class_name,
  CASE WHEN c_custkey % 50 = 0 THEN ''
       WHEN c_custkey % 3 = 0 THEN taxon_id
       ELSE cast(900000 + (c_custkey - c_custkey % 2) AS string) END AS raw_id,
  CASE WHEN c_custkey % 3 = 0 THEN organism
       ELSE trim(concat(organism, ' strain ', cast(c_custkey AS string))) END AS scientific_name,
  CASE WHEN c_custkey % 3 = 0 THEN 'species' ELSE 'strain' END AS taxon_rank
FROM {{customer}}
JOIN {ORGANISM_DIM} AS organism_rows ON c_nationkey = k
JOIN {LINEAGE_DIM} AS lineage_rows ON lk = k
"""
TAXON_PAYLOADS = f"""
SELECT c_custkey AS landed_order, concat(
  '<TaxaSet><Taxon>',
  CASE WHEN raw_id = '' THEN '' ELSE concat('<TaxId> ', raw_id, ' </TaxId>') END,
  '<ScientificName>', scientific_name, '</ScientificName><Rank>', taxon_rank, '</Rank>',
  '<ParentTaxId>', cast(nation_key AS string), '</ParentTaxId><Lineage>', lineage, '</Lineage>',
  CASE WHEN lineage_xml = '' THEN '' ELSE concat('<LineageEx>', lineage_xml, '</LineageEx>') END,
  '</Taxon></TaxaSet>') AS body
FROM ({TAXON_SOURCE}) AS taxon_source
"""

SEARCH_PAYLOADS = """
SELECT o_orderkey, concat(
  '{{"header": {{"type": "esearch"}}, "esearchresult": {{',
  CASE WHEN o_custkey % 10 = 0 THEN '' ELSE concat(
    '"count": "', cast(o_custkey AS string), '", "querykey": "', cast(o_orderkey % 7 AS string),
    '", "webenv": "MCID_', cast(o_orderkey AS string), '", ') END,
  '"idlist": [',
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(
    '"', cast(o_orderkey AS string), '", "', cast(o_custkey AS string), '"') END,
  ']}}}}') AS body
FROM {orders}
"""

# One search response per supplier.
JOB_SEARCHES = """
SELECT concat('job-', cast(l_suppkey AS string)) AS job_id, concat(
  '{{"esearchresult": {{"count": "', cast(count(*) AS string), '", "querykey": "1", "webenv": "W',
  cast(l_suppkey AS string), '"}}}}') AS body
FROM {lineitem}
GROUP BY l_suppkey
"""


#: Every category that the built-in dictionary knows.
CATEGORIES = sorted({category for _, category in core_dictionary()})
