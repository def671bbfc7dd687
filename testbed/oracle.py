"""The same results in plain SQL for DuckDB, written apart from the Spark code.

Every statement starts from the shared input definitions and spells the operators out with
windows and string functions. Only word lists are shared.
"""

from __future__ import annotations

from seqlake import schemas, vocab
from testbed import inputs

TABLES = ("lineitem", "orders", "customer", "events", "pages", "part", "documents")
SIZE = 200


def _fill(text: str) -> str:
    return text.format(**{name: name for name in TABLES})


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _any(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def _listed(columns: list[str], alias: str = "") -> str:
    return ", ".join(f"{alias}{c}" for c in columns)


def _norm(column: str, mark: str = "_") -> str:
    return f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', '{mark}', 'g'), '{mark}')"


# Categories of the names that occur in the inputs.
CATEGORIES = {
    "geo_loc_name": "spatiotemporal", "host": "host", "env_broad_scale": "environment",
    "sex": "clinical", "assembly_method": "metagenome_assembly", "cell_line": "host_material",
    "treatment": "experimental_design", "host_body_site": "host",
    "geographic_location_country_and_or_sea": "spatiotemporal", "biosamplemodel": "schema_hint",
    "tissue": "host_material", "diagnosis": "clinical",
}
RULED = {
    "clinical_status": "clinical", "ifsac_category": "other", "covid_anxious": "human_survey",
    "bowel_movement_frequency": "human_survey", "ww_sample_type": "wastewater_surveillance",
    "samp_collect_device": "sample_processing", "environment_zone": "environment",
    "age_cat": "human_survey",
}


def _category(column: str) -> str:
    cases = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in {**CATEGORIES, **RULED}.items())
    return f"CASE {column} {cases} ELSE 'other' END"


def _group_case(name: str = "lower(organism)", taxon: str = "taxon_id",
                dataset: str = "lower(source_dataset)") -> str:
    return f"""CASE
      WHEN {taxon} = '9606' OR {name} = 'homo sapiens' THEN 'Eukaryota'
      WHEN {taxon} = '10090' OR {taxon} IN {_in(vocab.ANIMAL_TAXA)} OR {name} = 'mus musculus'
        THEN 'Eukaryota'
      WHEN {taxon} IN {_in(vocab.INSECT_TAXA)} OR contains({name}, 'drosophila') THEN 'Eukaryota'
      WHEN {taxon} IN {_in(vocab.PLANT_TAXA)} OR contains({dataset}, 'viridiplantae')
        OR contains({dataset}, 'plant-wgs') THEN 'Viridiplantae'
      WHEN {taxon} IN {_in(vocab.FUNGAL_TAXA)} OR contains({dataset}, 'fungi')
        OR {_any(name, vocab.FUNGAL_TERMS)} THEN 'Fungi'
      WHEN {taxon} IN {_in(vocab.ALGAL_TAXA)} THEN 'Viridiplantae'
      WHEN {taxon} IN {_in(vocab.PROTIST_TAXA)} OR {_any(name, vocab.PROTIST_TERMS)}
        THEN 'Protists'
      WHEN contains({dataset}, 'archaea') OR {_any(name, vocab.ARCHAEAL_TERMS)} THEN 'Archaea'
      WHEN contains({name}, 'virus') OR contains({dataset}, 'viruses-organism') THEN 'Viruses'
      WHEN contains({dataset}, 'bacteria') OR {_any(name, vocab.BACTERIAL_TERMS)} THEN 'Bacteria'
      WHEN contains({name}, 'metagenome') OR contains({dataset}, 'metagenomic') THEN 'Metagenome'
      WHEN contains({dataset}, 'long-read') AND {name} <> ''
        AND {name} NOT IN {_in(vocab.UNNAMED_SAMPLES)} THEN 'Eukaryota'
      ELSE 'unknown' END"""


def _domain_case(group: str, metagenome: str) -> str:
    return f"""CASE
      WHEN taxon_id = '9606' OR lower(organism) = 'homo sapiens' THEN 'human'
      WHEN contains(lower(source_dataset), 'viridiplantae') OR {group} = 'Viridiplantae'
        THEN 'plant'
      WHEN {group} = 'Fungi' THEN 'fungi'
      WHEN {group} = 'Viruses' THEN 'virus'
      WHEN {group} IN ('Bacteria', 'Archaea') THEN 'microorganism'
      WHEN {group} = 'Protists' THEN 'protist'
      WHEN contains(lower(organism), 'metagenome') OR contains(lower(source_dataset), 'metagenomic')
        OR {metagenome} THEN 'metagenome'
      WHEN {group} = 'Eukaryota' THEN 'animal'
      ELSE 'unknown' END"""


def _context_case(domain: str) -> str:
    return f"""CASE
      WHEN {domain} = 'human' AND clinical THEN 'clinical'
      WHEN host THEN 'host-associated'
      WHEN environment OR contains(lower(organism), 'wastewater')
        OR contains(lower(organism), 'soil') THEN 'environmental'
      WHEN {domain} = 'metagenome' THEN 'metagenomic'
      WHEN host_material THEN 'tissue'
      WHEN experimental OR contains(lower(source_dataset), 'single-cell') THEN 'experimental'
      ELSE 'unknown' END"""


def _combined(name: str, raw: str, keys: list[str], columns: list[str], order: list[str]) -> str:
    """First row per key, and the sources of the key by first appearance."""
    key, on = _listed(keys), " AND ".join(f"r.{k} = l.{k}" for k in keys)

    def lineage(column: str) -> str:
        return f"""SELECT {key}, string_agg({column}, ' | ' ORDER BY first_pos) AS listed
        FROM (SELECT {key}, {column}, min(pos) AS first_pos FROM {name}_ranked
              GROUP BY {key}, {column}) AS firsts GROUP BY {key}"""

    return f"""
    {name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {_listed(order)})
      AS pos FROM {raw}),
    {name}_datasets AS ({lineage("source_dataset")}),
    {name}_files AS ({lineage("source_file")}),
    {name}_with_datasets AS (SELECT r.*, l.listed AS datasets FROM {name}_ranked AS r
      JOIN {name}_datasets AS l ON {on} WHERE r.pos = 1),
    {name} AS (SELECT r.datasets AS source_dataset, l.listed AS source_file, {_listed(columns, "r.")},
        {", ".join(f"r.{c} AS o{i}" for i, c in enumerate(order))}
      FROM {name}_with_datasets AS r JOIN {name}_files AS l ON {on})"""


_RUN_O = _listed([f"o{i}" for i in range(len(inputs.RUN_ORDER))])
_ATTRIBUTE_O = _listed([f"o{i}" for i in range(len(inputs.ATTRIBUTE_ORDER))])


def _nulls(table: str) -> str:
    return ", ".join(f"nullif({c}, '') AS {c}" for c in schemas.SILVER[table])


def _flag(column: str, category: str) -> str:
    return f"bool_or(attribute_category = '{category}') AS {column}"


LAKE = f"""WITH
    organism_dim AS {inputs.ORGANISM_DIM},
    taxonomy_ref AS {inputs.TAXONOMY_DIM},
    raw_runs AS ({_fill(inputs.RUN_RAW)}),
    raw_attributes AS (
      SELECT *, {_norm("attribute_name")} AS normalized_attribute_name FROM (
        {_fill(inputs.ATTRIBUTE_RAW)}) AS plain),
    {_combined("bronze_runs", "raw_runs", schemas.RUN_KEY, schemas.BRONZE_RUN, inputs.RUN_ORDER)},
    {_combined("bronze_names", "raw_attributes", schemas.ATTRIBUTE_KEY,
               schemas.BRONZE_ATTRIBUTE[:5], inputs.ATTRIBUTE_ORDER)},
    bronze_attributes AS (SELECT *, {_category("normalized_attribute_name")} AS attribute_category
      FROM bronze_names),
    run_text AS (SELECT {_listed(schemas.SILVER["sra_run"])} FROM (
      SELECT *, row_number() OVER (PARTITION BY run_accession ORDER BY {_RUN_O}) AS first_run
      FROM bronze_runs WHERE run_accession <> '') AS x WHERE first_run = 1),
    sample_text AS (SELECT {_listed(schemas.SILVER["sra_sample"])} FROM (
      SELECT *, row_number() OVER (PARTITION BY CASE WHEN sample_accession <> ''
        THEN sample_accession ELSE biosample_accession END ORDER BY {_RUN_O}) AS first_sample
      FROM bronze_runs WHERE sample_accession <> '' OR biosample_accession <> '') AS x
      WHERE first_sample = 1),
    attribute_text AS (SELECT {_listed(schemas.SILVER["sra_sample_attribute"])} FROM (
      SELECT *, row_number() OVER (PARTITION BY {_listed(schemas.ATTRIBUTE_KEY)}
        ORDER BY {_ATTRIBUTE_O}) AS first_attribute
      FROM bronze_attributes WHERE sample_accession <> '' OR biosample_accession <> ''
        OR normalized_attribute_name <> '' OR attribute_value <> '') AS x
      WHERE first_attribute = 1),
    category_counts AS (SELECT sample_accession, attribute_category, count(*) AS n
      FROM attribute_text WHERE sample_accession <> ''
      GROUP BY sample_accession, attribute_category),
    signals AS (SELECT sample_accession,
        string_agg(concat(attribute_category, ':', n), ' | ' ORDER BY n DESC, attribute_category)
          AS attribute_category_summary,
        count(*) AS category_count,
        {_flag("host", "host")}, {_flag("environment", "environment")},
        {_flag("clinical", "clinical")}, {_flag("metagenome", "metagenome_assembly")},
        {_flag("host_material", "host_material")}, {_flag("experimental", "experimental_design")}
      FROM category_counts GROUP BY sample_accession),
    sample_signals AS (SELECT s.*, coalesce(host, false) AS host,
        coalesce(environment, false) AS environment, coalesce(clinical, false) AS clinical,
        coalesce(metagenome, false) AS metagenome,
        coalesce(host_material, false) AS host_material,
        coalesce(experimental, false) AS experimental,
        coalesce(attribute_category_summary, '') AS attribute_category_summary
      FROM sample_text AS s LEFT JOIN signals AS g ON s.sample_accession = g.sample_accession),
    grouped AS (SELECT s.*, t.sample_domain AS known_domain, t.taxon_id IS NOT NULL AS known,
        CASE WHEN t.taxon_id IS NOT NULL THEN t.organism_group ELSE
          {_group_case(taxon="s.taxon_id")} END AS organism_group,
        {_group_case(taxon="s.taxon_id")} AS ruled_group
      FROM sample_signals AS s LEFT JOIN taxonomy_ref AS t ON s.taxon_id = t.taxon_id
        AND t.organism_group <> '' AND t.sample_domain <> ''),
    domained AS (SELECT *, CASE WHEN known THEN known_domain
        ELSE {_domain_case("organism_group", "metagenome")} END AS sample_domain,
        {_domain_case("ruled_group", "metagenome")} AS ruled_domain FROM grouped),
    contexts AS (SELECT *, {_context_case("sample_domain")} AS sample_context,
        {_context_case("ruled_domain")} AS ruled_context FROM domained),
    classification_text AS (SELECT sample_accession, biosample_accession, sample_domain,
        organism_group, sample_context,
        CASE WHEN host THEN 'True' ELSE 'False' END AS host_present,
        CASE WHEN environment THEN 'True' ELSE 'False' END AS environment_present,
        CASE WHEN clinical THEN 'True' ELSE 'False' END AS clinical_present,
        CASE WHEN metagenome THEN 'True' ELSE 'False' END AS metagenome_present,
        attribute_category_summary,
        concat('organism=', CASE WHEN organism = '' THEN 'missing' ELSE organism END,
          '; taxon_id=', CASE WHEN taxon_id = '' THEN 'missing' ELSE taxon_id END,
          '; source_dataset=', source_dataset, '; organism_group=', organism_group,
          '; sample_domain=', sample_domain, '; sample_context=', sample_context,
          CASE WHEN host THEN '; host_attribute_present' ELSE '' END,
          CASE WHEN environment THEN '; environment_attribute_present' ELSE '' END,
          CASE WHEN clinical THEN '; clinical_attribute_present' ELSE '' END,
          CASE WHEN metagenome THEN '; metagenome_assembly_attribute_present' ELSE '' END,
          CASE WHEN known THEN '; taxonomy_reference_present' ELSE '' END) AS classification_basis,
        source_dataset, source_file
      FROM contexts),
    sra_run AS (SELECT {_nulls("sra_run")} FROM run_text),
    sra_sample AS (SELECT {_nulls("sra_sample")} FROM sample_text),
    sra_sample_attribute AS (SELECT {_nulls("sra_sample_attribute")} FROM attribute_text),
    sra_sample_classification AS (SELECT {_nulls("sra_sample_classification")}
      FROM classification_text),
    per_sample AS (SELECT c.*,
        (SELECT count(*) FROM sra_run AS r WHERE r.sample_accession = c.sample_accession) AS runs,
        (SELECT count(*) FROM sra_sample_attribute AS a
          WHERE a.sample_accession = c.sample_accession) AS attributes
      FROM sra_sample_classification AS c),
    sra_domain_summary AS (SELECT sample_domain, count(*) AS sample_count,
        cast(sum(runs) AS bigint) AS run_count, cast(sum(attributes) AS bigint) AS attribute_count,
        count(DISTINCT organism_group) AS organism_group_count,
        count(*) FILTER (WHERE host_present = 'True') AS host_present_sample_count,
        count(*) FILTER (WHERE environment_present = 'True') AS environment_present_sample_count,
        count(*) FILTER (WHERE clinical_present = 'True') AS clinical_present_sample_count,
        count(*) FILTER (WHERE metagenome_present = 'True') AS metagenome_present_sample_count
      FROM per_sample GROUP BY sample_domain),
    sra_context_summary AS (SELECT sample_context, count(*) AS sample_count,
        cast(sum(runs) AS bigint) AS run_count, cast(sum(attributes) AS bigint) AS attribute_count,
        count(DISTINCT sample_domain) AS sample_domain_count
      FROM per_sample GROUP BY sample_context),
    classified_runs AS (SELECT r.*, c.sample_domain FROM sra_run AS r
      JOIN sra_sample_classification AS c USING (sample_accession)),
    sra_domain_library_strategy_summary AS (SELECT sample_domain, library_strategy,
        count(*) AS run_count, count(DISTINCT sample_accession) AS sample_count,
        count(DISTINCT experiment_accession) AS experiment_count,
        cast(sum(cast(total_spots AS bigint)) AS bigint) AS total_spots,
        cast(sum(cast(total_bases AS bigint)) AS bigint) AS total_bases
      FROM classified_runs GROUP BY sample_domain, library_strategy),
    organism_counts AS (SELECT sample_domain, coalesce(organism, 'missing') AS organism,
        coalesce(taxon_id, 'missing') AS taxon_id, n AS sample_count FROM (
          SELECT c.sample_domain, s.organism, s.taxon_id, count(*) AS n
          FROM sra_sample AS s JOIN sra_sample_classification AS c USING (sample_accession)
          GROUP BY c.sample_domain, s.organism, s.taxon_id) AS x),
    sra_top_organisms_by_domain AS (SELECT sample_domain, organism_rank, organism, taxon_id,
        sample_count FROM (SELECT *, cast(row_number() OVER (PARTITION BY sample_domain
          ORDER BY sample_count DESC, organism, taxon_id) AS bigint) AS organism_rank
        FROM organism_counts) AS ranked WHERE organism_rank <= 10),
    sra_attribute_category_by_domain AS (SELECT c.sample_domain, a.attribute_category,
        count(*) AS attribute_count, count(DISTINCT a.sample_accession) AS sample_count
      FROM sra_sample_attribute AS a JOIN sra_sample_classification AS c USING (sample_accession)
      GROUP BY c.sample_domain, a.attribute_category),
    unknown_samples AS (SELECT count(*) AS n FROM sra_sample_classification
      WHERE sample_domain = 'unknown'),
    sra_quality_summary AS (SELECT (SELECT count(*) FROM sra_sample_classification) AS sample_count,
        (SELECT count(*) FROM sra_run) AS run_count,
        (SELECT count(*) FROM sra_sample_attribute) AS attribute_count,
        (SELECT n FROM unknown_samples) AS unknown_sample_count,
        round((SELECT n FROM unknown_samples) * 100.0::double
          / (SELECT count(*) FROM sra_sample_classification), 4) AS unknown_sample_pct)
"""

TEXTS = f"""
    SELECT 'pages.url' AS origin, page_id AS id, url AS value FROM pages
    UNION ALL SELECT 'part.p_name', p_partkey, p_name FROM part
    UNION ALL SELECT 'documents.text', doc_id, text FROM documents
    UNION ALL SELECT 'attribute', ord1, attribute_name FROM ({_fill(inputs.ATTRIBUTE_RAW)}) AS a"""

# What the landed XML says, read off the table it was made from.
XML_RUNS = """
    SELECT concat('SRX', l_orderkey) AS experiment_accession, run_accession,
      CASE WHEN l_suppkey % 2 = 0 THEN concat('SRP-ref', l_suppkey) ELSE concat('SRP', l_suppkey)
        END AS study_accession,
      CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE concat('PRJNA', l_suppkey) END
        AS bioproject_accession,
      concat('SRS', l_partkey) AS sample_accession, concat('SAMN', l_partkey) AS biosample_accession,
      'A <b> c' AS organism, cast(l_partkey % 100 AS varchar) AS taxon_id,
      concat(l_returnflag, '-Seq') AS library_strategy, 'GENOMIC & other' AS library_source,
      '' AS library_selection,
      CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber % 2 = 0 THEN 'PAIRED' ELSE 'SINGLE' END
        AS library_layout,
      CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'ILLUMINA' END AS platform,
      CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE concat('Model ', l_suppkey % 4) END
        AS instrument_model,
      total_spots, total_bases
      {extra}
    FROM (
      SELECT *, CASE WHEN l_quantity = 50 THEN '' ELSE concat('SRR', l_orderkey, '-', l_linenumber)
          END AS run_accession,
        CASE WHEN l_quantity = 50 THEN '' ELSE cast(cast(floor(l_quantity) AS bigint) AS varchar)
          END AS total_spots,
        CASE WHEN l_quantity = 50 THEN ''
          ELSE cast(cast(floor(l_extendedprice) AS bigint) AS varchar) END AS total_bases
      FROM lineitem
      UNION ALL
      SELECT *, concat('SRR', l_orderkey, '-again'), '', '' FROM lineitem
      WHERE l_linenumber = 2 AND l_quantity <> 50) AS runs"""
XML_ATTRIBUTES = """
    SELECT concat('SRS', l_partkey) AS sample_accession, concat('SAMN', l_partkey)
      AS biosample_accession, attribute_name, attribute_value, normalized_attribute_name,
      attribute_category {extra}
    FROM (
      SELECT *, 'Host' AS attribute_name, l_linestatus AS attribute_value,
        'host' AS normalized_attribute_name, 'host' AS attribute_category FROM lineitem
      UNION ALL
      SELECT *, 'geo loc name', '', 'geo_loc_name', 'spatiotemporal' FROM lineitem
      UNION ALL
      SELECT *, 'Dose & time', '5 > 4', 'dose_time', 'other' FROM lineitem
      WHERE l_linenumber = 1) AS attributes"""
JOB = f", concat('job-', pos // {SIZE} % 4) AS job_id, pos // {SIZE} * {SIZE} AS retstart"
NUMBERED = f"""WITH numbered AS (SELECT *,
    row_number() OVER (ORDER BY {', '.join(inputs.PACKAGE_ORDER)}) - 1 AS pos FROM lineitem)"""

_CLADES = "string_split(lower(lineage), '; ')"


def _within(*clades: str) -> str:
    return "(" + " OR ".join(f"list_contains({_CLADES}, '{c}')" for c in clades) + ")"


TAXA = f"""
    taxon_source AS ({_fill(inputs.TAXON_SOURCE)}),
    taxon_groups AS (SELECT *, lower(scientific_name) AS low, CASE
        WHEN raw_id = '9606' OR lower(scientific_name) = 'homo sapiens' THEN 'Eukaryota'
        WHEN {_any("lower(scientific_name)", vocab.UNNAMED_SAMPLES)} THEN 'unknown'
        WHEN {_within("metagenomes")} OR contains(lower(scientific_name), 'metagenome')
          THEN 'Metagenome'
        WHEN {_within("viruses")} THEN 'Viruses'
        WHEN {_within("bacteria")} THEN 'Bacteria'
        WHEN {_within("archaea")} THEN 'Archaea'
        WHEN {_within("viridiplantae")} THEN 'Viridiplantae'
        WHEN {_within("fungi")} THEN 'Fungi'
        WHEN {_within(*vocab.PROTIST_CLADES)} THEN 'Protists'
        WHEN {_within("metazoa")} THEN 'Eukaryota'
        WHEN {_within("eukaryota")} THEN 'Protists'
        ELSE 'unknown' END AS organism_group FROM taxon_source),
    taxon_domains AS (SELECT *, CASE
        WHEN raw_id = '9606' OR low = 'homo sapiens' THEN 'human'
        WHEN organism_group = 'Viridiplantae' THEN 'plant'
        WHEN organism_group = 'Fungi' THEN 'fungi'
        WHEN organism_group = 'Protists' THEN 'protist'
        WHEN organism_group IN ('Bacteria', 'Archaea') THEN 'microorganism'
        WHEN organism_group = 'Viruses' THEN 'virus'
        WHEN organism_group = 'Metagenome' THEN 'metagenome'
        WHEN organism_group = 'Eukaryota' THEN 'animal'
        ELSE 'unknown' END AS sample_domain FROM taxon_groups),
    taxon_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_id
        ORDER BY c_custkey DESC) AS age FROM taxon_domains WHERE raw_id <> '') AS x WHERE age = 1),
    taxon_parsed AS (SELECT raw_id AS taxon_id, scientific_name, taxon_rank AS rank,
        cast(nation_key AS varchar) AS parent_taxon_id, lineage, lineage_ids AS lineage_taxon_ids,
        superkingdom, kingdom, phylum, class_name AS class, '' AS "order", '' AS family,
        '' AS genus, CASE WHEN taxon_rank = 'species' THEN scientific_name ELSE '' END AS species,
        organism_group, sample_domain FROM taxon_last)"""
_BLANK_TAXON = ", ".join(
    f"'' AS \"{c}\"" for c in schemas.TAXONOMY
    if c not in ("taxon_id", "scientific_name", "rank", "lineage"))


def _from(layer: str, columns: list[str]) -> str:
    return f"{LAKE} SELECT {_listed(columns)} FROM {layer}"


def _check(name: str, kind: str, passed: str, observed: str, expected: str, source: str,
           failure: str = "''") -> str:
    from seqlake.plans.quality import MESSAGES

    good, bad = MESSAGES[kind]
    return f"""SELECT '{name}' AS name, CASE WHEN {passed} THEN 'pass' ELSE 'fail' END AS status,
      cast({observed} AS varchar) AS observed, cast({expected} AS varchar) AS expected,
      CASE WHEN {passed} THEN '{good}' ELSE concat('{bad}', {failure}) END AS message
      FROM ({source}) AS checked"""


def _unique(name: str, table: str, field: str) -> str:
    value = f"coalesce({field}, '')"
    return _check(
        name, "unique", "missing = 0 AND repeated = 0",
        "concat('rows=', total, '; missing=', missing, '; duplicates=', repeated)",
        f"'{field} is non-empty and unique'",
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE {value} = '') AS missing,
        count(*) FILTER (WHERE {value} <> '') - count(DISTINCT nullif({field}, '')) AS repeated
        FROM {table}""")


def _match(name: str, observed: str, expected: str) -> str:
    return _check(name, "row_count", "a = b", "a", "b",
                  f"SELECT (SELECT count(*) FROM {observed}) AS a, (SELECT count(*) FROM {expected}) AS b")


def _required(name: str) -> str:
    fields = ["sample_accession", "normalized_attribute_name", "attribute_category"]
    total = " + ".join(f"count(*) FILTER (WHERE coalesce({f}, '') = '')" for f in fields)
    return _check(name, "required", "n = 0", "n", "'0 missing required values'",
                  f"SELECT {total} AS n FROM sra_sample_attribute")


def _allowed(name: str, table: str, field: str, allowed: list[str]) -> str:
    return _check(
        name, "allowed", "n = 0", "CASE WHEN n = 0 THEN 'none' ELSE listed END",
        "'" + " | ".join(sorted(allowed)) + "'",
        f"""SELECT count(*) AS n, string_agg(v, ' | ' ORDER BY v) AS listed FROM (
          SELECT DISTINCT coalesce({field}, '') AS v FROM {table}
          WHERE coalesce({field}, '') NOT IN {_in(allowed)}) AS offending""")


def _threshold(name: str, most: int, fraction: str, shown: str) -> str:
    return _check(
        name, "threshold", f"n <= {most} OR n::double / total <= {fraction}",
        "concat(n, ' (', printf('%.3f', n * 100::double / total), '%)')",
        f"'<= {most} or <= {shown}'",
        """SELECT count(*) AS total, count(*) FILTER (WHERE sample_domain = 'unknown') AS n
        FROM sra_sample_classification""")


def _coverage(name: str) -> str:
    return _check(
        name, "taxonomy", "n = 0", "concat('missing=', n)",
        "'all sample taxon_id values are present'",
        """SELECT count(*) AS n, string_agg(taxon_id, ' | ' ORDER BY taxon_id)
            FILTER (WHERE pos <= 20) AS listed FROM (
          SELECT taxon_id, row_number() OVER (ORDER BY taxon_id) AS pos FROM (
            SELECT DISTINCT taxon_id FROM sra_sample WHERE taxon_id IS NOT NULL
              AND taxon_id NOT IN (SELECT taxon_id FROM taxonomy_ref)) AS absent) AS numbered""",
        "listed")


def _report() -> list[str]:
    return [
        _unique("sra_run_run_accession_unique", "sra_run", "run_accession"),
        _unique("sra_sample_sample_accession_unique", "sra_sample", "sample_accession"),
        _unique("sra_classification_sample_accession_unique", "sra_sample_classification",
                "sample_accession"),
        _match("sra_sample_classification_matches_samples", "sra_sample_classification",
               "sra_sample"),
        _required("sra_sample_attribute_required_fields_present"),
        _allowed("sra_sample_domain_allowed_values", "sra_sample_classification", "sample_domain",
                 vocab.SAMPLE_DOMAINS),
        _threshold("sra_unknown_sample_count_below_threshold", 10, "0.001", "0.10%"),
        _unique("taxonomy_reference_taxon_id_unique", "taxonomy_ref", "taxon_id"),
        _allowed("taxonomy_reference_sample_domain_allowed_values", "taxonomy_ref",
                 "sample_domain", vocab.SAMPLE_DOMAINS),
        _coverage("taxonomy_reference_covers_sample_taxon_ids"),
    ]


def _checks(parts: list[str]) -> str:
    return LAKE + " UNION ALL ".join(parts)


def _counts(tables: dict[str, str]) -> str:
    return LAKE + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
        for name, table in tables.items())


def _group(table: str, fields: list[str], count: str, missing: bool) -> str:
    shown = [f"coalesce(nullif({f}, ''), 'missing')" if missing else f for f in fields]
    picked = ", ".join(f"{s} AS {f}" for s, f in zip(shown, fields))
    return f"{LAKE} SELECT {picked}, count(*) AS \"{count}\" FROM {table} GROUP BY {', '.join(shown)}"


def _top(table: str, label: str, measure: str, k: int) -> str:
    return f"""{LAKE} SELECT {label}, cast(sum({measure}) AS bigint) AS {measure} FROM {table}
      GROUP BY {label} ORDER BY sum({measure}) DESC, {label} NULLS LAST LIMIT {k}"""


def statements() -> dict[str, str]:
    gold = {name: list(columns) for name, columns in schemas.GOLD.items()}
    domains, contexts, strategies, organisms, categories, quality = gold
    out: dict[str, str] = {}

    # landed payloads
    out["xml_run_records"] = XML_RUNS.format(extra="")
    out["xml_bulk_run_records"] = out["xml_run_records"]
    out["xml_sample_attributes"] = XML_ATTRIBUTES.format(extra="")
    out["ingest_landed_batches"] = NUMBERED + XML_RUNS.format(extra=JOB).replace("FROM lineitem", "FROM numbered")
    out["ingest_incremental"] = NUMBERED + XML_ATTRIBUTES.format(extra=JOB).replace("FROM lineitem", "FROM numbered")
    out["xml_taxonomy_reference"] = f"WITH {TAXA} SELECT * FROM taxon_parsed"
    out["json_search_ids"] = """
        SELECT o_orderkey, cast(o_orderkey AS varchar) AS uid FROM orders WHERE o_orderkey % 5 <> 0
        UNION ALL SELECT o_orderkey, cast(o_custkey AS varchar) FROM orders
        WHERE o_orderkey % 5 <> 0"""
    out["json_search_history"] = """
        SELECT o_orderkey,
          CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_custkey END AS "count",
          CASE WHEN o_custkey % 10 = 0 THEN '' ELSE cast(o_orderkey % 7 AS varchar) END AS query_key,
          CASE WHEN o_custkey % 10 = 0 THEN '' ELSE concat('MCID_', o_orderkey) END AS webenv,
          CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(o_orderkey, ' | ', o_custkey) END AS ids
        FROM orders"""
    out["scan_csv_strings"] = f"""{LAKE} SELECT concat('source_dataset=', source_dataset)
        AS source_dataset, {_listed(schemas.BRONZE_RUN)} FROM raw_runs"""
    short = {"library_strategy", "sample_accession", "run_accession", "experiment_accession"}
    kept = ", ".join(
        c if c in short else f"CASE WHEN length(experiment_accession) % 2 = 0 THEN {c} ELSE '' END AS {c}"
        for c in schemas.BRONZE_RUN)
    out["scan_csv_by_name"] = f"""{LAKE} SELECT concat('source_dataset=', source_dataset)
        AS source_dataset, {kept} FROM raw_runs"""
    quoted = {"organism": "concat(organism, ',', chr(10), '\"', platform, '\"', chr(10))",
              "library_source": "concat(library_source, '\"')"}
    out["scan_csv_split"] = f"""{LAKE} SELECT {", ".join(
        f"{quoted.get(c, c)} AS {c}" for c in schemas.BRONZE_RUN)} FROM raw_runs"""
    out["latest_snapshot"] = """
        SELECT strftime(ts, '%Y%m%d') AS snapshot, event_id, event_type FROM events
        WHERE cast(ts AS date) = (SELECT max(cast(ts AS date)) FROM events)"""
    out["manifest_completed_offsets"] = f"""
        SELECT DISTINCT event_id * {SIZE} AS retstart FROM events WHERE event_type <> 'error'"""
    out["pending_batches"] = f"""
        SELECT event_at * {SIZE} AS retstart, {SIZE} AS retmax, event_at + 1 AS batch_number
        FROM (SELECT unnest(range((SELECT count(*) FROM events))) AS event_at) AS windows
        WHERE event_at NOT IN (SELECT event_id FROM events WHERE event_type <> 'error')"""

    # scalar functions
    out["normalize_attribute_name"] = f"""
        SELECT origin, id, {_norm("value")} AS normalized FROM ({TEXTS}) AS texts"""
    out["slugify"] = f"""
        SELECT origin, id, coalesce(nullif({_norm("value", "-")}, ''), 'query') AS slug
        FROM ({TEXTS}) AS texts"""
    category = _category("normalized_attribute_name")
    out["categorize_attribute"] = f"""{LAKE} SELECT ord1 AS event_id, attribute_name,
        normalized_attribute_name, {category} AS attribute_category FROM raw_attributes"""
    out["known_attribute_names"] = f"""{LAKE} SELECT normalized_attribute_name AS name,
        {category} AS category, count(*) AS uses FROM raw_attributes
        WHERE normalized_attribute_name IN {_in(list(CATEGORIES))}
        GROUP BY normalized_attribute_name"""
    brand = "cast(regexp_extract(p_brand, '([0-9]+)$', 1) AS int)"
    name = _norm("concat(p_name, ' ', p_brand)")
    known = f"[{', '.join(repr(c) for c in inputs.CATEGORIES)}]"
    out["categorize_with_dictionary"] = f"""SELECT p_partkey,
        concat(array_to_string(list_transform(string_split(p_name, ' '),
            lambda w: concat(upper(w[1]), lower(w[2:]))), ' '), ' / ', p_brand) AS attribute_name,
        {name} AS normalized_attribute_name,
        CASE WHEN {brand} % 5 <> 0
          THEN {known}[({brand} * 3 + length(p_name)) % {len(inputs.CATEGORIES)} + 1]
          ELSE 'other' END AS attribute_category FROM part"""
    out["dictionary_attribute_names"] = f"SELECT DISTINCT {name} AS name FROM part WHERE {brand} % 5 <> 0"
    out["renormalize_attributes"] = f"""{LAKE} SELECT ord1 AS event_id, sample_accession,
        biosample_accession, attribute_name, attribute_value, normalized_attribute_name,
        {category} AS attribute_category FROM raw_attributes"""
    out["source_dataset_name"] = f"""{LAKE} SELECT experiment_accession, run_accession,
        CASE ord2 % 3
          WHEN 0 THEN concat('file:///lake/batches/', source_dataset, '/job-1/', source_file)
          WHEN 1 THEN concat('/lake/batches/', source_file)
          ELSE concat('/other/', source_dataset, '/', source_file) END AS path,
        CASE ord2 % 3 WHEN 1 THEN 'root' ELSE source_dataset END AS source_dataset, source_file
        FROM raw_runs"""
    out["redact_url"] = """
        SELECT page_id, concat(base,
          CASE WHEN contains(base, '?') THEN '&' ELSE '?' END,
          'api_key=%5BREDACTED%5D&term=a+b%2Fc&empty=', substr(url, length(base) + 1))
          AS redacted_url
        FROM (SELECT *, split_part(url, '#', 1) AS base FROM pages) AS parts"""
    out["redact_params"] = """
        SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN '[REDACTED]' END AS api_key,
          CASE WHEN page_id % 2 = 1 THEN concat('k', page_id) END AS my_api_key FROM pages"""
    out["plan_fetches"] = f"""
        WITH done AS (SELECT concat('job-', event_id % 100) AS job_id,
            event_id // 100 % 8 * {SIZE} AS retstart FROM events WHERE event_type <> 'error'
              AND (event_id % 100 + event_id // 100 % 8) % 3 <> 0),
          totals AS (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY l_suppkey),
          windows AS (SELECT l_suppkey, total, unnest(range((total + {SIZE - 1}) // {SIZE})) AS pos
            FROM totals)
        SELECT concat('job-', l_suppkey) AS job_id, '1' AS query_key,
          concat('W', l_suppkey) AS webenv, pos * {SIZE} AS retstart,
          least({SIZE}, total - pos * {SIZE}) AS retmax, pos + 1 AS batch_number
        FROM windows WHERE NOT EXISTS (SELECT 1 FROM done
          WHERE done.job_id = concat('job-', l_suppkey) AND done.retstart = pos * {SIZE})"""
    out["merge_source_value"] = f"""{LAKE} SELECT experiment_accession, run_accession,
        source_dataset AS again, concat(source_dataset, ' | ', library_layout) AS grown
        FROM bronze_runs"""
    out["attribute_category_summary"] = f"""{LAKE}
        SELECT sample_accession, attribute_category_summary FROM signals"""
    out["classification_basis"] = f"""{LAKE} SELECT sample_accession, biosample_accession,
        classification_basis FROM classification_text"""
    out["batch_windows"] = f"""{LAKE} SELECT source_dataset, pos * {SIZE} AS retstart,
        least({SIZE}, total - pos * {SIZE}) AS retmax, pos + 1 AS batch_number
        FROM (SELECT source_dataset, total, unnest(range((total + {SIZE - 1}) // {SIZE})) AS pos
          FROM (SELECT source_dataset, count(*) AS total FROM raw_runs GROUP BY source_dataset)
          AS totals) AS windows"""
    out["batched_ids"] = f"""WITH {TAXA} SELECT batch AS batch_number,
        string_agg(raw_id, ' | ' ORDER BY pos) AS ids FROM (
          SELECT raw_id, pos, (pos - 1) // {SIZE} + 1 AS batch FROM (
            SELECT raw_id, row_number() OVER (ORDER BY cast(raw_id AS bigint)) AS pos
            FROM (SELECT DISTINCT raw_id FROM taxon_source WHERE raw_id <> '') AS ids) AS p) AS b
        GROUP BY batch"""

    # bronze, silver, classification
    out["bronze_runs_combined"] = _from("bronze_runs", [*schemas.LINEAGE, *schemas.BRONZE_RUN])
    out["bronze_attributes_combined"] = _from(
        "bronze_attributes", [*schemas.LINEAGE, *schemas.BRONZE_ATTRIBUTE])
    for key, layer, table in (
        ("silver_run", "run_text", "sra_run"),
        ("silver_sample", "sample_text", "sra_sample"),
        ("silver_sample_attribute", "attribute_text", "sra_sample_attribute"),
        ("silver_sample_classification", "classification_text", "sra_sample_classification"),
        ("silver_empty_to_null", "sra_sample_attribute", "sra_sample_attribute"),
    ):
        out[key] = _from(layer, schemas.SILVER[table])
    out["classify_organism_group"] = f"""{LAKE} SELECT experiment_accession, run_accession,
        {_group_case()} AS organism_group FROM bronze_runs"""
    out["classify_sample_domain"] = f"""{LAKE} SELECT experiment_accession, run_accession,
        {_domain_case("grp", "(length(experiment_accession) % 2 = 1)")} AS sample_domain
        FROM (SELECT *, {_group_case()} AS grp FROM bronze_runs) AS g"""
    out["classify_sample_context"] = f"""{LAKE} SELECT sample_accession, biosample_accession,
        ruled_domain AS sample_domain, ruled_context AS sample_context FROM contexts"""
    out["attribute_signals"] = f"""{LAKE} SELECT sample_accession, category_count,
        host AS host_present, environment AS environment_present, clinical AS clinical_present,
        metagenome AS metagenome_present FROM signals"""

    # taxonomy
    out["taxonomy_organism_group"] = (
        f"WITH {TAXA} SELECT c_custkey, organism_group FROM taxon_domains")
    out["taxonomy_sample_domain"] = (
        f"WITH {TAXA} SELECT c_custkey, sample_domain FROM taxon_domains")
    out["unique_taxon_ids"] = f"""{LAKE} SELECT DISTINCT taxon_id FROM raw_runs
        WHERE taxon_id <> ''"""
    out["taxonomy_dimension"] = f"""WITH {TAXA} SELECT taxon_id, scientific_name, rank, lineage,
        {_BLANK_TAXON} FROM taxon_parsed"""
    out["taxonomy_stored_reference"] = f"""WITH {TAXA} SELECT raw_id AS taxon_id,
        max(CASE WHEN c_custkey % 7 = 0 THEN 'b' WHEN c_custkey % 7 < 4 THEN 'c' ELSE 'a' END)
          || ':' || raw_id AS scientific_name
        FROM taxon_source WHERE raw_id <> '' GROUP BY raw_id"""
    out["taxonomy_sorted"] = f"""WITH {TAXA} SELECT taxon_id, scientific_name,
        row_number() OVER (ORDER BY cast(taxon_id AS bigint)) - 1 AS row_index FROM taxon_parsed"""
    out["taxonomy_missing_ids"] = f"""{LAKE} SELECT DISTINCT taxon_id FROM raw_runs
        WHERE taxon_id <> '' AND taxon_id NOT IN (SELECT taxon_id FROM taxonomy_ref)"""
    out["taxonomy_upsert"] = f"""{LAKE}, {TAXA}
        SELECT taxon_id, scientific_name, organism_group, sample_domain FROM taxon_parsed
        UNION ALL SELECT DISTINCT taxon_id, '', 'stored', 'stored' FROM raw_runs
        WHERE taxon_id <> '' AND taxon_id NOT IN (SELECT taxon_id FROM taxon_parsed)"""
    out["taxonomy_update_summary"] = f"""{LAKE}, {TAXA} SELECT
        (SELECT count(DISTINCT taxon_id) FROM raw_runs WHERE taxon_id <> '') AS input_taxon_ids,
        (SELECT count(*) FROM taxonomy_ref) AS existing_taxon_ids,
        (SELECT count(*) FROM taxon_parsed) AS fetched_taxon_ids,
        (SELECT count(*) FROM (SELECT taxon_id FROM taxonomy_ref
          UNION SELECT taxon_id FROM taxon_parsed) AS u) AS output_taxon_ids"""

    # summaries
    by = {
        "sample_domain": ("classification_text", ["sample_domain"]),
        "organism_group": ("classification_text", ["organism_group"]),
        "sample_context": ("classification_text", ["sample_context"]),
        "domain_context": ("classification_text", ["sample_domain", "sample_context"]),
        "attribute_category": ("attribute_text", ["attribute_category"]),
        "library_strategy": ("run_text", ["library_strategy"]),
    }
    for key, (table, fields) in by.items():
        out[f"summary_{key}"] = _group(table, fields, "count", missing=True)
    c = "sra_sample_classification"
    out["sql_sample_domain_counts"] = _group(c, ["sample_domain"], "sample_count", False)
    out["sql_sample_context_counts"] = _group(c, ["sample_context"], "sample_count", False)
    out["sql_sample_domain_context_counts"] = _group(
        c, ["sample_domain", "sample_context"], "sample_count", False)
    out["sql_attribute_category_counts"] = _group(
        "sra_sample_attribute", ["attribute_category"], "attribute_count", False)
    out["sql_library_strategy_counts"] = _group("sra_run", ["library_strategy"], "run_count", False)
    out["sql_domain_library_strategy_counts"] = f"""{LAKE} SELECT sample_domain, library_strategy,
        count(*) AS run_count FROM classified_runs GROUP BY sample_domain, library_strategy"""

    # gold, serving, reports
    keys = dict(zip(gold, (
        "gold_domain_summary", "gold_context_summary", "gold_domain_library_strategy",
        "gold_top_organisms", "gold_attribute_category_by_domain", "gold_quality_summary")))
    for name, columns in gold.items():
        rows = _from(name, columns)
        out[keys[name]] = out[f"serving_{name}"] = rows
    out["gold_domain_library_strategy_snapshots"] = out["gold_domain_library_strategy"]
    out["gold_table_counts"] = out["serving_row_counts"] = _counts({n: n for n in gold})
    shown = {
        "domain_summary": (domains, [x for x in gold[domains]
                                     if x not in ("organism_group_count",
                                                  "metagenome_present_sample_count")]),
        "context_summary": (contexts, gold[contexts]),
        "domain_library_strategy_summary": (strategies, gold[strategies]),
        "top_organisms_by_domain": (organisms, gold[organisms]),
        "attribute_category_by_domain": (categories, gold[categories]),
        "quality_summary": (quality, gold[quality]),
    }
    for key, (table, columns) in shown.items():
        out[f"report_{key}"] = out[f"serving_report_{key}"] = _from(table, columns)
    out["report_overview"] = f"""{LAKE} SELECT d.* EXCLUDE (organism_group_count),
        round(d.sample_count * 100.0::double / nullif(q.sample_count, 0), 2) AS sample_pct
        FROM {domains} AS d, {quality} AS q"""
    out["report_top_library_strategies"] = f"""{LAKE} SELECT sample_domain, library_strategy,
        run_count, sample_count, experiment_count, total_bases FROM {strategies}
        WHERE library_strategy IS NOT NULL
        ORDER BY run_count DESC, sample_domain, library_strategy LIMIT 25"""
    for key, column in (("total_samples", "sample_count"), ("total_runs", "run_count"),
                        ("unknown_pct", "unknown_sample_pct"),
                        ("total_attributes", "attribute_count")):
        out[f"card_{key}"] = _from(quality, [column])
    for key, column in (("samples_by_domain", "sample_count"), ("runs_by_domain", "run_count"),
                        ("domains_by_samples", "sample_count"),
                        ("domains_by_attributes", "attribute_count")):
        out[f"card_{key}"] = _from(domains, ["sample_domain", column])
    out["card_domain_summary"] = _from(
        domains, [x for x in gold[domains] if x != "organism_group_count"])
    out["card_top_organisms"] = _from(organisms, gold[organisms])
    out["card_top_organisms_overall"] = _top(organisms, "organism", "sample_count", 20)
    out["card_domain_strategy"] = _from(strategies, gold[strategies])
    out["card_top_strategies"] = _top(strategies, "library_strategy", "run_count", 15)
    out["card_attribute_categories"] = _top(
        categories, "attribute_category", "attribute_count", 20)
    out["card_categories_by_domain"] = _from(categories, gold[categories])

    # quality and profile
    out["quality_unique_keys"] = _checks([
        _unique("raw_run_accession_unique", "raw_runs", "run_accession"), *_report()[:2]])
    out["quality_row_count_match"] = _checks([
        _match("classification_matches_samples", c, "sra_sample"),
        _match("bronze_matches_raw", "bronze_runs", "raw_runs")])
    out["quality_required_fields"] = _checks([_required("required")])
    out["quality_allowed_values"] = _checks([
        _allowed("domains", c, "sample_domain", vocab.SAMPLE_DOMAINS),
        _allowed("strategies", "raw_runs", "library_strategy", ["WGS", "RNA-Seq"]),
        _allowed("taxonomy", "taxonomy_ref", "sample_domain", vocab.SAMPLE_DOMAINS)])
    out["quality_unknown_threshold"] = _checks([
        _threshold("strict", 10, "0.001", "0.10%"),
        _threshold("by_fraction", 0, "0.5", "50.00%")])
    out["quality_taxonomy_coverage"] = _checks([_coverage("coverage")])
    out["quality_report"] = _checks(_report())
    out["quality_gate"] = f"""{LAKE} SELECT bool_and(status = 'pass') AS passed
        FROM ({" UNION ALL ".join(_report())}) AS checks"""
    profile = f"""SELECT n.normalized_attribute_name, {_category("n.normalized_attribute_name")}
          AS attribute_category, count(*) AS "count",
          count(DISTINCT nullif(attribute_value, '')) AS distinct_value_count,
          string_agg(DISTINCT attribute_name, ' | ' ORDER BY attribute_name)
            AS original_attribute_names,
          coalesce((SELECT string_agg(v, ' | ' ORDER BY v) FROM (
            SELECT DISTINCT nullif(attribute_value, '') AS v FROM raw_attributes AS o
            WHERE o.normalized_attribute_name = n.normalized_attribute_name
              AND attribute_value <> '' ORDER BY v LIMIT 5) AS firsts), '') AS example_values
        FROM raw_attributes AS n WHERE n.normalized_attribute_name <> ''
        GROUP BY n.normalized_attribute_name"""
    out["attribute_profile"] = f"{LAKE} {profile}"
    out["attribute_profile_other_count"] = f"""{LAKE} SELECT count(*) AS profiled,
        count(*) FILTER (WHERE attribute_category = 'other') AS other FROM ({profile}) AS p"""
    out["lake_build_counts"] = _counts({
        "bronze/runs": "bronze_runs", "bronze/attributes": "bronze_attributes",
        "silver/sra_run": "run_text", "silver/sra_sample": "sample_text",
        "silver/sra_sample_attribute": "attribute_text",
        "silver/sra_sample_classification": "classification_text",
        **{f"gold/{name}": name for name in gold}})
    return out
