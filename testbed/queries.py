"""Every registered query: a function of the stages of one set of driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions import classify, text
from seqlake.operators import attributes, batches, dedupe
from seqlake.plans import gold, quality, reports, serving, silver, summary, taxonomy
from seqlake.sources import files, manifest, payloads, snapshots
from seqlake.streaming import ingest
from seqlake.vocab import LIST_SEPARATOR, SAMPLE_DOMAINS
from testbed import inputs
from testbed.stages import Stages, Tables

BATCH_SIZE = 200
#: Bytes of package dumps that lie on disk at once.
DUMP_BYTES = 4 << 30
ROOT = "/lake/batches"


# --- landed payloads -------------------------------------------------------------------------

def xml_run_records(s: Stages) -> DataFrame:
    parsed = payloads.parse_packages(s.packages(), attributes=False)
    return payloads.run_records(parsed).select(*schemas.BRONZE_RUN)


def dump_bodies(s: Stages, names: list[str] | None = None) -> DataFrame:
    """The payloads of few large files, half as many as there are cores: read one after the other, so that
    no payload is shuffled, sorted or held. `names` are the landed files to take, by default all."""
    packages = s.packages()
    if names is not None:
        folder = s.path("landed/packages", lambda p: None)
        packages = s.spark.read.schema(packages.schema).parquet(*[f"{folder}/{n}" for n in names])
    return packages.select("body").coalesce(max(2, s.spark.sparkContext.defaultParallelism // 2))


def dump_rounds(s: Stages) -> list[list[str]]:
    """The landed files in groups of at most DUMP_BYTES of payloads each, or of one file that has more."""
    sizes = s.packages().groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.sum(F.octet_length("body")).alias("bytes")).orderBy("name").collect()
    rounds, filled = [], DUMP_BYTES
    for file in sizes:
        if filled + file.bytes > DUMP_BYTES:
            rounds.append([])
            filled = 0
        rounds[-1].append(file.name)
        filled += file.bytes
    return rounds


def xml_bulk_run_records(s: Stages) -> DataFrame:
    """The packages as large dump files, cut into packages by many tasks. A round of dumps is read and
    deleted before the next is written, as all of them would take the disk of the whole text."""
    def write(path: str) -> None:
        for number, names in enumerate(dump_rounds(s) or [None]):
            dump = f"{path}/dumps-{number}"
            dump_bodies(s, names).write.option("lineSep", "\n").text(dump)
            dumps = payloads.read_package_dumps(s.spark, dump, attributes=False)
            rows = payloads.run_records(dumps).select(*schemas.BRONZE_RUN)
            rows.write.mode("append").option("compression", "zstd").parquet(f"{path}/runs")
            files.delete(s.spark, dump)

    path = s.path("dumped", write)
    return s.spark.read.schema(schemas.strings(schemas.BRONZE_RUN)).parquet(f"{path}/runs")


def xml_sample_attributes(s: Stages) -> DataFrame:
    parsed = payloads.parse_packages(s.packages(), runs=False)
    rows = attributes.normalize_names(payloads.sample_attributes(parsed))
    spread = ["sample_accession", "attribute_value"]
    return attributes.categorize(rows, s.dictionary, spread).select(*schemas.BRONZE_ATTRIBUTE)


def xml_taxonomy_reference(s: Stages) -> DataFrame:
    return payloads.taxonomy_rows(s.taxa(), "landed_order")


def json_search_ids(s: Stages) -> DataFrame:
    return payloads.search_ids(s.searches(), ["o_orderkey"])


def json_search_history(s: Stages) -> DataFrame:
    parsed = payloads.search_history(s.searches(), ["o_orderkey"])
    return parsed.withColumn("ids", F.array_join("ids", LIST_SEPARATOR))


def scan_csv_strings(s: Stages) -> DataFrame:
    def write(path: str) -> None:
        rows = s.raw_runs().select("source_dataset", *schemas.BRONZE_RUN)
        rows.write.partitionBy("source_dataset").option("header", True).option("escape", '"') \
            .option("emptyValue", "").csv(path)

    path = s.path("batch-csv", write)
    scanned = files.read_bronze_batches(s.spark, path, "*.csv", schemas.BRONZE_RUN)
    return scanned.select("source_dataset", *schemas.BRONZE_RUN)


def scan_csv_split(s: Stages) -> DataFrame:
    """All runs in one file with quotes, commas and line breaks in its fields, read block by block."""
    def write(path: str) -> None:
        files.write_csv(_quoted_runs(s.raw_runs()), path, single_file=True)

    path = s.path("one-csv", write)
    return files.read_csv_strings(s.spark, path, schemas.BRONZE_RUN, split_above=0)


def _quoted_runs(runs: DataFrame) -> DataFrame:
    return runs.select(*schemas.BRONZE_RUN).withColumns({
        "organism": F.concat("organism", F.lit(',\n"'), "platform", F.lit('"\n')),
        "library_source": F.concat("library_source", F.lit('"'))})


def scan_csv_by_name(s: Stages) -> DataFrame:
    """Batch files whose headers differ: columns in another order, and without some of them."""
    short = ["library_strategy", "sample_accession", "run_accession", "experiment_accession"]

    def write(path: str) -> None:
        rows = s.raw_runs().select("source_dataset", *schemas.BRONZE_RUN)
        half = F.length("experiment_accession") % 2 == 0
        for part in (rows.where(half), rows.where(~half).select("source_dataset", *short)):
            part.write.partitionBy("source_dataset").mode("append").option("header", True) \
                .option("escape", '"').option("emptyValue", "").csv(path)

    path = s.path("batch-csv-by-name", write)
    scanned = files.read_bronze_batches(s.spark, path, "*.csv", schemas.BRONZE_RUN)
    return scanned.select("source_dataset", *schemas.BRONZE_RUN)


def latest_snapshot(s: Stages) -> DataFrame:
    """One table per day's events, committed day by day but for one that broke off before its end."""
    def write(path: str) -> None:
        events = s.table("events").select(
            F.date_format("ts", "yyyyMMdd").alias("day"), "event_id", "event_type")
        events.write.partitionBy("day").parquet(f"{path}/tables")
        days = [r.day for r in events.select("day").distinct().orderBy("day").collect()]
        for day in days:
            snapshots.commit_snapshot(s.spark, path, {"events": f"{path}/tables/day={day}", "day": day})
        events.limit(3).drop("day").write.parquet(f"{path}/tables/day=99991231")

    newest = snapshots.newest_tables(s.spark, s.path("day-snapshots", write))
    return s.spark.read.parquet(newest["events"]).select(
        F.lit(newest["day"]).alias("snapshot"), "event_id", "event_type")


def _manifest(s: Stages) -> DataFrame:
    def write(path: str) -> None:
        manifest.append_events(s.table("events").select(
            F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
            F.col("event_type").alias("job_id"),
            (F.col("event_id") * BATCH_SIZE).alias("retstart"),
        ), path)

    return manifest.read_manifest(s.spark, s.path("manifest", write))


def manifest_completed_offsets(s: Stages) -> DataFrame:
    return manifest.completed_offsets(_manifest(s))


def ingest_landed_batches(s: Stages) -> DataFrame:
    """Half of the jobs are landed first; the second ingestion then skips what is done."""
    def write(path: str) -> None:
        landed = s.packages()
        even = landed.where(F.regexp_extract("job_id", "([0-9]+)$", 1).cast("bigint") % 2 == 0)
        for number, part in enumerate((even, landed)):
            ingest.ingest_batches(part, path, f"{path}/manifest", f"run-{number}", s.dictionary)

    path = s.path("ingested", write)
    rows = manifest.read_ingested(s.spark, path, f"{path}/manifest", "runs")
    return rows.select("job_id", "retstart", *schemas.BRONZE_RUN)


def ingest_incremental(s: Stages) -> DataFrame:
    def write(path: str) -> None:
        s.packages()
        ingest.ingest_stream(
            s.spark, s.path("landed/packages", lambda p: None), path, f"{path}/manifest",
            f"{path}/checkpoint", s.dictionary, max_files=4)

    path = s.path("streamed", write)
    rows = manifest.read_ingested(s.spark, path, f"{path}/manifest", "attributes")
    return rows.select("job_id", "retstart", *schemas.BRONZE_ATTRIBUTE)


# --- scalar functions ------------------------------------------------------------------------

def _texts(s: Stages) -> DataFrame:
    pick = lambda table, key, column: s.table(table).select(
        F.lit(f"{table}.{column}").alias("origin"), F.col(key).cast("bigint").alias("id"),
        F.col(column).alias("value"))
    names = s.raw_attributes().select(
        F.lit("attribute").alias("origin"), F.col("row_order.ord1").alias("id"),
        F.col("attribute_name").alias("value"))
    return (
        pick("pages", "page_id", "url").unionAll(pick("part", "p_partkey", "p_name"))
        .unionAll(pick("documents", "doc_id", "text")).unionAll(names)
    )


def normalize_attribute_name(s: Stages) -> DataFrame:
    return _texts(s).select(
        "origin", "id", text.normalize_attribute_name(F.col("value")).alias("normalized"))


def slugify(s: Stages) -> DataFrame:
    return _texts(s).select("origin", "id", text.slugify(F.col("value")).alias("slug"))


def _categorized(s: Stages) -> DataFrame:
    return attributes.renormalize(s.raw_attributes(), s.dictionary)


def categorize_attribute(s: Stages) -> DataFrame:
    return _categorized(s).select(
        F.col("row_order.ord1").alias("event_id"), "attribute_name", "normalized_attribute_name",
        "attribute_category")


def known_attribute_names(s: Stages) -> DataFrame:
    """Dictionary names that occur in the data, and how often."""
    seen = attributes.normalize_names(s.raw_attributes()).groupBy(
        F.col("normalized_attribute_name").alias("name")).agg(F.count("*").alias("uses"))
    return seen.join(F.broadcast(s.dictionary), "name").select("name", "category", "uses")


def _part_names(s: Stages) -> DataFrame:
    return s.table("part").select(
        "p_partkey", F.concat(F.initcap("p_name"), F.lit(" / "), "p_brand").alias("attribute_name"))


def _part_dictionary(s: Stages) -> DataFrame:
    """A dictionary of names in all categories, derived from most parts and passed in as a CSV file."""
    def write(path: str) -> None:
        brand = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
        at = (brand * 3 + F.length("p_name")) % len(inputs.CATEGORIES)
        named = attributes.normalize_names(s.table("part").withColumn(
            "attribute_name", F.concat("p_name", F.lit(" "), "p_brand")))
        rows = named.where(brand % 5 != 0).select(
            F.col("normalized_attribute_name").alias("name"),
            F.element_at(F.array(*map(F.lit, inputs.CATEGORIES)), at + 1).alias("category"))
        files.write_csv(rows.distinct(), path)

    return attributes.attribute_dictionary(s.spark, s.path("part-dictionary", write))


def categorize_with_dictionary(s: Stages) -> DataFrame:
    named = attributes.normalize_names(_part_names(s))
    return attributes.categorize(named, _part_dictionary(s), ["p_partkey"]).select(
        "p_partkey", "attribute_name", "normalized_attribute_name", "attribute_category")


def dictionary_attribute_names(s: Stages) -> DataFrame:
    return attributes.known_attribute_names(_part_dictionary(s))


def renormalize_attributes(s: Stages) -> DataFrame:
    stale = s.raw_attributes().withColumns({
        "normalized_attribute_name": F.col("attribute_name"),
        "attribute_category": F.lit("stale")})
    return attributes.renormalize(stale, s.dictionary).select(
        F.col("row_order.ord1").alias("event_id"), *schemas.BRONZE_ATTRIBUTE)


def _paths(s: Stages) -> DataFrame:
    where = F.col("row_order.ord2") % 3
    folder = (
        F.when(where == 0, F.concat(F.lit(f"file://{ROOT}/"), "source_dataset", F.lit("/job-1")))
        .when(where == 1, F.lit(ROOT)).otherwise(F.concat(F.lit("/other/"), "source_dataset")))
    return s.raw_runs().select(
        "experiment_accession", "run_accession", F.concat(folder, F.lit("/"), "source_file").alias("path"))


def source_dataset_name(s: Stages) -> DataFrame:
    return _paths(s).select(
        "*", text.source_dataset_name(F.col("path"), ROOT).alias("source_dataset"),
        text.file_name(F.col("path")).alias("source_file"))


def redact_url(s: Stages) -> DataFrame:
    url, key = F.col("url"), F.concat(F.lit("api_key=k"), "page_id")
    base, rest = F.substring_index(url, "#", 1), F.regexp_extract(url, "(#.*)$", 1)
    mark = F.when(F.contains(base, F.lit("?")), "&").otherwise("?")
    keyed = F.concat(base, mark, key, F.lit("&term=a+b%2Fc&empty="), rest)
    return s.table("pages").select("page_id", text.redact_url(keyed).alias("redacted_url"))


def redact_params(s: Stages) -> DataFrame:
    params = F.create_map(
        F.lit("url"), "url",
        F.when(F.col("page_id") % 2 == 0, "api_key").otherwise("my_api_key"),
        F.concat(F.lit("k"), "page_id"))
    hidden = text.redact_params(params)
    return s.table("pages").select(
        "page_id", hidden["url"].alias("url"), hidden["api_key"].alias("api_key"),
        hidden["my_api_key"].alias("my_api_key"))


def merge_source_value(s: Stages) -> DataFrame:
    first = F.col("row_order.source_dataset")
    return s.bronze_runs().select(
        "experiment_accession", "run_accession",
        text.merge_source_value(F.col("source_dataset"), first).alias("again"),
        text.merge_source_value(F.col("source_dataset"), F.col("library_layout")).alias("grown"))


def attribute_category_summary(s: Stages) -> DataFrame:
    signals = attributes.attribute_signals(s.silver_text("sra_sample_attribute"))
    return signals.select(
        "sample_accession",
        classify.category_summary(F.col("category_counts")).alias("attribute_category_summary"))


def classification_basis(s: Stages) -> DataFrame:
    return silver_sample_classification(s).select(
        "sample_accession", "biosample_accession", "classification_basis")


def batch_windows(s: Stages) -> DataFrame:
    totals = s.raw_runs().groupBy("source_dataset").agg(F.count("*").alias("total"))
    return batches.batch_windows(totals, "total", BATCH_SIZE)


def _taxon_rows(s: Stages) -> DataFrame:
    return s.sql(inputs.TAXON_SOURCE, "customer")


def batched_ids(s: Stages) -> DataFrame:
    ids = taxonomy.unique_taxon_ids(_taxon_rows(s).withColumnRenamed("raw_id", "taxon_id"))
    cut = batches.batch_ids(ids, "taxon_id", BATCH_SIZE, taxonomy.numeric_order())
    return cut.select("batch_number", F.array_join("ids", LIST_SEPARATOR).alias("ids"))


# --- bronze and silver -----------------------------------------------------------------------

def bronze_runs_combined(s: Stages) -> DataFrame:
    return s.combine_runs().select(*schemas.LINEAGE, *schemas.BRONZE_RUN)


def bronze_attributes_combined(s: Stages) -> DataFrame:
    return s.combine_attributes().select(*schemas.LINEAGE, *schemas.BRONZE_ATTRIBUTE)


def silver_run(s: Stages) -> DataFrame:
    return silver.silver_runs(s.bronze_runs())


def silver_sample(s: Stages) -> DataFrame:
    return silver.silver_samples(s.bronze_runs())


def silver_sample_attribute(s: Stages) -> DataFrame:
    return silver.silver_attributes(s.bronze_attributes())


def silver_sample_classification(s: Stages) -> DataFrame:
    return silver.classify_samples(
        s.silver_text("sra_sample"), s.silver_text("sra_sample_attribute"), s.taxonomy)


def _heuristic(s: Stages) -> DataFrame:
    """Every bronze row classified by rules alone."""
    name, taxon, source = map(F.col, ("organism", "taxon_id", "source_dataset"))
    return s.bronze_runs().select(
        "experiment_accession", "run_accession", "organism", "taxon_id", "source_dataset",
        classify.organism_group(name, taxon, source).alias("organism_group"))


def classify_organism_group(s: Stages) -> DataFrame:
    return _heuristic(s).select("experiment_accession", "run_accession", "organism_group")


def _signalled(s: Stages) -> DataFrame:
    odd = F.length("experiment_accession") % 2 == 1
    return _heuristic(s).withColumn("metagenome", odd)


def classify_sample_domain(s: Stages) -> DataFrame:
    name, taxon, source = map(F.col, ("organism", "taxon_id", "source_dataset"))
    domain = classify.sample_domain(
        name, taxon, source, F.col("organism_group"), F.col("metagenome"))
    return _signalled(s).select(
        "experiment_accession", "run_accession", domain.alias("sample_domain"))


def classify_sample_context(s: Stages) -> DataFrame:
    """Contexts by rules alone: no taxonomy reference takes part."""
    ruled = silver.classify_samples(
        s.silver_text("sra_sample"), s.silver_text("sra_sample_attribute"))
    return ruled.select(
        "sample_accession", "biosample_accession", "sample_domain", "sample_context")


def taxonomy_organism_group(s: Stages) -> DataFrame:
    return _lineage_classes(s).select("c_custkey", "organism_group")


def taxonomy_sample_domain(s: Stages) -> DataFrame:
    return _lineage_classes(s).select("c_custkey", "sample_domain")


def _lineage_classes(s: Stages) -> DataFrame:
    names, taxon, name = F.split("lineage", "; "), F.col("raw_id"), F.col("scientific_name")
    return _taxon_rows(s).withColumn(
        "organism_group", classify.lineage_group(taxon, name, names)
    ).withColumn("sample_domain", classify.lineage_domain(taxon, name, F.col("organism_group")))


def attribute_signals(s: Stages) -> DataFrame:
    flags = list(attributes.SIGNAL_FLAGS.values())
    return attributes.attribute_signals(s.silver_text("sra_sample_attribute")).select(
        "sample_accession", F.size("category_counts").cast("bigint").alias("category_count"), *flags)


def silver_empty_to_null(s: Stages) -> DataFrame:
    return files.blanks_to_null(silver.silver_attributes(s.bronze_attributes()))


# --- taxonomy reference ----------------------------------------------------------------------

def _stored_taxonomy(s: Stages) -> DataFrame:
    """Reference rows as stored: ids repeat, and the columns that are not listed are absent."""
    rows = _taxon_rows(s)
    return rows.select(
        F.col("raw_id").alias("taxon_id"), "scientific_name", F.col("taxon_rank").alias("rank"),
        "lineage", F.struct("c_custkey").alias(dedupe.ORDER))


def unique_taxon_ids(s: Stages) -> DataFrame:
    return taxonomy.unique_taxon_ids(s.bronze_runs())


def taxonomy_dimension(s: Stages) -> DataFrame:
    return taxonomy.dimension(_stored_taxonomy(s))


def taxonomy_stored_reference(s: Stages) -> DataFrame:
    """A stored reference of files of unequal size in which ids repeat: later files count."""
    def write(path: str) -> None:
        rows = _taxon_rows(s).where("raw_id <> ''").withColumn(
            "part", F.when(F.col("c_custkey") % 7 == 0, "b").when(F.col("c_custkey") % 7 < 4, "c")
            .otherwise("a"))
        filled = files.project_fields(rows.select(
            F.col("raw_id").alias("taxon_id"), F.concat("part", F.lit(":"), "raw_id").alias(
                "scientific_name"), "part"), [*schemas.TAXONOMY, "part"])
        for part in "abc":
            files.write_csv(filled.where(F.col("part") == part).drop("part")
                            .dropDuplicates(["taxon_id"]), f"{path}.csv/{part}")

    path = s.path("stored-reference", write)
    return taxonomy.read_reference(s.spark, f"{path}.csv").select("taxon_id", "scientific_name")


def taxonomy_sorted(s: Stages) -> DataFrame:
    rows = taxonomy.dimension(_stored_taxonomy(s)).select("taxon_id", "scientific_name")
    return batches.with_row_index(rows, taxonomy.numeric_order())


def taxonomy_missing_ids(s: Stages) -> DataFrame:
    return taxonomy.missing_ids(s.bronze_runs(), s.taxonomy)


def _existing(s: Stages) -> DataFrame:
    """A reference of the ids met in the data, with placeholder classes to be replaced."""
    return files.project_fields(
        unique_taxon_ids(s).withColumns({
            "organism_group": F.lit("stored"), "sample_domain": F.lit("stored")}),
        schemas.TAXONOMY)


def taxonomy_upsert(s: Stages) -> DataFrame:
    return dedupe.upsert(_existing(s), xml_taxonomy_reference(s), "taxon_id").select(
        "taxon_id", "scientific_name", "organism_group", "sample_domain")


def taxonomy_update_summary(s: Stages) -> DataFrame:
    return taxonomy.update_counts(s.bronze_runs(), s.taxonomy, xml_taxonomy_reference(s))


def pending_batches(s: Stages) -> DataFrame:
    totals = s.table("events").select(
        F.lit(1).alias("one")).groupBy("one").agg((F.count("*") * BATCH_SIZE).alias("total"))
    windows = batches.batch_windows(totals, "total", BATCH_SIZE).drop("one")
    return batches.pending_batches(windows, manifest.completed_offsets(_manifest(s)), ["retstart"])


def plan_fetches(s: Stages) -> DataFrame:
    """One search per supplier over its lineitems; some windows are done already."""
    def write(path: str) -> None:
        manifest.append_events(s.table("events").select(
            # a third of the windows never succeeds, whatever the scale
            F.when((F.col("event_type") == "error")
                   | ((F.col("event_id") % 100 + F.floor(F.col("event_id") / 100) % 8) % 3 == 0),
                   "failure").otherwise("success").alias("status"),
            F.concat(F.lit("job-"), F.col("event_id") % 100).alias("job_id"),
            (F.floor(F.col("event_id") / 100) % 8 * BATCH_SIZE).alias("retstart"),
        ), path)

    done = manifest.read_manifest(s.spark, s.path("fetch-manifest", write))
    searches = s.sql(inputs.JOB_SEARCHES, "lineitem")
    return ingest.plan_fetches(searches, done, BATCH_SIZE)


# --- quality and profile ---------------------------------------------------------------------

def quality_unique_keys(s: Stages) -> DataFrame:
    tables = s.silver()
    return quality.stack([
        quality.unique_key("raw_run_accession_unique", s.raw_runs(), "run_accession"),
        quality.unique_key("sra_run_run_accession_unique", tables["sra_run"], "run_accession"),
        quality.unique_key("sra_sample_sample_accession_unique", tables["sra_sample"],
                           "sample_accession"),
    ])


def quality_row_count_match(s: Stages) -> DataFrame:
    tables = s.silver()
    return quality.stack([
        quality.row_count_match("classification_matches_samples",
                                tables["sra_sample_classification"], tables["sra_sample"]),
        quality.row_count_match("bronze_matches_raw", s.bronze_runs(), s.raw_runs()),
    ])


def quality_required_fields(s: Stages) -> DataFrame:
    return quality.required_fields(
        "required", s.silver()["sra_sample_attribute"],
        ["sample_accession", "normalized_attribute_name", "attribute_category"])


def quality_allowed_values(s: Stages) -> DataFrame:
    return quality.stack([
        quality.allowed_values("domains", s.silver()["sra_sample_classification"],
                               "sample_domain", SAMPLE_DOMAINS),
        quality.allowed_values("strategies", s.raw_runs(), "library_strategy", ["WGS", "RNA-Seq"]),
        quality.allowed_values("taxonomy", s.taxonomy, "sample_domain", SAMPLE_DOMAINS),
    ])


def quality_unknown_threshold(s: Stages) -> DataFrame:
    rows = s.silver()["sra_sample_classification"]
    unknown = F.col("sample_domain") == "unknown"
    return quality.stack([
        quality.below_threshold("strict", rows, unknown, 10, 0.001),
        quality.below_threshold("by_fraction", rows, unknown, 0, 0.5),
    ])


def quality_taxonomy_coverage(s: Stages) -> DataFrame:
    return quality.taxonomy_coverage("coverage", s.silver()["sra_sample"], s.taxonomy)


def quality_report(s: Stages) -> DataFrame:
    tables = s.silver()
    return quality.content_report(tables, s.taxonomy)


def quality_gate(s: Stages) -> DataFrame:
    return quality.gate(quality_report(s))


def attribute_profile(s: Stages) -> DataFrame:
    return attributes.profile_attributes(s.raw_attributes(), s.dictionary)


def attribute_profile_other_count(s: Stages) -> DataFrame:
    return attribute_profile(s).agg(
        F.count("*").alias("profiled"),
        F.count_if(F.col("attribute_category") == "other").alias("other"))


def lake_build_counts(s: Stages) -> DataFrame:
    layers = {
        "bronze": {"runs": s.bronze_runs(), "attributes": s.bronze_attributes()},
        "silver": {name: s.silver_text(name) for name in schemas.SILVER},
        "gold": s.gold(),
    }
    return serving.row_counts({
        f"{layer}/{name}": df for layer, tables in layers.items() for name, df in tables.items()})


# --- registry --------------------------------------------------------------------------------

PLAIN = [
    xml_run_records, xml_bulk_run_records, xml_sample_attributes, xml_taxonomy_reference, json_search_ids,
    json_search_history, scan_csv_strings, scan_csv_split, scan_csv_by_name, latest_snapshot, manifest_completed_offsets,
    ingest_landed_batches, ingest_incremental,
    normalize_attribute_name, categorize_attribute, known_attribute_names,
    categorize_with_dictionary, dictionary_attribute_names, renormalize_attributes,
    source_dataset_name, redact_url, redact_params, slugify, merge_source_value, attribute_category_summary,
    classification_basis, batch_windows, batched_ids,
    bronze_runs_combined, bronze_attributes_combined, silver_run, silver_sample,
    silver_sample_attribute, silver_sample_classification, silver_empty_to_null,
    classify_organism_group, classify_sample_domain, classify_sample_context,
    taxonomy_organism_group, taxonomy_sample_domain, attribute_signals,
    unique_taxon_ids, taxonomy_dimension, taxonomy_sorted, taxonomy_stored_reference, taxonomy_missing_ids, taxonomy_upsert,
    taxonomy_update_summary, pending_batches, plan_fetches,
    quality_unique_keys, quality_row_count_match, quality_required_fields, quality_allowed_values,
    quality_unknown_threshold, quality_taxonomy_coverage, quality_report, quality_gate,
    attribute_profile, attribute_profile_other_count, lake_build_counts,
]

def _strategy_snapshots(s: Stages) -> DataFrame:
    """The same summary from the merged states of three snapshots of runs."""
    runs, classified = s.silver()["sra_run"], s.silver()["sra_sample_classification"]
    snapshot, state = F.pmod(F.xxhash64("run_accession"), F.lit(3)), None
    for number in range(3):
        state = gold.strategy_state(runs.where(snapshot == number), classified, state)
    return gold.strategy_summary(state)


# Query name: gold table and how it is built from silver.
GOLD = {
    "gold_domain_summary": lambda s: gold.domain_summary(s.build_facts()),
    "gold_context_summary": lambda s: gold.context_summary(s.build_facts()),
    "gold_domain_library_strategy": lambda s: gold.domain_library_strategy(
        s.silver()["sra_run"], s.silver()["sra_sample_classification"]),
    "gold_domain_library_strategy_snapshots": lambda s: _strategy_snapshots(s),
    "gold_top_organisms": lambda s: gold.top_organisms(
        s.silver()["sra_sample"], s.silver()["sra_sample_classification"]),
    "gold_attribute_category_by_domain": lambda s: gold.attribute_category_by_domain(
        s.silver()["sra_sample_attribute"], s.silver()["sra_sample_classification"]),
    "gold_quality_summary": lambda s: gold.quality_summary(
        s.silver()["sra_sample_classification"], s.silver()["sra_run"],
        s.silver()["sra_sample_attribute"]),
    "gold_table_counts": lambda s: serving.row_counts(s.gold()),
}

SUMMARY_KEYS = {
    "summary_sample_domain": "sample_domain_counts",
    "summary_organism_group": "organism_group_counts",
    "summary_sample_context": "sample_context_counts",
    "summary_domain_context": "sample_domain_context_counts",
    "summary_attribute_category": "attribute_category_counts",
    "summary_library_strategy": "library_strategy_counts",
}

# Query name: silver table, group columns, name of the count.
COUNTS = {
    "sql_sample_domain_counts": ("sra_sample_classification", ["sample_domain"], "sample_count"),
    "sql_sample_context_counts": ("sra_sample_classification", ["sample_context"], "sample_count"),
    "sql_sample_domain_context_counts": (
        "sra_sample_classification", ["sample_domain", "sample_context"], "sample_count"),
    "sql_attribute_category_counts": (
        "sra_sample_attribute", ["attribute_category"], "attribute_count"),
    "sql_library_strategy_counts": ("sra_run", ["library_strategy"], "run_count"),
}


def _summary(name: str) -> Callable[[Stages], DataFrame]:
    table, fields = summary.SUMMARIES[name]
    return lambda s: summary.count_by_fields(s.silver_text(table), fields)


def _serving(s: Stages) -> Tables:
    tables = s.gold()
    return Tables(schemas.GOLD, lambda name: serving.serving_table(name, tables))


def registry() -> dict[str, Callable[[Stages], DataFrame]]:
    found: dict[str, Callable[[Stages], DataFrame]] = {f.__name__: f for f in PLAIN}
    found.update(GOLD)
    found.update({key: _summary(name) for key, name in SUMMARY_KEYS.items()})
    for key, (table, fields, name) in COUNTS.items():
        found[key] = lambda s, t=table, f=fields, n=name: summary.count_rows(s.silver()[t], f, n)
    found["sql_domain_library_strategy_counts"] = lambda s: summary.domain_library_strategy_counts(
        s.silver()["sra_run"], s.silver()["sra_sample_classification"])
    for table in schemas.GOLD:
        found[f"serving_{table}"] = lambda s, t=table: _serving(s)[t]
    found["serving_row_counts"] = lambda s: serving.row_counts(_serving(s))
    for name in reports.report_names():
        found[f"report_{name}"] = lambda s, n=name: reports.report(n, s.gold())
    for name in reports.report_names()[:6]:
        found[f"serving_report_{name}"] = lambda s, n=name: reports.report(n, _serving(s))
    for name in reports.card_names():
        found[f"card_{name}"] = lambda s, n=name: reports.card(n, _serving(s))
    return found


def bind(query: Callable[[Stages], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Stages(spark, sf_dir))
