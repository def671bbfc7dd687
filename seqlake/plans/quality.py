"""Quality gate: every check is one (name, status, observed, expected, message) row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.text import is_blank, null_to_blank
from seqlake.sources.files import exists
from seqlake.vocab import LIST_SEPARATOR, SAMPLE_DOMAINS

MAX_UNKNOWN_SAMPLES = 10
MAX_UNKNOWN_FRACTION = 0.001
MISSING_TAXA_SHOWN = 20
#: Offending values that a report lists; those beyond are counted.
LISTED = 1000

# Messages of each kind of check when it passes and when it fails.
MESSAGES = {
    "exists": ("Found required file.", "Required file is missing."),
    "unique": ("Primary key candidate is valid.",
               "Primary key candidate has missing or duplicate values."),
    "row_count": ("Row counts match.", "Row counts do not match."),
    "required": ("Required fields are present.", "Required fields contain missing values."),
    "allowed": ("All values are allowed.", "Unexpected values were found."),
    "threshold": ("Value is within threshold.", "Value exceeds threshold."),
    "taxonomy": ("Taxonomy reference covers all sample taxon IDs.",
                 "Taxonomy reference is missing sample taxon IDs: "),
}


def _row(name: str, kind: str, passed: Column, observed: Column, expected: Column,
         detail: Column | None = None) -> Column:
    """A check as one struct."""
    good, bad = MESSAGES[kind]
    failure = F.lit(bad) if detail is None else F.concat(F.lit(bad), detail)
    return F.struct(
        F.lit(name).alias("name"),
        F.when(passed, "pass").otherwise("fail").alias("status"),
        observed.cast("string").alias("observed"),
        expected.cast("string").alias("expected"),
        F.when(passed, F.lit(good)).otherwise(failure).alias("message"),
    )


def _check(df: DataFrame, *parts) -> DataFrame:
    return df.select(_row(*parts).alias("check")).select("check.*")


def _exists_row(spark: SparkSession, name: str, path: str) -> Column:
    return _row(name, "exists", F.lit(exists(spark, path)), F.lit(path), F.lit("file exists"))


def unique_key(name: str, df: DataFrame, field: str) -> DataFrame:
    """Counting rows per value first keeps this one shuffle with partial sums, however skewed."""
    counted = (
        df.groupBy(null_to_blank(F.col(field)).alias("value")).agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value") == "", F.col("n"))), F.lit(0)).alias("missing"),
            F.coalesce(F.sum(F.when(F.col("value") != "", F.col("n") - 1)), F.lit(0)).alias("repeated"),
        )
    )
    return _check(
        counted, name, "unique", (F.col("missing") == 0) & (F.col("repeated") == 0),
        F.format_string("rows=%d; missing=%d; duplicates=%d", "rows", "missing", "repeated"),
        F.lit(f"{field} is non-empty and unique"),
    )


def row_count_match(name: str, observed: DataFrame, expected: DataFrame) -> DataFrame:
    tagged = observed.select(F.lit(True).alias("seen")).unionAll(
        expected.select(F.lit(False).alias("seen")))
    counted = tagged.agg(F.count_if("seen").alias("a"), F.count_if(~F.col("seen")).alias("b"))
    return _check(counted, name, "row_count", F.col("a") == F.col("b"), F.col("a"), F.col("b"))


def required_fields(name: str, df: DataFrame, fields: list[str]) -> DataFrame:
    blanks = [F.count_if(is_blank(F.col(f))) for f in fields]
    counted = df.agg(reduce(lambda a, b: a + b, blanks).alias("missing"))
    return _check(counted, name, "required", F.col("missing") == 0, F.col("missing"),
                  F.lit("0 missing required values"))


def allowed_values(name: str, df: DataFrame, field: str, allowed: list[str]) -> DataFrame:
    """Offending values are made distinct across the cluster before they are listed."""
    value = null_to_blank(F.col(field))
    offending = (
        df.select(value.alias("value")).where(~F.col("value").isin(allowed)).distinct()
        .agg(F.count("*").alias("n"),
             F.array_join(F.array_sort(F.collect_list("value")), LIST_SEPARATOR).alias("listed"))
    )
    return _check(
        offending, name, "allowed", F.col("n") == 0,
        F.when(F.col("n") == 0, "none").otherwise(F.col("listed")),
        F.lit(LIST_SEPARATOR.join(sorted(allowed))),
    )


def below_threshold(
    name: str, df: DataFrame, matches: Column, max_count: int, max_fraction: float
) -> DataFrame:
    counted = df.agg(F.count("*").alias("total"), F.count_if(matches).alias("n")).withColumn(
        "share", F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("total")), F.lit(0.0)))
    return _check(
        counted, name, "threshold",
        (F.col("n") <= max_count) | (F.col("share") <= max_fraction),
        F.format_string("%d (%.3f%%)", "n", F.col("share") * 100),
        F.lit(f"<= {max_count} or <= {max_fraction:.2%}"),
    )


def taxonomy_coverage(name: str, samples: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The anti join runs distributed; only the first ids in text order are gathered."""
    missing = (
        samples.select("taxon_id").where(~is_blank(F.col("taxon_id"))).distinct()
        .join(taxonomy.select("taxon_id"), "taxon_id", "left_anti")
    )
    shown = missing.orderBy("taxon_id").limit(MISSING_TAXA_SHOWN).select(
        "taxon_id", F.lit(0).alias("n"))
    total = missing.select(F.lit(None).cast("string").alias("taxon_id"), F.lit(1).alias("n"))
    counted = shown.unionAll(total).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.array_join(F.array_sort(F.collect_list("taxon_id")), LIST_SEPARATOR).alias("listed"))
    return _check(
        counted, name, "taxonomy", F.col("n") == 0,
        F.concat(F.lit("missing="), F.col("n")),
        F.lit("all sample taxon_id values are present"), F.col("listed"),
    )


@dataclass(frozen=True)
class Facts:
    """What a report gathers from one table while it is read once: the values of some columns by
    the name of the check they belong to, and numbers of blanks to be added up."""

    table: DataFrame
    values: dict[str, Column]
    sums: dict[str, Column] = field(default_factory=dict)

    def rows(self) -> DataFrame:
        """(check, value, n) per row and check, before any shuffle; sums of 0 are left out."""
        listed = [F.struct(F.lit(name).alias("check"), null_to_blank(value).alias("value"),
                           F.lit(1).cast("bigint").alias("n")) for name, value in self.values.items()]
        listed += [F.struct(F.lit(name).alias("check"), F.lit("").alias("value"),
                            n.cast("bigint").alias("n")) for name, n in self.sums.items()]
        return self.table.select(F.inline(F.array(*listed))).where("n > 0")


def _silver_facts(silver: Mapping[str, DataFrame], covered: bool) -> list[Facts]:
    key = F.col("sample_accession")
    required = ["sample_accession", "normalized_attribute_name", "attribute_category"]
    blanks = reduce(lambda a, b: a + b, [is_blank(F.col(c)).cast("bigint") for c in required])
    taxa = {"sample_taxa": F.col("taxon_id")} if covered else {}
    return [
        Facts(silver["sra_run"], {"runs": F.col("run_accession")}),
        Facts(silver["sra_sample"], {"samples": key, **taxa}),
        Facts(silver["sra_sample_attribute"], {}, {"blank_attributes": blanks}),
        Facts(silver["sra_sample_classification"],
              {"classifications": key, "domains": F.col("sample_domain")}),
    ]


def _gather(facts: list[Facts]) -> DataFrame:
    """One row with everything the checks need.

    All tables go through one aggregation by (check, value) with partial sums, so each is read once,
    nothing is joined, and a hot value is one row per task. Ids that only samples have are found in the
    same pass. Of offending values and missing ids the first are listed (LISTED and
    MISSING_TAXA_SHOWN, cut per task before they are gathered), all are counted.
    """
    taxon = F.col("check").isin("sample_taxa", "reference_taxa")
    # ids of both sides meet under one name, and n counts the sides apart
    rows = reduce(DataFrame.unionAll, [f.rows() for f in facts])
    counted = rows.groupBy(
        F.when(taxon, "taxa").otherwise(F.col("check")).alias("check"), "value").agg(
        F.sum(F.when(F.col("check") != "reference_taxa", F.col("n"))).alias("n"),
        F.sum(F.when(F.col("check") == "reference_taxa", F.col("n"))).alias("reference"))
    domain = F.col("check").isin("domains", "reference_domains")
    flagged = counted.withColumn("offends", F.coalesce(
        F.when(domain, ~F.col("value").isin(SAMPLE_DOMAINS))
        .when(F.col("check") == "taxa", (F.col("value") != "") & F.col("reference").isNull()),
        F.lit(False)))
    by_value = Window.partitionBy("check").orderBy("value")
    # n is carried along so that both branches read the same shuffled rows
    firsts = flagged.where("offends").withColumn("at", F.row_number().over(by_value)) \
        .where(F.col("at") <= LISTED).groupBy("check").agg(
            F.array_sort(F.collect_list(F.struct("value", "n"))).alias("firsts"))
    listed = firsts.select("check", F.transform("firsts", lambda f: f["value"]).alias("listed"))
    # the reference counts its own ids, the other checks theirs
    sides = F.explode(F.array(
        F.struct(F.col("check").alias("name"), F.col("n").alias("m")),
        F.struct(F.when(F.col("check") == "taxa", "reference_taxa").alias("name"),
                 F.col("reference").alias("m"))))
    totals = flagged.withColumn("side", sides).where("side.m IS NOT NULL") \
        .groupBy("side.name").agg(
            F.sum("side.m").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value") == "", F.col("side.m"))), F.lit(0)).alias("missing"),
            F.coalesce(F.sum(F.when(F.col("value") != "", F.col("side.m") - 1)), F.lit(0)).alias("repeated"),
            F.coalesce(F.sum(F.when(F.col("value") == "unknown", F.col("side.m"))), F.lit(0)).alias("unknown"),
            F.count_if("offends").alias("offending"))
    none = F.lit(None)
    stacked = totals.select(
        F.col("name").alias("check"), F.struct("rows", "missing", "repeated", "unknown", "offending").alias("m"),
        none.cast("array<string>").alias("listed")
    ).unionAll(listed.select("check", none.cast(
        "struct<rows:bigint,missing:bigint,repeated:bigint,unknown:bigint,offending:bigint>"), "listed"))
    names = [name for f in facts for name in (*f.values, *f.sums)] + ["taxa"]
    is_ = lambda name: F.col("check") == name
    zero = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in
                      ("rows", "missing", "repeated", "unknown", "offending")])
    return stacked.agg(
        *[F.coalesce(F.max(F.when(is_(name), F.col("m"))), zero).alias(name) for name in names],
        *[F.coalesce(F.max(F.when(is_(name), F.col("listed"))), F.array().cast("array<string>"))
          .alias(f"{name}_listed") for name in ("domains", "reference_domains", "taxa")])


def content_report(
    silver: Mapping[str, DataFrame], taxonomy: DataFrame | None = None,
    max_unknown_samples: int = MAX_UNKNOWN_SAMPLES,
    max_unknown_fraction: float = MAX_UNKNOWN_FRACTION,
    before: list[Column] = (), between: list[Column] = (), after: list[Column] = (),
) -> DataFrame:
    """The checks of silver's content, and of the taxonomy reference where there is one, from one read
    of each table. Further checks go before them, between the two parts, and after them."""
    facts = _silver_facts(silver, taxonomy is not None)
    if taxonomy is not None:
        facts.append(Facts(taxonomy, {
            "reference_taxa": F.col("taxon_id"), "reference_domains": F.col("sample_domain")}))
    found = _gather(facts)

    def unique(name: str, kind: str, of: str) -> Column:
        m = F.col(kind)
        return _row(name, "unique", (m["missing"] == 0) & (m["repeated"] == 0),
                    F.format_string("rows=%d; missing=%d; duplicates=%d",
                                    m["rows"], m["missing"], m["repeated"]),
                    F.lit(f"{of} is non-empty and unique"))

    def allowed(name: str, kind: str) -> Column:
        n, listed = F.col(kind)["offending"], F.col(f"{kind}_listed")
        more = F.when(n > F.size(listed), F.concat(F.lit(f"{LIST_SEPARATOR}and "), n - F.size(listed),
                                                   F.lit(" more"))).otherwise("")
        return _row(name, "allowed", n == 0, F.when(n == 0, "none").otherwise(
            F.concat(F.array_join(listed, LIST_SEPARATOR), more)),
            F.lit(LIST_SEPARATOR.join(sorted(SAMPLE_DOMAINS))))

    rows, unknown = F.col("classifications")["rows"], F.col("domains")["unknown"]
    share = F.coalesce(F.try_divide(unknown.cast("double"), rows), F.lit(0.0))
    blank = F.col("blank_attributes")["rows"]
    checks = [
        unique("sra_run_run_accession_unique", "runs", "run_accession"),
        unique("sra_sample_sample_accession_unique", "samples", "sample_accession"),
        unique("sra_classification_sample_accession_unique", "classifications", "sample_accession"),
        _row("sra_sample_classification_matches_samples", "row_count",
             rows == F.col("samples")["rows"], rows, F.col("samples")["rows"]),
        _row("sra_sample_attribute_required_fields_present", "required", blank == 0, blank,
             F.lit("0 missing required values")),
        allowed("sra_sample_domain_allowed_values", "domains"),
        _row("sra_unknown_sample_count_below_threshold", "threshold",
             (unknown <= max_unknown_samples) | (share <= max_unknown_fraction),
             F.format_string("%d (%.3f%%)", unknown, share * 100),
             F.lit(f"<= {max_unknown_samples} or <= {max_unknown_fraction:.2%}")),
    ]
    checks = [*before, *checks, *between]
    if taxonomy is not None:
        n, listed = F.col("taxa")["offending"], F.slice("taxa_listed", 1, MISSING_TAXA_SHOWN)
        checks += [
            unique("taxonomy_reference_taxon_id_unique", "reference_taxa", "taxon_id"),
            allowed("taxonomy_reference_sample_domain_allowed_values", "reference_domains"),
            _row("taxonomy_reference_covers_sample_taxon_ids", "taxonomy", n == 0,
                 F.concat(F.lit("missing="), n), F.lit("all sample taxon_id values are present"),
                 F.array_join(listed, LIST_SEPARATOR)),
        ]
    return found.select(F.inline(F.array(*checks, *after)))


def gate(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.coalesce(F.bool_and(F.col("status") == "pass"), F.lit(True)).alias("passed"))


def stack(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)


def validate_lake(
    spark: SparkSession, silver_paths: dict[str, str], read,
    gold_paths: dict[str, str] | None = None,
    taxonomy_path: str | None = None, taxonomy_manifest: str | None = None,
    max_unknown_samples: int = MAX_UNKNOWN_SAMPLES,
    max_unknown_fraction: float = MAX_UNKNOWN_FRACTION,
) -> DataFrame:
    """The full report. `read(path, columns)` opens a stored text table.

    When a silver table is missing, the report ends after the four existence checks.
    """
    found = [_exists_row(spark, f"silver_{n}_exists", p) for n, p in silver_paths.items()]
    if not all(exists(spark, p) for p in silver_paths.values()):
        return spark.range(1).select(F.inline(F.array(*found)))
    silver = {n: read(p, schemas.SILVER[n]) for n, p in silver_paths.items()}
    taxonomy, between, after = None, [], []
    if taxonomy_path is not None:
        between.append(_exists_row(spark, "taxonomy_reference_exists", taxonomy_path))
        if exists(spark, taxonomy_path):
            taxonomy = read(taxonomy_path, schemas.TAXONOMY)
    if taxonomy_manifest is not None:
        after.append(_exists_row(spark, "taxonomy_manifest_exists", taxonomy_manifest))
    for name, path in (gold_paths or {}).items():
        after.append(_exists_row(spark, f"gold_{name}_exists", path))
    return content_report(
        silver, taxonomy, max_unknown_samples, max_unknown_fraction, found, between, after)
