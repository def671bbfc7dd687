"""Landed API payloads: experiment-package XML, taxonomy XML and search JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.classify import lineage_domain, lineage_group
from seqlake.functions.text import (
    blank_to_null, null_to_blank, redact_params, redact_url, strip,
)
from seqlake.operators.dedupe import keep_last
from seqlake.session import PAYLOAD_GROUPS
from seqlake.vocab import LIST_SEPARATOR

BAD = "_corrupt_record"

# Tag names carry data in PLATFORM and LIBRARY_LAYOUT, hence maps from tag to content.
_EXTERNAL_IDS = "IDENTIFIERS: struct<EXTERNAL_ID: array<struct<_VALUE: string, _namespace: string>>>"
_RUN_PARTS = f"""
  EXPERIMENT: struct<
    _accession: string,
    STUDY_REF: struct<_accession: string>,
    DESIGN: struct<LIBRARY_DESCRIPTOR: struct<
      LIBRARY_STRATEGY: string, LIBRARY_SOURCE: string, LIBRARY_SELECTION: string,
      LIBRARY_LAYOUT: map<string, string>>>,
    PLATFORM: map<string, struct<INSTRUMENT_MODEL: string>>>,
  STUDY: struct<_accession: string, {_EXTERNAL_IDS}>,
  RUN_SET: struct<RUN: array<struct<
    _accession: string, _total_spots: string, _total_bases: string>>>
"""
_SAMPLE_NAME = "SAMPLE_NAME: struct<SCIENTIFIC_NAME: string, TAXON_ID: string>"
_SAMPLE_ATTRIBUTES = """SAMPLE_ATTRIBUTES: struct<SAMPLE_ATTRIBUTE: array<struct<
  TAG: string, VALUE: string>>>"""


def _package_schema(runs: bool, attributes: bool) -> str:
    """Only what the wanted rows need: the parser skips elements that the schema leaves out."""
    sample = ["_accession: string", _EXTERNAL_IDS]
    sample += [_SAMPLE_NAME] * runs + [_SAMPLE_ATTRIBUTES] * attributes
    parts = [f"SAMPLE: struct<{', '.join(sample)}>"] + [_RUN_PARTS] * runs
    return f"EXPERIMENT_PACKAGE array<struct<{', '.join(parts)}>>, {BAD} string"


TAXA = f"""
  Taxon array<struct<
    TaxId: string, ScientificName: string, Rank: string, ParentTaxId: string, Lineage: string,
    LineageEx: struct<Taxon: array<struct<TaxId: string, ScientificName: string, Rank: string>>>>>,
  {BAD} string
"""
SEARCH = """esearchresult struct<
  count: string, querykey: string, webenv: string, idlist: array<string>>"""


def _text(c: Column) -> Column:
    return strip(null_to_blank(c))


def _external_id(owner: Column, namespace: str) -> Column:
    ids = owner["IDENTIFIERS"]["EXTERNAL_ID"]
    named = F.filter(ids, lambda x: (x["_namespace"] == namespace) & (x["_VALUE"] != ""))
    return _text(F.get(named, F.lit(0))["_VALUE"])


def _without_map_attributes(xml: Column) -> Column:
    """In the two elements that are read as maps, an attribute would look like an entry: bare their
    start tags. The plain text search spares almost every payload the rewrite."""
    starts = [f"<{tag}{space}" for tag in ("PLATFORM", "LIBRARY_LAYOUT") for space in " \t\r\n"]
    present = reduce(lambda a, b: a | b, [F.contains(xml, F.lit(start)) for start in starts])
    bared = F.regexp_replace(xml, r"<(PLATFORM|LIBRARY_LAYOUT)\s[^>]*?(/?)>", "<$1$2>")
    return F.when(present, bared).otherwise(xml)


def parse_packages(
    landed: DataFrame, body: str = "body", runs: bool = True, attributes: bool = True
) -> DataFrame:
    """Parse each XML payload once: adds `packages` and `parse_error` (NULL when well formed).

    `runs` and `attributes` say which rows will be taken from the packages.
    """
    # Text is stripped where it is used; attributes are kept as they are.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD,
               "ignoreSurroundingSpaces": "false"}
    # An absent body is no well-formed document either.
    xml = _without_map_attributes(null_to_blank(F.col(body)))
    parsed = F.from_xml(xml, _package_schema(runs, attributes), options)
    return (
        landed.withColumn("__xml", parsed)
        .withColumn("packages", F.col("__xml.EXPERIMENT_PACKAGE"))
        .withColumn("parse_error", F.col(f"__xml.{BAD}"))
        .drop("__xml")
    )


def read_package_dumps(
    spark: SparkSession, path: str, runs: bool = True, attributes: bool = True
) -> DataFrame:
    """Packages of XML files of any size, parsed by as many tasks as the files have blocks.

    Files are cut at the end tag of a package, which Spark's text reader finds across block borders,
    so no file is held as one string. One row per package: `source_path`, `row_order` (block and
    place in it), `packages` (the one package) and `parse_error`, as `parse_packages` gives them. A
    file's text between and around packages is left out. A package that breaks off at the end of its
    file is an error row unless all its elements are closed. The end tag must not occur inside
    CDATA or comments.
    """
    end = "</EXPERIMENT_PACKAGE>"
    cut = spark.read.option("lineSep", end).text(path)
    starts = F.regexp_instr("value", F.lit(r"<EXPERIMENT_PACKAGE[\s>]"))
    packages = cut.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("row_order"),
        "value", starts.alias("start")).where("start > 0")
    body = F.concat(F.lit("<EXPERIMENT_PACKAGE_SET>"), F.expr("substring(value, start)"),
                    F.lit(f"{end}</EXPERIMENT_PACKAGE_SET>"))
    return parse_packages(
        packages.select("source_path", "row_order", body.alias("body")), "body", runs, attributes
    ).drop("body")


def _exploded(df: DataFrame, keep: list, array: str | Column, position: str, element: str) -> DataFrame:
    """One row per array element. An inner explode would make the optimizer add a filter on the
    array's size, and with it parse every payload again."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, element))
    return rows.where(F.col(position).isNotNull())


def _packages(parsed: DataFrame, keep: list[str]) -> DataFrame:
    return _exploded(parsed, keep, "packages", "package_index", "p")


def run_records(parsed: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One bronze row per run; a package without runs gives one row with a blank run id."""
    keep = list(keep)
    p = F.col("p")
    rows = _packages(parsed, keep).select(
        *keep, "package_index", "p", F.posexplode_outer(p["RUN_SET"]["RUN"]).alias("run_index", "run")
    )
    experiment, study, sample, run = p["EXPERIMENT"], p["STUDY"], p["SAMPLE"], F.col("run")
    library = experiment["DESIGN"]["LIBRARY_DESCRIPTOR"]
    platform = experiment["PLATFORM"]
    values = {
        "experiment_accession": null_to_blank(experiment["_accession"]),
        "run_accession": null_to_blank(run["_accession"]),
        "study_accession": F.coalesce(
            blank_to_null(study["_accession"]), experiment["STUDY_REF"]["_accession"], F.lit("")),
        "bioproject_accession": _external_id(study, "BioProject"),
        "sample_accession": null_to_blank(sample["_accession"]),
        "biosample_accession": _external_id(sample, "BioSample"),
        "organism": _text(sample["SAMPLE_NAME"]["SCIENTIFIC_NAME"]),
        "taxon_id": _text(sample["SAMPLE_NAME"]["TAXON_ID"]),
        "library_strategy": _text(library["LIBRARY_STRATEGY"]),
        "library_source": _text(library["LIBRARY_SOURCE"]),
        "library_selection": _text(library["LIBRARY_SELECTION"]),
        "library_layout": null_to_blank(F.get(F.map_keys(library["LIBRARY_LAYOUT"]), F.lit(0))),
        "platform": null_to_blank(F.get(F.map_keys(platform), F.lit(0))),
        "instrument_model": _text(F.get(F.map_values(platform), F.lit(0))["INSTRUMENT_MODEL"]),
        "total_spots": null_to_blank(run["_total_spots"]),
        "total_bases": null_to_blank(run["_total_bases"]),
    }
    return rows.select(
        *keep, "package_index", "run_index",
        *[values[c].alias(c) for c in schemas.BRONZE_RUN],
    )


def sample_attributes(parsed: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One row per sample attribute in document order; names are not yet normalized."""
    keep = list(keep)
    p = F.col("p")
    sample = p["SAMPLE"]
    owners = [
        *keep, "package_index",
        null_to_blank(sample["_accession"]).alias("sample_accession"),
        _external_id(sample, "BioSample").alias("biosample_accession"),
    ]
    listed = sample["SAMPLE_ATTRIBUTES"]["SAMPLE_ATTRIBUTE"]
    return _exploded(_packages(parsed, keep), owners, listed, "attribute_index", "a").select(
        *keep, "package_index", "attribute_index", "sample_accession", "biosample_accession",
        _text(F.col("a.TAG")).alias("attribute_name"),
        _text(F.col("a.VALUE")).alias("attribute_value"),
    )


def taxonomy_rows(landed: DataFrame, order: str, body: str = "body") -> DataFrame:
    """Taxonomy dimension from landed XML. Of a repeated id the last entry wins.

    `order` is the column that puts payloads in landing order. Only top-level entries count, and
    entries without an id are dropped.
    """
    parsed = F.from_xml(F.col(body), TAXA, {"mode": "FAILFAST", "columnNameOfCorruptRecord": BAD})
    taxa = _exploded(landed, [F.col(order).alias("__doc")], parsed["Taxon"], "__pos", "t")
    t = F.col("t")
    lineage = F.coalesce(t["LineageEx"]["Taxon"], F.array().cast(
        "array<struct<TaxId: string, ScientificName: string, Rank: string>>"))
    taxon_id, name, rank = _text(t["TaxId"]), _text(t["ScientificName"]), _text(t["Rank"])
    names = F.transform(lineage, lambda e: _text(e["ScientificName"]))

    def at_rank(level: str) -> Column:
        # try_element_at(-1): when a rank repeats in the lineage, its last entry counts.
        hits = F.filter(lineage, lambda e: _text(e["Rank"]) == level)
        return null_to_blank(_text(F.try_element_at(hits, F.lit(-1))["ScientificName"]))

    group = lineage_group(taxon_id, name, names)
    values = {
        "taxon_id": taxon_id,
        "scientific_name": name,
        "rank": rank,
        "parent_taxon_id": _text(t["ParentTaxId"]),
        "lineage": _text(t["Lineage"]),
        "lineage_taxon_ids": F.array_join(
            F.transform(lineage, lambda e: _text(e["TaxId"])), LIST_SEPARATOR),
        **{level: at_rank(level) for level in schemas.TAXONOMY[6:13]},
        "species": F.when(rank == "species", name).otherwise(at_rank("species")),
        "organism_group": group,
        "sample_domain": lineage_domain(taxon_id, name, group),
    }
    # Deduplicate the raw entries first; lineage columns are derived for the surviving ones only.
    latest = keep_last(
        taxa.withColumn("taxon_id", taxon_id).where("taxon_id <> ''")
        .withColumn("row_order", F.struct("__doc", "__pos")), ["taxon_id"],
    )
    return latest.select(*[values[c].alias(c) for c in schemas.TAXONOMY])


def _search(landed: DataFrame, body: str) -> DataFrame:
    parsed = F.from_json(F.col(body), SEARCH, {"mode": "FAILFAST"})
    return landed.withColumn("__result", parsed["esearchresult"])


def search_ids(landed: DataFrame, keep: list[str] = (), body: str = "body") -> DataFrame:
    """One row per id of each search response."""
    found = _exploded(_search(landed, body), list(keep), "__result.idlist", "__pos", "uid")
    return found.select(*keep, "uid")


def search_history(landed: DataFrame, keep: list[str] = (), body: str = "body") -> DataFrame:
    """Record count and history handles of each search response; absent parts are 0, '' or []."""
    return _search(landed, body).select(
        *keep,
        F.coalesce(F.col("__result.count").cast("bigint"), F.lit(0)).alias("count"),
        null_to_blank(F.col("__result.querykey")).alias("query_key"),
        null_to_blank(F.col("__result.webenv")).alias("webenv"),
        F.coalesce("__result.idlist", F.array().cast("array<string>")).alias("ids"),
    )


def redacted(landed: DataFrame) -> DataFrame:
    """The landing table without credentials in url and params."""
    return landed.withColumns(
        {"url": redact_url(F.col("url")), "params": redact_params(F.col("params"))}
    )


def land(responses: DataFrame, path: str) -> None:
    """Append responses to the landing table at `path`."""
    rows = redacted(responses.select(*schemas.LANDING.names))
    rows.write.mode("append").options(**PAYLOAD_GROUPS).parquet(path)
