"""Command line: python -m seqlake <command> [--root data] ..."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from seqlake.functions.text import utc_stamp
from seqlake.operators.attributes import attribute_dictionary, profile_attributes
from seqlake.plans import lake, quality, reports, serving, taxonomy
from seqlake.plans.lake import LakePaths
from seqlake.schemas import BRONZE_ATTRIBUTE, GOLD, LANDING
from seqlake.session import build_session
from seqlake.sources.files import newest_snapshot, read_bronze_batches, read_tables, write_csv
from seqlake.sources.manifest import read_manifest
from seqlake.streaming.ingest import IngestError, ingest_stream, plan_fetches, preview


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="seqlake", description=__doc__)
    parser.add_argument("--root", default="data", help="folder that holds the lake")
    parser.add_argument("--dictionary", help="CSV with the columns name, category")
    parser.add_argument("--csv", action="store_true", help="write silver as CSV, too")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in {
        "combine": "merge bronze batches",
        "silver": "build the silver tables",
        "export-silver": "existing silver CSV tables to Parquet",
        "gold": "build the gold tables",
        "summarize": "write the silver summaries",
    }.items():
        commands.add_parser(name, help=text)
    for name, text in {"build": "rebuild the whole lake", "validate": "run the quality checks"}.items():
        gate = commands.add_parser(name, help=text)
        gate.add_argument("--max-unknown-samples", type=int, default=quality.MAX_UNKNOWN_SAMPLES)
    profile = commands.add_parser("profile", help="profile the sample attributes")
    profile.add_argument("--input", help="folder searched for attribute files")
    profile.add_argument("--pattern", default="sra-sample-attributes*.csv")
    profile.add_argument("--output")
    profile.add_argument("--max-examples", type=int, default=5)
    ingest = commands.add_parser("ingest", help="ingest landed XML batches")
    ingest.add_argument("--landing", required=True)
    look = commands.add_parser("preview", help="bronze rows of a small discovery run")
    look.add_argument("--search", required=True, help="landing table with the search response")
    look.add_argument("--fetched", required=True, help="landing table with the fetched XML")
    look.add_argument("--retmax", type=int, default=3)
    taxa = commands.add_parser("taxonomy", help="merge landed taxonomy XML into the reference")
    taxa.add_argument("--landing", required=True)
    taxa.add_argument("--rebuild", action="store_true")
    fetches = commands.add_parser("plan-fetches", help="batches that are still to be fetched")
    fetches.add_argument("--searches", required=True, help="table of (job_id, body of the search)")
    fetches.add_argument("--batch-size", type=int, default=200)
    fetches.add_argument("--max-records", type=int)
    fetches.add_argument("--output", required=True)
    requests = commands.add_parser("taxonomy-batches", help="missing taxon ids in request batches")
    requests.add_argument("--batch-size", type=int, default=200)
    requests.add_argument("--output", required=True)
    publish = commands.add_parser("publish", help="load gold into the serving schema")
    publish.add_argument("--schema", default="gold_sra")
    publish.add_argument("--jdbc-url", help="a database; default: the Spark catalog")
    publish.add_argument("--user")
    publish.add_argument("--password")
    query = commands.add_parser("sql", help="run SQL over the silver and gold tables")
    query.add_argument("text")
    query.add_argument("--rows", type=int, default=100, help="rows to print")
    report = commands.add_parser("report", help="show a report or dashboard card")
    report.add_argument("name", choices=sorted({*reports.report_names(), *reports.card_names()}))
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session()
    paths = LakePaths(args.root)
    stamp = spark.range(1).select(utc_stamp()).first()[0]

    simple = {
        "combine": lambda: lake.combine(spark, paths, args.dictionary),
        "silver": lambda: lake.build_silver(spark, paths, args.csv),
        "export-silver": lambda: lake.export_silver(spark, paths),
        "gold": lambda: lake.build_gold(spark, paths),
        "summarize": lambda: lake.summarize(spark, paths),
    }
    if args.command in simple:
        for name, count in simple[args.command]().items():
            print(f"{name}: {count} rows")
    elif args.command == "build":
        result = lake.build_lake(
            spark, paths, args.dictionary, args.max_unknown_samples, args.csv)
        for step in ("bronze", "silver", "gold", "summary"):
            print(f"{step}: {result[step]}")
        print(f"Quality checks passed: {result['passed']}")
        return 0 if result["passed"] else 1
    elif args.command == "validate":
        checks = lake.validate(spark, paths, args.max_unknown_samples)
        checks.show(max(1, checks.count()), truncate=False)
        return 0 if quality.gate(checks).first().passed else 1
    elif args.command == "profile":
        folder = args.input or f"{args.root}/bronze/sra/batches"
        rows = read_bronze_batches(spark, folder, args.pattern, BRONZE_ATTRIBUTE)
        output = args.output or f"{args.root}/profiles/sra/sra-attribute-profile-{stamp}.csv"
        profile = profile_attributes(
            rows, attribute_dictionary(spark, args.dictionary), args.max_examples)
        write_csv(profile, output)
        stored = spark.read.option("header", True).csv(output)
        print(f"Profiled attributes: {stored.count()}")
        print("Attributes categorized as other: "
              f"{stored.where(F.col('attribute_category') == 'other').count()}")
        print(f"Output profile: {output}")
    elif args.command == "ingest":
        try:
            ingest_stream(
                spark, args.landing, paths.ingested, paths.ingest_manifest,
                f"{args.root}/manifests/sra/checkpoint",
                attribute_dictionary(spark, args.dictionary), schema=LANDING)
        except IngestError as error:
            print(error)
            return 1
    elif args.command == "preview":
        land = lambda path: spark.read.schema(LANDING).parquet(path)
        ids, runs, attributes = preview(land(args.search), land(args.fetched), args.retmax)
        if ids.isEmpty():
            print("No ids returned for the query.")
            return 1
        write_csv(runs, f"{args.root}/bronze/sra/preview-{stamp}/runs.csv")
        write_csv(attributes, f"{args.root}/bronze/sra/preview-{stamp}/attributes.csv")
    elif args.command == "taxonomy":
        samples = spark.read.parquet(paths.silver_tables()["sra_sample"])
        landed = spark.read.schema(LANDING).parquet(args.landing)
        print(taxonomy.update_reference(
            spark, samples, landed, paths.taxonomy_reference, paths.taxonomy_manifest,
            args.rebuild))
    elif args.command == "plan-fetches":
        searches = spark.read.schema("job_id string, body string").parquet(args.searches)
        write_csv(plan_fetches(searches, read_manifest(spark, paths.ingest_manifest),
                               args.batch_size, args.max_records), args.output)
    elif args.command == "taxonomy-batches":
        samples = spark.read.parquet(paths.silver_tables()["sra_sample"])
        stored = newest_snapshot(spark, paths.taxonomy_reference)
        reference = taxonomy.read_reference(spark, paths.taxonomy_reference) if stored else None
        requests = taxonomy.request_batches(samples, reference, args.batch_size)
        write_csv(requests.withColumn("ids", F.array_join("ids", ",")), args.output)
    elif args.command == "publish":
        if args.jdbc_url:
            login = {"user": args.user or "", "password": args.password or ""}
            counts = serving.publish_to_database(
                spark, paths.gold, args.jdbc_url, login, args.schema)
        else:
            counts = serving.publish_to_catalog(spark, paths.gold, args.schema)
        for name, count in counts.items():
            print(f"{args.schema}.{name}: {count}")
    elif args.command == "sql":
        lake.register_views(spark, paths)
        spark.sql(args.text).show(args.rows, truncate=False)
    elif args.command == "report":
        tables = read_tables(spark, paths.gold, list(GOLD), "Gold Parquet table")
        show = reports.report if args.name in reports.report_names() else reports.card
        found = show(args.name, tables)
        found.show(max(1, found.count()), truncate=False)
    return 0
