"""The lake's layers over one set of driver tables, each written once per session and re-read.

Silver is built from stored bronze and gold from stored silver, as in a scheduled lake build, so a
gold query does not replay the whole ingestion. The tables live in the shared folder that
spark.checkpoint.dir names; changed input files lead to fresh tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seqlake import schemas
from seqlake.operators.attributes import attribute_dictionary
from seqlake.operators.batches import row_indexed
from seqlake.operators.dedupe import ORDER
from seqlake.plans import bronze, gold, silver
from seqlake.session import PAYLOAD_GROUPS, scratch_path, shuffles_dropped
from seqlake.sources.files import blanks_to_null, exists, matching_files
from testbed import inputs

#: Lines that a task groups into batches at once, and payloads of a landed file.
LINES_PER_TASK = 200_000
PAYLOADS_PER_FILE = 4096
# (session, input files, table name): its path, and its schema once it has been read
_written: dict[tuple, str] = {}
_schemas: dict[str, StructType] = {}


class Tables(Mapping):
    """Named tables that are opened (and if need be built) only when they are asked for."""

    def __init__(self, names: Iterable[str], open_table: Callable[[str], DataFrame]) -> None:
        self.names, self.open_table = list(names), open_table

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        return self.open_table(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


class Stages:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        files = sorted(
            (s.getPath().toString(), s.getLen(), s.getModificationTime())
            for s in matching_files(spark, f"{self.sf_dir}/*.parquet"))
        self.key = (spark.sparkContext.applicationId, tuple(files))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, *names: str) -> DataFrame:
        return self.spark.sql(text, **{n: self.table(n) for n in names})

    def path(self, name: str, write: Callable[[str], object]) -> str:
        """Path of a stored table, written by `write(path)` on first use."""
        key = (*self.key, name)
        if key not in _written or not exists(self.spark, _written[key]):
            path = scratch_path(self.spark, name.replace("/", "-"))
            with shuffles_dropped(self.spark):
                write(path)
            _written[key] = path
        return _written[key]

    def stored(self, name: str, build: Callable[[], DataFrame], **options: str) -> DataFrame:
        return self.opened(
            self.path(name, lambda p: build().write.options(compression="zstd", **options).parquet(p)))

    def opened(self, path: str) -> DataFrame:
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def landed(self, name: str, build: Callable[[], DataFrame], **options: str) -> DataFrame:
        """An input table, stored as many files the way batches land, not as the one file
        that the driver tables come in."""
        files = self.spark.sparkContext.defaultParallelism
        return self.stored(f"landed/{name}", lambda: build().repartition(files), **options)

    @property
    def dictionary(self) -> DataFrame:
        return attribute_dictionary(self.spark)

    @property
    def taxonomy(self) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM {inputs.TAXONOMY_DIM}")

    def raw_runs(self) -> DataFrame:
        def build() -> DataFrame:
            # the narrow lines are dealt out for their join, the wide rows are stored where they arise
            lines = self.table("lineitem").select(*inputs.RUN_LINE).repartition("l_orderkey")
            rows = self.spark.sql(
                inputs.RUN_RAW, lineitem=lines, orders=self.table("orders"),
                customer=self.table("customer"))
            return rows.select(*schemas.LINEAGE, *schemas.BRONZE_RUN,
                               F.struct(*inputs.RUN_ORDER).alias(ORDER))
        return self.stored("landed/runs", build)

    def raw_attributes(self) -> DataFrame:
        def build() -> DataFrame:
            rows = self.sql(inputs.ATTRIBUTE_RAW, "events")
            return rows.select(
                *schemas.LINEAGE, "sample_accession", "biosample_accession", "attribute_name",
                "attribute_value", F.struct(*inputs.ATTRIBUTE_ORDER).alias(ORDER))
        return self.landed("attributes", build)

    def packages(self) -> DataFrame:
        """Landed batches as (job_id, batch_number, retstart, retmax, body), in files of bounded size.

        Only lines are sorted and dealt out; the text of a batch arises where it is written."""
        size = inputs.PACKAGES_PER_BATCH
        package = re.sub(r"\bl_\w+", r"m.\g<0>", inputs.PACKAGE)

        def write(path: str) -> None:
            lines = self.table("lineitem").select(*inputs.PACKAGE_ORDER)
            files = self.spark.sparkContext.defaultParallelism
            parts = max(files, lines.count() // LINES_PER_TASK)
            with row_indexed(lines, inputs.PACKAGE_ORDER) as rows:
                dealt = rows.withColumn("batch", F.floor(F.col("row_index") / size)).repartition(parts, "batch")
                members = F.array_sort(F.collect_list(F.struct("row_index", *inputs.PACKAGE_ORDER)))
                batches = dealt.groupBy("batch").agg(members.alias("members"))
                batches.select(
                    F.concat(F.lit("job-"), F.col("batch") % 4).alias("job_id"),
                    (F.col("batch") + 1).alias("batch_number"),
                    (F.col("batch") * size).alias("retstart"),
                    F.size("members").cast("bigint").alias("retmax"),
                    F.concat(F.lit("<EXPERIMENT_PACKAGE_SET>"),
                             F.array_join(F.expr(f"transform(members, m -> {package})"), ""),
                             F.lit("</EXPERIMENT_PACKAGE_SET>")).alias("body")
                ).coalesce(files).write.options(
                    compression="zstd", maxRecordsPerFile=PAYLOADS_PER_FILE, **PAYLOAD_GROUPS).parquet(path)

        return self.opened(self.path("landed/packages", write))

    def taxa(self) -> DataFrame:
        return self.landed("taxa", lambda: self.sql(inputs.TAXON_PAYLOADS, "customer"))

    def searches(self) -> DataFrame:
        return self.landed("searches", lambda: self.sql(inputs.SEARCH_PAYLOADS, "orders"))

    @staticmethod
    def source_order() -> list:
        return [F.col(f"{ORDER}.source_dataset"), F.col(f"{ORDER}.source_file")]

    def combine_runs(self) -> DataFrame:
        return bronze.combine_runs(self.raw_runs(), self.source_order())

    def combine_attributes(self) -> DataFrame:
        return bronze.combine_attributes(
            self.raw_attributes(), self.dictionary, self.source_order())

    def bronze_runs(self) -> DataFrame:
        return self.stored("bronze/runs", self.combine_runs)

    def bronze_attributes(self) -> DataFrame:
        return self.stored("bronze/attributes", self.combine_attributes)

    def silver_table(self, name: str) -> DataFrame:
        """Silver as it is stored: a missing value is NULL."""
        build = {
            "sra_run": lambda: silver.silver_runs(self.bronze_runs()),
            "sra_sample": lambda: silver.silver_samples(self.bronze_runs()),
            "sra_sample_attribute": lambda: silver.silver_attributes(self.bronze_attributes()),
            "sra_sample_classification": lambda: silver.classify_samples(
                self.silver_text("sra_sample"), self.silver_text("sra_sample_attribute"),
                self.taxonomy),
        }
        return self.stored(f"silver/{name}", lambda: blanks_to_null(build[name]()))

    def silver_text(self, name: str) -> DataFrame:
        """Silver as text, where a missing value is ''."""
        return self.silver_table(name).fillna("")

    def silver(self) -> Tables:
        return Tables(schemas.SILVER, self.silver_table)

    def build_facts(self) -> DataFrame:
        tables = self.silver()
        return gold.sample_facts(
            tables["sra_sample_classification"], tables["sra_run"],
            tables["sra_sample_attribute"])

    def facts(self) -> DataFrame:
        """Stored once, because two gold tables aggregate it."""
        return self.stored("gold/facts", self.build_facts)

    def gold(self) -> Tables:
        def build(name: str) -> DataFrame:
            return gold.BUILDERS[name](self.silver(), self.facts()).coalesce(1)

        return Tables(schemas.GOLD, lambda name: self.stored(f"gold/{name}", lambda: build(name)))
