"""Sample attributes: name normalization, categories, per-sample signals and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqlake import vocab
from seqlake.functions.text import is_blank, normalize_attribute_name
from seqlake.operators.dedupe import keep_first
from seqlake.operators.skew import lookup_join
from seqlake.session import materialize

# Categories that raise a flag on the sample, and the flag's column.
SIGNAL_FLAGS = {
    "host": "host_present",
    "environment": "environment_present",
    "clinical": "clinical_present",
    "metagenome_assembly": "metagenome_present",
}


def attribute_dictionary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(name, category) rows: the CSV at `path`, or the built-in core dictionary."""
    if path is not None:
        table = spark.read.schema("name string, category string").option("header", True).csv(path)
        return keep_first(table.where(~is_blank(F.col("name"))), ["name"], F.col("category"))
    values = ", ".join(f"('{name}', '{category}')" for name, category in vocab.core_dictionary())
    return spark.sql(f"SELECT * FROM VALUES {values} AS dictionary(name, category)")


def known_attribute_names(dictionary: DataFrame) -> DataFrame:
    """Every name that the dictionary gives a category, once."""
    return dictionary.select("name").where(~is_blank(F.col("name"))).distinct()


def categorize(df: DataFrame, dictionary: DataFrame, spread_by: list[str]) -> DataFrame:
    """Set attribute_category from normalized_attribute_name: exact name, prefix, suffix, other."""
    name = F.col("normalized_attribute_name")
    rule = F
    for category, prefixes in vocab.PREFIX_RULES:
        rule = rule.when(name.rlike(f"^({'|'.join(prefixes)})"), category)
    for category, suffixes in vocab.SUFFIX_RULES:
        rule = rule.when(name.rlike(f"({'|'.join(suffixes)})$"), category)
    exact = dictionary.select(
        F.col("name").alias("normalized_attribute_name"), F.col("category").alias("__exact")
    )
    return (
        lookup_join(df, exact, "normalized_attribute_name", spread_by)
        .withColumn("attribute_category", F.coalesce("__exact", rule.otherwise(vocab.OTHER_CATEGORY)))
        .drop("__exact")
    )


def normalize_names(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "normalized_attribute_name", normalize_attribute_name(F.col("attribute_name"))
    )


def renormalize(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Recompute normalized name and category, overriding what is stored."""
    return categorize(normalize_names(df), dictionary, ["sample_accession", "attribute_value"])


def attribute_signals(attributes: DataFrame) -> DataFrame:
    """Per sample: attribute count by category, and a flag per signal category.

    Counting by (sample, category) first leaves at most one row per category for each sample.
    """
    counts = (
        attributes.where(~is_blank(F.col("sample_accession")))
        .groupBy("sample_accession", F.coalesce("attribute_category", F.lit("")).alias("category"))
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy("sample_accession").agg(
        F.collect_list(F.struct("category", "n")).alias("category_counts"),
        *[
            F.bool_or(F.col("category") == category).alias(flag)
            for category, flag in SIGNAL_FLAGS.items()
        ],
    )


def profile_attributes(
    attributes: DataFrame, dictionary: DataFrame, max_examples: int = 5
) -> DataFrame:
    """Per normalized name: category, rows, distinct values, raw spellings and example values.

    The attributes are read once, into rows per (name, spelling, value); everything else comes from
    those. Examples are ranked per task, so a name that holds a large share of the rows is never
    gathered in one place.
    """
    if max_examples <= 0:
        raise ValueError("max_examples must be positive")
    name = "normalized_attribute_name"
    value = F.nullif(F.col("attribute_value"), F.lit(""))
    named = materialize(
        normalize_names(attributes).where(F.col(name) != "")
        .groupBy(name, "attribute_name", value.alias("value")).agg(F.count("*").alias("n")),
        "profile")
    by_value = named.groupBy(name, "value").agg(F.sum("n").alias("n"))
    totals = by_value.groupBy(name).agg(
        F.sum("n").alias("count"), F.count("value").alias("distinct_value_count")
    )
    spellings = (
        named.select(name, "attribute_name").distinct().groupBy(name)
        .agg(F.array_sort(F.collect_list("attribute_name")).alias("spellings"))
    )
    first_values = Window.partitionBy(name).orderBy("value")
    examples = (
        named.select(name, "value").where(F.col("value").isNotNull()).distinct()
        .withColumn("rank", F.row_number().over(first_values))
        .where(F.col("rank") <= max_examples)
        .groupBy(name).agg(F.array_sort(F.collect_list("value")).alias("examples"))
    )
    joined = totals.join(spellings, name).join(examples, name, "left")
    return categorize(joined, dictionary, [name]).select(
        name,
        "attribute_category",
        "count",
        "distinct_value_count",
        F.array_join("spellings", vocab.LIST_SEPARATOR).alias("original_attribute_names"),
        F.coalesce(F.array_join("examples", vocab.LIST_SEPARATOR), F.lit("")).alias("example_values"),
    ).orderBy(F.desc("count"), name)
