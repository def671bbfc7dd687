import pytest
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.plans import gold, quality, reports, silver, summary, taxonomy
from seqlake.sources.files import blanks_to_null
from seqlake.vocab import SAMPLE_DOMAINS

RUN_COLUMNS = [*schemas.LINEAGE, *schemas.BRONZE_RUN]


@pytest.fixture
def bronze_runs(rows):
    def build(*records):
        df = rows(list(records), [*RUN_COLUMNS, "at"])
        return df.withColumn("row_order", F.struct(F.col("at").cast("int"))).drop("at")
    return build


def test_silver_runs_and_samples(bronze_runs):
    df = bronze_runs(
        {"run_accession": "R1", "sample_accession": "S1", "organism": "first", "at": "1"},
        {"run_accession": "R1", "sample_accession": "S1", "organism": "again", "at": "2"},
        {"run_accession": "", "sample_accession": "S2", "organism": "no run", "at": "3"},
        {"run_accession": "R3", "biosample_accession": "B3", "at": "5", "organism": "later"},
        {"run_accession": "R2", "biosample_accession": "B3", "at": "4", "organism": "earlier"},
        {"run_accession": "R4", "at": "6"},
        {"run_accession": "R5", "sample_accession": "B3", "at": "9", "organism": "same key"},
    )
    runs = silver.silver_runs(df)
    assert runs.columns == schemas.SILVER["sra_run"]
    assert sorted(r.run_accession for r in runs.collect()) == ["R1", "R2", "R3", "R4", "R5"]
    samples = silver.silver_samples(df)
    assert samples.columns == schemas.SILVER["sra_sample"]
    assert {r.organism for r in samples.collect()} == {"first", "no run", "earlier"}


def test_silver_attributes(rows):
    keys = schemas.ATTRIBUTE_KEY
    df = rows([dict(zip(keys, k), at=str(i), attribute_name=str(i)) for i, k in enumerate(
        [("S", "B", "n", "v"), ("S", "B", "n", "v"), ("", "", "", ""), ("", "", "n", "")])])
    df = df.withColumn("row_order", F.struct("at")).drop("at")
    assert {r.attribute_name for r in silver.silver_attributes(df).collect()} == {"0", "3"}


@pytest.fixture
def lake(rows):
    """A small silver layer with a sample that has no accession, and blanks."""
    c = schemas.SILVER["sra_sample_classification"]
    classification = rows([
        {"sample_accession": "S1", "sample_domain": "human", "organism_group": "Eukaryota",
         "sample_context": "clinical", "clinical_present": "True", "host_present": "False"},
        {"sample_accession": "S2", "sample_domain": "human", "organism_group": "Other",
         "sample_context": "unknown", "host_present": "True"},
        {"sample_accession": "S3", "sample_domain": "unknown", "organism_group": "unknown",
         "sample_context": "unknown", "environment_present": "True", "metagenome_present": "True"},
        {"biosample_accession": "B4", "sample_domain": "human", "organism_group": "Eukaryota",
         "sample_context": "clinical"},
        {"biosample_accession": "S1", "sample_domain": "unknown", "organism_group": "unknown",
         "sample_context": "clinical"},
    ], c)
    runs = rows([
        {"run_accession": "R1", "sample_accession": "S1", "experiment_accession": "X1",
         "library_strategy": "WGS", "total_spots": "10", "total_bases": "100"},
        {"run_accession": "R2", "sample_accession": "S1", "experiment_accession": "X1",
         "library_strategy": "WGS", "total_spots": "", "total_bases": "5"},
        {"run_accession": "R3", "sample_accession": "S2", "experiment_accession": "X3",
         "library_strategy": "WGS", "total_spots": "1", "total_bases": "1"},
        {"run_accession": "R4", "sample_accession": "S3", "experiment_accession": "X4"},
        {"run_accession": "R5", "experiment_accession": "X5", "library_strategy": "WGS"},
    ], schemas.SILVER["sra_run"])
    samples = rows([
        {"sample_accession": "S1", "organism": "Homo sapiens", "taxon_id": "9606"},
        {"sample_accession": "S2", "organism": "", "taxon_id": ""},
        {"sample_accession": "S3", "organism": "missing", "taxon_id": "77"},
        {"biosample_accession": "B4", "organism": "Homo sapiens", "taxon_id": "9606"},
        {"biosample_accession": "S1", "organism": "x", "taxon_id": "8"},
    ], schemas.SILVER["sra_sample"])
    attributes = rows([
        {"sample_accession": "S1", "normalized_attribute_name": "a", "attribute_category": "host"},
        {"sample_accession": "S1", "normalized_attribute_name": "b", "attribute_category": "host"},
        {"sample_accession": "S2", "normalized_attribute_name": "a", "attribute_category": "host"},
        {"sample_accession": "", "normalized_attribute_name": "a", "attribute_category": "other"},
    ], schemas.SILVER["sra_sample_attribute"])
    text = {"sra_run": runs, "sra_sample": samples, "sra_sample_attribute": attributes,
            "sra_sample_classification": classification}
    return {name: blanks_to_null(df) for name, df in text.items()}, text


@pytest.fixture
def tables(lake):
    nulls, _ = lake
    facts = gold.sample_facts(nulls["sra_sample_classification"], nulls["sra_run"],
                              nulls["sra_sample_attribute"])
    return gold.build_gold(nulls, facts)


def listed(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_gold_values(tables):
    assert [tuple(r) for r in tables["sra_domain_summary"].collect()] == [
        ("human", 3, 3, 3, 2, 1, 0, 1, 0), ("unknown", 2, 1, 0, 1, 0, 1, 0, 1)]
    assert [tuple(r) for r in tables["sra_context_summary"].collect()] == [
        ("clinical", 3, 2, 2, 2), ("unknown", 2, 2, 1, 2)]
    assert [tuple(r) for r in tables["sra_domain_library_strategy_summary"].collect()] == [
        ("human", "WGS", 3, 2, 2, 11, 106), ("unknown", None, 1, 1, 1, None, None)]
    assert [tuple(r) for r in tables["sra_top_organisms_by_domain"].collect()] == [
        ("human", 1, "Homo sapiens", "9606", 1), ("human", 2, "missing", "missing", 1),
        ("unknown", 1, "missing", "77", 1)]
    assert [tuple(r) for r in tables["sra_attribute_category_by_domain"].collect()] == [
        ("human", "host", 3, 2)]
    assert tuple(tables["sra_quality_summary"].first()) == (5, 5, 4, 2, 40.0)


def test_gold_types_are_the_serving_types(tables):
    for name, columns in schemas.GOLD.items():
        assert dict(tables[name].dtypes) == columns and tables[name].columns == list(columns)


def test_a_hot_sample_counts_like_the_others(spark):
    """One sample with most of the runs, experiments that repeat, and runs without a sample."""
    rows = [("HOT", "WGS", f"E{i % 40}", "1", "") for i in range(400)] \
        + [("S1", "WGS", "E1", None, "5"), ("S2", None, "E1", "2", "5"), (None, "WGS", "E9", "1", "1")]
    runs = spark.createDataFrame(
        rows, "sample_accession string, library_strategy string, experiment_accession string, "
              "total_spots string, total_bases string")
    domains = spark.createDataFrame(
        [("HOT", "human"), ("S1", "human"), ("S2", "animal"), (None, "unknown")],
        "sample_accession string, sample_domain string")
    found = gold.domain_library_strategy(runs, domains).collect()
    assert [tuple(r) for r in found] == [
        ("human", "WGS", 401, 2, 40, 400, 5), ("animal", None, 1, 1, 1, 2, 5)]


def test_no_samples_divides_by_nothing(lake):
    nulls, _ = lake
    empty = {name: df.limit(0) for name, df in nulls.items()}
    row = gold.quality_summary(empty["sra_sample_classification"], empty["sra_run"],
                               empty["sra_sample_attribute"]).first()
    assert tuple(row) == (0, 0, 0, 0, None)


def test_bad_numbers_raise(lake):
    nulls, _ = lake
    bad = nulls["sra_run"].withColumn("total_spots", F.lit("abc"))
    with pytest.raises(Exception):
        gold.domain_library_strategy(bad, nulls["sra_sample_classification"]).collect()


def test_top_organisms_stop_at_ten(spark, rows):
    samples = rows([{"sample_accession": f"S{i}-{j}", "organism": f"o{i:02d}", "taxon_id": str(i)}
                    for i in range(14) for j in range(1 + i % 3)])
    classification = samples.select("sample_accession", F.lit("d").alias("sample_domain"))
    found = gold.top_organisms(samples, classification).collect()
    assert [(r.organism_rank, r.organism, r.sample_count) for r in found] == [
        (k + 1, o, n) for k, (o, n) in enumerate(
            [("o02", 3), ("o05", 3), ("o08", 3), ("o11", 3), ("o01", 2), ("o04", 2), ("o07", 2),
             ("o10", 2), ("o13", 2), ("o00", 1)])]


def test_conservation(tables):
    totals = tables["sra_quality_summary"].first()
    summed = tables["sra_domain_summary"].agg(F.sum("sample_count")).first()[0]
    assert summed == totals.sample_count


def test_summaries_count_blanks_as_missing(lake, tmp_path):
    _, text = lake
    found = summary.count_by_fields(text["sra_run"], ["library_strategy"])
    assert listed(found, "library_strategy", "count") == [("WGS", 4), ("missing", 1)]
    counts = summary.summarize_silver(text, str(tmp_path))
    assert counts == {"sample_domain_counts": 2, "organism_group_counts": 3,
                      "sample_context_counts": 2, "sample_domain_context_counts": 4,
                      "attribute_category_counts": 2, "library_strategy_counts": 2}


def test_counts_keep_the_null_group(lake):
    nulls, _ = lake
    found = summary.count_rows(nulls["sra_run"], ["library_strategy"], "run_count")
    assert listed(found, "library_strategy", "run_count") == [("WGS", 4), (None, 1)]
    found = summary.domain_library_strategy_counts(
        nulls["sra_run"], nulls["sra_sample_classification"])
    assert [tuple(r) for r in found.collect()] == [("human", "WGS", 3), ("unknown", None, 1)]


def test_reports(tables):
    assert len(reports.report_names()) == 8 and len(reports.card_names()) == 15
    for name in reports.report_names():
        reports.report(name, tables).collect()
    for name in reports.card_names():
        reports.card(name, tables).collect()
    overview = reports.report("overview", tables)
    assert listed(overview, "sample_domain", "sample_pct") == [("human", 60.0), ("unknown", 40.0)]
    plan = overview._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    assert listed(reports.report("top_library_strategies", tables), "library_strategy") == [("WGS",)]
    assert listed(reports.card("top_organisms_overall", tables), "organism", "sample_count") == [
        ("missing", 2), ("Homo sapiens", 1)]
    assert listed(reports.card("unknown_pct", tables), "unknown_sample_pct") == [(40.0,)]


# --- quality ---------------------------------------------------------------------------------

def check(df):
    return tuple(df.first()[1:])


def test_unique_key(rows):
    df = rows([{"k": v} for v in ("a", "a", "a", "", "b")])
    assert check(quality.unique_key("n", df, "k")) == (
        "fail", "rows=5; missing=1; duplicates=2", "k is non-empty and unique",
        "Primary key candidate has missing or duplicate values.")
    assert check(quality.unique_key("n", df.where("k = 'b'"), "k"))[0] == "pass"
    assert check(quality.unique_key("n", df.limit(0), "k"))[:2] == (
        "pass", "rows=0; missing=0; duplicates=0")


def test_allowed_values(rows):
    df = rows([{"d": v} for v in ("human", "robot", "alien", "robot", "")])
    status, observed, expected, message = check(quality.allowed_values("n", df, "d", ["plant", "human"]))
    assert (status, observed, expected) == ("fail", " | alien | robot", "human | plant")
    assert check(quality.allowed_values("n", df.where("d = 'human'"), "d", ["human"]))[:2] == ("pass", "none")


@pytest.mark.parametrize("unknown, total, count, fraction, status, observed", [
    (10, 20, 10, 0.001, "pass", "10 (50.000%)"), (11, 20, 10, 0.001, "fail", "11 (55.000%)"),
    (11, 20, 10, 0.6, "pass", "11 (55.000%)"), (0, 0, 10, 0.001, "pass", "0 (0.000%)"),
])
def test_threshold(spark, unknown, total, count, fraction, status, observed):
    df = spark.range(total).select((F.col("id") < unknown).alias("u"))
    found = check(quality.below_threshold("n", df, F.col("u"), count, fraction))
    assert found[:3] == (status, observed, f"<= {count} or <= {fraction:.2%}")


def test_taxonomy_coverage_shows_twenty(rows):
    samples = rows([{"taxon_id": str(i)} for i in range(30)] + [{"taxon_id": ""}])
    missing = sorted(str(i) for i in range(30) if i != 5)
    found = check(quality.taxonomy_coverage("n", samples, rows([{"taxon_id": "5"}])))
    assert found[0] == "fail" and found[1] == "missing=29"
    assert found[3] == "Taxonomy reference is missing sample taxon IDs: " + " | ".join(missing[:20])
    assert check(quality.taxonomy_coverage("n", samples, samples))[1] == "missing=0"


def test_required_fields_and_row_counts(lake):
    _, text = lake
    df = text["sra_sample_attribute"]
    fields = ["sample_accession", "normalized_attribute_name"]
    assert check(quality.required_fields("n", df, fields))[:2] == ("fail", "1")
    assert check(quality.row_count_match("n", df, df))[:3] == ("pass", "4", "4")
    assert check(quality.row_count_match("n", df, df.limit(1)))[:3] == ("fail", "4", "1")


def single_checks(silver, taxonomy):
    """The report as single checks, each with a scan of its own."""
    classified, samples = silver["sra_sample_classification"], silver["sra_sample"]
    return quality.stack([
        quality.unique_key("sra_run_run_accession_unique", silver["sra_run"], "run_accession"),
        quality.unique_key("sra_sample_sample_accession_unique", samples, "sample_accession"),
        quality.unique_key("sra_classification_sample_accession_unique", classified, "sample_accession"),
        quality.row_count_match("sra_sample_classification_matches_samples", classified, samples),
        quality.required_fields("sra_sample_attribute_required_fields_present",
                                silver["sra_sample_attribute"],
                                ["sample_accession", "normalized_attribute_name", "attribute_category"]),
        quality.allowed_values("sra_sample_domain_allowed_values", classified, "sample_domain",
                               SAMPLE_DOMAINS),
        quality.below_threshold("sra_unknown_sample_count_below_threshold", classified,
                                F.col("sample_domain") == "unknown", 1, 0.001),
        quality.unique_key("taxonomy_reference_taxon_id_unique", taxonomy, "taxon_id"),
        quality.allowed_values("taxonomy_reference_sample_domain_allowed_values", taxonomy,
                               "sample_domain", SAMPLE_DOMAINS),
        quality.taxonomy_coverage("taxonomy_reference_covers_sample_taxon_ids", samples, taxonomy),
    ])


def test_one_pass_report_equals_the_single_checks(spark, rows, tmp_path):
    """Faults of every kind; the report reads each table once."""
    faulty = {
        "sra_run": rows([{"run_accession": r} for r in ("R1", "R1", "R1", "", "R2")]),
        "sra_sample": rows([{"sample_accession": f"S{i % 40}", "taxon_id": str(i % 30) if i else ""}
                            for i in range(50)]),
        "sra_sample_attribute": rows([
            {"sample_accession": "S1", "normalized_attribute_name": "", "attribute_category": ""},
            {"sample_accession": "", "normalized_attribute_name": "n", "attribute_category": "c"}]),
        "sra_sample_classification": rows([
            {"sample_accession": f"S{i}", "sample_domain": d} for i, d in enumerate(
                ["human", "unknown", "unknown", "marsian", "", "venusian", "marsian"])]),
    }
    taxonomy = rows([{"taxon_id": t, "sample_domain": d} for t, d in
                     (("1", "human"), ("1", "plant"), ("", "x"), ("99", "y"))])
    empty = {n: t.limit(0) for n, t in faulty.items()}
    for n, (tables, reference) in enumerate([(faulty, taxonomy), (empty, taxonomy.limit(0)),
                                             (empty, taxonomy), (faulty, taxonomy.limit(0))]):
        report = quality.content_report(tables, reference, max_unknown_samples=1)
        assert [tuple(r) for r in report.collect()] == [
            tuple(r) for r in single_checks(tables, reference).collect()], n
    stored = {}
    for name, table in {**faulty, "taxonomy": taxonomy}.items():
        table.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    report = quality.content_report(stored, stored["taxonomy"])
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == len(stored) and plan.count("ReusedExchange") == 1


def test_many_offenders_are_counted_beyond_those_listed(spark, rows, monkeypatch):
    monkeypatch.setattr(quality, "LISTED", 3)
    table = rows([{"sample_accession": f"S{i}", "sample_domain": f"d{i}"} for i in range(8)])
    blank = rows([{"run_accession": "", "taxon_id": "", "normalized_attribute_name": "", "attribute_category": "",
                   "sample_accession": ""}])
    report = quality.content_report({
        "sra_run": blank, "sra_sample": blank, "sra_sample_attribute": blank,
        "sra_sample_classification": table})
    row = report.where("name = 'sra_sample_domain_allowed_values'").first()
    assert row.observed == "d0 | d1 | d2 | and 5 more"


def test_gate(lake):
    _, text = lake
    checks = quality.content_report(text)
    assert [r.status for r in checks.collect()] == [
        "pass", "fail", "fail", "pass", "fail", "pass", "pass"]
    assert quality.gate(checks).first().passed is False
    assert quality.gate(checks.where("status = 'pass'")).first().passed is True


# --- taxonomy --------------------------------------------------------------------------------

def test_missing_ids_in_numeric_order(rows):
    samples = rows([{"taxon_id": t} for t in ("100", " 9 ", "20", "20", "", "x", "7")])
    reference = rows([{"taxon_id": "7"}])
    assert [r.taxon_id for r in taxonomy.missing_ids(samples, reference).collect()] == [
        "9", "20", "100", "x"]
    batches = taxonomy.request_batches(samples, reference, 3).orderBy("batch_number").collect()
    assert [r.ids for r in batches] == [["9", "20", "100"], ["x"]]


def test_dimension_keeps_the_last_row(rows):
    df = rows([{"taxon_id": "1", "rank": "old", "at": "1"}, {"taxon_id": "1", "rank": "new", "at": "2"},
               {"taxon_id": "", "rank": "dropped", "at": "3"}]).withColumnRenamed("at", "row_order")
    found = taxonomy.dimension(df)
    assert found.columns == schemas.TAXONOMY
    assert [(r.taxon_id, r.rank, r.lineage) for r in found.collect()] == [("1", "new", "")]


def test_missing_values_come_last_among_ties(spark):
    runs = spark.createDataFrame(
        [("S1", s, f"E{i}", "1", "2") for i, s in enumerate([None, "WGS", "AMPLICON"])],
        "sample_accession string, library_strategy string, experiment_accession string, "
        "total_spots string, total_bases string")
    domains = spark.createDataFrame([("S1", "human")], "sample_accession string, sample_domain string")
    found = gold.domain_library_strategy(runs, domains).collect()
    assert [r.library_strategy for r in found] == ["AMPLICON", "WGS", None]
    attributes = spark.createDataFrame(
        [("S1", c) for c in (None, "host", "clinical")],
        "sample_accession string, attribute_category string")
    found = gold.attribute_category_by_domain(attributes, domains).collect()
    assert [r.attribute_category for r in found] == ["clinical", "host", None]
