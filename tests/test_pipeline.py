import json

import pytest
from pyspark.sql import functions as F

from seqlake import cli, schemas
from seqlake.plans import lake, serving, taxonomy
from seqlake.plans.lake import LakePaths
from seqlake.operators.attributes import attribute_dictionary
from seqlake.sources import files, manifest, snapshots
from seqlake.streaming import ingest
from test_payloads import PACKAGES, taxon


def write(path, header, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header), *(",".join(r.get(c, "") for c in header) for r in records)]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture
def root(tmp_path):
    """Two overlapping batch folders, a taxonomy reference and its manifest."""
    base = tmp_path / "data"
    batches = base / "bronze/sra/batches"
    run = {"experiment_accession": "SRX70", "run_accession": "SRR1", "sample_accession": "SRS72",
           "biosample_accession": "SAMN1", "organism": "Homo sapiens", "taxon_id": "9606",
           "library_strategy": "RNA-Seq", "total_spots": "10", "total_bases": "100"}
    other = {**run, "experiment_accession": "SRX2", "run_accession": "SRR2", "sample_accession": "SRS2",
             "biosample_accession": "SAMN2", "organism": "Zea mays", "taxon_id": "4577"}
    write(batches / "human" / "sra-bronze-batch-000001.csv", schemas.BRONZE_RUN, run)
    write(batches / "mixed" / "sra-bronze-batch-000001.csv", schemas.BRONZE_RUN, run, other)
    for folder in ("human", "mixed"):
        write(batches / folder / "sra-sample-attributes-batch-000001.csv", schemas.BRONZE_ATTRIBUTE,
              {"sample_accession": "SRS72", "biosample_accession": "SAMN1",
               "attribute_name": "Diagnosis", "attribute_value": "none"})
    write(base / "reference/ncbi_taxonomy/taxonomy_reference.csv", schemas.TAXONOMY,
          {"taxon_id": "9606", "organism_group": "Eukaryota", "sample_domain": "human"},
          {"taxon_id": "4577", "organism_group": "Viridiplantae", "sample_domain": "plant"})
    log = base / "manifests/ncbi_taxonomy/taxonomy-reference-updates.jsonl"
    log.parent.mkdir(parents=True)
    log.write_text("{}\n")
    return base


def test_full_build(spark, root):
    result = lake.build_lake(spark, LakePaths(str(root)), text_copies=True)
    assert result["bronze"] == {"runs": 2, "attributes": 1}
    assert result["silver"] == lake.export_silver(spark, LakePaths(str(root))) == {
        "sra_run": 2, "sra_sample": 2, "sra_sample_attribute": 1, "sra_sample_classification": 2}
    assert result["gold"] == {
        "sra_domain_summary": 2, "sra_context_summary": 2, "sra_domain_library_strategy_summary": 2,
        "sra_top_organisms_by_domain": 2, "sra_attribute_category_by_domain": 1,
        "sra_quality_summary": 1}
    assert result["summary"]["attribute_category_counts"] == 1
    checks = result["checks"].collect()
    assert len(checks) == 22 and result["passed"]
    assert {c.status for c in checks} == {"pass"}
    paths = LakePaths(str(root))
    run = files.read_csv_strings(spark, paths.silver_csv()["sra_run"], schemas.SILVER["sra_run"])
    assert run.where("run_accession = 'SRR1'").first().source_dataset == "human | mixed"
    classified = spark.read.parquet(f"{paths.silver_parquet}/sra_sample_classification.parquet")
    human = classified.where("sample_accession = 'SRS72'").first()
    assert (human.sample_context, human.clinical_present, human.sample_domain) == (
        "clinical", "True", "human")
    assert human.classification_basis.endswith("; clinical_attribute_present; taxonomy_reference_present")


def test_command_line(spark, root, capsys, tmp_path):
    # An uncovered taxon id fails the gate.
    assert cli.main(["--root", str(root), "--csv", "build"]) == 0
    for command in ("combine", "silver", "export-silver", "gold", "summarize", "validate"):
        assert cli.main(["--root", str(root), command]) == 0
    assert cli.main(["--root", str(root), "report", "overview"]) == 0
    assert cli.main(["--root", str(root), "report", "top_strategies"]) == 0
    query = "SELECT sum(run_count) + 39 AS n FROM sra_domain_summary JOIN sra_sample_classification " \
            "USING (sample_domain)"
    assert cli.main(["--root", str(root), "sql", query]) == 0
    assert "|41 |" in capsys.readouterr().out
    assert cli.main(["--root", str(root), "profile"]) == 0
    assert "Profiled attributes: 1" in capsys.readouterr().out
    reference = root / "reference/ncbi_taxonomy/taxonomy_reference.csv"
    write(reference, schemas.TAXONOMY,
          {"taxon_id": "9606", "organism_group": "Eukaryota", "sample_domain": "human"})
    assert cli.main(["--root", str(root), "validate"]) == 1
    assert cli.main(["--root", str(root), "publish", "--schema", "gold_cli"]) == 0
    assert "gold_cli.sra_domain_summary: 2" in capsys.readouterr().out


def test_silver_reads_the_newest_combined_tables(spark, root):
    paths = LakePaths(str(root))
    with pytest.raises(ValueError, match="No files matched sra-bronze-combined"):
        lake.build_silver(spark, paths)
    lake.combine(spark, paths)
    old = snapshots.newest_tables(spark, paths.combined)
    newer = f"{paths.combined}/sra-bronze-combined-29990101T000000Z.parquet"
    spark.read.parquet(old["runs"]).where("run_accession = 'SRR1'").write.parquet(newer)
    # nothing counts until it is committed, whatever its name and time
    assert lake.build_silver(spark, paths)["sra_run"] == 2
    assert snapshots.commit_snapshot(spark, paths.combined, {**old, "runs": newer}) == 2
    assert lake.build_silver(spark, paths)["sra_run"] == 1


def test_a_combine_that_breaks_off_is_never_read(spark, root, monkeypatch):
    paths = LakePaths(str(root))
    lake.combine(spark, paths)
    before = snapshots.newest_tables(spark, paths.combined)
    whole = lake.write_parquet

    def broken(df, path):
        if "attributes" in path:
            raise OSError("executor lost")
        return whole(df, path)

    monkeypatch.setattr(lake, "write_parquet", broken)
    with pytest.raises(OSError):
        lake.combine(spark, paths)
    monkeypatch.setattr(lake, "write_parquet", whole)
    assert snapshots.newest_tables(spark, paths.combined) == before
    lake.combine(spark, paths)
    assert snapshots.newest_tables(spark, paths.combined) != before


def test_snapshot_log(spark, tmp_path):
    folder = str(tmp_path)
    assert snapshots.newest_tables(spark, folder) is None
    assert [snapshots.commit_snapshot(spark, folder, {"t": f"p{i}"}) for i in (1, 2)] == [1, 2]
    log = tmp_path / snapshots.LOG
    # an entry that was not finished is passed over, and its number is not given twice
    (log / "000000000003.json").write_text("")
    (log / "000000000004.json").write_text('{"tables": {"t"')
    assert snapshots.newest_tables(spark, folder) == {"t": "p2"}
    assert snapshots.commit_snapshot(spark, folder, {"t": "p3"}) == 5
    assert [e["number"] for e in snapshots.snapshots(spark, folder)] == [5, 2, 1]
    # a number that another writer took in between is not overwritten
    assert not snapshots._create(spark, f"{folder}/{snapshots.LOG}/000000000005.json", "x")
    assert snapshots.newest_tables(spark, folder) == {"t": "p3"}


def test_quality_report_stops_when_silver_is_missing(spark, tmp_path):
    report = lake.validate(spark, LakePaths(str(tmp_path)))
    rows = report.collect()
    assert [r.name for r in rows] == [f"silver_{n}_exists" for n in schemas.SILVER]
    assert {(r.status, r.message) for r in rows} == {("fail", "Required file is missing.")}


def test_steps_need_their_inputs(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for step, text in ((lake.export_silver, "Silver CSV table"), (lake.build_gold, "Silver Parquet table"),
                       (lake.summarize, "Silver Parquet table")):
        with pytest.raises(ValueError, match=f"Missing required {text}"):
            step(spark, paths)
    with pytest.raises(ValueError, match="Missing required Gold Parquet table"):
        serving.publish_to_catalog(spark, str(tmp_path), "nowhere")


def test_publish_replaces_the_tables(spark, root, monkeypatch):
    paths = LakePaths(str(root))
    lake.combine(spark, paths)
    lake.build_silver(spark, paths)
    counts = lake.build_gold(spark, paths)
    assert serving.publish_to_catalog(spark, paths.gold, "gold_test") == counts
    assert serving.publish_to_catalog(spark, paths.gold, "gold_test") == counts
    # an incomplete load leaves what was published before
    before = spark.table("gold_test.sra_domain_summary").collect()
    fourth = list(schemas.GOLD)[3]
    whole = serving.serving_table

    def broken(name, gold):
        if name == fourth:
            raise OSError("disk full")
        return whole(name, gold).limit(0)

    monkeypatch.setattr(serving, "serving_table", broken)
    with pytest.raises(OSError):
        serving.publish_to_catalog(spark, paths.gold, "gold_test")
    monkeypatch.setattr(serving, "serving_table", lambda n, g: whole(n, g).limit(0))
    with pytest.raises(ValueError, match="incomplete"):
        serving.publish_to_catalog(spark, paths.gold, "gold_test")
    assert spark.table("gold_test.sra_domain_summary").collect() == before
    stored = spark.table("gold_test.sra_quality_summary")
    assert dict(stored.dtypes) == schemas.GOLD["sra_quality_summary"]
    assert stored.first().sample_count == 2


STEPS = ["_stage_load", "_commit_load", "_ensure_views", "_drop_old_loads"]


@pytest.mark.parametrize("stop", STEPS)
def test_a_publish_that_stops_shows_one_load_in_all_views(spark, root, monkeypatch, stop):
    """Stopped before or after any step, the six views show the old load or the new one."""
    paths, schema = LakePaths(str(root)), f"gold_stop{stop}"
    lake.combine(spark, paths)
    lake.build_silver(spark, paths)
    lake.build_gold(spark, paths)
    whole, tag = serving.serving_table, {"v": "old"}
    # every text column says which load it is from
    monkeypatch.setattr(serving, "serving_table", lambda n, g: whole(n, g).withColumns({
        c: F.lit(tag["v"]) for c, kind in schemas.GOLD[n].items() if kind == "string"}))
    text = {n: next(c for c, kind in columns.items() if kind == "string")
            for n, columns in schemas.GOLD.items() if "string" in columns.values()}

    def shown():
        return {r[0] for n, c in text.items() for r in spark.table(f"{schema}.{n}").select(c).collect()}

    serving.publish_to_catalog(spark, paths.gold, schema)
    assert shown() == {"old"}
    tag["v"] = "new"
    step = getattr(serving, stop)

    def stopped(*args):
        step(*args)
        raise OSError("driver lost")

    def before(*args):
        raise OSError("driver lost")

    for broken, then in ((before, STEPS.index(stop) > 1), (stopped, STEPS.index(stop) > 0)):
        monkeypatch.setattr(serving, stop, broken)
        with pytest.raises(OSError):
            serving.publish_to_catalog(spark, paths.gold, schema)
        assert shown() == ({"new"} if then else {"old"})
        monkeypatch.setattr(serving, stop, step)
        tag["v"] = "old"
        serving.publish_to_catalog(spark, paths.gold, schema)
        assert shown() == {"old"}
        tag["v"] = "new"
    # loads that were never published are gone with the old ones
    loads = spark.sql(f"SHOW PARTITIONS `{schema}_loads`.`sra_domain_summary_by_load`").collect()
    assert len(loads) == serving.KEPT_LOADS


def test_views_from_before_the_pointer_are_replaced(spark, root):
    paths = LakePaths(str(root))
    lake.combine(spark, paths)
    lake.build_silver(spark, paths)
    counts = lake.build_gold(spark, paths)
    spark.sql("CREATE SCHEMA IF NOT EXISTS gold_former")
    spark.sql("CREATE OR REPLACE VIEW gold_former.sra_quality_summary AS SELECT 1 AS sample_count")
    spark.range(1).write.mode("overwrite").saveAsTable("gold_former.sra_domain_summary")
    assert serving.publish_to_catalog(spark, paths.gold, "gold_former") == counts
    assert spark.table("gold_former.sra_quality_summary").first().sample_count == 2
    assert spark.table("gold_former.sra_domain_summary").count() == 2


# --- taxonomy update -------------------------------------------------------------------------

def test_taxonomy_update_is_incremental(spark, rows, tmp_path):
    path, log = str(tmp_path / "reference.csv"), str(tmp_path / "log.jsonl")
    samples = rows([{"taxon_id": t} for t in ("5833", "9606", "", "9606")])
    landed = spark.createDataFrame([
        ("1", f"<TaxaSet>{taxon(9606, 'Homo sapiens')}</TaxaSet>"),
        ("2", f"<TaxaSet>{taxon(5833, 'Plasmodium falciparum')}</TaxaSet>")],
        "source_path string, body string")
    first = taxonomy.update_reference(spark, samples, landed.limit(1), path, log)
    assert (first.input_taxon_ids, first.existing_taxon_ids, first.fetched_taxon_ids,
            first.output_taxon_ids) == (2, 0, 1, 1)
    second = taxonomy.update_reference(spark, samples, landed.where("source_path = '2'"), path, log)
    assert (second.existing_taxon_ids, second.output_taxon_ids, second.batch_count) == (1, 2, 1)
    third = taxonomy.update_reference(spark, samples, landed, path, log)
    assert (third.fetched_taxon_ids, third.output_taxon_ids, third.batch_count) == (0, 2, 0)
    rebuilt = taxonomy.update_reference(spark, samples, landed, path, log, rebuild=True)
    assert (rebuilt.existing_taxon_ids, rebuilt.fetched_taxon_ids) == (0, 2)
    newest = files.newest_snapshot(spark, path)
    stored = files.read_csv_strings(spark, newest, schemas.TAXONOMY)
    assert [r.taxon_id for r in stored.collect()] == ["5833", "9606"]
    # a write that broke off is not read
    (tmp_path / "reference-29990101T000000000000Z.csv").mkdir()
    assert files.newest_snapshot(spark, path) == newest
    assert taxonomy.read_reference(spark, path).count() == 2
    events = [json.loads(r.value) for r in spark.read.text(log).collect()]
    assert sorted(e["status"] for e in events) == ["noop", "success", "success", "success"]


def test_later_files_of_a_stored_reference_count(spark, tmp_path):
    """Files of unequal size: Spark packs the large one first, but order goes by path and row."""
    folder = tmp_path / "reference.csv"
    small = [{"taxon_id": "7", "scientific_name": "early"}]
    large = [{"taxon_id": str(i), "scientific_name": f"late {i}"} for i in range(2000)]
    write(folder / "part-00000.csv", schemas.TAXONOMY, *small)
    write(folder / "part-00001.csv", schemas.TAXONOMY, *large,
          {"taxon_id": "9", "scientific_name": "last row"})
    found = {r.taxon_id: r.scientific_name for r in
             taxonomy.read_reference(spark, str(folder)).collect()}
    assert len(found) == 2000
    assert (found["7"], found["9"]) == ("late 7", "last row")


# --- ingestion -------------------------------------------------------------------------------

def batches(spark, *bodies, job="job", start=0):
    return spark.createDataFrame(
        [(job, i + 1 + start, (i + start) * 200, 200, body) for i, body in enumerate(bodies)],
        ingest.BATCHES)


def test_ingestion_is_resumable(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    dictionary = attribute_dictionary(spark)
    landed = batches(spark, PACKAGES, PACKAGES.replace("SRR", "ERR"))
    first = ingest.ingest_batches(landed, bronze, log, "one", dictionary)
    assert first == {"completed_batches": 2, "failed_batches": 0, "run_rows": 8,
                     "sample_attribute_rows": 4, "skipped_batches": 0}
    again = ingest.ingest_batches(landed, bronze, log, "two", dictionary)
    assert (again["completed_batches"], again["skipped_batches"], again["run_rows"]) == (0, 2, 0)
    runs = manifest.read_ingested(spark, bronze, log, "runs")
    assert runs.count() == 8
    assert {r.run_accession for r in runs.where("retstart = 200").collect()} == {"ERR1", "ERR2", ""}
    attributes = manifest.read_ingested(spark, bronze, log, "attributes")
    assert {r.attribute_category for r in attributes.collect()} == {"host_material", "spatiotemporal"}


def test_a_failing_batch_is_recorded_and_raised(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    dictionary = attribute_dictionary(spark)
    broken = batches(spark, PACKAGES, "<EXPERIMENT_PACKAGE_SET><EXPERIMENT")
    with pytest.raises(ingest.IngestError):
        ingest.ingest_batches(broken, bronze, log, "one", dictionary)
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 4
    events = manifest.read_manifest(spark, log)
    assert {(r.retstart, r.status) for r in events.collect()} == {(0, "success"), (200, "failure")}
    mended = batches(spark, PACKAGES, PACKAGES)
    result = ingest.ingest_batches(mended, bronze, log, "two", dictionary)
    assert (result["completed_batches"], result["skipped_batches"]) == (1, 1)
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 8


def test_a_broken_payload_does_not_stop_the_stream(spark, tmp_path):
    landing, bronze, log = (str(tmp_path / n) for n in ("landing", "bronze", "log"))
    dictionary = attribute_dictionary(spark)
    broken = "<EXPERIMENT_PACKAGE_SET><EXPERIMENT"

    def stream():
        ingest.ingest_stream(spark, landing, bronze, log, str(tmp_path / "checkpoint"), dictionary,
                             max_files=1)

    batches(spark, broken).coalesce(1).write.parquet(landing)
    batches(spark, PACKAGES, start=1).coalesce(1).write.mode("append").parquet(landing)
    with pytest.raises(ingest.IngestError, match="1 landed batches"):
        stream()
    runs = manifest.read_ingested(spark, bronze, log, "runs")
    assert {r.retstart for r in runs.collect()} == {200}
    held = spark.read.parquet(f"{bronze}/quarantine").collect()
    assert [(r.job_id, r.retstart, r.error) for r in held] == [
        ("job", 0, "payload is not well-formed XML")]
    # the mended payload, and what else lands
    batches(spark, PACKAGES).coalesce(1).write.mode("append").parquet(landing)
    batches(spark, PACKAGES, start=2).coalesce(1).write.mode("append").parquet(landing)
    stream()
    runs = manifest.read_ingested(spark, bronze, log, "runs")
    assert {r.retstart for r in runs.collect()} == {0, 200, 400} and runs.count() == 12
    events = manifest.read_manifest(spark, log)
    assert sorted((r.retstart, r.status) for r in events.collect()) == [
        (0, "failure"), (0, "success"), (200, "success"), (400, "success")]


def test_a_batch_that_landed_twice_is_ingested_once(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    landed = batches(spark, PACKAGES).unionAll(batches(spark, PACKAGES))
    result = ingest.ingest_batches(landed, bronze, log, "one", attribute_dictionary(spark))
    assert (result["completed_batches"], result["run_rows"], result["skipped_batches"]) == (1, 4, 0)
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 4


def test_payloads_are_not_shuffled(spark, tmp_path):
    landing = str(tmp_path / "landing")
    batches(spark, PACKAGES, PACKAGES).write.parquet(landing)
    arrived = spark.read.schema(ingest.BATCHES).parquet(landing)
    with ingest._pending(arrived, str(tmp_path / "log")) as (pending, landed):
        plan = pending._jdf.queryExecution().executedPlan().toString()
        assert landed == 2 and pending.count() == 2
    assert not any("body" in line for line in plan.split("\n") if "Exchange" in line)


def test_copies_and_versions_of_a_payload(spark, tmp_path):
    """Of several payloads under one key one is taken, the same one in whatever files they lie."""
    dictionary = attribute_dictionary(spark)
    other = PACKAGES.replace("SRR", "ERR")
    rows = [batches(spark, b) for b in (PACKAGES, other, PACKAGES, other, PACKAGES)]
    found = set()
    for n, order in enumerate(([0, 1, 2, 3, 4], [4, 3, 1, 0, 2], [1, 3])):
        landing, bronze, log = (str(tmp_path / f"{x}{n}") for x in ("landing", "bronze", "log"))
        for i in order:
            rows[i].coalesce(1).write.mode("append").parquet(landing)
        result = ingest.ingest_batches(
            spark.read.schema(ingest.BATCHES).parquet(landing), bronze, log, "one", dictionary)
        assert (result["completed_batches"], result["run_rows"]) == (1, 4)
        found.add((len(set(order) & {0, 2, 4}) > 0, frozenset(
            r.run_accession for r in manifest.read_ingested(spark, bronze, log, "runs").collect())))
    assert len({runs for both, runs in found if both}) == 1


def test_a_manifest_is_read_by_job_and_range(spark, tmp_path):
    log, step = str(tmp_path / "log"), manifest.RANGE
    # lines from before there were ranges
    manifest.append_events(spark.sql("SELECT 'success' AS status, 'a' AS job_id, 0L AS retstart"), log)
    event = lambda job, at: spark.createDataFrame(
        [("success", job, at)], "status string, job_id string, retstart bigint")
    for job in ("a", "b/c d=ü", None):
        for at in (0, 200, step, 5 * step + 7):
            manifest.append_batch_events(event(job, at), log)
    assert manifest.read_manifest(spark, log).count() == 13
    wanted = spark.createDataFrame([("a", 400), ("b/c d=ü", 5 * step), ("absent", 0)],
                                   "job_id string, retstart bigint")
    some = manifest.read_manifest(spark, log, wanted)
    assert sorted((r.job_id, r.retstart) for r in some.collect()) == [
        ("a", 0), ("a", 0), ("a", 200), ("b/c d=ü", 5 * step + 7)]
    # what is read does not grow with the rest of the manifest
    files = lambda: len(set(manifest.read_manifest(spark, log, wanted).inputFiles()))
    before = files()
    for at in range(10, 16):
        manifest.append_batch_events(event("a", at * step), log)
    assert files() == before


def test_manifest_folders_are_compacted(spark, tmp_path):
    log = str(tmp_path / "log")
    for i in range(5):
        manifest.append_batch_events(spark.createDataFrame(
            [("success", "a", i * 200)], "status string, job_id string, retstart bigint"), log)
    before = sorted(map(tuple, manifest.read_manifest(spark, log).collect()))
    assert manifest.compact_manifest(spark, log, above=5) == 0
    assert manifest.compact_manifest(spark, log, above=4) == 1
    assert sorted(map(tuple, manifest.read_manifest(spark, log).collect())) == before
    assert len(manifest.read_manifest(spark, log).inputFiles()) == 1


def test_events_name_query_and_files(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    landed = batches(spark, PACKAGES, "<broken").withColumns(
        {"query": F.lit("plants"), "raw_xml_path": F.lit("/raw/b1.xml")})
    ingest.ingest_batches(landed, bronze, log, "one", attribute_dictionary(spark), quarantine=True)
    good, bad = manifest.read_manifest(spark, log).orderBy("retstart").collect()
    assert (good.query, good.raw_xml_path) == (bad.query, bad.raw_xml_path) == ("plants", "/raw/b1.xml")
    assert spark.read.parquet(good.bronze_path).count() == 4
    assert spark.read.parquet(good.sample_attributes_path).count() == 2
    assert bad.bronze_path is None and bad.error


def test_unconfirmed_rows_stay_invisible(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    dictionary = attribute_dictionary(spark)
    ingest.ingest_batches(batches(spark, PACKAGES), bronze, log, "one", dictionary)
    spark.read.parquet(f"{bronze}/runs").drop("ingest_id").write.parquet(f"{bronze}/runs/ingest_id=lost")
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 4


def test_stream_picks_up_new_files_only(spark, tmp_path):
    landing, bronze, log = (str(tmp_path / n) for n in ("landing", "bronze", "log"))
    dictionary = attribute_dictionary(spark)
    stream = lambda: ingest.ingest_stream(
        spark, landing, bronze, log, str(tmp_path / "checkpoint"), dictionary, max_files=1)
    batches(spark, PACKAGES, PACKAGES).repartition(2).write.parquet(landing)
    stream()
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 8
    stream()
    batches(spark, PACKAGES, start=5).write.mode("append").parquet(landing)
    stream()
    assert manifest.read_ingested(spark, bronze, log, "runs").count() == 12
    assert manifest.read_manifest(spark, log).count() == 3


def test_ingested_batches_feed_the_lake(spark, root):
    """Ingested XML and batch files merge into one bronze table, with lineage of both."""
    paths = LakePaths(str(root))
    known = PACKAGES.replace("SRR1", "SRR9")
    ingest.ingest_batches(batches(spark, PACKAGES, known, job="job-x"), paths.ingested,
                          paths.ingest_manifest, "one", attribute_dictionary(spark))
    result = lake.build_lake(spark, paths)
    # SRX70/SRR1 is known from two batch files; new are SRR2, SRR9, the bare package and the empty one.
    assert result["bronze"]["runs"] == 2 + 4
    run = spark.read.parquet(paths.silver_tables()["sra_run"])
    # SRR2 is in SRX70 of job-x and in SRX2 of mixed; the folder that sorts first wins.
    assert {r.run_accession: r.source_dataset for r in run.collect()} == {
        "SRR1": "human | job-x | mixed", "SRR2": "job-x", "SRR9": "job-x"}
    merged = lake.read_combined(spark, paths)["runs"]
    first = merged.where("run_accession = 'SRR1'").first()
    assert first.source_file == "sra-bronze-batch-000001.csv"
    assert first.library_strategy == "RNA-Seq" and first.platform == ""
    again = merged.where("experiment_accession = 'SRX2' AND run_accession = ''").first()
    assert again.source_file == "sra-bronze-batch-000001.csv | sra-bronze-batch-000002.csv"


def test_a_lake_can_be_built_from_ingested_batches_alone(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    ingest.ingest_batches(batches(spark, PACKAGES), paths.ingested, paths.ingest_manifest, "one",
                          attribute_dictionary(spark))
    (tmp_path / "bronze/sra/batches/empty").mkdir(parents=True)
    result = lake.build_lake(spark, paths)
    assert result["silver"]["sra_run"] == 2 and not result["passed"]


def test_fetches_are_planned_from_searches_and_manifest(spark, tmp_path):
    answer = lambda count, key: json.dumps(
        {"esearchresult": {"count": str(count), "querykey": key, "webenv": "W"}})
    searches = spark.createDataFrame([("a", answer(450, "1")), ("b", answer(5000, "2"))],
                                     "job_id string, body string")
    log = str(tmp_path / "log")
    manifest.append_events(spark.sql("SELECT 'success' AS status, 'a' AS job_id, 200L AS retstart"), log)
    events = manifest.read_manifest(spark, log)
    planned = ingest.plan_fetches(searches, events, 200, 1000).collect()
    assert sorted((r.job_id, r.batch_number, r.retstart, r.retmax, r.query_key) for r in planned) == [
        ("a", 1, 0, 200, "1"), ("a", 3, 400, 50, "1"),
        *[("b", i + 1, i * 200, 200, "2") for i in range(5)]]
    with pytest.raises(ValueError, match="max_records"):
        ingest.plan_fetches(searches, events, 200, 0)
    bare = spark.createDataFrame([("c", answer(5, ""))], "job_id string, body string")
    with pytest.raises(Exception, match="history handles"):
        ingest.plan_fetches(bare, events, 200).collect()


def test_raw_landing_is_ingested_from_the_command_line(spark, tmp_path):
    landing = spark.createDataFrame([
        ("/raw/sra/job-7/esearch.json", "esearch", "u", {"retstart": "0"}, 200, "json", "{}"),
        ("/raw/sra/job-7/b1.xml", "efetch", "u", {"retstart": "0", "retmax": "200"}, 200, "xml", PACKAGES),
        ("/raw/sra/job-7/b2.xml", "efetch", "u", {"retstart": "200", "retmax": "200"}, 200, "xml",
         PACKAGES.replace("SRR", "ERR")),
    ], schemas.LANDING)
    landing.write.parquet(str(tmp_path / "landing"))
    command = ["--root", str(tmp_path), "ingest", "--landing", str(tmp_path / "landing")]
    assert cli.main(command) == 0 and cli.main(command) == 0
    paths = LakePaths(str(tmp_path))
    rows = manifest.read_ingested(spark, paths.ingested, paths.ingest_manifest, "runs")
    assert {(r.job_id, r.batch_number) for r in rows.collect()} == {("job-7", 1), ("job-7", 2)}
    assert rows.count() == 8


def test_planning_commands(spark, root, tmp_path):
    paths = LakePaths(str(root))
    lake.combine(spark, paths)
    lake.build_silver(spark, paths)
    answer = json.dumps({"esearchresult": {"count": "450", "querykey": "1", "webenv": "W"}})
    spark.createDataFrame([("a", answer)], "job_id string, body string").write.parquet(
        str(tmp_path / "searches"))
    out = str(tmp_path / "out")
    assert cli.main(["--root", str(root), "plan-fetches", "--searches", str(tmp_path / "searches"),
                     "--output", f"{out}-fetches"]) == 0
    assert spark.read.option("header", True).csv(f"{out}-fetches").count() == 3
    write(root / "reference/ncbi_taxonomy/taxonomy_reference.csv", schemas.TAXONOMY)
    assert cli.main(["--root", str(root), "taxonomy-batches", "--batch-size", "1",
                     "--output", f"{out}-ids"]) == 0
    rows = spark.read.option("header", True).csv(f"{out}-ids").collect()
    assert sorted((r.batch_number, r.ids) for r in rows) == [("1", "4577"), ("2", "9606")]


def test_scratch_is_discarded(spark, tmp_path):
    from seqlake import session

    kept = session.materialize(spark.range(3), "kept")
    path = kept.inputFiles()[0]
    assert files.exists(spark, path)
    session.discard_scratch(spark)
    assert not files.exists(spark, path)


def test_preview(spark):
    search = spark.createDataFrame([('{"esearchresult": {"idlist": ["1", "2", "3", "4"]}}',)], "body string")
    ids, runs, attributes = ingest.preview(search, batches(spark, PACKAGES), 3)
    assert (ids.count(), runs.count(), attributes.count()) == (3, 4, 2)
