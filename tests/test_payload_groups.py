"""Tables of payloads are stored in Parquet row groups of few rows, which bounds a reader's batch."""

from pathlib import Path

import pyarrow.parquet as pq

from seqlake.operators.attributes import attribute_dictionary
from seqlake.sources import payloads
from seqlake.streaming import ingest
from test_payloads import PACKAGES
from testbed import inputs, queries
from testbed.stages import Stages

FEW = 64


def largest_group(folder):
    files = [pq.ParquetFile(p).metadata for p in Path(folder.removeprefix("file:")).glob("*.parquet")]
    return max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups))


def test_landed_packages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PACKAGES_PER_BATCH", 1)
    (spark.range(800).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
        "1.0D AS l_extendedprice", "2.0D AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    packages = Stages(spark, str(tmp_path)).packages()
    assert packages.count() == 800
    folder = packages.inputFiles()[0].rsplit("/", 1)[0]
    assert largest_group(folder.replace("file://", "")) <= FEW


def test_landing_table(spark, tmp_path):
    responses = spark.range(300).coalesce(1).selectExpr(
        "'efetch' AS utility", "concat('u', id) AS url", "map('retstart', string(id)) AS params",
        "'x' AS body", "concat('p', id) AS source_path")
    columns = [c if c in responses.columns else f"CAST(NULL AS {t}) AS {c}"
               for c, t in ((f.name, f.dataType.simpleString()) for f in payloads.schemas.LANDING)]
    payloads.land(responses.selectExpr(*columns), f"{tmp_path}/landing")
    assert spark.read.parquet(f"{tmp_path}/landing").count() == 300
    assert largest_group(f"{tmp_path}/landing") <= FEW


def test_parsed_packages(spark, tmp_path, monkeypatch):
    groups, stored = {}, ingest.stored

    def watched(df, label, **options):
        context = stored(df, label, **options)
        enter = context.__enter__

        class Watched:
            def __enter__(self):
                table = enter()
                folder = table.inputFiles()[0].rsplit("/", 1)[0]
                groups[label] = largest_group(folder.replace("file://", ""))
                return table

            def __exit__(self, *error):
                return context.__exit__(*error)
        return Watched()

    monkeypatch.setattr(ingest, "stored", watched)
    landed = spark.range(200).coalesce(1).selectExpr(
        "'job' AS job_id", "id + 1 AS batch_number", "id AS retstart", "1L AS retmax").crossJoin(
        spark.createDataFrame([(PACKAGES,)], "body string"))
    result = ingest.ingest_batches(landed.coalesce(1), f"{tmp_path}/bronze", f"{tmp_path}/log", "one",
                                   attribute_dictionary(spark))
    assert result["completed_batches"] == 200
    assert groups["parsed"] <= FEW


def test_package_dumps_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PACKAGES_PER_BATCH", 3)
    (spark.range(100).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
        "1.0D AS l_extendedprice", "2.0D AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    stages, written = Stages(spark, str(tmp_path)), []
    read = payloads.read_package_dumps

    def watched(session, path, **options):
        written.append(session.read.text(path).inputFiles())
        return read(session, path, **options)

    monkeypatch.setattr(payloads, "read_package_dumps", watched)
    assert queries.xml_bulk_run_records(stages).count() == 100
    assert 2 <= len(written[0]) <= max(2, spark.sparkContext.defaultParallelism // 2)
    plan = queries.dump_bodies(stages)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" in plan and "Exchange" not in plan
