"""What the payload queries leave on disk: no shuffled texts, dumps in rounds, compressed tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seqlake.operators import batches
from seqlake.session import shared_dir
from seqlake.sources import payloads
from seqlake.streaming import ingest
from testbed import inputs, queries, stages
from testbed.stages import Stages


@pytest.fixture
def lines(spark, tmp_path, monkeypatch):
    """60 lines in batches of 3, among them equal ones and one without a part."""
    monkeypatch.setattr(inputs, "PACKAGES_PER_BATCH", 3)
    (spark.range(60).selectExpr(
        "id DIV 2 AS l_orderkey", "cast(id % 7 + 1 AS int) AS l_linenumber",
        "if(id = 5, NULL, id % 11) AS l_partkey", "id % 6 AS l_suppkey", "id * 1.5D AS l_extendedprice",
        "cast(id % 50 + 1 AS double) AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus")
     .unionAll(spark.sql("SELECT 4L, 1, 2L, 2L, 3D, 50D, 'R', 'F' FROM range(2)"))
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    return Stages(spark, str(tmp_path))


def folders(spark, label):
    return set(Path(f"{shared_dir(spark).removeprefix('file:')}/seqlake").glob(f"{label}-*"))


def test_only_lines_are_sorted_for_landed_packages(spark, lines, monkeypatch):
    sorted_, stored = [], batches.stored
    monkeypatch.setattr(batches, "stored", lambda df, *a, **k: sorted_.append(df.columns) or stored(df, *a, **k))
    monkeypatch.setattr(stages, "PAYLOADS_PER_FILE", 2)
    before = folders(spark, "row-index")
    found = {r.retstart: r for r in lines.packages().collect()}
    assert [set(c) - {"__at"} for c in sorted_] == [set(inputs.PACKAGE_ORDER)]
    assert folders(spark, "row-index") == before
    # the plain reading of the same SQL
    plain = lines.sql(inputs.PACKAGES, "lineitem").orderBy(*inputs.PACKAGE_ORDER).collect()
    for at in range(0, len(plain), 3):
        texts = [r.package for r in plain[at:at + 3]]
        assert found[at].body == "<EXPERIMENT_PACKAGE_SET>" + "".join(
            t for t in texts if t is not None) + "</EXPERIMENT_PACKAGE_SET>"
        assert (found[at].job_id, found[at].batch_number, found[at].retmax) == (
            f"job-{at // 3 % 4}", at // 3 + 1, len(texts))
    assert len(found) == -(-len(plain) // 3)
    files = lines.packages().groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in files) <= 2


def test_dumps_are_written_and_deleted_in_rounds(spark, lines, monkeypatch):
    monkeypatch.setattr(queries, "DUMP_BYTES", 1)
    rounds, read = [], payloads.read_package_dumps

    def watched(session, path, **options):
        parent = Path(path.removeprefix("file:")).parent
        rounds.append(sorted(p.name for p in parent.glob("dumps-*")))
        return read(session, path, **options)

    monkeypatch.setattr(payloads, "read_package_dumps", watched)
    found = queries.xml_bulk_run_records(lines)
    landed = lines.packages().select(F.col("_metadata.file_name")).distinct().count()
    assert rounds == [[f"dumps-{n}"] for n in range(landed)] and landed > 1
    wanted = queries.xml_run_records(lines)
    assert sorted(found.collect()) == sorted(wanted.collect()) and found.columns == wanted.columns
    path = Path(lines.path("dumped", lambda p: None).removeprefix("file:"))
    assert not list(path.glob("dumps-*"))


def test_dumps_of_no_packages(spark, tmp_path):
    spark.range(0).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
        "1.0D AS l_extendedprice", "2.0D AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    assert queries.xml_bulk_run_records(Stages(spark, str(tmp_path))).collect() == []


def test_ingested_tables_are_stored_with_zstd(spark, lines, tmp_path, monkeypatch):
    options, stored = {}, ingest.stored

    def watched(df, label, **given):
        options[label] = given
        return stored(df, label, **given)

    monkeypatch.setattr(ingest, "stored", watched)
    bronze = f"{tmp_path}/bronze"
    done = ingest.ingest_batches(lines.packages(), bronze, f"{tmp_path}/log", "one", lines.dictionary)
    assert done["completed_batches"] == lines.packages().count() and not done["failed_batches"]
    assert {o["compression"] for o in options.values()} == {"zstd"} and set(options) == {"landed-batches", "parsed"}
    for kind in ("runs", "attributes"):
        files = [p.name for p in Path(bronze).glob(f"{kind}/*/*.parquet")]
        assert files and all(name.endswith(".zstd.parquet") for name in files)
