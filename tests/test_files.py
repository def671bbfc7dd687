import os
import random
import time

import pytest
from pyspark.sql import functions as F

from seqlake.operators.attributes import attribute_dictionary
from seqlake.plans import bronze
from seqlake.schemas import BRONZE_ATTRIBUTE, BRONZE_RUN
from seqlake.sources import files, manifest


def run_line(**values):
    return ",".join(values.get(c, "") for c in BRONZE_RUN)


def write_runs(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(BRONZE_RUN), *lines]) + "\n")


def test_csv_round_trip_keeps_text_as_it_is(spark, rows, tmp_path):
    data = [{"a": 'say "hi", twice', "b": "two\nlines"}, {"a": "", "b": " padded "}, {"a": "007", "b": "\\"}]
    files.write_csv(rows(data), str(tmp_path / "t.csv"))
    back = files.read_csv_strings(spark, str(tmp_path / "t.csv"), ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted((r["a"], r["b"]) for r in data)
    assert dict(back.dtypes) == {"a": "string", "b": "string"}


def test_a_different_header_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,c\n1,2\n")
    with pytest.raises(Exception):
        files.read_csv_strings(spark, str(tmp_path / "t.csv"), ["a", "b"]).collect()


def test_runs_merge_across_batch_folders(spark, tmp_path):
    root = tmp_path / "batches"
    key = {"experiment_accession": "SRX1", "run_accession": "SRR1"}
    write_runs(root / "q-b" / "sra-bronze-batch-000001.csv", run_line(**key, organism="third"))
    write_runs(root / "q" / "sra-bronze-batch-000002.csv", run_line(**key, organism="second"),
               run_line(experiment_accession="SRX2", organism="lone"))
    write_runs(root / "q" / "sra-bronze-batch-000001.csv", run_line(**key, organism="first"))
    write_runs(root / "sra-bronze-batch-000009.csv", run_line(**key, organism="in root"))
    write_runs(root / "q" / "ignored.csv", run_line(**key, organism="ignored"))
    merged = bronze.combine_files(spark, str(root), bronze.RUN_PATTERN, BRONZE_RUN,
                                  ["experiment_accession", "run_accession"])
    found = {r.experiment_accession: r for r in merged.collect()}
    assert found["SRX1"].organism == "first"
    assert found["SRX1"].source_dataset == "q | q-b | root"
    assert found["SRX1"].source_file == (
        "sra-bronze-batch-000001.csv | sra-bronze-batch-000002.csv | sra-bronze-batch-000009.csv")
    assert (found["SRX2"].source_dataset, len(found)) == ("q", 2)


def test_attributes_are_renormalized_before_the_merge(spark, tmp_path):
    folder = tmp_path / "b" / "q 1+2"
    folder.mkdir(parents=True)
    (folder / "sra-sample-attributes-batch-000001.csv").write_text(
        ",".join(BRONZE_ATTRIBUTE) + "\nS,B,Geo loc-name,x,stale,stale\nS,B,geo_loc_name,x,a,b\n")
    df = files.read_bronze_batches(spark, str(tmp_path / "b"), bronze.ATTRIBUTE_PATTERN, BRONZE_ATTRIBUTE)
    merged = bronze.combine_attributes(df, attribute_dictionary(spark)).collect()
    assert len(merged) == 1
    row = merged[0]
    assert (row.attribute_name, row.normalized_attribute_name, row.attribute_category) == (
        "Geo loc-name", "geo_loc_name", "spatiotemporal")
    assert (row.source_dataset, row.source_file) == ("q 1+2", "sra-sample-attributes-batch-000001.csv")


def test_a_row_transformation_can_be_passed(spark, tmp_path):
    write_runs(tmp_path / "q" / "a.csv", run_line(run_accession="x1"), run_line(run_accession="X1"))
    merged = bronze.combine_files(
        spark, str(tmp_path), "*.csv", BRONZE_RUN, ["run_accession"],
        lambda df: df.withColumn("run_accession", F.upper("run_accession")))
    assert [r.run_accession for r in merged.collect()] == ["X1"]


def test_headers_may_differ(spark, tmp_path):
    for path, content in {
        "q1/a.csv": "k,v,w\n1,first,w1\n", "q2/a.csv": "v,k\nsecond,1\nx,2\n", "a.csv": "k,w\n3,root\n",
    }.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(content)
    merged = bronze.combine_files(spark, str(tmp_path), "*.csv", ["k", "v", "w"], ["k"])
    assert sorted((r.k, r.v, r.w, r.source_dataset) for r in merged.collect()) == [
        ("1", "first", "w1", "q1 | q2"), ("2", "x", "", "q2"), ("3", "", "root", "root")]
    with pytest.raises(ValueError, match="Unexpected columns .*: w"):
        files.read_bronze_batches(spark, str(tmp_path), "*.csv", ["k", "v"])
    # also within one folder, with quoted names, a byte order mark and line breaks in values
    (tmp_path / "q1" / "b.csv").write_text('\ufeff"w","k"\r\n"a\nb",4\r\n')
    rows = files.read_bronze_batches(spark, str(tmp_path), "*.csv", ["k", "v", "w"])
    assert {(r.k, r.v, r.w, r.source_dataset) for r in rows.collect()} == {
        ("1", "first", "w1", "q1"), ("1", "second", "", "q2"), ("2", "x", "", "q2"),
        ("3", "", "root", "root"), ("4", "", "a\nb", "q1")}


def test_no_input_files_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="No CSV files matched"):
        files.read_bronze_batches(spark, str(tmp_path), "*.csv", BRONZE_RUN)
    with pytest.raises(ValueError, match="No CSV files matched"):
        files.read_bronze_batches(spark, str(tmp_path / "absent"), "*.csv", BRONZE_RUN)


def test_latest_matching(spark, tmp_path):
    for i, name in enumerate(["t-1.csv", "t-2.csv", "u.csv"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (time.time() - i * 60,) * 2)
    assert files.latest_matching(spark, str(tmp_path), "t-*.csv").endswith("/t-1.csv")
    with pytest.raises(ValueError, match="No files matched"):
        files.latest_matching(spark, str(tmp_path), "z*")


def test_a_table_that_broke_off_is_not_the_latest(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t-1.parquet"))
    spark.range(1).write.parquet(str(tmp_path / "t-2.parquet"))
    (tmp_path / "t-2.parquet" / "_SUCCESS").unlink()
    os.utime(tmp_path / "t-2.parquet", (time.time() + 60,) * 2)
    assert files.latest_matching(spark, str(tmp_path), "t-*.parquet").endswith("/t-1.parquet")


def test_required_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="Missing required Gold Parquet table: .*/g.parquet"):
        files.read_tables(spark, str(tmp_path), ["g"], "Gold Parquet table")


def test_null_boundary_and_projection(rows):
    df = rows([{"a": "", "b": "x"}])
    assert files.blanks_to_null(df).first().asDict() == {"a": None, "b": "x"}
    assert files.project_fields(df, ["b", "missing"]).first().asDict() == {"b": "x", "missing": ""}


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m.jsonl")
    assert manifest.read_manifest(spark, path).count() == 0
    events = spark.sql("""SELECT * FROM VALUES ('success', 0L), ('failure', 200L), ('success', 400L),
        ('success', 0L) AS t(status, retstart)""")
    manifest.append_events(events.where("retstart < 300"), path)
    manifest.append_events(events.where("retstart > 300"), path)
    (tmp_path / "m.jsonl" / "extra.json").write_text('\n{"status": "success", "retstart": 800}\n\n')
    done = manifest.completed_offsets(manifest.read_manifest(spark, path))
    assert sorted(r.retstart for r in done.collect()) == [0, 400, 800]
    line = spark.read.text(path).where("value LIKE '%failure%'").first().value
    assert line.startswith('{"created_at":"2') and line.index("retstart") < line.index("status")


# --- large files -----------------------------------------------------------------------------

def random_csv(seed, records, newline):
    """Fields with quotes, commas and line breaks, quoted or not, and quotes inside plain fields."""
    draw = random.Random(seed)

    def field():
        if draw.random() < 0.4:
            inner = "".join(draw.choice(['a', 'é', ',', '""', newline, ' ', '""""']) for _ in range(draw.randrange(12)))
            return f'"{inner}"'
        return "".join(draw.choice("xyz 0") for _ in range(draw.randrange(1, 6))) + draw.choice(["", 'q"q', '"'])
    return newline.join(",".join(field() for _ in range(3)) for _ in range(records)) + newline


@pytest.mark.parametrize("seed, newline, block", [
    (1, "\n", 40), (2, "\n", 7), (3, "\r\n", 50), (4, "\n", 4000), (5, "\n", 300)])
def test_a_large_file_is_read_in_blocks(spark, tmp_path, seed, newline, block):
    columns = ["a", "b", "c"]
    path = tmp_path / "q" / "t.csv"
    path.parent.mkdir()
    path.write_bytes((f"a,b,c{newline}" + random_csv(seed, 300, newline)).encode())
    (tmp_path / "q" / "u.csv").write_text('a,b,c\n"x\n""y""",2,3\n')
    read = lambda split: files.read_csv_strings(
        spark, str(tmp_path), columns, "*.csv", with_source=True, split_above=split)
    order = ["row_order.path", "row_order.row"]
    whole = [tuple(r) for r in read(1 << 40).orderBy(*order).select("source_file", *columns).collect()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        split = read(100)
        if block < 1000:
            scanned = spark.read.option("lineSep", "\n").text(str(path))
            assert scanned.rdd.getNumPartitions() > 3
        rows = split.orderBy(*order).select("source_file", *columns).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in rows] == whole
    assert len(whole) == 301


def test_a_quoted_field_over_many_blocks(spark, tmp_path):
    long = "\n".join(f"line {i}, of many" for i in range(400))
    (tmp_path / "t.csv").write_text(f'a,b\n1,"{long}"\n2,"x"\n3,"{long}"')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        rows = files.read_csv_strings(spark, str(tmp_path / "t.csv"), ["a", "b"], split_above=0).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, rows)) == [("1", long), ("2", "x"), ("3", long)]


def test_a_large_file_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv_strings(spark, str(tmp_path / "t.csv"), ["a", "b"], split_above=0).collect()
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert files.read_csv_strings(spark, str(tmp_path / "empty.csv"), ["a", "b"], split_above=0).collect() == []
