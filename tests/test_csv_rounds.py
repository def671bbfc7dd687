"""The lines of a split CSV file are shuffled once, in rounds of chunks; what they were stored for goes."""

from pathlib import Path

import pytest

from seqlake import session
from seqlake.session import SHUFFLE_CLEANUP, shared_dir
from seqlake.sources import csv_split, files


def folders(spark, label):
    return set(Path(f"{shared_dir(spark).removeprefix('file:')}/seqlake").glob(f"{label}-*"))


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_over_chunks_and_rounds(spark, tmp_path, monkeypatch, newline):
    monkeypatch.setattr(csv_split, "CHUNK_BITS", 3)
    monkeypatch.setattr(csv_split, "LINES_PER_ROUND", 20)
    long = newline.join(f"line {i}, ""of"" many" for i in range(30))
    rows = [f'{i},"a{newline}""b""{newline}c"' if i % 3 else f"{i},x" for i in range(40)] + [f'40,"{long}"', "41,"]
    (tmp_path / "t.csv").write_bytes(newline.join(["a,b", *rows]).encode())
    parts, write = [], csv_split.materialize_parts
    monkeypatch.setattr(csv_split, "materialize_parts", lambda found, *a, **k: parts.append(len(found)) or write(found, *a, **k))
    before = folders(spark, "csv-lines")
    read = lambda above: files.read_csv_strings(
        spark, str(tmp_path), ["a", "b"], "*.csv", with_source=True, split_above=above)
    split = read(0)
    assert folders(spark, "csv-lines") == before
    assert parts[0] > 3
    order = ["row_order.path", "row_order.row"]
    found = split.orderBy(*order).select("a", "b").collect()
    assert found == read(1 << 40).orderBy(*order).select("a", "b").collect() and len(found) == 42


def test_a_written_table_takes_its_shuffle_files_along(spark):
    seen, before = [], spark.conf.get(SHUFFLE_CLEANUP)
    with session.shuffles_dropped(spark):
        seen.append(spark.conf.get(SHUFFLE_CLEANUP))
    assert seen == ["true"] and spark.conf.get(SHUFFLE_CLEANUP) == before
    table = session.materialize_parts([spark.range(5).toDF("a"), spark.range(5, 9).toDF("a")], "parts")
    assert sorted(r.a for r in table.collect()) == list(range(9))
