import re
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from seqlake.functions import text
from seqlake.sources.payloads import redacted


def one(spark, expression, **values):
    types = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], types).select(expression).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("river bank side", "river_bank_side"), ("left-hand-rule", "left_hand_rule"),
    (" dose/per day ", "dose_per_day"), ("Mass (wet and/or dry)", "mass_wet_and_or_dry"),
    ("C++ Level", "c_level"),
    ("__A__b__", "a_b"), ("\tÉtat 1\n", "tat_1"), ("***", ""), ("", ""),
])
def test_normalize_attribute_name(spark, raw, expected):
    assert one(spark, text.normalize_attribute_name(F.col("v")), v=raw) == expected


@pytest.mark.parametrize("raw, expected", [
    ("Tundra[Place] OR (ice, Snow)", "tundra-place-or-ice-snow"),
    ("  ", "query"), ("--x--", "x"),
])
def test_slugify(spark, raw, expected):
    assert one(spark, text.slugify(F.col("v")), v=raw) == expected


@pytest.mark.parametrize("raw", [" a ", "\t\na\x1c\x85", " a ", "a b", "", "\n", "a\n\n"])
def test_strip_matches_python(spark, raw):
    assert one(spark, text.strip(F.col("v")), v=raw) == raw.strip()


@pytest.mark.parametrize("existing, new, expected", [
    ("a", "b", "a | b"), ("a | b", "a", "a | b"), ("", "a", "a"), ("b | a", "c", "b | a | c"),
])
def test_merge_source_value(spark, existing, new, expected):
    merged = text.merge_source_value(F.col("e"), F.col("n"))
    assert one(spark, merged, e=existing, n=new) == expected


@pytest.mark.parametrize("path, expected", [
    ("/lake/batches/q1/x.csv", "q1"), ("/lake/batches/q1/deep/x.csv", "q1"),
    ("file:///lake/batches/q1/x.csv", "q1"), ("/lake/batches/x.csv", "root"),
    ("/other/folder/x.csv", "folder"), ("/lake/batches2/q/x.csv", "q"),
])
def test_source_dataset_name(spark, path, expected):
    assert one(spark, text.source_dataset_name(F.col("p"), "/lake/batches/"), p=path) == expected


def test_path_order_compares_folder_by_folder(spark):
    paths = ["/b/a-b/x", "/b/a/x", "/b/a/w", "/b/a.c"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    ordered = [r.p for r in df.orderBy(text.path_parts(F.col("p"))).collect()]
    assert ordered == sorted(paths, key=lambda p: p.split("/"))


URLS = [
    "https://h/x?db=sra&api_key=secret&term=a+b%2Fc", "HTTPS://Host/x?api_key=s#api_key=keep",
    "http://h/x", "http://h/x?", "http://h/x?api_key=", "http://h/x?a&b=&api_key=1&&c=%zz*~!'()",
    "http://h/x?term=100%25&my_api_key=1", "http://h/x?q=%C3%A9t%C3%A9#f", "http://h/?api%5Fkey=1",
]


@pytest.mark.parametrize("url", URLS)
def test_redact_url_matches_a_query_string_rewrite(spark, url):
    parts = urlsplit(url)
    pairs = [(k, "[REDACTED]" if k == "api_key" else v)
             for k, v in parse_qsl(parts.query, keep_blank_values=True)]
    expected = urlunsplit(parts._replace(query=urlencode(pairs)))
    assert one(spark, text.redact_url(F.col("u")), u=url) == expected


def test_landing_table_is_redacted(spark):
    df = spark.createDataFrame([("http://h/?api_key=k", {"api_key": "k", "db": "sra"})],
                               "url string, params map<string,string>")
    row = redacted(df).first()
    assert row.url == "http://h/?api_key=%5BREDACTED%5D"
    assert row.params == {"api_key": "[REDACTED]", "db": "sra"}


def test_utc_stamp(spark):
    stamp = spark.range(1).select(
        text.utc_stamp(F.lit("2026-01-31 23:59:58").cast("timestamp")).alias("fixed"),
        text.utc_stamp().alias("now")).first()
    assert stamp.fixed == "20260131T235958Z"
    assert re.fullmatch(r"\d{8}T\d{6}Z", stamp.now)
