import json

import pytest

from seqlake.sources import payloads

PACKAGES = """<?xml version="1.0"?>
<EXPERIMENT_PACKAGE_SET>
  <EXPERIMENT_PACKAGE>
    <EXPERIMENT accession="SRX70"><STUDY_REF accession="SRP-ref"/>
      <DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY> RNA-Seq
        </LIBRARY_STRATEGY><LIBRARY_SOURCE>TRANSCRIPTOMIC</LIBRARY_SOURCE>
        <LIBRARY_SELECTION>cDNA</LIBRARY_SELECTION>
        <LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH="3"/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN>
      <PLATFORM><ILLUMINA><INSTRUMENT_MODEL> NovaSeq </INSTRUMENT_MODEL></ILLUMINA></PLATFORM>
    </EXPERIMENT>
    <STUDY accession="SRP71"><IDENTIFIERS><EXTERNAL_ID namespace="Other">x</EXTERNAL_ID>
      <EXTERNAL_ID namespace="BioProject"></EXTERNAL_ID>
      <EXTERNAL_ID namespace="BioProject">PRJ1</EXTERNAL_ID></IDENTIFIERS></STUDY>
    <SAMPLE accession="SRS72"><IDENTIFIERS>
        <EXTERNAL_ID namespace="BioSample">SAMN1</EXTERNAL_ID></IDENTIFIERS>
      <SAMPLE_NAME><TAXON_ID>9606</TAXON_ID><SCIENTIFIC_NAME>Homo sapiens</SCIENTIFIC_NAME></SAMPLE_NAME>
      <SAMPLE_ATTRIBUTES>
        <SAMPLE_ATTRIBUTE><TAG>Tissue</TAG><VALUE>blood &amp; bone</VALUE></SAMPLE_ATTRIBUTE>
        <SAMPLE_ATTRIBUTE><TAG>geo loc name</TAG></SAMPLE_ATTRIBUTE>
      </SAMPLE_ATTRIBUTES></SAMPLE>
    <RUN_SET><RUN accession="SRR1" total_spots="10" total_bases="100"/><RUN accession="SRR2"/></RUN_SET>
  </EXPERIMENT_PACKAGE>
  <EXPERIMENT_PACKAGE>
    <EXPERIMENT accession="SRX2"><STUDY_REF accession="SRP2"/><PLATFORM/></EXPERIMENT>
    <SAMPLE accession="SRS2"><SAMPLE_ATTRIBUTES/></SAMPLE>
  </EXPERIMENT_PACKAGE>
  <EXPERIMENT_PACKAGE><RUN_SET/></EXPERIMENT_PACKAGE>
</EXPERIMENT_PACKAGE_SET>"""


def landed(spark, *bodies):
    return spark.createDataFrame([(f"p{i}", b) for i, b in enumerate(bodies)],
                                 "source_path string, body string")


def test_run_records(spark):
    parsed = payloads.parse_packages(landed(spark, PACKAGES))
    found = payloads.run_records(parsed).orderBy("package_index", "run_index").collect()
    assert [r.run_accession for r in found] == ["SRR1", "SRR2", "", ""]
    first, second, bare, empty = found
    assert first.asDict() | {"package_index": 0, "run_index": 0} == {
        "package_index": 0, "run_index": 0, "experiment_accession": "SRX70", "run_accession": "SRR1",
        "study_accession": "SRP71", "bioproject_accession": "PRJ1", "sample_accession": "SRS72",
        "biosample_accession": "SAMN1", "organism": "Homo sapiens", "taxon_id": "9606",
        "library_strategy": "RNA-Seq", "library_source": "TRANSCRIPTOMIC",
        "library_selection": "cDNA", "library_layout": "PAIRED", "platform": "ILLUMINA",
        "instrument_model": "NovaSeq", "total_spots": "10", "total_bases": "100"}
    assert (second.total_spots, second.platform) == ("", "ILLUMINA")
    assert (bare.study_accession, bare.platform, bare.instrument_model) == ("SRP2", "", "")
    assert set(empty[2:]) == {""}


def test_sample_attributes_keep_document_order(spark):
    parsed = payloads.parse_packages(landed(spark, PACKAGES))
    found = payloads.sample_attributes(parsed, ["source_path"]).orderBy("attribute_index").collect()
    assert [(r.source_path, r.biosample_accession, r.attribute_name, r.attribute_value) for r in found] == [
        ("p0", "SAMN1", "Tissue", "blood & bone"), ("p0", "SAMN1", "geo loc name", "")]


def test_attributes_on_mapped_elements_are_no_entries(spark):
    marked = PACKAGES.replace("<PLATFORM>", '<PLATFORM\n a="1" >').replace(
        "<LIBRARY_LAYOUT>", '<LIBRARY_LAYOUT b="2">').replace("<PLATFORM/>", '<PLATFORM c="3"/>')
    first, _, bare, _ = payloads.run_records(payloads.parse_packages(landed(spark, marked))).orderBy(
        "package_index", "run_index").collect()
    assert (first.platform, first.instrument_model, first.library_layout) == (
        "ILLUMINA", "NovaSeq", "PAIRED")
    assert bare.platform == ""


def test_malformed_payload_is_reported(spark):
    parsed = payloads.parse_packages(landed(
        spark, PACKAGES, "<EXPERIMENT_PACKAGE_SET><EXP", "", None, "text", "<EXPERIMENT_PACKAGE_SET/>"))
    assert {r.source_path for r in parsed.where("parse_error IS NOT NULL").collect()} == {
        "p1", "p2", "p3", "p4"}


def taxon(taxon_id, name, rank="species", entries=()):
    lineage = "".join(f"<Taxon><TaxId>{i}</TaxId><ScientificName>{n}</ScientificName><Rank>{r}</Rank></Taxon>"
                      for i, n, r in entries)
    return (f"<Taxon><TaxId>{taxon_id}</TaxId><ScientificName>{name}</ScientificName><Rank>{rank}</Rank>"
            f"<ParentTaxId>7</ParentTaxId><Lineage>a; b</Lineage><LineageEx>{lineage}</LineageEx></Taxon>")


def test_taxonomy_rows(spark):
    entries = [(2759, "Eukaryota", "superkingdom"), (33630, "Alveolata", "clade"),
               (5794, "Apicomplexa", "phylum"), (5819, "Old genus", "genus"), (5820, "Plasmodium", "genus")]
    body = f"<TaxaSet>{taxon(5833, 'Plasmodium falciparum', entries=entries)}{taxon('', 'dropped')}</TaxaSet>"
    again = f"<TaxaSet>{taxon(1, 'first')}{taxon(1, 'second')}{taxon(2, 'kept', 'genus')}</TaxaSet>"
    later = f"<TaxaSet>{taxon(1, 'third', 'strain', [(9, 'A species', 'species')])}</TaxaSet>"
    found = {r.taxon_id: r for r in payloads.taxonomy_rows(
        landed(spark, body, again, later), "source_path").collect()}
    assert set(found) == {"5833", "1", "2"}
    row = found["5833"]
    assert (row.superkingdom, row.phylum, row.genus, row.species) == (
        "Eukaryota", "Apicomplexa", "Plasmodium", "Plasmodium falciparum")
    assert (row.kingdom, row["class"], row["order"]) == ("", "", "")
    assert row.lineage_taxon_ids == "2759 | 33630 | 5794 | 5819 | 5820"
    assert (row.organism_group, row.sample_domain, row.parent_taxon_id) == ("Protists", "protist", "7")
    assert (found["1"].scientific_name, found["1"].species) == ("third", "A species")


def test_malformed_taxonomy_raises(spark):
    with pytest.raises(Exception):
        payloads.taxonomy_rows(landed(spark, "<TaxaSet><Taxon>"), "source_path").collect()


def test_search_responses(spark):
    full = json.dumps({"esearchresult": {"count": "12", "querykey": "1", "webenv": "W",
                                         "idlist": ["5", "6"]}})
    numbers = json.dumps({"esearchresult": {"count": 3, "idlist": [7]}})
    bare = json.dumps({"header": {}})
    df = landed(spark, full, numbers, bare)
    assert sorted((r.source_path, r.uid) for r in payloads.search_ids(df, ["source_path"]).collect()) == [
        ("p0", "5"), ("p0", "6"), ("p1", "7")]
    found = {r.source_path: r for r in payloads.search_history(df, ["source_path"]).collect()}
    assert (found["p0"]["count"], found["p0"].query_key, found["p0"].webenv, found["p0"].ids) == (
        12, "1", "W", ["5", "6"])
    assert (found["p1"]["count"], found["p1"].webenv) == (3, "")
    assert (found["p2"]["count"], found["p2"].query_key, found["p2"].ids) == (0, "", [])


def test_payloads_are_parsed_once_per_row(spark):
    parsed = payloads.parse_packages(landed(spark, PACKAGES))
    for df in (payloads.run_records(parsed), payloads.sample_attributes(parsed),
               payloads.taxonomy_rows(landed(spark, "<TaxaSet/>"), "source_path")):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1


def test_landing_appends_redacted_rows(spark, tmp_path):
    from seqlake.schemas import LANDING

    path = str(tmp_path / "landing")
    response = spark.createDataFrame(
        [("p", "esearch", "http://h/?api_key=k", {"api_key": "k"}, 200, "text/xml", "<x/>")], LANDING)
    payloads.land(response, path)
    payloads.land(response, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and "k'" not in str(stored.select("url", "params").collect())


def test_a_dump_is_cut_into_packages(spark, tmp_path):
    """The same rows as from whole documents, from blocks much smaller than the file."""
    again = PACKAGES.replace("SRR", "ERR").replace("<EXPERIMENT_PACKAGE>", "<EXPERIMENT_PACKAGE\n>", 1)
    (tmp_path / "a.xml").write_text(PACKAGES)
    (tmp_path / "b.xml").write_text(again)
    (tmp_path / "c.xml").write_text(PACKAGES[: PACKAGES.index("<SAMPLE_ATTRIBUTE>")])
    whole = payloads.parse_packages(landed(spark, PACKAGES, again))
    wanted = sorted(map(str, payloads.run_records(whole).drop("package_index").collect()))
    attributes = sorted(map(str, payloads.sample_attributes(whole).drop("package_index").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        cut = payloads.read_package_dumps(spark, str(tmp_path))
        assert spark.read.option("lineSep", "</EXPERIMENT_PACKAGE>").text(str(tmp_path)) \
            .rdd.getNumPartitions() > 6
        good, bad = cut.where("parse_error IS NULL"), cut.where("parse_error IS NOT NULL")
        found = payloads.run_records(good).drop("package_index").collect()
        assert sorted(map(str, found)) == wanted
        rows = payloads.sample_attributes(good).drop("package_index").collect()
        assert sorted(map(str, rows)) == attributes
        assert [r.source_path.rsplit("/", 1)[1] for r in bad.collect()] == ["c.xml"]
        first = good.where("source_path LIKE '%a.xml'").orderBy("row_order.block", "row_order.row").first()
        assert first.packages[0]["EXPERIMENT"]["_accession"] == "SRX70"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
