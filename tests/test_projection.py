import pytest
from pyspark.sql import functions as F

from kgspark.operators import enrichment, projection, relational
from kgspark.sources import catalog, landing

RECORD = """claim_review_id string, source_name string, record_key string, claim_uri string, organization_uri string, urls array<string>, date_published string, language string, review_text string,
description string, abstract string, keywords array<string>, license_url string, authors array<struct<name:string,website:string,role:string,source_uri:string>>, label string, original_label string,
rating_value double, best_rating double, worst_rating double, explanation string, claim_text string, headline string, appearances array<string>, note string"""
NAMES = [f.split()[0] for f in RECORD.replace("\n", " ").replace("struct<name:string,website:string,role:string,source_uri:string>", "x").split(",")]


def _records(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in rows], RECORD)


def _row(**more):
    return {"claim_review_id": "r", "source_name": "s", "record_key": "1", "claim_uri": "claim/1", "organization_uri": "org/1", "claim_text": "text"} | more


def test_records_of_nulls_and_none(spark):
    bare = _records(spark, _row())
    by = {r["part"]: r["n"] for r in projection.record_quads(bare).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert by == {"review": 3, "claim": 2}
    empty = _records(spark, _row()).limit(0)
    for f in (projection.record_quads, projection.source_views, projection.grouped, projection.export_errors):
        assert f(empty).count() == 0
    assert projection.gathered(empty, "claim_review_id").count() == 0
    assert [tuple(r) for r in projection.gathered(bare, "claim_review_id").collect()] == [("r", [], [])]


def test_source_view_takes_the_fullest_record(spark):
    rows = _records(
        spark, _row(record_key="1", description="long text", keywords=["b", "a"]), _row(record_key="2", description="", language="en", date_published="2024-01-01", keywords=["c"], authors=[("A", None, None, None)]),
        _row(record_key="3", description="other txt", language="en", abstract="x", keywords=["a"]),
    )
    r = projection.source_views(rows).collect()
    assert len(r) == 1 and r[0]["record_key"] == "2" and r[0]["description"] == "long text" and r[0]["abstract"] == "x"  # the first of equal length
    assert r[0]["keywords"] == ["a", "b", "c"] and [a["name"] for a in r[0]["authors"]] == ["A"]


def test_selected_record_and_drift(spark):
    rows = _records(spark, _row(record_key="1", claim_uri="claim/9"), _row(record_key="2"), _row(record_key="3"))
    own = lambda uri: spark.createDataFrame([("r", uri)], "claim_review_id string, claim_uri string")
    assert [projection.selected(rows, own(u)).first()["record_key"] for u in ("claim/1", "claim/none", None)] == ["2", "1", "1"]
    reviews = spark.createDataFrame([("r", "org/1", "https://a.org"), ("q", "org/2", None)], "claim_review_id string, organization_uri string, organization_site string")
    now = spark.createDataFrame([("https://a.org", "org/1")], "site string, organization_uri string")
    assert [tuple(r) for r in projection.organization_drift(reviews, now).collect()] == [("q", "org/2", None)]


def test_iris_of_sources_are_sanitised_or_dropped(spark):
    rows = _records(spark, _row(urls=["https://a.org/x y", "https://a.org/x%20y", "ftp://b", None], license_url="CC BY", appearances=["ftp://b"], authors=[("", "", "editor", None), ("N", "https://n.org", None, "ftp://b")]))
    q = projection.record_quads(rows)
    assert [r["o"] for r in q.filter("part = 'url'").collect()] == ["https://a.org/x%20y"]
    assert [(r["o"], r["o_kind"]) for r in q.filter("part = 'keyword'").collect()] == [("CC BY", "literal")]
    assert q.filter("part = 'claim' and p like '%appearance'").count() == 0
    assert sorted(r["p"].rsplit("/")[-1].rsplit("#")[-1] for r in q.filter("part = 'person'").collect()) == ["author", "name", "type", "url"]


def test_factor_values(spark):
    rows = [("a", "emotion", '{"value":"Joy"}'), ("b", "emotion", '{"value":3}'), ("c", "tropes", '{"value":["x",1,null,"y"]}'), ("d", "climate_related", '{"value":" TRUE "}'), ("e", "climate_related", '{"value":"perhaps"}'), ("f", "climate_related", "{}"), ("g", "conspiracies", '{"value":{"mentioned":["m"]}}'), ("h", "tropes", "no json"), ("i", "tropes", None)]
    got = {r["subject_key"]: r for r in projection.factor_values(spark.createDataFrame(rows, "subject_key string, model string, payload string")).collect()}
    assert got["a"]["texts"] == ["Joy"] and got["b"]["texts"] == [] and got["c"]["texts"] == ["x", "y"] and got["g"]["mentioned"] == ["m"] and got["g"]["promoted"] == []
    assert got["d"]["flag"] is True and got["e"]["failed"] and not got["f"]["failed"] and got["h"]["texts"] == [] and got["i"]["texts"] == []


def test_catalog_rules(spark):
    rdf, s = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://schema.org/"
    t = lambda *rows: spark.createDataFrame(list(rows), "s string, p string, o string, o_kind string")
    one = [("o:1", rdf, s + "Organization", "iri"), ("o:1", s + "name", "A", "literal"), ("o:1", s + "url", "https://b.org", "iri"), ("o:1", s + "url", "http://www.a.org/", "iri")]
    good, errors = catalog.organization_catalog(t(*one), "o:")
    assert sorted((r["site"], r["website"]) for r in good.collect()) == [("https://a.org", "https://a.org"), ("https://b.org", "https://a.org")] and errors.count() == 0
    two = [("o:2", rdf, s + "Organization", "iri"), ("o:2", s + "name", " ", "literal"), ("o:2", s + "url", "a.org", "iri")]
    good, errors = catalog.organization_catalog(t(*one, *two), "o:")
    assert good.count() == 0 and sorted(tuple(r) for r in errors.collect()) == [("o:1", "site_shared"), ("o:2", "name"), ("o:2", "site_shared")]
    assert [tuple(r) for r in catalog.organization_catalog(t(*one).limit(0), "o:")[1].collect()] == [(None, "no_organization")]


def test_short_texts_and_extractions(spark):
    x = enrichment.skip_short(spark.createDataFrame([("a", "short"), ("b", "long enough"), ("c", None)], "subject_key string, input string"))
    assert {r["subject_key"]: r["payload"] is None for r in x.collect()} == {"a": False, "b": True, "c": False}
    o = spark.createDataFrame([("k",), ("n",)], "document_key string")
    e = spark.createDataFrame([("k", "success", "c"), ("n", "permanent_failure", "d")], "document_key string, status string, content string")
    assert sorted(map(tuple, relational.with_extraction(o, e).collect())) == [("k", "c"), ("n", None)]


@pytest.mark.parametrize(("text", "n"), [("50B", 50), ("50kb", 50 << 10), ("1.5 GB", 3 << 29), ("2TB", 2 << 40), ("77", 77), ("", 10 << 20), (None, 10 << 20), ("many MB", 10 << 20), ("1.5", 10 << 20)])
def test_sizes(text, n):
    assert landing.size_in_bytes(text) == n
