import decimal
import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kgspark.functions import text, urls
from kgspark.operators import enrichment, extraction, identity, rdf, relational
from kgspark.plans import graph_queries, registry, sparql, views
from kgspark.sources import formats, landing, turtle
from kgspark.streaming import merge

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return None if isinstance(v, float) and math.isnan(v) else int(v) if isinstance(v, float) and v == int(v) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_is_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = duck.sql(f"select {', '.join(chr(34) + c + chr(34) for c in got.columns)} from ({registry.ORACLE_SQL[name]})").fetchall()
    order = lambda r: repr(tuple(map(_plain, r)))
    assert sorted(map(order, got.collect())) == sorted(map(order, rows))


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5 and set(entry.oracle_sql()) <= set(entry.queries())


def _col(spark, f, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(f(F.col("v"))).collect()]


def test_scalars(spark):
    assert _col(spark, text.canonical_text, ["  &amp; Check\xa0this\n https://example.com &lt;tag&gt; ", None, "&amp;lt;"]) == ["& Check this https://example.com <tag>", None, "<"]
    assert _col(spark, text.analysis_text, ["see HTTPS://x.y/z now"]) == ["see now"]
    assert _col(spark, text.claim_problem, ["", "https://a.b", "[…]", "B12", "日本", None]) == ["empty", "url_only", "no_alphanumeric", None, None, "empty"]
    assert _col(spark, text.rating_label, ["False", " TRUE ", "unknown", "Not-Credible", "mostly credible", None]) == ["not_credible", "credible", None, "not_credible", "mostly_credible", None]
    sites = ["http://www.check-site.org", "check-site.org/", "https://WWW.check-site.org/en?x#y", "https://user:p@check-site.org:443", "http://check-site.org:80", "https://a.org:8080/", "ftp://a.org", "https://mañana.com", ""]
    assert _col(spark, urls.organization_url, sites) == ["https://check-site.org"] * 5 + ["https://a.org:8080", None, "https://xn--maana-pta.com", None]
    safe = ["https://a.org/x y", "https://a.org/%20%zz", "https://a.org:bad/", "https://u:p@a.org/é?q=a&b#f f", "ftp://a.org", "https://a b.org"]
    assert _col(spark, urls.sanitize_url, safe) == ["https://a.org/x%20y", "https://a.org/%20%25zz", None, "https://a.org/%C3%A9?q=a&b#f%20f", None, None]
    assert _col(spark, urls.document_url, ["HTTPS://A.org:443#x", "http://a.org:8080/p?q#f"]) == ["https://a.org/", "http://a.org:8080/p?q"]
    assert _col(spark, text.identity_text, ["Straße, ﬁn!", "", None]) == ["strasse fin", "", None]
    assert urls.canonical_link('<link rel="x"><LINK REL="Canonical" href=" /p?a=1 ">', "https://a.org/z") == "https://a.org/p?a=1"
    assert _col(spark, lambda c: urls.access_challenge(c, F.lit("https://a/")), ["x cf-chl-y", "hCaptcha", "hcaptcha g-recaptcha", None]) == [True, False, True, False]


def test_identity_partition_and_stickiness(spark):
    rows = [("a", "o1", "u1", "h1", "c1"), ("b", "o1", "u2", "h1", "c1"), ("c", "o1", "u1", "h2", "c2"), ("d", "o2", "u1", "h1", "c1")]
    cols = "record_key string, organization_uri string, document_key string, text_hash string, claim_uri string"
    first = identity.resolve(spark.createDataFrame(rows, cols)).select("record_key", "document_id", "claim_review_id").collect()
    assert len({r.document_id for r in first}) == 2 and len({r.claim_review_id for r in first}) == 3
    assert sorted(first) == sorted(identity.resolve(spark.createDataFrame(rows[::-1], cols)).select("record_key", "document_id", "claim_review_id").collect())
    known = spark.createDataFrame(first)
    changed = [(k, o, u, h, "new") for k, o, u, h, _ in rows]
    assert sorted(identity.resolve(spark.createDataFrame(changed, cols), known).select("record_key", "document_id", "claim_review_id").collect()) == sorted(first)
    split = spark.createDataFrame([("a", "D1", "R1"), ("c", "D2", "R2")], "record_key string, document_id string, claim_review_id string")
    with pytest.raises(ValueError, match="two known"):
        identity.resolve(spark.createDataFrame(rows, cols), split)
    chain = [(f"k{i:02}", "o", f"u{i // 2}", f"h{(i + 1) // 2}", "c") for i in range(30)]
    assert {r.founder for r in identity.document_classes(identity.evidence(spark.createDataFrame(chain, cols))).collect()} == {"k00"}


def test_enrichment_life_cycle(spark):
    items, now = spark.createDataFrame([("k1", "text one"), ("k1", "text one"), ("k2", "two"), ("k3", None)], "key string, value string"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    empty = spark.createDataFrame([], "enricher string, subject_key string, enricher_version string, input_hash string, config_hash string, status string, retry_at timestamp, payload string, updated_at timestamp")

    def broken(texts):
        raise RuntimeError("outage")

    good = enrichment.Enricher("m", "1", "key", "value", lambda t: [json.dumps({"value": x.upper()}) for x in t])
    bad = enrichment.Enricher("m", "1", "key", "value", broken)
    subjects = enrichment.subjects(items, good)
    work = lambda results, at, **f: {r.work: r.n for r in enrichment.summary(enrichment.plan(subjects, results, good, at, **f)).collect()}
    assert work(empty, now) == {"pending": 2} and work(empty, now, offline=True) == {"missing": 2}
    failed = enrichment.run(enrichment.plan(subjects, empty, bad, now), bad, now)
    assert work(failed, now) == {"deferred": 2} and work(failed, now + F.expr("interval 2 hours")) == {"pending": 2} and work(failed, now, ignore_cache=True) == {"pending": 2}
    done = enrichment.run(enrichment.plan(subjects, failed, good, now + F.expr("interval 2 hours")), good, now)
    assert work(done, now) == {"cached": 2}
    assert {r.subject_key: json.loads(r.payload)["value"] for r in enrichment.apply(subjects, done, good).collect()} == {"k1": "TEXT ONE", "k2": "TWO"}
    linked = json.dumps({"Resources": [{"@URI": "u:1", "@surfaceForm": "x", "@types": "A,B", "@similarityScore": "0.9", "@support": "3", "@offset": "1"}, {"@URI": "u:2", "@similarityScore": "0.1"}]})
    found = enrichment.entities(spark.createDataFrame([("k", linked)], "subject_key string, payload string"), 0.5)
    assert [(r.uri, r.types, r.support) for r in found.collect()] == [("u:1", ["A", "B"], 3)]
    facts = spark.createDataFrame([("u:1", "p", "v2", "literal"), ("u:1", "p", "v1", "uri"), ("u:1", "p", "v1", "uri"), ("u:1", "q", "x", "uri"), ("u:1", "p", "_:b", "bnode")], "entity string, property string, value string, kind string")
    assert [tuple(r) for r in enrichment.entity_properties(found, facts, ["p"]).collect()] == [("u:1", "p", ["v1", "v2"])]


def test_fetch_cools_hosts_down(spark):
    targets = spark.createDataFrame([(f"{h}{k}", f"https://{h}.org/{k}") for h in "abc" for k in range(20)], "document_key string, url string")

    def get(url):
        if "b.org" in url:
            return {"error_type": "http_error", "http_status": 429}
        if "c.org" in url:
            raise OSError
        return {"http_status": 200, "content": "x"}

    rows = extraction.fetch(targets, get).collect()
    assert len(rows) == 60 and sum(r.requested for r in rows if r.host == "b.org") == 1 and {r.error_type for r in rows if r.host == "c.org"} == {"unknown"}


def test_sparql_subset(spark):
    q = views.quads(spark, SF).cache()
    assert sparql.sparql(q, f"PREFIX s: <{views.SCHEMA}> ASK {{ ?x a s:Claim }}").first().answer is True
    assert sparql.sparql(q, f"PREFIX s: <{views.SCHEMA}> ASK {{ ?x a s:Nothing }}").first().answer is False
    with pytest.raises(ValueError, match="cross product"):
        sparql.sparql(q, "SELECT ?a ?b WHERE { ?a <x:p> <x:o> . ?b <x:p> <x:o> }")
    tiny = spark.createDataFrame([("g1", "c1", views.RDF_TYPE, views.SCHEMA + "Claim"), ("g2", "c1", views.RDF_TYPE, views.SCHEMA + "Claim"), ("g1", "c2", views.RDF_TYPE, views.SCHEMA + "Claim"), ("g1", "c1", views.ONTOLOGY + "hasEmotion", "e1"), ("g1", "c1", views.ONTOLOGY + "hasEmotion", "e2"), ("g1", "c2", views.ONTOLOGY + "promotesConspiracy", "k")], "graph string, s string, p string, o string").withColumns({"o_kind": F.lit("iri"), "o_datatype": F.lit("")})
    assert graph_queries.enrichment_coverage(tiny).collect() == graph_queries.enrichment_coverage_sparql(tiny).collect()
    assert graph_queries.claim_factors(tiny).collect() == graph_queries.claim_factors_sparql(tiny).collect()
    assert graph_queries.claim_factors(q).collect() == graph_queries.claim_factors_sparql(q).collect()
    assert [tuple(r) for r in graph_queries.class_distribution(tiny).collect()] == [(views.SCHEMA + "Claim", 2)]


def _graph(spark, *rows):
    """Quads of (s, p, o[, kind[, datatype[, graph]]])."""
    full = [(r[5] if len(r) > 5 else "g", r[0], r[1], r[2], r[3] if len(r) > 3 else "iri", r[4] if len(r) > 4 else "") for r in rows]
    return spark.createDataFrame(full, "graph string, s string, p string, o string, o_kind string, o_datatype string")


def _answers(q, text):
    return sorted((tuple(r) for r in sparql.sparql(q, text).collect()), key=repr)


def test_sparql_terms_have_kinds(spark):
    q = _graph(spark, ("a", "p", "http://x/", "literal"), ("b", "p", "http://x/"), ("c", "p", "1", "literal", "xsd:int"), ("d", "p", "1", "literal"), ("http://x/", "r", "z"))
    assert _answers(q, "SELECT ?s WHERE { ?s <p> <http://x/> }") == [("b",)] and _answers(q, 'SELECT ?s WHERE { ?s <p> "http://x/" }') == [("a",)]
    assert _answers(q, 'SELECT ?s WHERE { ?s <p> "1" }') == [("d",)]
    assert _answers(q, "SELECT ?s ?z WHERE { ?s <p> ?o . ?o <r> ?z }") == [("b", "z")]
    assert _answers(q, "SELECT (COUNT(DISTINCT ?o) AS ?n) WHERE { ?s <p> ?o }") == [(4,)]


def test_sparql_unbound_variables_order_and_values(spark):
    q = _graph(spark, ("a", "t", "T"), ("b", "t", "T"), ("c", "t", "T"), ("a", "p", "1"), ("a", "q", "2"), ("b", "q", "3"), ("1", "n", "N1"), ("3", "n", "N3"))
    two = "SELECT ?x ?y WHERE { ?x <t> <T> . OPTIONAL { ?x <p> ?y } OPTIONAL { ?x <q> ?y } }"
    assert _answers(q, two) == [("a", "1"), ("b", "3"), ("c", None)]
    # a pattern after OPTIONAL is joined after it: an unbound ?y takes what the pattern gives
    assert _answers(q, "SELECT ?x ?y WHERE { ?x <t> <T> . OPTIONAL { ?x <p> ?y } ?x <q> ?y }") == [("b", "3")]
    assert _answers(q, "SELECT ?x WHERE { VALUES ?x { <a> <z> } ?x <t> <T> }") == [("a",)] and _answers(q, "SELECT ?x WHERE { VALUES ?x { <a> <z> } }") == [("a",), ("z",)]
    assert _answers(q, "SELECT ?x ?n WHERE { ?x <t> <T> . ?y <n> ?n . ?x <q> ?y }") == [("b", "N3")]
    assert _answers(q, 'SELECT ?x ?y WHERE { ?x <t> <T> . OPTIONAL { ?x <q> ?y . FILTER(STRSTARTS(STR(?x), "b")) } }') == [("a", None), ("b", "3"), ("c", None)]
    assert _answers(q, "SELECT ?x ?n WHERE { { SELECT ?x (COUNT(?y) AS ?n) WHERE { ?x <t> <T> . OPTIONAL { ?x <q> ?y } } GROUP BY ?x } ?x <p> ?z }") == [("a", "1")]
    with pytest.raises(ValueError, match="bound already"):
        sparql.sparql(q, "SELECT ?x WHERE { ?x <t> <T> . BIND(<a> AS ?x) }")


def test_graph_plans_are_their_sparql(spark):
    q = views.quads(spark, SF).cache()
    classes = sparql.sparql(q, "SELECT ?class (COUNT(?s) AS ?count) WHERE { ?s a ?class } GROUP BY ?class ORDER BY DESC(?count)").collect()
    assert sorted(map(tuple, classes)) == sorted(map(tuple, graph_queries.class_distribution(q).collect()))
    volume = sparql.sparql(q, "SELECT ?graph (COUNT(*) AS ?n) WHERE { GRAPH ?graph { ?a ?b ?c } } GROUP BY ?graph").collect()
    assert sorted(map(tuple, volume)) == sorted(map(tuple, graph_queries.triple_volume(q).collect()))
    assert graph_queries.sample_claims(q, 10).count() == 10
    q.unpersist()


def test_publish_gate(spark, tmp_path):
    lines = rdf.nt_lines(views.quads(spark, SF))
    shut = f"{views.BASE}/graph/src1"
    table = {r.graph: r for r in rdf.publish(lines, f"{tmp_path}/nt", [shut]).collect()}
    assert not table[shut].published and sum(r.lines for r in table.values() if r.published) == spark.read.text(f"{tmp_path}/nt").count()


def test_formats(spark, tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value, indent=1))
        return str(tmp_path / name)

    checker, review = {"name": "F", "website": "http://www.f.org/x", "language": "en"}, lambda x: {"original_label": x, "date_published": "2024-01-02"}
    item = lambda claims, reviews: {"claim_text": claims, "review_url": "https://f.org/1", "fact_checker": checker, "reviews": reviews, "appearances": ["https://x.y", None]}
    path = put("a.json", [item(["c1 one", "c2 two"], [review("false"), review("true")]), item(["c3 x"], [review("a"), review("b")]), item(["c4 x", "[…]"], [review("true")]), item(["p", "q"], [review("1"), review("2"), review("3")]), {"claim_text": [], "review_url": ""}])
    good, bad = formats.read_source(spark, "review_items", path, "s")
    assert sorted((r.claim_text, r.original_label, r.discriminator, r.label) for r in good.collect()) == [("c1 one", "false", "0", "not_credible"), ("c2 two", "true", "1", "credible"), ("c3 x", "a", "0", None), ("c3 x", "b", "1", None), ("c4 x", "true", "0", "credible")]
    assert {e for r in bad.collect() for e in r.errors} >= {"claim_no_alphanumeric", "ambiguous", "claims", "url", "checker", "reviews"}
    assert {r.organization_site for r in good.collect()} == {"https://f.org"} and {tuple(r.appearances) for r in good.collect()} == {("https://x.y",)}
    good, bad = formats.read_source(spark, "articles", put("b.json", [{"url": "https://n.org/a", "title": " ", "description": "Some &amp; text", "category": "False", "date": "March 5, 2024"}, {"title": "x"}]), "s")
    assert [(r.claim_text, r.date_published, r.label) for r in good.collect()] == [("Some & text", "2024-03-05", "not_credible")] and bad.count() == 1
    good, _ = formats.read_source(spark, "debunks", put("c.json", [{"id": "1", "externalUrl": "https://d.org/p", "headline": "H", "reviewBody": "B", "itemReviewed": {"text": "a claim"}, "language": ["fr", "en"], "dateCreated": "2024-02-03T10:00:00Z"}]), "s")
    assert [(r.review_text, r.language, r.date_published) for r in good.collect()] == [("H\nB", "fr", "2024-02-03")]
    good, bad = formats.read_source(spark, "wiki_pages", put("d.json", [{"id": "xwiki:Medias.M.p1", "organization_url": "https://m.org", "title": "", "rawTitle": "Raw title", "absoluteUrl": "https://w.org/1", "content": "**Bold** [[label>>target]] {{macro/}}"}, {"id": "xwiki:Medias.M.p2", "organization_url": "https://m.org", "title": "x", "absoluteUrl": "/rel"}]), "s")
    assert [(r.claim_text, r.review_text) for r in good.collect()] == [("Raw title", "Bold label")] and bad.count() == 1
    good, bad = formats.read_source(spark, "evidence_lines", put("e.jsonl", json.dumps({"claim_id": "0", "claim": "Ice melts", "claim_label": "SUPPORTS", "evidences": [{"article": "Sea ice", "evidence": "e1"}, {"article": "Sea ice", "evidence": "e2"}]}) + "\nnot json\n"), "s")
    assert [(r.label, r.review_text, r.appearances) for r in good.collect()] == [("credible", "1. e1\n2. e2", ["https://en.wikipedia.org/wiki/Sea_ice"])] and bad.count() == 1
    ttl = '@prefix s: <https://schema.org/> .\n<https://x/c1> a s:Claim ; s:abstract "A real claim"@en ; s:url "https://x/1" ; s:publisher <https://pub.org> .\n<https://x/c2> a s:Claim ; s:abstract "no" ; s:url "u" .\n<https://x/r1> a s:ClaimReview ; s:url <https://x/r> ; s:claimReviewed [ s:text "anglais"@fr, "English claim"@en ] ; s:publisher [ s:url "https://pub.org/" ] ; s:reviewRating [ s:name "False" ; s:ratingValue 1.5 ] .'
    good, bad = formats.read_source(spark, "turtle_claims", put("f.ttl", ttl), "s")
    assert [r.claim_text for r in good.collect()] == ["A real claim"] and bad.count() == 1
    good, _ = formats.read_source(spark, "turtle_reviews", put("f.ttl", ttl), "s")
    assert [(r.claim_text, r.label, r.organization_site) for r in good.collect()] == [("English claim", "not_credible", "https://pub.org")]


def test_turtle_parser():
    t = turtle.TurtleParser('@base <http://b/> . @prefix p: <http://p#> .\n<x> p:a "q\\"\\n\\u00e9"@EN-gb , """l"ng""" ; p:b 1, 2.5, 3e1, true, "t"^^p:T ; p:c ( 1 _:n ) . # end').parse()
    assert t[:2] == [("http://b/x", "http://p#a", 'q"\né', "literal", "", "en-gb"), ("http://b/x", "http://p#a", 'l"ng', "literal", "", "")] and len(t) == 12
    with pytest.raises(ValueError):
        turtle.TurtleParser("<a> <b> .").parse()


def test_landing(tmp_path):
    clock = [0.0]
    area, config = landing.Landing(str(tmp_path / "land"), 10, lambda: clock[0]), {"path": str(tmp_path / "x.gz")}
    import gzip

    (tmp_path / "x.gz").write_bytes(gzip.compress(b"[1]"))
    with pytest.raises(landing.SourceError):
        area.fetch("s", "file", config, skip_download=True)
    assert area.fetch("s", "file", config).read_bytes() == b"[1]"
    clock[0] = 20
    assert area.get("s", config) is None and area.fetch("s", "file", config, skip_download=True) and area.stats() == {"entries": 1, "bytes": 3, "expired": 1}
    assert json.loads(landing.paged_provider({"page_size": 2}, lambda at, n: list(range(5))[at : at + n])) == [0, 1, 2, 3, 4]
    with pytest.raises(landing.SourceError):
        landing.bounded(iter([b"12", b"34"]), 3)
    for k in range(5):
        (tmp_path / "snap" / f"2024-0{k}").mkdir(parents=True)
    (tmp_path / "snap" / "2024-00" / "x.lock").touch()
    assert landing.keep_newest(str(tmp_path / "snap"), 3) == ["2024-01"] and area.clear("s") == 1


def test_streaming_merge_and_windows(spark, tmp_path):
    schema = "id long, source_name string, payload string, first_seen_at string"
    for k, rows in enumerate([[(1, "s", "a", "t0"), (2, "s", "b", "t0")], [(1, "s", "c", "t1"), (3, "s", "d", "t1")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        versions = {n: str(tmp_path / f"v{n}") for n in range(-1, 3)}
        if k == 0:
            spark.createDataFrame([], schema + ", last_seen_run_id string, active boolean").write.parquet(versions[-1])
        landed = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        merge.merge_snapshots(landed, lambda k=k: spark.read.parquet(versions[k - 1]), lambda df, n: df.write.mode("overwrite").parquet(versions[n]), ["id"], ["first_seen_at"], str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.id, r.payload, r.first_seen_at, r.active) for r in spark.read.parquet(versions[1]).collect()) == [(1, "c", "t0", True), (2, "b", "t0", False), (3, "d", "t1", True)]
    views.processing_results(spark, SF).withColumn("updated_at", F.col("updated_at").cast("timestamp")).write.parquet(str(tmp_path / "results"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "results")).schema).parquet(str(tmp_path / "results"))
    merge.windowed_activity(stream).writeStream.format("memory").queryName("activity").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("activity").agg(F.sum("recent_results")).first()[0] == spark.read.parquet(str(tmp_path / "results")).count()


def test_upsert_and_failure_classes(spark):
    old, new = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, first string"), spark.createDataFrame([(2, "c", "z"), (3, "d", "z")], "k int, v string, first string")
    assert sorted(map(tuple, relational.upsert(old, new, ["k"], ["first"]).collect())) == [(1, "a", "x"), (2, "c", "y"), (3, "d", "z")]
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = spark.createDataFrame([("http_error", 403), ("http_error", 404), ("http_error", 429), ("dns", None), ("unsupported_content", None), (None, None)], "e string, h int")
    got = rows.select(relational.classify_failure(F.col("e"), F.col("h"), F.lit("2024-06-01 00:00:00").cast("timestamp"), now).alias("x")).select("x.status", "x.category", F.date_format("x.retry_at", "MM-dd").alias("d")).collect()
    assert [tuple(r) for r in got] == [("retryable_failure", "access_blocked", "01-31"), ("permanent_failure", "permanent", None), ("retryable_failure", "transient", "06-01"), ("retryable_failure", "dns", "06-01"), ("permanent_failure", "permanent", None), ("retryable_failure", "transient", "06-01")]
