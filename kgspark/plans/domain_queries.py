"""Further registered queries: sources, enrichment, projection and publication over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import enrichment, identity, relational
from ..sources import formats
from . import views as V
from .registry import _I, _O, _Q, _add, _docs, _on, _pages, _resolved, _stamp

# --- sources ----------------------------------------------------------------------------------------------------
_on(_docs, "src_scan", lambda d: d.select("doc_id", "source", F.octet_length("text").cast("long").alias("bytes")), "SELECT doc_id, source, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")
_on(_docs, "src_size_guard", lambda d: d.groupBy("source").agg(F.count_if(F.octet_length("text") > 4096).alias("too_large"), F.count("*").alias("n")), "SELECT source, count(*) FILTER (WHERE strlen(text) > 4096) AS too_large, count(*) AS n FROM documents GROUP BY 1")
_on(_docs, "fetch_guard", lambda d: d.select("doc_id", U.fetch_problem(F.when(F.col("doc_id") % 3 == 0, "application/pdf").otherwise("Text/HTML; charset=x"), F.col("doc_id") * 40_000).alias("problem")), "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'unsupported_content' WHEN doc_id * 40000 > 5242880 THEN 'response_too_large' END AS problem FROM documents")
def _wiki_text():
    return F.concat(F.when(F.col("doc_id") % 2 == 0, "== Head == **bold**  [[label>>Target.Page]] {{box a=1/}}x (%style%)y //it// z__z a**b ").otherwise("https://a.org/x__y (% c %)t "), F.col("source"))


_on(_docs, "wiki_clean", lambda d: d.select("doc_id", T.strip_wiki(_wiki_text()).alias("clean")), "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '== Head == bold label x y it z__z a**b ' ELSE 'https://a.org/x__y t ' END || source AS clean FROM documents")
_on(_docs, "retry_after", lambda d: _stamp(d.select("doc_id", U.retry_after(F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).when(F.col("doc_id") % 3 == 1, "Fri, 05 Jan 2024 10:00:00 GMT").otherwise("soon"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("retry_at"))), "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), '%Y-%m-%d %H:%M:%S') WHEN 1 THEN '2024-01-05 10:00:00' END AS retry_at FROM documents")
_on(_docs, "iri_valid", lambda d: d.select("doc_id", U.valid_iri(F.concat(F.lit("https://x.org/"), "source", F.when(F.col("doc_id") % 4 == 0, "%zz").when(F.col("doc_id") % 4 == 1, " y").otherwise("%20"))).alias("iri")), "SELECT doc_id, CASE WHEN doc_id % 4 >= 2 THEN 'https://x.org/' || source || '%20' END AS iri FROM documents")
_on(_docs, "factor_label", lambda d: d.select("doc_id", T.factor_title(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("loaded_language-"), "lang"))).alias("label")), "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE 'Loaded Language ' || upper(lang[1]) || lang[2:] END AS label FROM documents")
#: How one day (D) is written, by doc_id, and whether it is a date at all.
_DATES = [("yyyy-MM-dd'T'HH:mm:ss'Z'", True), ("MMMM d, yyyy", True), ("MM/dd/yyyy", True), ("'1755002968'", False), ("yyyy-MM-dd HH:mm:ss", True), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", True), ("MMM d yyyy", True), ("d MMMM yyyy", True), ("yyyyMMdd", True), ("yyyy-MM-dd 'or so'", False), ("yyyy-'02-31'", False), ("MMMM yyyy", False)]


@_add("date_norm", f"SELECT doc_id, CASE WHEN doc_id % {len(_DATES)} NOT IN ({', '.join(str(k) for k, (_, good) in enumerate(_DATES) if not good)}) THEN strftime(DATE '2019-12-25' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%d') END AS day FROM documents")
def _date_norm(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("t", F.date_add(F.lit("2019-12-25").cast("date"), (F.col("doc_id") % 700).cast("int")).cast("timestamp"))
    text = F.coalesce(*[F.when(F.col("doc_id") % len(_DATES) == k, F.date_format("t", f)) for k, (f, _) in enumerate(_DATES)])
    return d.select("doc_id", formats.any_date(text).alias("day"))


_ITEM = '{"id":"1","title":"t","other":[1]}'
_TEXTS = [f"[{_ITEM}, {_ITEM}]", f"[{_ITEM}] [{_ITEM}]", "{}", "", f"[{_ITEM} {_ITEM}]", "[]", f" \n[{_ITEM}]\n "]
_on(_docs, "crd_parse", lambda d: formats.json_items(d.select(F.coalesce(*[F.when(F.col("doc_id") % 7 == k, F.lit(t)) for k, t in enumerate(_TEXTS)]).alias("value")), "id string, title string").groupBy("bad_file", "id", "title").agg(F.count("*").alias("n")), "WITH t AS (SELECT doc_id % 7 AS k FROM documents) SELECT false AS bad_file, '1' AS id, 't' AS title, CAST(sum(CASE k WHEN 0 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM t WHERE k IN (0, 6) UNION ALL SELECT true, NULL, NULL, count(*) FROM t WHERE k IN (1, 2, 3, 4)")
_on(_pages, "page_text", lambda p: p.select("page_id", U.page_text(F.concat(F.lit("<html><head><title>no</title><script>var no;</script></head><body><nav><a href=x>no</a></nav>"), F.when(F.col("page_id") % 3 == 0, "<div>no</div><article>").otherwise("<div>"), F.lit("<h1>Head &amp; more</h1><p>Page  <b>"), F.col("page_id").cast("string"), F.lit("</b> https://u.org/x end</p><ul><li><a href=y>only a link</a></li></ul>"), F.when(F.col("page_id") % 3 == 0, "</article><p>no</p>").otherwise("</div>"), F.lit("<footer>no</footer></body></html>"))).alias("text")), "SELECT page_id, 'Head & more' || chr(10) || 'Page ' || page_id || ' end' AS text FROM pages")
_FIRST = "trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g'))"
_BAD = f"({_FIRST} = '' OR NOT regexp_matches({_FIRST}, '[\\p{{L}}\\p{{N}}]'))"


def _first():
    return F.split_part("text", F.lit("\n"), F.lit(1))


@_add("ecc_normalize", f"SELECT 'https://www.' || lang || '.org/' || doc_id AS observed_url, 'https://' || lang || '.org' AS organization_site, {_FIRST} AS claim_text, CASE WHEN doc_id % 2 = 0 THEN 'not_credible' END AS label, CASE WHEN doc_id % 3 = 0 THEN '2024-03-05' ELSE '' END AS date_published, lang AS language, {_BAD} AS rejected FROM documents")
def _articles(spark, sf_dir):
    d = _docs(spark, sf_dir)
    items = d.select(F.concat(F.lit("https://www."), "lang", F.lit(".org/"), "doc_id").alias("url"), F.lit(" ").alias("title"), _first().alias("description"), F.when(F.col("doc_id") % 2 == 0, "False").otherwise("other").alias("category"), F.when(F.col("doc_id") % 3 == 0, "March 5, 2024").otherwise("n/a").alias("date"), F.col("lang").alias("language"))
    # a description of blanks alone is no text at all, hence the empty claim
    x = formats.articles(spark, items, "articles")
    return x.select("observed_url", "organization_site", F.coalesce("claim_text", F.lit("")).alias("claim_text"), "label", "date_published", "language", (F.size("errors") > 0).alias("rejected"))


@_add("dbkf_normalize", f"SELECT CAST(doc_id AS VARCHAR) AS native_id, {_FIRST} AS claim_text, 'H' || chr(10) || source AS review_text, 'fr' AS language, sha256(CAST(to_json(['source-review-record-native', 'debunks', 'debunks', CAST(doc_id AS VARCHAR)]) AS VARCHAR)) AS record_key FROM documents WHERE NOT {_BAD}")
def _debunks(spark, sf_dir):
    items = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), F.lit("https://d.org/x").alias("externalUrl"), F.lit("H").alias("headline"), F.col("source").alias("reviewBody"), F.lit('["fr","en"]').alias("language"), F.struct(_first().alias("text")).alias("itemReviewed"))
    x = formats.debunks(spark, items, "debunks").filter(F.size("errors") == 0)
    return x.select("native_id", "claim_text", "review_text", "language", "record_key")


@_add("fever_normalize", f"SELECT CAST(doc_id AS VARCHAR) AS native_id, {_FIRST} AS claim_text, CASE WHEN doc_id % 2 = 0 THEN 'credible' ELSE 'not_credible' END AS label, '1. ' || source || chr(10) || '2. ' || lang AS review_text, 'https://en.wikipedia.org/wiki/Sea_ice' AS appearance FROM documents WHERE NOT {_BAD}")
def _evidence(spark, sf_dir):
    e = lambda c: F.struct(F.lit("Sea ice").alias("article"), F.col(c).alias("evidence"), F.lit("x").alias("evidence_label"))
    line = F.struct(F.col("doc_id").cast("string").alias("claim_id"), _first().alias("claim"), F.when(F.col("doc_id") % 2 == 0, "SUPPORTS").otherwise("REFUTES").alias("claim_label"), F.array(e("source"), e("lang")).alias("evidences"))
    x = formats.evidence_lines(spark, _docs(spark, sf_dir).select(F.to_json(line).alias("value")), "evidence").filter(F.size("errors") == 0)
    return x.select("native_id", "claim_text", "label", "review_text", F.array_join("appearances", " ").alias("appearance"))


# --- organizations --------------------------------------------------------------------------------------------------
_HOSTS = "lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1))"


@_add("org_resolve", f"WITH s AS (SELECT page_id, 'https://' || regexp_replace({_HOSTS}, '^www\\.', '') AS site FROM pages), c AS (SELECT site, min(page_id) AS first FROM s GROUP BY 1) SELECT page_id, 'org/' || c.first AS organization_uri FROM s JOIN c USING (site)")
def _org_resolve(spark, sf_dir):
    sites = _pages(spark, sf_dir).select("page_id", U.organization_url(F.col("url")).alias("site"))
    catalog = sites.groupBy("site").agg(F.concat(F.lit("org/"), F.min("page_id")).alias("organization_uri"))
    return sites.join(catalog, "site").select("page_id", "organization_uri")


# --- enrichment -----------------------------------------------------------------------------------------------------
_MODEL = enrichment.Enricher("factor", "1", "claim_uri", "claim_text", lambda texts: ['{"value": "x"}' for _ in texts])
_NOW = "2024-01-10 00:00:00"


def _subjects(spark, sf_dir):
    return enrichment.subjects(V.observations(spark, sf_dir).filter("problem is null"), _MODEL)


def _stored(spark, sf_dir):
    s = _subjects(spark, sf_dir).withColumn("k", F.ascii(F.substring("subject_key", 7, 1)) % 5)
    status = F.when(F.col("k") == 0, "permanent_failure").when(F.col("k") == 1, "retryable_failure").otherwise("success")
    retry = F.when(F.col("k") == 1, F.lit("2024-01-11 00:00:00").cast("timestamp"))
    version = F.when(F.col("k") == 2, "0").otherwise("1")
    return s.filter("k < 4").select(F.lit("factor").alias("enricher"), "subject_key", version.alias("enricher_version"), "input_hash", F.sha2(F.lit("{}"), 256).alias("config_hash"), status.alias("status"), retry.alias("retry_at"), F.concat(F.lit('{"value":"'), F.substring("subject_key", 7, 4), F.lit('"}')).alias("payload"))


_E = _O.rstrip() + ",\nsub AS (SELECT DISTINCT claim_uri AS subject_key, claim_text, ascii(substr(claim_uri, 7, 1)) % 5 AS k FROM observations WHERE problem IS NULL)\n"
_on(_subjects, "enrich_subjects", lambda s: s.groupBy().agg(F.count("*").alias("subjects"), F.sum(F.length("input")).alias("characters")), _E + "SELECT count(*) AS subjects, CAST(sum(length(claim_text)) AS BIGINT) AS characters FROM sub")


@_add("enrich_plan", _E + "SELECT CASE k WHEN 0 THEN 'permanent' WHEN 1 THEN 'deferred' WHEN 3 THEN 'cached' ELSE 'pending' END AS work, count(*) AS n FROM sub GROUP BY 1")
def _enrich_plan(spark, sf_dir):
    return enrichment.summary(enrichment.plan(_subjects(spark, sf_dir), _stored(spark, sf_dir), _MODEL, F.lit(_NOW).cast("timestamp")))


@_add("enrich_apply", _E + """SELECT subject_key, '{"value":"' || substr(subject_key, 7, 4) || '"}' AS payload FROM sub WHERE k = 3""")
def _enrich_apply(spark, sf_dir):
    return enrichment.apply(_subjects(spark, sf_dir), _stored(spark, sf_dir), _MODEL)


@_add("stage_summary", _E + "SELECT k <> 4 AS available, count(*) AS n FROM sub GROUP BY 1")
def _stage_summary(spark, sf_dir):
    stored = _stored(spark, sf_dir).select("subject_key", F.lit(True).alias("available"))
    return _subjects(spark, sf_dir).join(stored, "subject_key", "left").groupBy(F.coalesce("available", F.lit(False)).alias("available")).agg(F.count("*").alias("n"))


def _linked(spark, sf_dir):
    one = lambda uri, score: F.concat(F.lit('{"@URI":"'), uri, F.lit('","@surfaceForm":"s","@types":"A,B","@similarityScore":"'), score, F.lit('","@support":"3","@offset":"1"}'))
    n = F.col("doc_id")
    both = F.concat(F.lit('{"Resources":['), one(F.concat(F.lit("u:"), n % 7), F.lit("0.9")), F.lit(","), one(F.concat(F.lit("w:"), n % 3), F.concat(F.lit("0."), n % 10)), F.lit("]}"))
    return enrichment.entities(_docs(spark, sf_dir).select(n.cast("string").alias("subject_key"), both.alias("payload")), 0.5)


_L = "WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS subject_key, 'u:' || (doc_id % 7) AS uri, 0.9 AS score FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR), 'w:' || (doc_id % 3), CAST('0.' || (doc_id % 10) AS DOUBLE) FROM documents) "
_on(_linked, "entities_parse", lambda e: e.select("subject_key", "uri", F.array_join("types", "|").alias("types"), "score", "support"), _L + "SELECT subject_key, uri, 'A|B' AS types, CAST(score AS DOUBLE) AS score, 3 AS support FROM e WHERE score >= 0.5")


@_add("entity_props", _L + "SELECT uri, 'p' AS property, uri || '/1,' || uri || '/2' AS vals FROM (SELECT DISTINCT uri FROM e WHERE score >= 0.5)")
def _entity_props(spark, sf_dir):
    entity = F.concat(F.when(F.col("id") < 7, "u:").otherwise("w:"), F.when(F.col("id") < 7, F.col("id")).otherwise(F.col("id") - 7))
    facts = spark.range(20).select(entity.alias("entity"), F.explode(F.array(F.lit("/2"), F.lit("/1"), F.lit("/1"), F.lit("_:b"))).alias("v"))
    facts = facts.select("entity", F.lit("p").alias("property"), F.concat("entity", "v").alias("value"), F.when(F.col("v") == "_:b", "bnode").otherwise("uri").alias("kind"))
    return enrichment.entity_properties(_linked(spark, sf_dir), facts, ["p"]).select("uri", "property", F.array_join("values", ",").alias("vals"))


# --- identity and projection ------------------------------------------------------------------------------------------
def _with_words(spark, sf_dir):
    return _resolved(spark, sf_dir).withColumn("words", F.when(F.col("identity_text") == "", 0).otherwise(F.size(F.split("identity_text", " "))))


_W = _I.rstrip() + ",\nw AS (SELECT *, CASE WHEN identity_text = '' THEN 0 ELSE len(string_split(identity_text, ' ')) END AS words FROM r)\n"
_on(_with_words, "identity_absorb", identity.absorb, _W + "SELECT document_id, any_value(text_hash) AS text_hash, CAST(max(words) AS INTEGER) AS words FROM w GROUP BY 1")
_on(_resolved, "identity_conflicts", lambda r: identity.conflicts(r.withColumn("document_id", F.concat("document_id", F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y")))), _W + "SELECT organization_uri, 'hash' AS kind, text_hash AS value, count(DISTINCT document_id || (doc_id % 2)) AS documents FROM w WHERE text_hash IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT document_id || (doc_id % 2)) > 1")


@_add("identity_sticky", _W + "SELECT record_key, claim_review_id FROM w")
def _sticky(spark, sf_dir):
    r = _resolved(spark, sf_dir)
    known = r.select("record_key", "document_id", "claim_review_id")
    changed = r.drop("document_id", "claim_review_id", "founder").withColumn("claim_uri", F.lit("claim/changed"))
    return identity.resolve(changed, known).select("record_key", "claim_review_id")


_on(_resolved, "review_for_source", lambda r: identity.per_source(r.select("claim_review_id", "source_name", "record_key", "label"), ["label"]).select("claim_review_id", "source_name", "record_key"), _W + "SELECT claim_review_id, source_name, arg_max(record_key, (CASE WHEN label IS NULL THEN 0 ELSE 1 END, record_key)) AS record_key FROM w GROUP BY 1, 2")
_on(_resolved, "review_longest", lambda r: identity.longest(r.withColumn("source_text", F.length("source_text").cast("string")), "source_text"), _W + "SELECT claim_review_id, source_name, arg_min(CAST(length(source_text) AS VARCHAR), (-length(CAST(length(source_text) AS VARCHAR)), record_key)) AS source_text FROM w GROUP BY 1, 2")
_on(_resolved, "review_urls", lambda r: r.groupBy("document_id").agg(F.count_distinct("observed_url").alias("urls")), _W + "SELECT document_id, count(DISTINCT observed_url) AS urls FROM w GROUP BY 1")
_on(_resolved, "review_ids", lambda r: r.select("claim_review_id").distinct().orderBy("claim_review_id"), _W + "SELECT DISTINCT claim_review_id FROM w")
_on(_resolved, "review_sources", lambda r: r.select("claim_review_id", "source_name").distinct(), _W + "SELECT DISTINCT claim_review_id, source_name FROM w")
_on(V.observations, "obs_roundtrip", lambda o: o.select("doc_id", F.from_json(F.to_json(F.struct("claim_text", "label", "lang"), {"ignoreNullFields": "false"}), "claim_text string, label string, lang string").alias("x")).select("doc_id", "x.*"), _O + "SELECT doc_id, claim_text, label, lang FROM observations")
_on(V.observations, "install_source", lambda o: o.groupBy("source_name").agg(F.count("*").alias("n"), F.count_if(F.col("problem").isNotNull()).alias("rejected")).withColumn("installed", F.col("n") > F.col("rejected")), _O + "SELECT source_name, count(*) AS n, count(problem) AS rejected, count(*) > count(problem) AS installed FROM observations GROUP BY 1")

# --- publication ------------------------------------------------------------------------------------------------------
_GATE = "SELECT graph, count(*) AS triples, count(DISTINCT s) AS subjects, graph NOT LIKE '%1' AS published FROM quads GROUP BY 1"
_on(V.quads, "export_gate", lambda q: q.groupBy("graph").agg(F.count("*").alias("triples"), F.count_distinct("s").alias("subjects")).withColumn("published", ~F.col("graph").endswith("1")), _Q + _GATE)
_on(V.quads, "export_summary", lambda q: q.filter(~F.col("graph").endswith("1")).agg(F.count_distinct("graph").alias("graphs"), F.count("*").alias("triples")), _Q + "SELECT count(DISTINCT graph) AS graphs, count(*) AS triples FROM quads WHERE graph NOT LIKE '%1'")
_on(_resolved, "export_routing", lambda r: r.filter(~F.col("source_name").endswith("1")).select(F.concat(F.lit(f"{V.BASE}/graph/"), "source_name").alias("graph"), "claim_review_id").distinct(), _W + f"SELECT DISTINCT '{V.BASE}/graph/' || source_name AS graph, claim_review_id FROM w WHERE source_name NOT LIKE '%1'")


@_add("host_cooldown", "WITH t AS (SELECT page_id, lower(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1)) AS h FROM pages), c AS (SELECT h, count(*) AS n FROM t GROUP BY 1) SELECT h AS host, CASE WHEN h LIKE '%.com' THEN 1 ELSE n END AS requested, CASE WHEN h LIKE '%.com' THEN n - 1 ELSE 0 END AS cooled FROM c")
def _cooldown(spark, sf_dir):
    from ..operators.extraction import fetch

    host = F.lower(F.split_part(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1)))
    targets = _pages(spark, sf_dir).select(F.col("page_id").cast("string").alias("document_key"), F.concat(F.lit("https://"), host, F.lit("/"), "page_id").alias("url"))
    done = fetch(targets, lambda url: {"http_status": 429 if url.split("/")[2].endswith(".com") else 200})
    return done.groupBy("host").agg(F.count_if("requested").alias("requested"), F.count_if(~F.col("requested")).alias("cooled"))


@_add("purge", "SELECT source, count(*) AS deleted FROM documents WHERE doc_id % 3 = 0 GROUP BY 1")
def _purge(spark, sf_dir):
    d = _docs(spark, sf_dir)
    kept = relational.upsert(d, d.limit(0), ["doc_id"]).filter("doc_id % 3 <> 0")
    return d.join(kept.select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("deleted"))
