"""All registered queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import identity, pairing, rdf, relational
from . import graph_queries as G
from . import metrics as M
from . import views as V

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _add(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return keep


def _on(view, name: str, f, sql: str | None = None) -> None:
    _add(name, sql)(lambda spark, sf_dir: f(view(spark, sf_dir)))


def _docs(spark, sf_dir):
    return V.table(spark, sf_dir, "documents")


def _pages(spark, sf_dir):
    return V.table(spark, sf_dir, "pages")


def _stamp(df):
    """Timestamps as text: the same in every time zone and client."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


# --- stage metrics ---------------------------------------------------------------------------------------------
_R = f"WITH {V.RESULTS_SQL}\n"
_FROM = "2024-01-30 00:00:00"
_TXT = "json_extract_string(payload, '$.{0}')"
_CODE = "TRY_CAST(json_extract_string(payload, '$.http_status') AS INTEGER)"
_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_on(V.processing_results, "processing_results", _stamp, _R + f"SELECT stage_name, stage_version, status, {_TS.format('retry_at')} AS retry_at, payload, {_TS.format('updated_at')} AS updated_at FROM processing_results")
_RATE = "SELECT stage_name, stage_version, count(*) AS total_results, count(*) FILTER (WHERE status = 'success') AS successful, count(*) FILTER (WHERE status <> 'success') AS failed, CAST(round(CAST(count(*) FILTER (WHERE status = 'success') * 100.0 AS DOUBLE) / count(*), 2) AS DOUBLE) AS success_rate_percent FROM processing_results GROUP BY ALL"
_on(V.processing_results, "stage_success_rate", M.success_rate, _R + _RATE)
_on(V.processing_results, "stage_overall", M.overall, _R + f"SELECT CAST(sum(total_results) AS BIGINT) AS total_results, CAST(sum(successful) AS BIGINT) AS successful, CAST(sum(failed) AS BIGINT) AS failed, round(CAST(sum(successful) * 100.0 AS DOUBLE) / sum(total_results), 2) AS success_rate_percent FROM ({_RATE})")
_ERRORS = f"SELECT stage_name, stage_version, status, {_TXT.format('error_type')} AS error_type, {_TXT.format('failure_category')} AS failure_category, {_CODE} AS http_status, count(*) AS error_count FROM processing_results WHERE status <> 'success' GROUP BY ALL"
_on(V.processing_results, "stage_error_types", lambda r: M.error_types(r, None), _R + _ERRORS)
_on(V.processing_results, "topk_error_types", lambda r: M.error_types(r, 20), _R + _ERRORS + " ORDER BY error_count DESC, stage_name, stage_version, status, error_type, failure_category, http_status LIMIT 20")
_on(V.processing_results, "stage_domain_failures", lambda r: M.domain_failures(r, None), _R + f"SELECT stage_name, stage_version, status, coalesce(nullif(split_part({_TXT.format('url')}, '/', 3), ''), 'unknown') AS domain, count(*) AS failure_count FROM processing_results WHERE stage_name = 'document.extract' AND status <> 'success' GROUP BY ALL")
_on(V.processing_results, "stage_recent_activity", lambda r: _stamp(M.recent_activity(r, None, from_ts=_FROM)), _R + f"SELECT stage_name, stage_version, count(*) AS recent_results, {_TS.format('min(updated_at)')} AS earliest, {_TS.format('max(updated_at)')} AS latest, count(*) FILTER (WHERE status = 'success') AS successful, count(*) FILTER (WHERE status <> 'success') AS failed FROM processing_results WHERE updated_at >= TIMESTAMP '{_FROM}' GROUP BY stage_name, stage_version")
_on(V.processing_results, "stage_retry_queue", lambda r: _stamp(M.retry_queue(r, None)), _R + f"SELECT stage_name, stage_version, status, {_TXT.format('failure_category')} AS failure_category, {_CODE} AS http_status, count(*) AS result_count, {_TS.format('min(retry_at)')} AS next_retry_at FROM processing_results WHERE status <> 'success' GROUP BY ALL")

# --- text and URL functions ----------------------------------------------------------------------------------------
_TRIM = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_on(_docs, "canon_text", lambda d: d.select("doc_id", T.canonical_text(F.col("text")).alias("canonical")), f"SELECT doc_id, {_TRIM} AS canonical FROM documents")
_on(_docs, "analysis_text", lambda d: d.select("doc_id", T.analysis_text(T.collapse(F.col("text"))).alias("analysis")), f"SELECT doc_id, trim(regexp_replace(regexp_replace({_TRIM}, '(?i)https?://\\S+', '', 'g'), '\\s+', ' ', 'g')) AS analysis FROM documents")
_on(_docs, "identity_text", lambda d: d.select("doc_id", T.identity_text(F.col("text")).alias("identity")), "SELECT doc_id, array_to_string(regexp_extract_all(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[\\p{L}\\p{N}_]+'), ' ') AS identity FROM documents")
_on(_docs, "fingerprint", lambda d: d.select("doc_id", T.identity_text(F.col("text")).alias("i")).select("doc_id", F.when(F.col("i") != "", F.sha2("i", 256)).alias("text_hash"), F.when(F.col("i") != "", F.size(F.split("i", " "))).otherwise(0).alias("words")), "WITH t AS (SELECT doc_id, regexp_extract_all(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[\\p{L}\\p{N}_]+') AS w FROM documents) SELECT doc_id, CASE WHEN len(w) > 0 THEN sha256(array_to_string(w, ' ')) END AS text_hash, CAST(len(w) AS INTEGER) AS words FROM t")
_on(_docs, "input_hash", lambda d: d.select("doc_id", T.stable_hash(source=F.col("source"), lang=F.col("lang"), id=F.col("doc_id"), none=F.lit(None).cast("string")).alias("input_hash")), """SELECT doc_id, sha256('{"id":' || doc_id || ',"lang":"' || lang || '","none":null,"source":"' || source || '"}') AS input_hash FROM documents""")
_on(_docs, "factor_iri", lambda d: d.select("doc_id", T.label_segment(F.concat(F.lit("Very Angry~*("), "source", F.lit(") "), "lang")).alias("segment")), "SELECT doc_id, 'very_angry~%2A%28' || source || '%29_' || lang AS segment FROM documents")
_on(_docs, "full_uri", lambda d: d.select("doc_id", T.full_uri(F.concat(F.lit("claim/"), "doc_id"), V.BASE).alias("uri")), f"SELECT doc_id, '{V.BASE}/claim/' || doc_id AS uri FROM documents")
_HOST = "lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1))"
_on(_pages, "org_url", lambda p: p.select("page_id", U.organization_url(F.col("url")).alias("site")), f"SELECT page_id, 'https://' || regexp_replace({_HOST}, '^www\\.', '') AS site FROM pages")


def _by(*parts):
    """One of the texts for each page, in turn."""
    return F.coalesce(*[F.when(F.col("page_id") % len(parts) == k, x) for k, x in enumerate(parts)])


def _odd_url():
    rest = F.substr(F.col("url"), F.instr(F.col("url"), "://") + 3)
    return _by(F.col("url"), F.concat(F.lit("https://u:p@"), rest), F.concat(F.lit("ftp://"), rest), F.concat(F.lit("https://a.org/x y/%zz%20/"), F.col("page_id")), F.concat(F.lit("https://a.org:port/"), F.col("page_id")), F.concat(F.lit("HTTPS://B.org:443/é#f"), F.col("page_id")))


_SQL_REST = "substr(url, strpos(url, '://') + 3)"
_on(_pages, "url_sanitize", lambda p: p.select("page_id", U.sanitize_url(_odd_url()).alias("safe")), f"SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'https://' || {_SQL_REST} WHEN 3 THEN 'https://a.org/x%20y/%25zz%20/' || page_id WHEN 5 THEN 'https://b.org:443/%C3%A9#f' || page_id END AS safe FROM pages")
_on(_pages, "url_document_key", lambda p: p.select("page_id", U.document_url(_odd_url()).alias("document_key")), f"SELECT page_id, CASE page_id % 6 WHEN 0 THEN split_part(url, '#', 1) WHEN 1 THEN 'https://' || split_part({_SQL_REST}, '#', 1) WHEN 3 THEN 'https://a.org/x%20y/%25zz%20/' || page_id WHEN 5 THEN 'https://b.org/%C3%A9' END AS document_key FROM pages")
_on(_pages, "url_redact", lambda p: p.select("page_id", U.redact_credentials(F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "://", "://user:se@cret@")).otherwise(F.concat("url", F.lit("/@x")))).alias("redacted")), "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || '/@x' END AS redacted FROM pages")
_on(_pages, "url_origin", lambda p: p.select("page_id", U.origin(F.col("url")).alias("o")).select("page_id", "o.scheme", "o.host", "o.port"), f"SELECT page_id, split_part(url, ':', 1) AS scheme, {_HOST} AS host, CASE WHEN url LIKE 'https%' THEN 443 ELSE 80 END AS port FROM pages")
_on(_pages, "page_challenge", lambda p: p.select("page_id", U.access_challenge(F.col("html"), F.col("url")).alias("challenge")), "SELECT page_id, " + " OR ".join(f"contains(lower(html), '{m.replace(chr(39), chr(39) * 2)}')" for m in U.STRONG_MARKS) + " OR (" + " + ".join(f"CAST(contains(lower(html), '{m}') AS INTEGER)" for m in U.SOFT_MARKS) + ") >= 2 AS challenge FROM pages")
_on(_pages, "page_canonical", lambda p: p.select("page_id", U.page_canonical(_by(F.lit("<link rel='icon' href='/i'>"), F.concat(F.lit('<head><LINK REL="x Canonical" href=" /c?p='), F.col("page_id"), F.lit('"><link rel=canonical href="https://z.org/"></head>')), F.lit('<link rel=canonical href="ftp://x">')), F.lit("https://a.org/b/c")).alias("canonical_url")), "SELECT page_id, CASE WHEN page_id % 3 = 1 THEN 'https://a.org/c?p=' || page_id END AS canonical_url FROM pages")
_on(_pages, "extract_urls", lambda p: p.select("page_id", F.array_join(T.extract_urls(F.concat(F.lit('<a HREF = "https://a.example.org/x?a=1&amp;b='), F.col("page_id"), F.lit("\">y</a> <a href='/rel'>z</a> (https://b.org/[1]) https://a.example.org/x?a=1&amp;b="), F.col("page_id"))), " ").alias("urls")), "SELECT page_id, 'https://a.example.org/x?a=1&b=' || page_id || ' /rel https://b.org/[1])' AS urls FROM pages")

# --- observations ---------------------------------------------------------------------------------------------------
_O = f"WITH {V.OBSERVATIONS_SQL}\n"
_on(V.observations, "obs_record_key", lambda o: o.select("doc_id", "record_key"), _O + "SELECT doc_id, record_key FROM observations")
_on(V.observations, "claim_uri", lambda o: o.select("doc_id", "claim_uri"), _O + "SELECT doc_id, claim_uri FROM observations")
_on(V.observations, "claim_valid", lambda o: o.select("doc_id", "problem"), _O + "SELECT doc_id, problem FROM observations")
_on(V.observations, "rejects_count", lambda o: o.filter("problem is not null").groupBy("source_name", "problem").agg(F.count("*").alias("n")), _O + "SELECT source_name, problem, count(*) AS n FROM observations WHERE problem IS NOT NULL GROUP BY ALL")
_on(V.observations, "rating_norm", lambda o: o.select("doc_id", "label"), _O + "SELECT doc_id, label FROM observations")
_on(V.observations, "rating_uri", lambda o: o.filter("label is not null").select("doc_id", F.concat(F.lit("rating/"), T.digest("organization-rating", F.col("organization_uri"), F.col("label"))).alias("rating_uri")), _O + "SELECT doc_id, 'rating/' || sha256(CAST(to_json(['organization-rating', organization_uri, label]) AS VARCHAR)) AS rating_uri FROM observations WHERE label IS NOT NULL")
_on(V.observations, "extract_targets", lambda o: o.filter(F.col("observed_url").startswith("http://") | F.col("observed_url").startswith("https://")).groupBy("document_key").agg(F.min("observed_url").alias("url"), F.count_distinct("record_key").alias("records")), _O + "SELECT observed_url AS document_key, min(observed_url) AS url, count(DISTINCT record_key) AS records FROM observations GROUP BY 1")


def _versions(spark, sf_dir):
    """A stored table (every second document) and a new snapshot (every document of even source that isn't divisible by 5)."""
    d = _docs(spark, sf_dir)
    old = d.filter("doc_id % 2 = 0").select("doc_id", F.col("source").alias("source_name"), F.lit("old").alias("payload"), F.lit(True).alias("active"), F.lit("r1").alias("last_seen_run_id"), F.lit("t1").alias("first_seen_at"))
    new = d.filter("doc_id % 5 <> 0 and source like '%2'").select("doc_id", F.col("source").alias("source_name"), F.lit("new").alias("payload"), F.lit(True).alias("active"), F.lit("r2").alias("last_seen_run_id"), F.lit("t2").alias("first_seen_at"))
    return old, new


_V = "WITH o AS (SELECT doc_id, source AS source_name, 'old' AS payload, true AS active, 'r1' AS last_seen_run_id, 't1' AS first_seen_at FROM documents WHERE doc_id % 2 = 0), n AS (SELECT doc_id, source AS source_name, 'new' AS payload, true AS active, 'r2' AS last_seen_run_id, 't2' AS first_seen_at FROM documents WHERE doc_id % 5 <> 0 AND source LIKE '%2'), u AS (SELECT * FROM o WHERE doc_id NOT IN (SELECT doc_id FROM n) UNION ALL SELECT n.doc_id, n.source_name, n.payload, n.active, n.last_seen_run_id, coalesce(o.first_seen_at, n.first_seen_at) FROM n LEFT JOIN o ON n.doc_id = o.doc_id) "


@_add("upsert_observations", _V + "SELECT * FROM u")
def _upsert(spark, sf_dir):
    return relational.upsert(*_versions(spark, sf_dir), ["doc_id"], ["first_seen_at"])


@_add("deactivate", _V + "SELECT doc_id, source_name, payload, NOT (last_seen_run_id <> 'r2' AND source_name IN (SELECT source_name FROM n)) AS active, last_seen_run_id, first_seen_at FROM u")
def _deactivate(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    return relational.deactivate_missing(relational.upsert(old, new, ["doc_id"], ["first_seen_at"]), new.select("source_name"), "r2")


@_add("obs_active", _V + "SELECT source_name, count(*) AS n FROM u WHERE NOT (last_seen_run_id <> 'r2' AND source_name IN (SELECT source_name FROM n)) GROUP BY 1")
def _active(spark, sf_dir):
    return _deactivate(spark, sf_dir).filter("active").groupBy("source_name").agg(F.count("*").alias("n"))


_NOW = "2024-01-20 00:00:00"


@_add("extract_plan", _R + f"SELECT stage_name, CASE WHEN status = 'success' THEN 'cached' WHEN status = 'permanent_failure' THEN 'permanent' WHEN retry_at > TIMESTAMP '{_NOW}' THEN 'deferred' ELSE 'pending' END AS work, count(*) AS n FROM processing_results GROUP BY ALL")
def _plan(spark, sf_dir):
    r = V.processing_results(spark, sf_dir)
    work = relational.classify_work(F.col("stage_version") == "1", F.col("status"), F.col("retry_at"), F.lit(_NOW).cast("timestamp"))
    return r.select("stage_name", work.alias("work")).groupBy("stage_name", "work").agg(F.count("*").alias("n"))


_KINDS = ["invalid_url", "http_error", "dns", "access_challenge", "extraction_failed", "timeout"]
_STATES = [401, 404, 429, 503]


@_add("classify_failure", f"""WITH e AS (SELECT event_id, ts, {_KINDS}[event_id % 6 + 1] AS error_type, {_STATES}[event_id % 4 + 1] AS http_status FROM events),
c AS (SELECT *, CASE WHEN error_type = 'invalid_url' OR (error_type = 'http_error' AND http_status = 404) THEN 'permanent' WHEN error_type = 'http_error' AND http_status = 401 OR error_type = 'access_challenge' THEN 'access_blocked' WHEN error_type = 'dns' THEN 'dns' WHEN error_type = 'extraction_failed' THEN 'unextractable_content' ELSE 'transient' END AS category FROM e)
SELECT event_id, CASE WHEN category = 'permanent' THEN 'permanent_failure' ELSE 'retryable_failure' END AS status, category, strftime(CASE category WHEN 'transient' THEN ts + INTERVAL 1 HOUR WHEN 'dns' THEN ts + INTERVAL 7 DAY WHEN 'permanent' THEN NULL ELSE ts + INTERVAL 30 DAY END, '%Y-%m-%d %H:%M:%S') AS retry_at FROM c""")
def _classify(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kind, code = F.get(F.array(*map(F.lit, _KINDS)), (F.col("event_id") % 6).cast("int")), F.get(F.array(*map(F.lit, _STATES)), (F.col("event_id") % 4).cast("int"))
    found = relational.classify_failure(kind, code, F.lit(None).cast("timestamp"), F.col("ts"))
    return _stamp(e.select("event_id", found.alias("f")).select("event_id", "f.*"))


# --- identity ---------------------------------------------------------------------------------------------------------
_I = _O.rstrip() + """,
h AS (SELECT *, CASE WHEN identity_text <> '' THEN sha256(identity_text) END AS text_hash FROM observations WHERE problem IS NULL),
f AS (SELECT *, min(record_key) OVER (PARTITION BY organization_uri, coalesce(text_hash, record_key)) AS founder FROM h),
g AS (SELECT *, sha256(CAST(to_json(['document', organization_uri, founder]) AS VARCHAR)) AS x FROM f),
d AS (SELECT *, regexp_replace(substr(x, 1, 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS document_id FROM g),
y AS (SELECT *, sha256(CAST(to_json(['claim-review', document_id, claim_uri]) AS VARCHAR)) AS z FROM d),
r AS (SELECT *, regexp_replace(substr(z, 1, 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS claim_review_id FROM y)
"""


def _resolved(spark, sf_dir):
    return identity.resolve(V.with_hash(V.observations(spark, sf_dir).filter("problem is null")))


_on(lambda s, d: V.with_hash(V.observations(s, d).filter("problem is null")), "identity_evidence", lambda o: identity.evidence(o), _I + "SELECT organization_uri, record_key, 'url' AS kind, observed_url AS value FROM h UNION ALL SELECT organization_uri, record_key, 'hash', text_hash FROM h WHERE text_hash IS NOT NULL")
_on(_resolved, "identity_documents", lambda r: r.select("record_key", "document_id"), _I + "SELECT record_key, document_id FROM r")
_on(_resolved, "identity_reviews", lambda r: r.select("record_key", "document_id", "claim_review_id"), _I + "SELECT record_key, document_id, claim_review_id FROM r")
_on(_resolved, "identity_summary", lambda r: r.agg(F.count("*").alias("observations"), F.count_distinct("document_id").alias("documents"), F.count_distinct("claim_review_id").alias("reviews")), _I + "SELECT count(*) AS observations, count(DISTINCT document_id) AS documents, count(DISTINCT claim_review_id) AS reviews FROM r")
_on(_resolved, "review_document", identity.preferred_urls, _I + "SELECT document_id, min(observed_url) AS preferred_url FROM r GROUP BY 1")
_on(_resolved, "review_views", identity.review_views, _I + "SELECT claim_review_id, document_id, organization_uri, claim_uri AS review_claim_uri, count(*) AS observations, array_to_string(list_sort(list(DISTINCT source_name)), ',') AS sources, array_to_string(list_sort(list(DISTINCT observed_url)), ',') AS urls, arg_min(record_key, (source_name, record_key)) AS representative FROM r GROUP BY ALL")

# --- claim and review pairing -----------------------------------------------------------------------------------------
_PAIRS = """WITH c AS (SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user') AS claims, list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS reviews FROM conversations GROUP BY 1),
n AS (SELECT *, coalesce(len(claims), 0) AS a, coalesce(len(reviews), 0) AS b FROM c),"""
_add("crd_pairing", _PAIRS + """ k AS (SELECT *, unnest(range(0, greatest(a, b))) AS i FROM n WHERE a > 0 AND b > 0 AND (a = b OR a = 1 OR b = 1))
SELECT conv_id, CAST(i AS INTEGER) AS pair_index, claims[CASE WHEN a = 1 THEN 1 ELSE i + 1 END] AS claim_text, reviews[CASE WHEN b = 1 THEN 1 ELSE i + 1 END] AS review_text FROM k""")(lambda s, d: pairing.pairs(pairing.items(V.table(s, d, "conversations"))))
_add("crd_validate", _PAIRS + " z AS (SELECT 1) SELECT CASE WHEN a = 0 OR b = 0 THEN 'invalid' WHEN a = b THEN 'zip' WHEN a = 1 THEN 'claim_broadcast' WHEN b = 1 THEN 'review_broadcast' ELSE 'ambiguous' END AS kind, count(*) AS n FROM n GROUP BY 1")(lambda s, d: pairing.items(V.table(s, d, "conversations")).groupBy("kind").agg(F.count("*").alias("n")))

# --- quads and graph queries --------------------------------------------------------------------------------------------
_Q = f"WITH {V.quads_sql()}\n"
_TYPE = f"p = '{V.RDF_TYPE}'"
_ONE = "(SELECT DISTINCT s, p, o, o_kind, o_datatype FROM quads)"
_on(V.quads, "quads_distinct", lambda q: q, _Q + "SELECT * FROM quads")
_on(V.quads, "nt_lines", rdf.nt_lines, _Q + """SELECT graph, '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '"' || replace(replace(o, '\\', '\\\\'), '"', '\\"') || '"' || CASE WHEN o_datatype <> '' THEN '^^<' || o_datatype || '>' ELSE '' END END || ' .' AS line FROM quads""")
_on(V.stored_quads, "kg_core_counts", G.core_counts, _Q + f"SELECT count(DISTINCT s) FILTER (WHERE o = '{V.SCHEMA}ClaimReview') AS total_reviews, count(DISTINCT s) FILTER (WHERE o = '{V.SCHEMA}Claim') AS total_claims, count(DISTINCT s) FILTER (WHERE o = '{V.SCHEMA}Rating') AS total_ratings FROM quads WHERE {_TYPE}")
_on(V.stored_quads, "kg_class_distribution", G.class_distribution, _Q + f"SELECT o AS class, count(*) AS count FROM {_ONE} WHERE {_TYPE} GROUP BY 1 ORDER BY count DESC, class LIMIT 50")
_on(V.stored_quads, "kg_triple_volume", G.triple_volume, _Q + "SELECT graph, count(*) AS triple_count FROM quads GROUP BY 1 ORDER BY triple_count DESC, graph LIMIT 25")
_on(V.stored_quads, "kg_entity_types", G.entity_mentions, _Q + f"SELECT m.o AS entity, count(*) AS count FROM (SELECT DISTINCT s, o FROM quads WHERE {_TYPE} AND o IN ('{V.SCHEMA}Claim', '{V.SCHEMA}ClaimReview')) t JOIN quads m ON m.s = t.s WHERE m.graph = '{V.ENTITY_GRAPH}' AND m.p = '{V.SCHEMA}mentions' GROUP BY 1 ORDER BY count DESC, entity LIMIT 25")
_COVER = {"emotion": "hasEmotion", "sentiment": "hasSentiment", "political_leaning": "hasPoliticalLeaning", "conspiracy": "Conspiracy", "tropes": "hasTrope", "persuasion_techniques": "hasPersuasionTechnique", "climate": "isClimateRelated"}
_on(V.stored_quads, "kg_enrichment_coverage", G.enrichment_coverage, _Q + f"SELECT count(DISTINCT s) AS total_claims, " + ", ".join(f"count(DISTINCT s) FILTER (WHERE p LIKE '%{v}') AS with_{k}" for k, v in _COVER.items()) + f" FROM quads WHERE s IN (SELECT s FROM quads WHERE {_TYPE} AND o = '{V.SCHEMA}Claim')")
_on(V.stored_quads, "kg_claim_factors", G.claim_factors, _Q + f"SELECT category, value, count(DISTINCT s) AS count FROM (SELECT s, CASE p " + " ".join(f"WHEN '{p}' THEN '{c}'" for c, p, _, _ in V.FACTORS) + f" WHEN '{V.CLIMATE}' THEN 'climate_related' END AS category, CASE WHEN p = '{V.CLIMATE}' THEN o ELSE regexp_extract(o, '/([^/]*)$', 1) END AS value FROM quads) WHERE category IS NOT NULL GROUP BY 1, 2")
_on(V.stored_quads, "kg_totals", G.totals, _Q + "SELECT count(*) AS triples, count(DISTINCT graph) AS graphs FROM quads")
_on(V.stored_quads, "kg_graph_stats", G.graph_stats, _Q + "SELECT graph, count(*) AS n FROM quads GROUP BY 1")
_on(V.stored_quads, "kg_graph_stats_typed", G.graph_stats_typed, _Q + f"SELECT graph, count(*) AS n FROM quads WHERE {_TYPE} GROUP BY 1")
_on(V.stored_quads, "kg_sample_claims", G.sample_claims, _Q + f"SELECT r.s AS review, t.o AS text, v.o AS value FROM {_ONE} r JOIN {_ONE} i ON i.s = r.s AND i.p = '{V.SCHEMA}itemReviewed' JOIN {_ONE} x ON x.s = r.s AND x.p = '{V.SCHEMA}reviewRating' JOIN {_ONE} t ON t.s = i.o AND t.p = '{V.SCHEMA}text' JOIN {_ONE} v ON v.s = x.o AND v.p = '{V.SCHEMA}ratingValue' WHERE r.{_TYPE} AND r.o = '{V.SCHEMA}ClaimReview'")

from . import domain_queries  # noqa: E402, F401  it adds its queries to the two tables above
from . import projection_queries  # noqa: E402, F401
