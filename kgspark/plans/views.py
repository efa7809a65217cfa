"""The domain's derived views over the test tables, and the same in SQL for the oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import claim_problem, collapse, digest, rating_label

BASE = "https://kg.example.org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: str, values: dict) -> F.Column:
    out = None
    for k, v in values.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out


STAGES = {"error": "document.extract", "click": "factors.emotion", "view": "factors.sentiment", "purchase": "entities.claim", "signup": "entities.properties"}
CATEGORIES = ["transient", "access_blocked", "dns", "unextractable_content", "permanent"]
CODES = [403, 404, 429, 503]


def processing_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored stage results: (stage_name, stage_version, status, retry_at, payload, updated_at)."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    failed = F.col("k") >= 70
    payload = F.to_json(F.struct(
        F.concat(F.lit("https://h"), F.col("user_id") % 20, F.lit(".example.com/"), F.col("event_id")).alias("url"),
        F.when(failed, F.get(F.array(*map(F.lit, CATEGORIES)), F.col("k") % 5)).alias("failure_category"),
        F.when(failed, F.get(F.array(*map(F.lit, CODES)), F.col("k") % 4)).alias("http_status"),
        F.when(failed, F.lit("http")).alias("error_type"),
    ))
    status = F.when(F.col("k") < 70, "success").when(F.col("k") < 90, "retryable_failure").otherwise("permanent_failure")
    retry = F.when(status == "retryable_failure", F.col("ts") + F.expr("interval 1 hour"))
    return e.select(_case("event_type", STAGES).alias("stage_name"), F.lit("1").alias("stage_version"), status.alias("status"), retry.alias("retry_at"), payload.alias("payload"), F.col("ts").alias("updated_at"))


def _sql_case(col: str, values: dict) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


RESULTS_SQL = f"""ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
processing_results AS (SELECT {_sql_case('event_type', STAGES)} AS stage_name, '1' AS stage_version,
  CASE WHEN k < 70 THEN 'success' WHEN k < 90 THEN 'retryable_failure' ELSE 'permanent_failure' END AS status,
  CASE WHEN k >= 70 AND k < 90 THEN ts + INTERVAL 1 HOUR END AS retry_at,
  '{{"url":"https://h' || (user_id % 20) || '.example.com/' || event_id || '"' || CASE WHEN k >= 70 THEN
    ',"failure_category":"' || [{', '.join(f"'{c}'" for c in CATEGORIES)}][k % 5 + 1] || '","http_status":' || {CODES}[k % 4 + 1] || ',"error_type":"http"' ELSE '' END || '}}' AS payload,
  ts AS updated_at FROM ev)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source observations: documents with their labels; ``problem`` is null where the claim text is valid."""
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    x = d.join(labels, "doc_id", "left")
    text = collapse(F.split_part("text", F.lit("\n"), F.lit(1)))
    label = F.when(F.col("toxic") == 1, "Misinformed or potentially-misleading").when(F.col("quality") == 1, "true").when(F.col("quality") == 0, "FALSE")
    url = F.concat(F.lit("https://"), "lang", F.lit(".example.org/doc/"), "doc_id")
    x = x.select("doc_id", F.col("source").alias("source_name"), "lang", text.alias("claim_text"), F.col("text").alias("source_text"), url.alias("observed_url"), label.alias("original_label"))
    return x.select(
        "*", claim_problem(F.col("claim_text")).alias("problem"), rating_label(F.col("original_label")).alias("label"),
        F.concat(F.lit("org/"), "lang").alias("organization_uri"), F.col("observed_url").alias("document_key"),
        digest("source-review-record-native", F.col("source_name"), F.lit("fx"), F.col("doc_id").cast("string")).alias("record_key"),
        F.concat(F.lit("claim/"), digest("claim", F.col("claim_text"))).alias("claim_uri"),
        F.array_join(F.regexp_extract_all(F.lower("source_text"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), " ").alias("identity_text"),
    )


def with_hash(obs: DataFrame) -> DataFrame:
    """Adds text_hash (null for texts without a word) and url_rank."""
    return obs.withColumn("text_hash", F.when(F.col("identity_text") != "", F.sha2("identity_text", 256))).withColumn("url_rank", F.lit(2))


OBSERVATIONS_SQL = """ob0 AS (SELECT d.doc_id, source AS source_name, lang, trim(regexp_replace(split_part(text, chr(10), 1), '[\\s]+', ' ', 'g')) AS claim_text, text AS source_text,
  'https://' || lang || '.example.org/doc/' || d.doc_id AS observed_url, CASE WHEN toxic = 1 THEN 'misinformed_or_potentially_misleading' WHEN quality = 1 THEN 'credible' WHEN quality = 0 THEN 'not_credible' END AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
observations AS (SELECT *, CASE WHEN claim_text = '' THEN 'empty' WHEN trim(regexp_replace(claim_text, '(?i)https?://\\S+', '', 'g')) = '' THEN 'url_only' WHEN NOT regexp_matches(claim_text, '[\\p{L}\\p{N}]') THEN 'no_alphanumeric' END AS problem,
  'org/' || lang AS organization_uri, sha256(CAST(to_json(['source-review-record-native', source_name, 'fx', CAST(doc_id AS VARCHAR)]) AS VARCHAR)) AS record_key,
  'claim/' || sha256(CAST(to_json(['claim', claim_text]) AS VARCHAR)) AS claim_uri, array_to_string(regexp_extract_all(lower(source_text), '[\\p{L}\\p{N}_]+'), ' ') AS identity_text FROM ob0)"""


#: Factor categories of a claim: (category, predicate, IRI segment, number of values in the deterministic stub).
ONTOLOGY = f"{BASE}/ontology#"
FACTORS = [
    ("sentiment", f"{ONTOLOGY}hasSentiment", "sentiment", 3), ("political_leaning", f"{ONTOLOGY}hasPoliticalLeaning", "political-leaning", 4),
    ("emotion", f"{ONTOLOGY}hasEmotion", "emotion", 6), ("tropes", f"{ONTOLOGY}hasTrope", "trope", 5),
    ("persuasion_techniques", f"{ONTOLOGY}hasPersuasionTechnique", "persuasion-technique", 7),
    ("conspiracies_mentioned", f"{ONTOLOGY}mentionsConspiracy", "conspiracy", 4), ("conspiracies_promoted", f"{ONTOLOGY}promotesConspiracy", "conspiracy", 9),
]
CLIMATE = f"{ONTOLOGY}isClimateRelated"
RDF_TYPE, SCHEMA, XSD = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://schema.org/", "http://www.w3.org/2001/XMLSchema#"
ENTITY_GRAPH = f"{BASE}/graph/entities"


def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations' RDF projection: one wide projection and one explode, each quad once."""
    from ..operators.rdf import observation_quads

    return observation_quads(observations(spark, sf_dir).filter("problem is null"))


_STORED: dict[tuple[str, str], str] = {}


def stored_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quads written once a session in the shared folder, ranged by predicate, so that filters on it reach the scan."""
    from ..sources.storage import checkpoint_root, files

    key = (spark.sparkContext.applicationId, sf_dir)
    root = checkpoint_root(spark)
    if key not in _STORED or not files(spark, root if "://" in root else "").exists(f"{_STORED[key]}/_SUCCESS"):
        path = f"{root}/quads-{uuid.uuid4().hex}"
        quads(spark, sf_dir).sortWithinPartitions("p", "o").write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def _iri(expr: str) -> str:
    return f"'{BASE}/' || {expr}"


def _quad_rows() -> list[tuple[str, str, str, str, str, str, str]]:
    """(graph, s, p, o, o_kind, o_datatype, condition) as SQL, for the oracle."""
    g, review, claim = f"'{BASE}/graph/' || source_name", _iri("'review/' || record_key"), _iri("claim_uri")
    rating, org = _iri("'rating/' || rating_key"), _iri("organization_uri")
    s = lambda x: f"'{SCHEMA}{x}'"
    rows = [
        (g, review, f"'{RDF_TYPE}'", s("ClaimReview"), "iri", "", "true"), (g, review, s("itemReviewed"), claim, "iri", "", "true"),
        (g, review, s("author"), org, "iri", "", "true"), (g, review, s("url"), "observed_url", "iri", "", "true"), (g, review, s("inLanguage"), "lang", "literal", "", "lang <> ''"),
        (g, claim, f"'{RDF_TYPE}'", s("Claim"), "iri", "", "true"), (g, claim, s("text"), "claim_text", "literal", "", "true"),
        (g, review, s("reviewRating"), rating, "iri", "", "label IS NOT NULL"), (g, review, f"'{ONTOLOGY}normalizedReviewRating'", _iri("'rating/' || label"), "iri", "", "label IS NOT NULL"),
        (g, rating, f"'{RDF_TYPE}'", s("Rating"), "iri", "", "label IS NOT NULL"), (g, rating, s("author"), org, "iri", "", "label IS NOT NULL"), (g, rating, s("ratingValue"), "label", "literal", "", "label IS NOT NULL"),
        (g, claim, f"'{CLIMATE}'", "CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END", "literal", f"{XSD}boolean", "true"),
        (f"'{ENTITY_GRAPH}'", claim, s("mentions"), _iri("'entity/' || (doc_id % 40)"), "iri", "", "doc_id % 2 = 0"),
        (f"'{ENTITY_GRAPH}'", review, s("mentions"), _iri("'entity/' || (doc_id % 17)"), "iri", "", "doc_id % 5 = 0"),
    ]
    for k, (_, p, segment, n) in enumerate(FACTORS):
        rows.append((g, claim, f"'{p}'", _iri(f"'{segment}/value_' || (doc_id % {n})"), "iri", "", f"doc_id % {k + 2} <> 0"))
    return rows


def quads_sql() -> str:
    parts = [f"SELECT {g} AS graph, {s} AS s, {p} AS p, {o} AS o, '{kind}' AS o_kind, '{dt}' AS o_datatype FROM valid WHERE {cond}" for g, s, p, o, kind, dt, cond in _quad_rows()]
    rating = "sha256(CAST(to_json(['organization-rating', organization_uri, label]) AS VARCHAR))"
    return f"{OBSERVATIONS_SQL},\nvalid AS (SELECT *, {rating} AS rating_key FROM observations WHERE problem IS NULL),\nquads AS (" + "\nUNION\n".join(parts) + ")"
