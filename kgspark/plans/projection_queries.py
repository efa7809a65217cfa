"""Registered queries of the canonical projection, the catalog and the remaining source formats, over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import enrichment, identity, projection, rdf, relational
from ..sources import catalog, formats
from . import graph_queries as G
from . import views as V
from .domain_queries import _BAD, _FIRST, _W, _first, _subjects
from .registry import _O, _Q, _R, _add, _docs, _on, _resolved

# --- records: identified observations with what a source may say of them ------------------------------------------------
_AUTHOR = "array<struct<name:string,website:string,role:string,source_uri:string>>"


def _records(spark, sf_dir):
    mod = lambda n: F.col("doc_id") % n
    text = lambda prefix, n: F.concat(F.lit(prefix), mod(n))
    rated = mod(2) == 0
    author = F.struct(
        F.when(mod(4) == 3, "").otherwise(text("A", 4)).alias("name"), F.when(rated, text("https://p.example.org/", 3)).alias("website"),
        F.when(mod(5) == 0, "editor").alias("role"), F.when(mod(6) == 0, "ftp://x").otherwise("https://s.example.org/a b").alias("source_uri"),
    )
    return _resolved(spark, sf_dir).withColumns({
        "keywords": F.array(text("k", 7), F.when(mod(3) == 0, "").otherwise(text("K", 5))), "authors": F.array(author).cast(_AUTHOR),
        "description": F.when(mod(5) > 0, F.repeat(F.lit("d"), mod(5).cast("int"))), "abstract": F.when(mod(3) == 0, text("abs", 10)),
        "license_url": F.when(mod(3) == 0, "https://creativecommons.org/licenses/by/4.0/").when(mod(3) == 1, "CC BY"),
        "date_published": F.when(rated, F.concat(F.lit("2024-01-0"), mod(9) + 1)), "language": F.col("lang"), "review_text": F.when(mod(2) == 1, text("body ", 50)),
        "rating_value": F.when(rated, mod(5).cast("double")), "best_rating": F.when(rated, F.lit(5.0)), "worst_rating": F.when(rated, F.lit(1.0)),
        "explanation": F.when(mod(7) == 0, "because"), "headline": F.when(mod(3) > 0, text("H", 3)), "appearances": F.array(F.concat(F.lit("https://a.example.org/"), F.col("doc_id")), F.lit("ftp://no")),
        "urls": F.array("observed_url"), "original_label": F.col("label"),
    })


_RECORDS = _W.rstrip() + """,
m AS (SELECT *, doc_id % 2 = 0 AS rated FROM w),
records AS (SELECT *, ['k' || (doc_id % 7), CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'K' || (doc_id % 5) END] AS keywords,
  CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'A' || (doc_id % 4) END AS a_name, CASE WHEN rated THEN 'https://p.example.org/' || (doc_id % 3) END AS a_site, CASE WHEN doc_id % 5 = 0 THEN 'editor' END AS a_role,
  CASE WHEN doc_id % 6 <> 0 THEN 'https://s.example.org/a%20b' END AS a_same,
  CASE WHEN doc_id % 5 > 0 THEN repeat('d', CAST(doc_id % 5 AS INTEGER)) END AS description, CASE WHEN doc_id % 3 = 0 THEN 'abs' || (doc_id % 10) END AS abstract,
  CASE doc_id % 3 WHEN 0 THEN 'https://creativecommons.org/licenses/by/4.0/' WHEN 1 THEN 'CC BY' END AS license_url, CASE WHEN rated THEN '2024-01-0' || (doc_id % 9 + 1) END AS date_published,
  CASE WHEN doc_id % 2 = 1 THEN 'body ' || (doc_id % 50) END AS review_text, CASE WHEN rated THEN CAST(doc_id % 5 AS DOUBLE) END AS rating_value, CASE WHEN rated THEN 5.0::DOUBLE END AS best_rating, CASE WHEN rated THEN 1.0::DOUBLE END AS worst_rating,
  CASE WHEN doc_id % 7 = 0 THEN 'because' END AS explanation, CASE WHEN doc_id % 3 > 0 THEN 'H' || (doc_id % 3) END AS headline FROM m)
"""
_on(_records, "reviews_obs", lambda r: projection.grouped(r).select("claim_review_id", F.array_join("records", ",").alias("records")), _RECORDS + "SELECT claim_review_id, string_agg(source_name || ':' || record_key, ',' ORDER BY source_name, record_key) AS records FROM records GROUP BY 1")
_on(_records, "review_selected", lambda r: projection.selected(r, r.groupBy("claim_review_id").agg(F.max("claim_uri").alias("claim_uri"))), _RECORDS + "SELECT claim_review_id, arg_min(record_key, (claim_uri <> top, source_name, record_key)) AS record_key FROM (SELECT *, max(claim_uri) OVER (PARTITION BY claim_review_id) AS top FROM records) GROUP BY 1")
_KEYS = "(SELECT claim_review_id, array_to_string(list_sort(list(DISTINCT k)), ',') AS keywords FROM (SELECT claim_review_id, unnest(keywords) AS k FROM records) GROUP BY 1)"
_WHO = "(SELECT claim_review_id, string_agg(who, ';' ORDER BY source_name, record_key) AS authors FROM (SELECT *, row_number() OVER (PARTITION BY claim_review_id, who, a_role, a_same IS NULL ORDER BY source_name, record_key) AS k FROM (SELECT *, a_name || '|' || coalesce(a_site, '') AS who FROM records)) WHERE k = 1 GROUP BY 1)"
_on(_records, "review_keywords", lambda r: projection.gathered(r, "claim_review_id").select("claim_review_id", F.array_join("keywords", ",").alias("keywords"), F.array_join(F.transform("authors", lambda a: F.concat(a["name"], F.lit("|"), F.coalesce(a["website"], F.lit("")))), ";").alias("authors")), _RECORDS + f"SELECT claim_review_id, keywords, authors FROM {_KEYS} JOIN {_WHO} USING (claim_review_id)")
_on(_records, "review_source_views", lambda r: projection.source_views(r).select("claim_review_id", "source_name", "record_key", "date_published", "license_url", F.array_join("keywords", ",").alias("keywords"), "description", "abstract"), _RECORDS + """,
vs AS (SELECT *, (date_published IS NOT NULL)::INT + (lang IS NOT NULL)::INT + (label IS NOT NULL)::INT + (license_url IS NOT NULL)::INT + (description IS NOT NULL)::INT + (abstract IS NOT NULL)::INT AS n FROM records),
bs AS (SELECT claim_review_id, source_name, record_key, date_published, license_url FROM (SELECT *, row_number() OVER (PARTITION BY claim_review_id, source_name ORDER BY n DESC, len(keywords) DESC, record_key DESC) AS k FROM vs) WHERE k = 1),
ks AS (SELECT claim_review_id, source_name, array_to_string(list_sort(list(DISTINCT x)), ',') AS keywords FROM (SELECT claim_review_id, source_name, unnest(keywords) AS x FROM records) GROUP BY 1, 2),
ds AS (SELECT claim_review_id, source_name, arg_min(description, (-length(description), record_key)) FILTER (WHERE description <> '') AS description, arg_min(abstract, (-length(abstract), record_key)) FILTER (WHERE abstract <> '') AS abstract FROM records GROUP BY 1, 2)
SELECT * FROM bs JOIN ks USING (claim_review_id, source_name) JOIN ds USING (claim_review_id, source_name)""")


@_add("org_drift", _RECORDS + "SELECT claim_review_id, organization_uri, CASE lang WHEN 'en' THEN NULL ELSE 'org/new' END AS catalog_uri FROM (SELECT DISTINCT claim_review_id, organization_uri, lang FROM records WHERE lang IN ('en', 'fr'))")
def _drift(spark, sf_dir):
    reviews = _records(spark, sf_dir).select("claim_review_id", "organization_uri", F.concat(F.lit("https://"), "lang", F.lit(".org")).alias("organization_site")).distinct()
    now = [("https://fr.org", "org/new"), ("https://de.org", "org/de"), ("https://es.org", "org/es")]
    return projection.organization_drift(reviews, spark.createDataFrame(now, "site string, organization_uri string"))


# --- quads of records ------------------------------------------------------------------------------------------------------
def _s(name: str) -> str:
    return f"'{V.SCHEMA}{name}'"


_G, _REV, _CLAIM, _ORG = (f"'{V.BASE}/' || {x}" for x in ("'graph/' || source_name", "'review/' || claim_review_id", "claim_uri", "organization_uri"))
_NUM = lambda c: f"coalesce(CAST({c} AS VARCHAR), '')"
_PRINT = f"sha256(CAST(to_json(['rating', coalesce(label, ''), coalesce(label, ''), {_NUM('rating_value')}, {_NUM('best_rating')}, {_NUM('worst_rating')}]) AS VARCHAR))"
_RATING = f"'{V.BASE}/rating/' || sha256(CAST(to_json(['organization-rating', {_ORG}, {_PRINT}]) AS VARCHAR))"
_PERSON = f"'{V.BASE}/person/' || sha256(CAST(to_json(['person', a_name, coalesce(a_site, '')]) AS VARCHAR))"
_KNOWN = "(a_name <> '' OR a_site IS NOT NULL)"
_TYPED = f"'{V.RDF_TYPE}'"
#: (subject, predicate, object, kind, datatype, condition) of each part of a record's projection, as SQL.
_PARTS = {
    "review": [
        (_REV, _TYPED, _s("ClaimReview"), "iri", "", "true"), (_REV, _s("itemReviewed"), _CLAIM, "iri", "", "true"), (_REV, _s("author"), _ORG, "iri", "", "true"),
        (_REV, _s("datePublished"), "date_published", "literal", f"{V.XSD}date", "date_published IS NOT NULL"), (_REV, _s("inLanguage"), "lang", "literal", "", "lang <> ''"),
        (_REV, _s("text"), "review_text", "literal", "", "review_text IS NOT NULL"), (_REV, _s("description"), "description", "literal", "", "description IS NOT NULL"), (_REV, _s("abstract"), "abstract", "literal", "", "abstract IS NOT NULL"),
    ],
    "person": [
        (_REV, _s("author"), _PERSON, "iri", "", _KNOWN), (_PERSON, _TYPED, _s("Person"), "iri", "", _KNOWN), (_PERSON, _s("name"), "a_name", "literal", "", "a_name <> ''"),
        (_PERSON, _s("url"), "a_site", "iri", "", "a_site IS NOT NULL"), (_PERSON, _s("jobTitle"), "a_role", "literal", "", f"a_role IS NOT NULL AND {_KNOWN}"), (_PERSON, _s("sameAs"), "a_same", "iri", "", f"a_same IS NOT NULL AND {_KNOWN}"),
    ],
    "url": [(_REV, _s("url"), "observed_url", "iri", "", "true")],
    "rating": [
        (_REV, _s("reviewRating"), _RATING, "iri", "", "label IS NOT NULL"), (_REV, f"'{V.ONTOLOGY}normalizedReviewRating'", f"'{V.BASE}/rating/' || label", "iri", "", "label IS NOT NULL"),
        (_RATING, _s("author"), _ORG, "iri", "", "label IS NOT NULL"), (_RATING, _TYPED, _s("Rating"), "iri", "", "label IS NOT NULL"), (_RATING, _s("name"), "label", "literal", "", "label IS NOT NULL"),
        (_RATING, _s("ratingValue"), "label", "literal", "", "label IS NOT NULL AND rating_value IS NULL"),
        *[(_RATING, _s(p), f"CAST({c} AS VARCHAR)", "literal", f"{V.XSD}float", f"label IS NOT NULL AND {c} IS NOT NULL") for p, c in (("ratingValue", "rating_value"), ("bestRating", "best_rating"), ("worstRating", "worst_rating"))],
        (_RATING, _s("ratingExplanation"), "explanation", "literal", "", "label IS NOT NULL AND explanation IS NOT NULL"),
    ],
    "keyword": [
        *[(s, _s("keywords"), f"keywords[{i}]", "literal", "", f"keywords[{i}] <> ''") for s in (_REV, _CLAIM) for i in (1, 2)],
        (_REV, _s("license"), "license_url", "iri", "", "license_url LIKE 'https%'"), (_REV, _s("license"), "license_url", "literal", "", "license_url = 'CC BY'"),
    ],
    "claim": [(_CLAIM, _TYPED, _s("Claim"), "iri", "", "true"), (_CLAIM, _s("text"), "claim_text", "literal", "", "true"), (_CLAIM, _s("headline"), "headline", "literal", "", "headline IS NOT NULL"), (_CLAIM, _s("appearance"), "'https://a.example.org/' || doc_id", "iri", "", "true")],
}


def _quads_of(part: str) -> None:
    rows = [f"SELECT {_G} AS graph, {s} AS s, {p} AS p, {o} AS o, '{kind}' AS o_kind, '{dt}' AS o_datatype FROM records WHERE {when}" for s, p, o, kind, dt, when in _PARTS[part]]
    _on(_records, f"quads_{part}", lambda r: projection.record_quads(r, part).drop("part"), _RECORDS + ("\nUNION\n".join(rows) if len(rows) > 1 else rows[0].replace("SELECT", "SELECT DISTINCT", 1)))


for _part in _PARTS:
    _quads_of(_part)
_on(_records, "export_errors", lambda r: projection.export_errors(r.withColumns({"claim_text": F.when(F.col("doc_id") % 4 > 0, F.col("claim_text")), "organization_uri": F.when(F.col("doc_id") % 6 > 0, F.col("organization_uri"))})), _RECORDS + f"SELECT {_G} AS graph, count(*) AS failed, arg_min(CASE WHEN doc_id % 4 = 0 THEN 'no claim text' ELSE 'no organization' END, record_key) AS first_error FROM records WHERE doc_id % 4 = 0 OR doc_id % 6 = 0 GROUP BY 1")
_MENTIONS = f"graph = '{V.ENTITY_GRAPH}' AND p = '{V.SCHEMA}mentions'"
_on(V.quads, "quads_mentions", lambda q: q.filter(F.col("graph") == V.ENTITY_GRAPH).filter(F.col("p") == f"{V.SCHEMA}mentions").select("s", "o"), _Q + f"SELECT s, o FROM quads WHERE {_MENTIONS}")


@_add("kg_sample_orgs", _Q + f"SELECT r.s AS review, a.o AS author, 'Org ' || right(a.o, 2) AS name FROM (SELECT DISTINCT s, p, o FROM quads) r JOIN (SELECT DISTINCT s, p, o FROM quads) a ON a.s = r.s AND a.p = '{V.SCHEMA}author' WHERE r.p = '{V.RDF_TYPE}' AND r.o = '{V.SCHEMA}ClaimReview'")
def _sample_orgs(spark, sf_dir):
    names = V.observations(spark, sf_dir).select("organization_uri", "lang").distinct()
    names = names.select(F.lit(f"{V.BASE}/graph/organizations").alias("graph"), F.concat(F.lit(f"{V.BASE}/"), "organization_uri").alias("s"), F.lit(f"{V.SCHEMA}name").alias("p"), F.concat(F.lit("Org "), "lang").alias("o"), F.lit("literal").alias("o_kind"), F.lit("").alias("o_datatype"))
    return G.sample_organizations(V.quads(spark, sf_dir).unionByName(names))


# --- factors ------------------------------------------------------------------------------------------------------------------
def _payloads(spark, sf_dir):
    """One payload a document and model, some of the wrong type."""
    k, models = F.col("doc_id") % 6, list(projection.FACTOR_KINDS)
    value = (
        F.when(F.col("model") == "climate_related", F.get(F.array(*map(F.lit, ["true", '" False "', "null", "1", '"maybe"', "false"])), k.cast("int")))
        .when(F.col("model") == "conspiracies", F.concat(F.lit('{"mentioned":["M '), k, F.lit('",3],"promoted":'), F.when(k == 0, '"x"').otherwise('["P"]'), F.lit("}")))
        .when(F.col("model").isin("tropes", "persuasion_techniques"), F.when(k == 1, '"no list"').otherwise(F.concat(F.lit('["T '), k, F.lit('","",null]'))))
        .otherwise(F.when(k == 2, '"None"').when(k == 3, "null").when(k == 4, "[1]").otherwise(F.concat(F.lit('"V '), k, F.lit('"'))))
    )
    each = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("claim/"), F.col("doc_id") % 50).alias("subject_key"), F.explode(F.array(*map(F.lit, models))).alias("model"))
    return each.select("doc_id", "subject_key", "model", F.concat(F.lit('{"value":'), value, F.lit("}")).alias("payload"))


_MODELS = "['emotion', 'sentiment', 'political_leaning', 'tropes', 'persuasion_techniques', 'conspiracies', 'climate_related']"
_FACTOR_SQL = f"""WITH p AS (SELECT doc_id, 'claim/' || (doc_id % 50) AS subject_key, source, doc_id % 6 AS k, unnest({_MODELS}) AS model FROM documents),
f AS (SELECT *, model IN ('emotion', 'sentiment', 'political_leaning') AS one, model IN ('tropes', 'persuasion_techniques') AS many, model = 'conspiracies' AS two, model = 'climate_related' AS flagged FROM p),
v AS (SELECT *, CASE WHEN one AND k = 2 THEN 'None' WHEN one AND k NOT IN (3, 4) THEN 'V ' || k WHEN many AND k <> 1 THEN 'T ' || k || ',' ELSE '' END AS texts, CASE WHEN two THEN 'M ' || k ELSE '' END AS mentioned,
  CASE WHEN two AND k <> 0 THEN 'P' ELSE '' END AS promoted, CASE WHEN flagged AND k = 0 THEN true WHEN flagged AND k IN (1, 5) THEN false END AS flag, flagged AND k IN (3, 4) AS failed FROM f)
"""


@_add("factor_shape", _FACTOR_SQL + "SELECT DISTINCT subject_key, model, texts, mentioned, promoted, flag, failed FROM v")
def _factor_shape(spark, sf_dir):
    joined = lambda c: F.array_join(c, ",").alias(c)
    return projection.factor_values(_payloads(spark, sf_dir)).select("subject_key", "model", joined("texts"), joined("mentioned"), joined("promoted"), "flag", "failed").distinct()


_LABEL = "replace(lower({0}), ' ', '_')"
_FACTOR_ROWS = [(p, segment, "texts", f"model = '{name}' AND texts <> '' AND NOT (model = 'emotion' AND texts = 'None')") for name, p, segment, _ in V.FACTORS[:5]] + [(p, segment, column, f"{column} <> ''") for (_, p, segment, _), column in zip(V.FACTORS[5:], ("mentioned", "promoted"))]


@_add("quads_factors", _FACTOR_SQL + "\nUNION\n".join([f"SELECT '{V.BASE}/graph/' || source AS graph, '{V.BASE}/' || subject_key AS s, '{p}' AS p, '{V.BASE}/{segment}/' || {_LABEL.format(f'rtrim({column}, chr(44))')} AS o, 'iri' AS o_kind, '' AS o_datatype FROM v WHERE {when}" for p, segment, column, when in _FACTOR_ROWS] + [f"SELECT '{V.BASE}/graph/' || source, '{V.BASE}/' || subject_key, '{V.CLIMATE}', CAST(flag AS VARCHAR), 'literal', '{V.XSD}boolean' FROM v WHERE flag IS NOT NULL"]))
def _quads_factors(spark, sf_dir):
    # a subject is one document here, so that each has its own source
    p = _payloads(spark, sf_dir).withColumn("subject_key", F.concat("subject_key", F.lit("#"), "doc_id"))
    graphs = _docs(spark, sf_dir).select(F.concat(F.lit("claim/"), F.col("doc_id") % 50, F.lit("#"), "doc_id").alias("subject_key"), F.col("source").alias("source_name"))
    q = projection.factor_quads(projection.factor_values(p), graphs)
    return q.withColumn("s", F.substring_index("s", "#", 1)).distinct()


# --- catalog and source formats ------------------------------------------------------------------------------------------------
def _catalog_triples(spark, sf_dir):
    """One organization a page: most are right, the others break a rule each."""
    d, k = V.table(spark, sf_dir, "pages"), F.col("page_id") % 7
    s = F.concat(F.lit("https://o.org/organization/"), "page_id")
    t = lambda p, o, kind, when=None: F.when(F.lit(True) if when is None else when, F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind")))
    site = F.concat(F.lit("https://www.s"), "page_id", F.lit(".org/about"))
    rows = [
        t(V.RDF_TYPE, F.lit(f"{V.SCHEMA}Organization"), "iri"), t(f"{V.SCHEMA}name", F.concat(F.lit(" N"), "page_id"), "literal", k != 1), t(f"{V.SCHEMA}name", F.lit("second"), "literal", k == 2),
        t(f"{V.SCHEMA}url", site, "iri", ~k.isin(3, 4, 5, 6)), t(f"{V.SCHEMA}url", site, "literal", k == 4), t(f"{V.SCHEMA}url", F.lit("ftp://x"), "iri", k == 5), t(f"{V.SCHEMA}url", F.lit("https://shared.org"), "iri", k == 6),
    ]
    return d.select(F.explode(F.array(*rows)).alias("t")).filter("t is not null").select("t.*")


_on(_catalog_triples, "org_catalog", lambda t: catalog.organization_catalog(t, "https://o.org/organization/")[0], "SELECT 'https://o.org/organization/' || page_id AS organization_uri, 'N' || page_id AS name, 'https://s' || page_id || '.org' AS website, 'https://s' || page_id || '.org' AS site FROM pages WHERE page_id % 7 = 0")
_on(_catalog_triples, "org_catalog_errors", lambda t: catalog.organization_catalog(t, "https://o.org/organization/")[1].groupBy("error").agg(F.count("*").alias("n")), "SELECT CASE page_id % 7 WHEN 1 THEN 'name' WHEN 2 THEN 'name' WHEN 3 THEN 'no_url' WHEN 4 THEN 'url_not_iri' WHEN 5 THEN 'url_invalid' ELSE 'site_shared' END AS error, count(*) AS n FROM pages WHERE page_id % 7 > 0 GROUP BY 1")


@_add("defacto_normalize", f"SELECT 'xwiki:Medias.' || lang || '.p.' || doc_id AS native_id, {_FIRST} AS claim_text, 'https://w.org/p%20/' || doc_id AS observed_url, 'https://' || lang || '.org' AS organization_site, 'bold ' || source AS review_text, CASE WHEN doc_id % 2 = 0 THEN '2024-03-05' END AS date_published, 'https://w.org/p%20/' || doc_id AS appearances FROM documents WHERE NOT {_BAD} AND doc_id % 5 <> 0 AND doc_id % 7 <> 0")
def _wiki(spark, sf_dir):
    page = F.concat(F.when(F.col("doc_id") % 7 == 0, "xwiki:Other.").otherwise("xwiki:Medias."), "lang", F.lit(".p."), "doc_id")
    items = _docs(spark, sf_dir).select(
        page.alias("id"), F.when(F.col("doc_id") % 2 == 0, " ").otherwise(_first()).alias("title"), _first().alias("rawTitle"), F.when(F.col("doc_id") % 5 == 0, "/relative").otherwise(F.concat(F.lit("https://w.org/p /"), "doc_id")).alias("absoluteUrl"),
        F.concat(F.lit("**bold** "), "source").alias("content"), F.when(F.col("doc_id") % 2 == 0, "2024-03-05T10:00:00Z").otherwise("soon").alias("created"), F.col("lang").alias("language"), F.concat(F.lit("https://www."), "lang", F.lit(".org/x")).alias("organization_url"),
    )
    x = formats.wiki_pages(spark, items, "wiki").filter(F.size("errors") == 0)
    return x.select("native_id", "claim_text", "observed_url", "organization_site", "review_text", "date_published", F.array_join("appearances", " ").alias("appearances"))


_ITEMS = """WITH c AS (SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user') AS claims, list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS reviews FROM conversations GROUP BY 1),
n AS (SELECT *, coalesce(len(claims), 0) AS a, coalesce(len(reviews), 0) AS b FROM c), k AS (SELECT *, unnest(range(0, greatest(a, b))) AS i FROM n WHERE a > 0 AND b > 0 AND (a = b OR a = 1 OR b = 1)),
x AS (SELECT conv_id, i, trim(regexp_replace(claims[CASE WHEN a = 1 THEN 1 ELSE i + 1 END], '\\s+', ' ', 'g')) AS claim_text, reviews[CASE WHEN b = 1 THEN 1 ELSE i + 1 END] AS original_label FROM k)
"""


@_add("crd_normalize", _ITEMS + "SELECT 'https://r.org/' || conv_id AS observed_url, CAST(i AS VARCHAR) AS discriminator, claim_text, original_label, '2024-01-02' AS date_published, 'en' AS language FROM x WHERE claim_text <> '' AND regexp_matches(claim_text, '[\\p{L}\\p{N}]')")
def _crd_normalize(spark, sf_dir):
    c = V.table(spark, sf_dir, "conversations")
    said = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda r: r["text"])
    items = c.groupBy("conv_id").agg(said("user").alias("claims"), said("assistant").alias("labels"))
    items = items.select(
        F.col("claims").alias("claim_text"), F.concat(F.lit("https://r.org/"), "conv_id").alias("review_url"), F.lit(" ").alias("date_published"), F.lit("").alias("language"), F.array().cast("array<string>").alias("appearances"),
        F.struct(F.lit("n").alias("name"), F.lit("c").alias("country"), F.lit("en").alias("language"), F.lit("https://r.org").alias("website")).alias("fact_checker"),
        F.transform("labels", lambda t: F.struct(F.lit(None).cast("string").alias("label"), t.alias("original_label"), F.lit("2024-01-02").alias("date_published"), F.struct(*[F.lit(None).cast("string").alias(n) for n in ("ratingValue", "bestRating", "worstRating")]).alias("review_rating"))).alias("reviews"),
    )
    x = formats.review_items(spark, items, "items").filter(F.size("errors") == 0)
    return x.select("observed_url", "discriminator", "claim_text", "original_label", "date_published", "language")


def _turtle(spark, sf_dir, body):
    """One Turtle text a document."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace(T.collapse(_first()), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    head = F.lit("@prefix s: <https://schema.org/> .\n")
    return _docs(spark, sf_dir).select(F.concat(F.lit("f"), "doc_id").alias("file"), F.concat(head, body(quoted)).alias("value"))


_TURTLE_CLAIM = f"SELECT *, {_FIRST} AS claim FROM documents WHERE NOT {_BAD}"


@_add("desmog_normalize", f"SELECT 'https://t.org/c/' || doc_id AS native_id, claim AS claim_text, 'https://t.org/p/' || doc_id AS observed_url, 'https://' || lang || '.org' AS organization_site, lang AS language, '2024-0' || (doc_id % 9 + 1) AS date_published, 'https://c.org/' || doc_id || '?a=1&b=2 https://d.org/x https://a.org/' || doc_id || ' https://t.org/p/' || doc_id AS appearances FROM ({_TURTLE_CLAIM}) WHERE doc_id % 3 <> 0 AND len(regexp_extract_all(claim, '[\\p{{L}}\\p{{N}}_]+')) >= 2 AND length(regexp_replace(claim, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= 4")
def _turtle_claims(spark, sf_dir):
    node = F.concat(F.lit("<https://t.org/c/"), "doc_id", F.lit("> a s:Claim ; s:abstract "))
    publisher = F.when(F.col("doc_id") % 3 == 0, F.lit('"no IRI"')).otherwise(F.concat(F.lit("<https://www."), "lang", F.lit(".org/x>")))
    archive = F.concat(F.lit("<https://a.org/"), "doc_id", F.lit('> s:datePublished "2024-0'), F.col("doc_id") % 9 + 1, F.lit("\" ; s:citation '<a href=\"https://c.org/"), "doc_id", F.lit("?a=1&amp;b=2\">c</a> <a href=\"//d.org/x\">d</a>, ftp://no' .\n"))
    texts = _turtle(spark, sf_dir, lambda claim: F.concat(archive, node, claim, F.lit(" ; s:url <https://t.org/p/"), "doc_id", F.lit("> ; s:archivedAt <https://a.org/"), "doc_id", F.lit("> ; s:publisher "), publisher, F.lit(' ; s:inLanguage "'), "lang", F.lit('" .')))
    x = formats.turtle_claims(spark, texts, "claims").filter(F.size("errors") == 0)
    return x.select("native_id", "claim_text", "observed_url", "organization_site", "language", "date_published", F.array_join("appearances", " ").alias("appearances"))


@_add("climafacts_normalize", f"""SELECT 'https://t.org/r/' || doc_id AS native_id, claim AS claim_text, 'https://t.org/p/' || doc_id AS observed_url, 'https://' || lang || '.org' AS organization_site, CASE WHEN doc_id % 2 = 0 THEN 'not_credible' END AS label, '2024-03-05' AS date_published,
'One,two,k' || (doc_id % 4) AS keywords, 'Ann ' || lang || '|editor' AS authors, 'https://l.org/by' AS license_url, CASE WHEN doc_id % 2 = 0 THEN 1.5 END AS rating_value, CASE WHEN doc_id % 2 = 0 THEN 5.0 END AS best_rating, 'H' AS headline FROM ({_TURTLE_CLAIM}) WHERE doc_id % 5 <> 0""")
def _turtle_reviews(spark, sf_dir):
    node = F.concat(F.lit("<https://t.org/r/"), "doc_id", F.when(F.col("doc_id") % 5 == 0, "> a s:ClaimReview , s:Claim").otherwise("> a s:ClaimReview"), F.lit(" ; s:claimReviewed _:c ; s:author _:a ; s:author _:o ; s:reviewRating _:v ; s:license <https://l.org/by> ; s:keywords \"One, two ,ONE\" ; s:dateCreated \"2024-03-05\" ; s:url <https://t.org/p/"), "doc_id", F.lit("> .\n_:a a s:Person ; s:name \"Ann "), "lang", F.lit("\" ; s:url <https://ann.org> ; s:jobTitle \"editor\" .\n_:c s:keywords \"k"), F.col("doc_id") % 4, F.lit(",Two\" ; s:headline \"H\" ; s:text \"falsch\"@de , "))
    rest = F.concat(F.lit("@en .\n_:o s:url <https://www."), "lang", F.lit(".org/> .\n_:v s:ratingValue 1.5 ; s:bestRating \"5\" ; s:name \""), F.when(F.col("doc_id") % 2 == 0, "False").otherwise("other"), F.lit('" .'))
    texts = _turtle(spark, sf_dir, lambda claim: F.concat(node, F.when(claim == '""', F.lit('" "')).otherwise(claim), rest))
    x = formats.turtle_reviews(spark, texts, "reviews").filter(F.size("errors") == 0).filter(~F.col("claim_text").isin("falsch", "H"))
    return x.select(
        "native_id", "claim_text", "observed_url", "organization_site", "label", "date_published", F.array_join("keywords", ",").alias("keywords"), F.array_join(F.transform("authors", lambda a: F.concat_ws("|", a["name"], a["role"])), ",").alias("authors"),
        "license_url", "rating_value", "best_rating", "headline",
    )


@_add("obs_with_extraction", _O + "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'content ' || doc_id END AS content FROM observations")
def _obs_with_extraction(spark, sf_dir):
    o = V.observations(spark, sf_dir)
    done = o.filter("doc_id % 2 = 0").select("document_key", F.when(F.col("doc_id") % 4 == 0, "success").otherwise("retryable_failure").alias("status"), F.concat(F.lit("content "), "doc_id").alias("content"))
    return relational.with_extraction(o, done).select("doc_id", "content")


@_add("upsert_results", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS status, CASE WHEN doc_id % 3 <> 0 THEN 'payload' END AS payload FROM documents")
def _upsert_results(spark, sf_dir):
    d = _docs(spark, sf_dir)
    old = d.select("doc_id", F.lit("old").alias("status"), F.lit("payload").alias("payload"))
    return relational.upsert(old, d.filter("doc_id % 3 = 0").select("doc_id", F.lit("new").alias("status"), F.lit(None).cast("string").alias("payload")), ["doc_id"])


_on(V.observations, "counts", lambda o: o.groupBy("source_name").agg(F.count_distinct("claim_uri").alias("claims"), F.count_distinct("document_key").alias("documents"), F.count_distinct("organization_uri").alias("organizations")), _O + "SELECT source_name, count(DISTINCT claim_uri) AS claims, count(DISTINCT observed_url) AS documents, count(DISTINCT organization_uri) AS organizations FROM observations GROUP BY 1")
_on(_resolved, "identity_ids", lambda r: r.groupBy("organization_uri").agg(F.count_distinct("document_id").alias("documents"), F.count_distinct("claim_review_id").alias("reviews"), F.min("document_id").alias("first_id")), _W + "SELECT organization_uri, count(DISTINCT document_id) AS documents, count(DISTINCT claim_review_id) AS reviews, min(document_id) AS first_id FROM w GROUP BY 1")


@_add("identity_order", _W + "SELECT record_key, document_id FROM w")
def _identity_order(spark, sf_dir):
    """The classes after the rows were dealt and ordered anew."""
    o = V.with_hash(V.observations(spark, sf_dir).filter("problem is null"))
    return identity.resolve(o.repartition(7, F.xxhash64("record_key", F.lit(1))).sortWithinPartitions(F.desc("record_key"))).select("record_key", "document_id")


@_add("cache_key", _R + """SELECT DISTINCT 'pipeline:errors:' || substr(sha256('{"limit":200,"stage":"' || stage_name || '"}'), 1, 16) AS key FROM processing_results""")
def _cache_key(spark, sf_dir):
    r = V.processing_results(spark, sf_dir).select("stage_name").distinct()
    return r.select(F.concat(F.lit("pipeline:errors:"), F.substring(T.stable_hash(limit=F.lit(200), stage=F.col("stage_name")), 1, 16)).alias("key"))


@_add("link_short_texts", "SELECT CAST(doc_id AS VARCHAR) AS subject_key, length(text) < 10 AS skipped FROM documents")
def _short(spark, sf_dir):
    x = enrichment.skip_short(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("subject_key"), F.col("text").alias("input")))
    return x.select("subject_key", F.col("payload").isNotNull().alias("skipped"))


# --- identity over URLs and hashes, and its memory --------------------------------------------------------------------------
def _chained(spark, sf_dir):
    """Documents 2k and 2k + 1 share a canonical URL, 2k - 1 and 2k a text, but for ids divisible by 3."""
    n = F.col("doc_id")
    o = V.observations(spark, sf_dir).select("doc_id", "record_key", "claim_uri", "observed_url", "document_key", F.lit("org/x").alias("organization_uri"), F.lit("text").alias("source_text"), F.lit(1).alias("words"))
    return o.withColumns({"canonical_url": F.concat(F.lit("HTTPS://C.org:443/"), F.floor(n / 2)), "final_url": F.lit(None).cast("string"), "text_hash": F.when(n % 3 != 0, F.sha2(F.floor((n + 1) / 2).cast("string"), 256))})


_UUID = "regexp_replace(substr({0}, 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
_CHAIN = _O.rstrip() + f""",
b AS (SELECT doc_id, record_key, claim_uri, observed_url, CASE WHEN doc_id % 2 = 1 OR (doc_id > 0 AND doc_id % 3 <> 0 AND (doc_id - 1) % 3 <> 0) THEN 0 ELSE 1 END AS first FROM observations),
k AS (SELECT *, sum(first) OVER (ORDER BY doc_id) AS run FROM b), m AS (SELECT *, min(record_key) OVER (PARTITION BY run) AS founder FROM k),
ch AS (SELECT *, {_UUID.format("sha256(CAST(to_json(['document', 'org/x', founder]) AS VARCHAR))")} AS document_id FROM m)
"""


@_add("identity_chain", _CHAIN + "SELECT record_key, document_id FROM ch")
def _chain(spark, sf_dir):
    return identity.resolve(_chained(spark, sf_dir)).select("record_key", "document_id")


@_add("identity_memory", _CHAIN + "SELECT 'n' || record_key AS record_key, document_id FROM ch WHERE doc_id % 4 = 0")
def _memory(spark, sf_dir):
    """A later run that holds none of the first one's observations, only new ones of every fourth URL."""
    first = identity.resolve(_chained(spark, sf_dir))
    known = identity.new_evidence(first, None)
    later = _chained(spark, sf_dir).filter("doc_id % 4 = 0").withColumns({"record_key": F.concat(F.lit("n"), "record_key"), "text_hash": F.lit(None).cast("string"), "canonical_url": F.lit(None).cast("string")})
    return identity.resolve(later, None, known).select("record_key", "document_id")


@_add("identity_table", _CHAIN + "SELECT document_id, 'HTTPS://C.org:443/' || CAST(min(doc_id // 2) AS VARCHAR) AS preferred_url, 0 AS preferred_url_rank, min(CASE WHEN doc_id % 3 <> 0 THEN sha256(CAST((doc_id + 1) // 2 AS VARCHAR)) END) AS text_hash FROM ch GROUP BY 1 HAVING max(doc_id // 2) < 10 OR min(doc_id // 2) >= 10 AND max(doc_id // 2) < 100")
def _documents(spark, sf_dir):
    """The table after two runs: the first saw every second observation by its observed URL alone."""
    now, r = F.lit("2024-01-01 00:00:00").cast("timestamp"), identity.resolve(_chained(spark, sf_dir))
    early = r.filter("doc_id % 2 = 0").withColumns({"canonical_url": F.lit(None).cast("string"), "text_hash": F.lit(None).cast("string"), "words": F.lit(0)})
    table = identity.absorb_documents(spark.createDataFrame([], identity.DOCUMENTS), early, now)
    table = identity.absorb_documents(table, r, now)
    numbers = r.groupBy("document_id").agg(F.min(F.floor(F.col("doc_id") / 2)).alias("a"), F.max(F.floor(F.col("doc_id") / 2)).alias("b")).filter("b < 10 or a >= 10 and b < 100")
    return table.join(numbers, "document_id").select("document_id", "preferred_url", "preferred_url_rank", "text_hash")


@_add("identity_broken", _W + "SELECT record_key, CASE WHEN doc_id % 2 = 0 THEN 'other_organization' ELSE 'missing_review' END AS problem FROM w WHERE NOT (doc_id % 2 = 0 AND lang = 'en')")
def _broken(spark, sf_dir):
    r = _resolved(spark, sf_dir).withColumn("document_id", F.concat("document_id", F.col("doc_id") % 2))
    even, odd = r.filter("doc_id % 2 = 0").withColumn("claim_review_id", F.lit(None).cast("string")), r.filter("doc_id % 2 = 1")
    documents = even.select("document_id").distinct().withColumn("organization_uri", F.lit("org/en"))
    return identity.broken_references(even.unionByName(odd), documents, r.select("claim_review_id").limit(0))


# --- serialisation, publication and service ------------------------------------------------------------------------------------
_on(V.quads, "nq_lines", rdf.nq_lines, _Q + """SELECT graph, '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '"' || replace(replace(o, '\\', '\\\\'), '"', '\\"') || '"' || CASE WHEN o_datatype <> '' THEN '^^<' || o_datatype || '>' ELSE '' END END || ' <' || graph || '> .' AS line FROM quads""")


@_add("snapshot_activate", _Q + "SELECT graph, s, p, o, o_kind, o_datatype FROM quads WHERE graph NOT LIKE '%1' OR p LIKE '%inLanguage'")
def _served(spark, sf_dir):
    """Two snapshots; the second lacks graphs that are incomplete, so it carries what the first had of them, and is served."""
    from ..sources.storage import checkpoint_root
    from . import control

    root, q = f"{checkpoint_root(spark)}/served-{uuid.uuid4().hex}", V.quads(spark, sf_dir)
    graphs = [r[0] for r in q.select("graph").distinct().collect()]
    shut = [g for g in graphs if g.endswith("1")]
    rdf.publish(rdf.nt_lines(q.filter(F.col("p").endswith("inLanguage"))), f"{root}/a").count()
    rdf.publish(rdf.nt_lines(q), f"{root}/b", shut, f"{root}/a").count()
    control.activate(spark, root, f"{root}/a", graphs[:0])
    control.activate(spark, root, f"{root}/b", [g for g in graphs if g not in shut])
    return control.served(spark, root)


@_add("quads_entities", """WITH e AS (SELECT 'claim/' || doc_id AS s, 'https://e.org/' || (doc_id % 7) AS o FROM documents), m AS (SELECT DISTINCT o FROM e WHERE o <> 'https://e.org/3')
SELECT 'https://kg.example.org/' || s AS s, 'http://schema.org/mentions' AS p, o, 'iri' AS o_kind FROM e UNION ALL SELECT o, 'https://p.org/label', 'Label ' || o, 'literal' FROM m UNION ALL SELECT o, 'https://p.org/same', o || '/x', 'iri' FROM m""")
def _entities(spark, sf_dir):
    mentions = _docs(spark, sf_dir).select(F.concat(F.lit("claim/"), "doc_id").alias("subject"), F.concat(F.lit("https://e.org/"), F.col("doc_id") % 7).alias("uri"))
    table = {f"https://e.org/{k}": k for k in range(20) if k != 3}
    facts = enrichment.fetch_properties(mentions, lambda uris: [row for u in uris if u in table for row in ((u, "https://p.org/label", f"Label {u}", "literal"), (u, "https://p.org/label", f"Label {u}", "literal"), (u, "https://p.org/same", f"{u}/x", "uri"), (u, "https://p.org/same", "_:b", "bnode"), (u, "https://p.org/other", "z", "literal"))], batch=3)
    properties = enrichment.entity_properties(mentions, facts, ["https://p.org/label", "https://p.org/same"])
    return rdf.mention_quads(mentions, properties).select("s", "p", "o", "o_kind")


@_add("entity_merge", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'u:new,w:' || doc_id ELSE 'u:old,w:' || doc_id END AS uris, 'p=1|2,q=' || (doc_id % 3) AS properties FROM documents")
def _merge(spark, sf_dir):
    """A linker's mentions replaced where it ran again, and two maps of properties as one."""
    d = _docs(spark, sf_dir)
    m = lambda uri, source: F.struct(uri.alias("uri"), F.lit("x").alias("surface_form"), F.lit(source).alias("source"), F.create_map().cast("map<string,array<string>>").alias("properties"))
    held = F.array(m(F.lit("u:old"), "a"), m(F.concat(F.lit("w:"), "doc_id"), "b"))
    again = enrichment.replace_mentions(held, "a", F.array(m(F.lit("u:new"), "a")))
    merged = enrichment.merge_properties(F.create_map(F.lit("p"), F.array(F.lit("1"))), F.create_map(F.lit("q"), F.array((F.col("doc_id") % 3).cast("string")), F.lit("p"), F.array(F.lit("2"), F.lit("1"))))
    shown = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|")))), ",")
    return d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, again).otherwise(held).alias("m"), merged.alias("p")).select("doc_id", F.array_join(F.array_sort(F.transform("m", lambda x: x["uri"])), ",").alias("uris"), shown(F.col("p")).alias("properties"))


@_add("extract_store", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'permanent_failure' ELSE 'retryable_failure' END AS status, CASE page_id % 4 WHEN 1 THEN 'permanent' WHEN 2 THEN 'transient' WHEN 3 THEN 'access_blocked' END AS category, CASE WHEN page_id % 4 = 0 THEN 3 END AS words, CASE page_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END AS attempts FROM pages")
def _store(spark, sf_dir):
    """Outcomes of fetching every page, with one more try where it may help, as they are stored."""
    from ..operators import extraction

    pages = V.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("document_key"), F.concat(F.lit("https://h"), F.col("page_id") % 20, F.lit(".org/"), "page_id").alias("url"))

    def get(url: str) -> dict:
        k = int(url.rsplit("/", 1)[1])
        return [{"content": f"Page number {k}", "http_status": 200}, {"error_type": "http_error", "http_status": 404}, {"error_type": "timeout"}, {"error_type": "access_challenge"}][k % 4]

    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    done = extraction.fetch(pages, get, workers=4, retries=1, sleep=lambda s: None)
    rows = extraction.stored(done, "1", "c", now).join(done.select("document_key", "attempts"), "document_key")
    return rows.select(F.col("document_key").cast("long").alias("page_id"), "status", "category", "words", "attempts")
