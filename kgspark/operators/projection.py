"""Canonical projection: the observations of a review gathered, one view a review and source, and their quads.

A *record* is an identified observation with what its source says of it: date_published,
language, label, original_label, rating numbers, explanation, license_url, description,
abstract, keywords, authors, headline, appearances and urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest, label_segment
from ..functions.urls import sanitize_url
from .rdf import _quad

def _no_texts() -> Column:
    return F.array().cast("array<string>")


def grouped(records: DataFrame) -> DataFrame:
    """(claim_review_id, records): the record keys of each review as ``source:key``, by source and key."""
    pair = F.struct("source_name", "record_key")
    return records.groupBy("claim_review_id").agg(F.transform(F.array_sort(F.collect_list(pair)), lambda r: F.concat(r["source_name"], F.lit(":"), r["record_key"])).alias("records"))


def selected(records: DataFrame, reviews: DataFrame) -> DataFrame:
    """(claim_review_id, record_key): the first record whose claim is the review's own, else the first; reviews is (claim_review_id, claim_uri)."""
    own = reviews.select("claim_review_id", F.col("claim_uri").alias("_claim"))
    order = F.struct((~F.col("claim_uri").eqNullSafe(F.col("_claim"))).alias("other"), "source_name", "record_key")
    return records.join(own, "claim_review_id").groupBy("claim_review_id").agg(F.min(order)["record_key"].alias("record_key"))


def gathered(records: DataFrame, *keys: str) -> DataFrame:
    """(keys, keywords, authors): sorted distinct keywords, and authors in the order of their first record."""
    order = F.struct("source_name", "record_key", "authors")
    each = records.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("keywords", _no_texts()))))).alias("keywords"),
        F.array_sort(F.collect_list(order)).alias("_ordered"),
    )
    return each.select(*keys, "keywords", F.array_distinct(F.flatten(F.filter(F.transform("_ordered", lambda r: r["authors"]), lambda a: a.isNotNull()))).alias("authors"))


#: The fields whose number of values decides which record speaks for a review in a source.
FIELDS = ["date_published", "language", "label", "license_url", "description", "abstract"]


def source_views(records: DataFrame) -> DataFrame:
    """One row a review and source: the fullest record, with the keywords and authors of all and the longest description and abstract.

    An empty text counts as a value when records are weighed, but is no description or abstract.
    """
    filled = sum((F.col(c).isNotNull().cast("int") for c in FIELDS), F.lit(0))
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))
    weight = F.struct(filled.alias("n"), size("keywords").alias("k"), size("authors").alias("a"), "record_key")
    row = F.struct(*[F.col(c) for c in records.columns if c not in ("keywords", "authors", "description", "abstract")])
    longest = lambda c: F.min_by(c, F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.struct((-F.length(c)).alias("n"), F.col("record_key")))).alias(c)
    best = records.groupBy("claim_review_id", "source_name").agg(F.max_by(row, weight).alias("r"), longest("description"), longest("abstract"))
    lists = gathered(records, "claim_review_id", "source_name")
    return best.join(lists, ["claim_review_id", "source_name"]).select("r.*", "keywords", "authors", "description", "abstract")


def organization_drift(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """Reviews (claim_review_id, organization_uri, organization_site) whose site the catalog (site, organization_uri) now gives another organization, or none."""
    now = catalog.select(F.col("site").alias("organization_site"), F.col("organization_uri").alias("catalog_uri"))
    return reviews.join(now, "organization_site", "left").filter(~F.col("organization_uri").eqNullSafe(F.col("catalog_uri"))).select("claim_review_id", "organization_uri", "catalog_uri")


def _present(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _float(value: Column, graph, s, p, schema, xsd) -> Column:
    return _quad(graph, s, f"{schema}{p}", value.cast("string"), "literal", f"{xsd}float", value.isNotNull())


def record_quads(records: DataFrame, part: str | None = None) -> DataFrame:
    """(part, graph, s, p, o, o_kind, o_datatype) of records, each once; ``part`` is review, person, url, rating, keyword or claim.

    IRIs given by a source are sanitised, and dropped where they can't be; a license
    that is no URL becomes a literal.  Empty values give no quad.  With ``part`` only that part is built.
    """
    from ..plans.views import BASE, ONTOLOGY, RDF_TYPE, SCHEMA, XSD

    c, lit = F.col, F.lit
    iri = lambda *parts: F.concat(F.lit(f"{BASE}/"), *parts)
    graph, review, claim, org = iri(lit("graph/"), c("source_name")), iri(lit("review/"), c("claim_review_id")), iri(c("claim_uri")), iri(c("organization_uri"))
    number = lambda name: F.coalesce(c(name).cast("string"), lit(""))
    print_ = digest("rating", F.coalesce("label", lit("")), F.coalesce("original_label", lit("")), number("rating_value"), number("best_rating"), number("worst_rating"))
    rating, rated = iri(lit("rating/"), digest("organization-rating", org, print_)), _present(c("label"))
    text = lambda s, p, name, when=None: _quad(graph, s, f"{SCHEMA}{p}", c(name), "literal", when=_present(c(name)) if when is None else when & _present(c(name)))

    def person(a: Column) -> Column:
        node = iri(lit("person/"), digest("person", F.coalesce(a["name"], lit("")), F.coalesce(a["website"], lit(""))))
        known = _present(a["name"]) | _present(a["website"])
        return F.array(
            _quad(graph, review, f"{SCHEMA}author", node, when=known), _quad(graph, node, RDF_TYPE, f"{SCHEMA}Person", when=known),
            _quad(graph, node, f"{SCHEMA}name", a["name"], "literal", when=_present(a["name"])), _quad(graph, node, f"{SCHEMA}url", a["website"], "url", when=_present(a["website"])),
            _quad(graph, node, f"{SCHEMA}jobTitle", a["role"], "literal", when=known & _present(a["role"])), _quad(graph, node, f"{SCHEMA}sameAs", a["source_uri"], "url", when=known & _present(a["source_uri"])),
        )

    each = lambda s, p, name, kind: F.transform(F.coalesce(c(name), _no_texts()), lambda v: _quad(graph, s, f"{SCHEMA}{p}", v, kind, when=_present(v)))
    parts = {
        "review": F.array(
            _quad(graph, review, RDF_TYPE, f"{SCHEMA}ClaimReview"), _quad(graph, review, f"{SCHEMA}itemReviewed", claim), _quad(graph, review, f"{SCHEMA}author", org),
            _quad(graph, review, f"{SCHEMA}datePublished", c("date_published"), "literal", f"{XSD}date", _present(c("date_published"))),
            text(review, "inLanguage", "language"), text(review, "text", "review_text"), text(review, "description", "description"), text(review, "abstract", "abstract"),
        ),
        "person": F.flatten(F.transform(F.filter(F.coalesce("authors", F.array().cast(records.schema["authors"].dataType)), lambda a: a.isNotNull()), person)),
        "url": each(review, "url", "urls", "url"),
        "rating": F.array(
            _quad(graph, review, f"{SCHEMA}reviewRating", rating, when=rated), _quad(graph, review, f"{ONTOLOGY}normalizedReviewRating", iri(lit("rating/"), c("label")), when=rated),
            _quad(graph, rating, f"{SCHEMA}author", org, when=rated), _quad(graph, rating, RDF_TYPE, f"{SCHEMA}Rating", when=rated),
            _quad(graph, rating, f"{SCHEMA}name", F.coalesce(F.when(_present(c("original_label")), c("original_label")), c("label")), "literal", when=rated),
            F.when(rated, F.when(c("rating_value").isNull(), _quad(graph, rating, f"{SCHEMA}ratingValue", c("label"), "literal")).otherwise(_float(c("rating_value"), graph, rating, "ratingValue", SCHEMA, XSD))),
            F.when(rated, _float(c("best_rating"), graph, rating, "bestRating", SCHEMA, XSD)), F.when(rated, _float(c("worst_rating"), graph, rating, "worstRating", SCHEMA, XSD)),
            text(rating, "ratingExplanation", "explanation", rated),
        ),
        "keyword": F.concat(each(review, "keywords", "keywords", "literal"), each(claim, "keywords", "keywords", "literal"), F.array(_quad(graph, review, f"{SCHEMA}license", c("license_url"), "url_or_text", when=_present(c("license_url"))))),
        "claim": F.concat(F.array(_quad(graph, claim, RDF_TYPE, f"{SCHEMA}Claim"), _quad(graph, claim, f"{SCHEMA}text", c("claim_text"), "literal"), text(claim, "headline", "headline")), each(claim, "appearance", "appearances", "url")),
    }
    wanted = {part: parts[part]} if part else parts
    tag = lambda name: lambda x: F.when(x.isNotNull(), F.struct(F.lit(name).alias("part"), x.alias("q")))
    tagged = [F.transform(q, tag(name)) for name, q in wanted.items()]
    x = records.select(F.explode(F.concat(*tagged)).alias("t")).filter("t is not null").select("t.part", "t.q.*").distinct()
    given = F.col("o_kind").isin("url", "url_or_text")
    x = x.withColumn("_safe", sanitize_url(F.when(given, F.col("o"))))
    kind = F.when(given, F.when(F.col("_safe").isNotNull(), "iri").when(F.col("o_kind") == "url_or_text", "literal")).otherwise(F.col("o_kind"))
    x = x.select("part", "graph", "s", "p", F.coalesce("_safe", "o").alias("o"), kind.alias("o_kind"), "o_datatype").filter("o_kind is not null")
    return x.distinct()  # two spellings of a URL may have become one


FACTOR_KINDS = {"emotion": "text", "sentiment": "text", "political_leaning": "text", "tropes": "list", "persuasion_techniques": "list", "conspiracies": "two_lists", "climate_related": "flag"}


def factor_values(payloads: DataFrame) -> DataFrame:
    """(subject_key, model, texts, mentioned, promoted, flag, failed) of stored model payloads (subject_key, model, payload).

    A text or list of another JSON type is none, members of lists that aren't texts go, and a
    flag is a boolean or its name; any other flag but null is ``failed``.
    """
    v = F.try_variant_get(F.try_parse_json("payload"), "$.value", "variant")
    kind = F.coalesce(*[F.when(F.col("model") == m, k) for m, k in FACTOR_KINDS.items()])
    is_text = lambda x: F.schema_of_variant(x) == "STRING"
    texts = lambda x: F.transform(F.filter(F.coalesce(F.when(F.schema_of_variant(x).startswith("ARRAY"), F.try_variant_get(x, "$", "array<variant>")), F.array().cast("array<variant>")), is_text), lambda y: F.variant_get(y, "$", "string"))
    one = F.when(is_text(v), F.array(F.try_variant_get(v, "$", "string"))).otherwise(_no_texts())
    name = F.when(is_text(v), F.lower(F.trim(F.try_variant_get(v, "$", "string"))))
    flag = F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(name.isin("true", "false"), name == "true")
    null = v.isNull() | F.is_variant_null(v)
    side = lambda s: F.when(kind == "two_lists", texts(F.try_variant_get(v, f"$.{s}", "variant"))).otherwise(_no_texts())
    return payloads.select(
        "subject_key", "model", F.when(kind == "text", one).when(kind == "list", texts(v)).otherwise(_no_texts()).alias("texts"),
        side("mentioned").alias("mentioned"), side("promoted").alias("promoted"), F.when(kind == "flag", flag).alias("flag"),
        F.coalesce((kind == "flag") & ~null & flag.isNull(), F.lit(False)).alias("failed"),
    )


def factor_quads(values: DataFrame, graphs: DataFrame) -> DataFrame:
    """(graph, s, p, o, o_kind, o_datatype) of ``factor_values`` for claims, in each graph of (subject_key, source_name); the emotion ``None`` and empty labels give none."""
    from ..plans.views import BASE, CLIMATE, FACTORS, XSD

    segments = {name: (p, segment) for name, p, segment, _ in FACTORS}
    c = F.col
    graph, claim = F.concat(F.lit(f"{BASE}/graph/"), "source_name"), F.concat(F.lit(f"{BASE}/"), "subject_key")

    def labels(name: str, column: str, when: Column) -> Column:
        p, segment = segments[name]
        fit = F.filter(column, lambda t: when & (t != "") & ~((c("model") == "emotion") & (t == "None")))
        return F.transform(fit, lambda t: _quad(graph, claim, p, F.concat(F.lit(f"{BASE}/{segment}/"), label_segment(t))))

    rows = [labels(m, "texts", c("model") == m) for m, k in FACTOR_KINDS.items() if k in ("text", "list")]
    rows += [labels("conspiracies_mentioned", "mentioned", F.lit(True)), labels("conspiracies_promoted", "promoted", F.lit(True))]
    rows.append(F.array(_quad(graph, claim, CLIMATE, c("flag").cast("string"), "literal", f"{XSD}boolean", c("flag").isNotNull())))
    x = values.filter("not failed").join(graphs.select("subject_key", "source_name").distinct(), "subject_key")
    return x.select(F.explode(F.concat(*rows)).alias("q")).filter("q is not null").select("q.*").distinct()


def export_errors(records: DataFrame) -> DataFrame:
    """(graph, failed, first_error) of records that can't be projected: no id, claim or organization; the first by record key."""
    from ..plans.views import BASE

    error = F.when(F.col("claim_review_id").isNull(), "no review id").when(F.coalesce(F.trim("claim_text"), F.lit("")) == "", "no claim text").when(F.col("organization_uri").isNull(), "no organization")
    bad = records.select(F.concat(F.lit(f"{BASE}/graph/"), "source_name").alias("graph"), "record_key", error.alias("error")).filter("error is not null")
    return bad.groupBy("graph").agg(F.count("*").alias("failed"), F.min_by("error", "record_key").alias("first_error"))
