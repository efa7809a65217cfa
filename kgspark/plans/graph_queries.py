"""The knowledge-graph queries over the quads view, as plans of their own; samples and checks in SPARQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparql import sparql
from .views import BASE, CLIMATE, ENTITY_GRAPH, FACTORS, ONTOLOGY, RDF_TYPE, SCHEMA

_HEAD = f"PREFIX schema: <{SCHEMA}>\nPREFIX kg: <{ONTOLOGY}>\n"
SAMPLE = _HEAD + "SELECT ?review ?text ?value WHERE { ?review a schema:ClaimReview ; schema:itemReviewed ?claim ; schema:reviewRating ?rating . ?claim schema:text ?text . ?rating schema:ratingValue ?value . }"
COVERAGE = [("emotion", "kg:hasEmotion"), ("sentiment", "kg:hasSentiment"), ("political_leaning", "kg:hasPoliticalLeaning"), ("conspiracy", "(kg:mentionsConspiracy|kg:promotesConspiracy)"), ("tropes", "kg:hasTrope"), ("persuasion_techniques", "kg:hasPersuasionTechnique"), ("climate", "kg:isClimateRelated")]


def _types(q: DataFrame) -> DataFrame:
    """(s, o): each subject and each of its classes once, over all graphs."""
    return q.filter((F.col("p") == RDF_TYPE) & (F.col("o_kind") == "iri")).select("s", "o").distinct()


def _top(counts: DataFrame, key: str, n: str, limit: int) -> DataFrame:
    """The largest counts first, ties by key."""
    return counts.orderBy(F.desc(n), key).limit(limit)


def core_counts(q: DataFrame) -> DataFrame:
    """Reviews, claims and ratings: subjects of each class."""
    n = _types(q.filter(F.col("o").isin(*[f"{SCHEMA}{c}" for c in ("ClaimReview", "Claim", "Rating")]))).groupBy("o").agg(F.count("*").alias("n"))
    of = lambda c: F.coalesce(F.sum(F.when(F.col("o") == f"{SCHEMA}{c}", F.col("n"))), F.lit(0))
    return n.agg(of("ClaimReview").alias("total_reviews"), of("Claim").alias("total_claims"), of("Rating").alias("total_ratings"))


def class_distribution(q: DataFrame, limit: int = 50) -> DataFrame:
    return _top(_types(q).groupBy(F.col("o").alias("class")).agg(F.count("*").alias("count")), "class", "count", limit)


def triple_volume(q: DataFrame, limit: int = 25) -> DataFrame:
    """Triples of each of the engine's own graphs."""
    own = q.filter(F.col("graph").startswith(f"{BASE}/graph/"))
    return _top(own.groupBy("graph").agg(F.count("*").alias("triple_count")), "graph", "triple_count", limit)


def entity_mentions(q: DataFrame, limit: int = 25) -> DataFrame:
    """How often claims and reviews mention an entity, once for each class of the subject."""
    subjects = _types(q.filter(F.col("o").isin(f"{SCHEMA}Claim", f"{SCHEMA}ClaimReview"))).select("s")
    mentions = q.filter((F.col("graph") == ENTITY_GRAPH) & (F.col("p") == f"{SCHEMA}mentions")).select("s", F.col("o").alias("entity"))
    return _top(mentions.join(subjects, "s").groupBy("entity").agg(F.count("*").alias("count")), "entity", "count", limit)


def sample_claims(q: DataFrame, limit: int | None = None) -> DataFrame:
    """Reviews with their claim's text and rating; a sample of the first ``limit`` by review, if given."""
    return sparql(q, SAMPLE if limit is None else f"{SAMPLE} ORDER BY ?review LIMIT {limit}")


def sample_organizations(q: DataFrame) -> DataFrame:
    """Reviews with their author's name, over all graphs together: the names lie in the organizations' own graph."""
    return sparql(q, f"SELECT ?review ?author ?name WHERE {{ ?review a <{SCHEMA}ClaimReview> . ?review <{SCHEMA}author> ?author . ?author <{SCHEMA}name> ?name . }}")


def enrichment_coverage(q: DataFrame) -> DataFrame:
    """Flags for each claim by conditional aggregation: one pass, where a chain of OPTIONALs would multiply rows."""
    flag = lambda *ps: F.max(F.col("p").isin(*ps).cast("int"))
    of = dict((c, p) for c, p, _, _ in FACTORS)
    kinds = {"emotion": [of["emotion"]], "sentiment": [of["sentiment"]], "political_leaning": [of["political_leaning"]], "conspiracy": [of["conspiracies_mentioned"], of["conspiracies_promoted"]], "tropes": [of["tropes"]], "persuasion_techniques": [of["persuasion_techniques"]], "climate": [CLIMATE]}
    is_claim = F.max(((F.col("p") == RDF_TYPE) & (F.col("o") == f"{SCHEMA}Claim")).cast("int")).alias("is_claim")
    by = q.groupBy("s").agg(is_claim, *[flag(*ps).alias(k) for k, ps in kinds.items()]).filter("is_claim = 1")
    return by.agg(F.count("*").alias("total_claims"), *[F.coalesce(F.sum(k), F.lit(0)).alias(f"with_{k}") for k in kinds])


def enrichment_coverage_sparql(q: DataFrame) -> DataFrame:
    """The same as a chain of OPTIONALs, for engines that write it so; the tests hold both against each other."""
    counts = " ".join(f"(COUNT(DISTINCT ?has_{k}) AS ?with_{k})" for k, _ in COVERAGE)
    body = " ".join(f"OPTIONAL {{ ?claim {p} ?v_{k} . BIND(?claim AS ?has_{k}) }}" for k, p in COVERAGE)
    return sparql(q, _HEAD + f"SELECT (COUNT(DISTINCT ?claim) AS ?total_claims) {counts} WHERE {{ ?claim a schema:Claim . {body} }}")


def claim_factors(q: DataFrame) -> DataFrame:
    """Distinct claims by category and value: one filtered pass for all categories, and one for the claims."""
    category = F.create_map(*[F.lit(x) for c, p, _, _ in FACTORS for x in (p, c)], F.lit(CLIMATE), F.lit("climate_related"))[F.col("p")]
    mark = F.create_map(*[F.lit(x) for _, p, segment, _ in FACTORS for x in (p, f"/{segment}/")])[F.col("p")]
    value = F.when(mark.isNull(), F.col("o")).when(F.locate("/", "o") == 0, "").otherwise(F.when(F.instr(F.col("o"), mark) > 0, F.substr("o", F.instr(F.col("o"), mark) + F.length(mark))).otherwise(""))
    held = q.filter(F.col("p").isin(*[p for _, p, _, _ in FACTORS], CLIMATE)).select("s", category.alias("category"), value.alias("value"))
    claims = q.filter((F.col("p") == RDF_TYPE) & (F.col("o") == f"{SCHEMA}Claim")).select("s")
    return held.join(claims, "s", "left_semi").groupBy("category", "value").agg(F.count_distinct("s").alias("count")).orderBy("category", "value")


def claim_factors_sparql(q: DataFrame) -> DataFrame:
    """The same as a union of patterns; the tests hold both against each other."""
    arms = [f'{{ ?claim <{p}> ?v . BIND("{c}" AS ?category) BIND(STRAFTER(STR(?v), "/{segment}/") AS ?value) }}' for c, p, segment, _ in FACTORS]
    arms.append(f'{{ ?claim <{CLIMATE}> ?v . BIND("climate_related" AS ?category) BIND(STR(?v) AS ?value) }}')
    return sparql(q, _HEAD + "SELECT ?category ?value (COUNT(DISTINCT ?claim) AS ?count) WHERE { ?claim a schema:Claim . " + " UNION ".join(arms) + " } GROUP BY ?category ?value ORDER BY ?category ?value")


def graph_stats(q: DataFrame) -> DataFrame:
    return q.groupBy("graph").agg(F.count("*").alias("n"))


def graph_stats_typed(q: DataFrame) -> DataFrame:
    return q.filter(F.col("p") == RDF_TYPE).groupBy("graph").agg(F.count("*").alias("n"))


def totals(q: DataFrame) -> DataFrame:
    v = triple_volume(q)
    return v.agg(F.sum("triple_count").alias("triples"), F.count("*").alias("graphs"))
