"""Readers of the source formats: raw snapshots to observations and rejects.

Every reader declares its schema, validates with named rules and returns one table with the
observation columns and ``errors``; rows with errors are the rejects and are never dropped silently.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.text import canonical_text, claim_problem, digest, extract_urls, rating_label, strip_wiki
from ..functions.urls import organization_url, sanitize_url

REVIEW_ITEM = """claim_text array<string>, review_url string, date_published string, language string, appearances array<string>,
fact_checker struct<name string, country string, language string, website string>,
reviews array<struct<label string, original_label string, date_published string, review_rating struct<ratingValue string, bestRating string, worstRating string>>>"""
ARTICLE = "url string, title string, description string, source string, category string, language string, date string, content string, author string"
DEBUNK = "id string, externalUrl string, headline string, reviewBody string, dateCreated string, language string, itemReviewed struct<text string>"
WIKI = "id string, title string, rawTitle string, absoluteUrl string, content string, created string, language string, organization_url string"
EVIDENCE = "claim_id string, claim string, claim_label string, evidences array<struct<article string, evidence string, evidence_label string>>"
#: Claim labels of the evidence format and the ratings they mean.
EVIDENCE_LABELS = {"SUPPORTS": "credible", "REFUTES": "not_credible", "NOT_ENOUGH_INFO": "not_verifiable", "DISPUTED": "uncertain"}


_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_TIME = r"(?:[t\s]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:am|pm)?\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2}|[+-]\d{2})?)?$"
_DAY_NAME = r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"
_MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"


def any_date(c: Column) -> Column:
    """A free-form date, with or without a time, as YYYY-MM-DD; null if it is none.

    Of numbers the month comes first unless it can't be one; a date needs day, month and year.
    """
    s = F.regexp_replace(F.lower(F.trim(c)), _DAY_NAME, "")
    part = lambda pattern, k: F.nullif(F.regexp_extract(s, pattern, k), F.lit(""))
    day = lambda y, m, d: F.to_date(F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("y-M-d")))
    number = F.create_map(*[F.lit(x) for k, m in enumerate(_MONTHS, 1) for x in (m, str(k))])
    ymd, flat, numeric = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TIME, r"^(\d{4})(\d{2})(\d{2})" + _TIME, r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _TIME
    first, second = rf"^{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}),?" + _TIME, rf"^(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+{_MONTH},?[\s-]+(\d{{4}}),?" + _TIME
    swapped = part(numeric, 1).cast("int") > 12
    found = (
        F.when(s.rlike(ymd), day(part(ymd, 1), part(ymd, 2), part(ymd, 3)))
        .when(s.rlike(flat), day(part(flat, 1), part(flat, 2), part(flat, 3)))
        .when(s.rlike(numeric), day(part(numeric, 3), F.when(swapped, part(numeric, 2)).otherwise(part(numeric, 1)), F.when(swapped, part(numeric, 1)).otherwise(part(numeric, 2))))
        .when(s.rlike(first), day(part(first, 3), number[F.left(part(first, 1), F.lit(3))], part(first, 2)))
        .when(s.rlike(second), day(part(second, 3), number[F.left(part(second, 2), F.lit(3))], part(second, 1)))
    )
    return F.date_format(found, "yyyy-MM-dd")


#: Further fields that a source may give an observation.
AUTHORS = "array<struct<name:string,website:string,role:string,source_uri:string>>"
DETAILS = {"description": "string", "abstract": "string", "headline": "string", "license_url": "string", "explanation": "string", "rating_value": "double", "best_rating": "double", "worst_rating": "double"}


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def first_text(*columns: Column) -> Column:
    """The first column that isn't blank."""
    return reduce(lambda a, c: F.coalesce(a, F.when(~blank(c), c)), columns, F.lit(None).cast("string"))


def _errors(**rules: Column) -> Column:
    """Names of the rules that a row breaks."""
    return F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules.items()]), lambda x: x.isNotNull())


@F.pandas_udf(BooleanType())
def _is_list(s: pd.Series) -> pd.Series:
    def whole(text: str | None) -> bool:
        try:
            return isinstance(json.loads(text or ""), list)
        except ValueError:  # empty, cut short, without a separator, or with more after its end
            return False

    return s.map(whole)


def json_items(raw: DataFrame, schema: str) -> DataFrame:
    """Items of texts (value) that hold one JSON array each; ``bad_file`` marks a text that isn't exactly one array, and such a text gives no items."""
    checked = raw.select(_is_list("value").alias("good"), "value")
    items = checked.select(F.when(F.col("good"), F.from_json("value", f"array<struct<{_typed(schema)}>>", {"mode": "PERMISSIVE"})).alias("items"), (~F.col("good")).alias("bad_file"))
    return items.filter("bad_file or size(items) > 0").select(F.posexplode_outer("items").alias("item_index", "item"), "bad_file").select("item_index", "bad_file", "item.*")


def _json_array(spark: SparkSession, path: str | DataFrame, schema: str) -> DataFrame:
    """Items of files that hold one JSON array each.  A table of items is taken as it is."""
    if isinstance(path, DataFrame):
        return path.select(F.lit(0).alias("item_index"), F.lit(False).alias("bad_file"), *[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in path.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _fields(schema)])
    return json_items(spark.read.text(path, wholetext=True), schema)


def _fields(schema: str) -> list:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fields


def _typed(schema: str) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in _fields(schema))


def _observations(x: DataFrame, source_name: str, source_type: str, **columns: Column) -> DataFrame:
    given = {c: F.lit(None).cast("string") for c in ("native_id", "review_text", "original_label", "date_published", "language", "organization_site")}
    given |= {"appearances": F.array().cast("array<string>"), "discriminator": F.lit(""), "keywords": F.array().cast("array<string>"), "authors": F.array().cast(AUTHORS)}
    given |= {c: F.lit(None).cast(t) for c, t in DETAILS.items()} | columns
    x = x.select(*[c.alias(k) for k, c in given.items()])
    x = x.withColumn("claim_text", canonical_text(F.col("claim_text"))).withColumn("organization_site", organization_url(F.col("organization_site")))
    problem = claim_problem(F.col("claim_text"))
    errors = F.concat("errors", F.when(problem.isNotNull() & (F.size("errors") == 0), F.array(F.concat(F.lit("claim_"), problem))).otherwise(F.array().cast("array<string>")))
    own = digest("source-review-record-native", F.lit(source_name), F.lit(source_type), F.trim("native_id"))
    other = digest("source-review-record", F.lit(source_name), F.lit(source_type), F.trim("observed_url"), F.col("claim_text"), F.col("discriminator"))
    return x.select(
        F.lit(source_name).alias("source_name"), F.lit(source_type).alias("source_type"), F.when(blank(F.col("native_id")), other).otherwise(own).alias("record_key"),
        "native_id", "observed_url", "organization_site", "claim_text", F.concat(F.lit("claim/"), digest("claim", F.col("claim_text"))).alias("claim_uri"),
        "review_text", "original_label", rating_label(F.col("original_label")).alias("label"), "date_published", "language", "appearances", "discriminator", "keywords", "authors", *[F.col(c).cast(t).alias(c) for c, t in DETAILS.items()], errors.alias("errors"),
    )


def review_items(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    """Items of claims and reviews: paired one to one, or one with each; others are ambiguous."""
    x = _json_array(spark, path, REVIEW_ITEM)
    a, b = F.size("claim_text"), F.size("reviews")
    rules = _errors(
        not_a_list=F.col("bad_file"), claims=~F.coalesce((a > 0) & F.forall("claim_text", lambda c: ~blank(c)), F.lit(False)), url=blank(F.col("review_url")),
        checker=blank(F.col("fact_checker.name")) | blank(F.col("fact_checker.website")), reviews=~F.coalesce((b > 0) & F.forall("reviews", lambda r: r["original_label"].isNotNull()), F.lit(False)),
        ambiguous=(a != b) & (a != 1) & (b != 1),
    )
    pair = lambda c, r: F.struct(c.alias("c"), r.alias("r"))
    pairs = F.when(F.size("errors") > 0, F.array(pair(F.lit(None).cast("string"), F.get("reviews", F.lit(0))))).when(a == b, F.zip_with("claim_text", "reviews", pair)).when(a == 1, F.transform("reviews", lambda r: pair(F.get("claim_text", F.lit(0)), r))).otherwise(F.transform("claim_text", lambda c: pair(c, F.get("reviews", F.lit(0)))))
    x = x.withColumn("errors", rules).select("*", F.posexplode_outer(pairs).alias("pair_index", "pair"))
    return _observations(
        x, source_name, "review_items", claim_text=F.col("pair.c"), observed_url=F.col("review_url"), organization_site=F.col("fact_checker.website"), original_label=F.col("pair.r.original_label"),
        date_published=first_text(F.col("date_published"), F.col("pair.r.date_published")), language=first_text(F.col("language"), F.col("fact_checker.language")),
        appearances=F.filter(F.coalesce("appearances", F.array().cast("array<string>")), lambda u: u.isNotNull()), discriminator=F.col("pair_index").cast("string"), errors=F.col("errors"),
        rating_value=F.col("pair.r.review_rating.ratingValue").try_cast("double"), best_rating=F.col("pair.r.review_rating.bestRating").try_cast("double"), worst_rating=F.col("pair.r.review_rating.worstRating").try_cast("double"),
    )


def articles(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    """Articles: the claim is the first of title, description and content; the category is the rating."""
    x = _json_array(spark, path, ARTICLE)
    x = x.withColumn("errors", _errors(not_a_list=F.col("bad_file"), url=blank(F.col("url"))))
    site = F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]+)", 1)
    return _observations(x, source_name, "articles", claim_text=first_text(F.col("title"), F.col("description"), F.col("content")), observed_url=F.col("url"), organization_site=site, review_text=F.col("content"), original_label=F.col("category"), date_published=F.coalesce(any_date(F.col("date")), F.lit("")), language=F.col("language"), errors=F.col("errors"))


def debunks(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    """Debunks: language is a string or a list, whose first element counts."""
    x = _json_array(spark, path, DEBUNK)
    rules = _errors(not_a_list=F.col("bad_file"), id=blank(F.col("id")), url=blank(F.col("externalUrl")), claim=blank(F.col("itemReviewed.text")), text=blank(F.col("headline")) & blank(F.col("reviewBody")))
    language = F.coalesce(F.get_json_object("language", "$[0]"), F.when(~F.col("language").startswith("["), F.col("language")))
    text = F.trim(F.concat_ws("\n", F.coalesce("headline", F.lit("")), F.coalesce("reviewBody", F.lit(""))))
    return _observations(x.withColumn("errors", rules), source_name, "debunks", native_id=F.col("id"), claim_text=F.col("itemReviewed.text"), observed_url=F.col("externalUrl"), organization_site=F.col("externalUrl"), review_text=text, date_published=any_date(F.col("dateCreated")), language=language, errors=F.col("errors"))


def wiki_pages(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    """Wiki pages: title before raw title, markup removed; the organization is the page id's second part under ``xwiki:Medias``, with its site."""
    x = _json_array(spark, path, WIKI)
    parts = F.split("id", r"\.")
    known = (F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "xwiki:Medias") & (F.get(parts, F.lit(1)) != "") & F.col("organization_url").isNotNull()
    url = F.when(F.col("absoluteUrl").rlike("^https?://[^/]+"), sanitize_url(F.col("absoluteUrl")))
    rules = _errors(not_a_list=F.col("bad_file"), id=blank(F.col("id")), url=url.isNull(), organization=~F.coalesce(known, F.lit(False)))
    return _observations(x.withColumn("errors", rules), source_name, "wiki_pages", native_id=F.col("id"), claim_text=F.trim(first_text(F.col("title"), F.col("rawTitle"))), observed_url=url, organization_site=F.col("organization_url"), review_text=F.nullif(strip_wiki(F.col("content")), F.lit("")), date_published=any_date(F.col("created")), language=F.col("language"), appearances=F.filter(F.array(url), lambda u: u.isNotNull()), errors=F.col("errors"))


def evidence_lines(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    """JSON lines of claims with evidence; lines that don't parse are rejects."""
    raw = (path if isinstance(path, DataFrame) else spark.read.text(path)).filter(~blank(F.col("value")))
    x = raw.select(F.from_json("value", EVIDENCE).alias("x"), "value").select("x.*")
    rules = _errors(line=F.col("claim_id").isNull(), claim=blank(F.col("claim")), label=~F.coalesce(F.col("claim_label").isin(*EVIDENCE_LABELS), F.lit(False)))
    pages = F.array_distinct(F.transform(F.coalesce("evidences", F.array().cast("array<struct<article:string,evidence:string,evidence_label:string>>")), lambda e: F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.regexp_replace(e["article"], " ", "_"))))
    text = F.array_join(F.transform("evidences", lambda e, i: F.concat((i + 1).cast("string"), F.lit(". "), e["evidence"])), "\n")
    label = F.create_map(*[F.lit(v) for kv in EVIDENCE_LABELS.items() for v in kv])[F.col("claim_label")]
    return _observations(x.withColumn("errors", rules), source_name, "evidence_lines", native_id=F.col("claim_id"), claim_text=F.col("claim"), observed_url=F.concat(F.lit("urn:claim:"), "claim_id"), review_text=text, original_label=label, appearances=pages, language=F.lit("en"), errors=F.col("errors"))


def _safe_urls(urls: Column) -> Column:
    """http(s) URLs trimmed, with https where only ``//`` is given; the rest go."""
    whole = F.transform(urls, lambda u: F.when(F.trim(u).startswith("//"), F.concat(F.lit("https:"), F.trim(u))).otherwise(F.trim(u)))
    return F.filter(whole, lambda u: u.rlike("(?i)^https?://"))


def turtle_claims(spark: SparkSession, path: str, source_name: str, schema: str = "https://schema.org/") -> DataFrame:
    """``Claim`` resources of Turtle files with abstract, url and publisher; appearances are the URLs of the archived nodes' citations, these nodes' own URLs and the claim's."""
    from .turtle import RDF, read_turtle

    t = read_turtle(spark, path)
    claims = t.filter((F.col("p") == RDF + "type") & (F.col("o") == schema + "Claim") & ~F.col("s").startswith("_:")).select("s").distinct()
    pick = lambda name, kind=None: F.min(F.when((F.col("p") == schema + name) & (F.lit(True) if kind is None else F.col("o_kind") == kind), F.struct("pos", "o")))["o"]
    x = t.join(claims, "s").groupBy("s").agg(pick("abstract").alias("abstract"), pick("url").alias("url"), pick("publisher", "iri").alias("publisher"), pick("inLanguage").alias("lang"), pick("description").alias("description"))
    archived = t.join(claims, "s").filter(F.col("p") == schema + "archivedAt").select("s", F.col("o").alias("node"), F.col("o_kind").alias("node_kind"), F.col("pos").alias("at"))
    nodes = t.filter(F.col("p").isin(*[schema + n for n in ("citation", "url", "datePublished")])).groupBy(F.col("s").alias("node")).agg(pick("citation").alias("citation"), pick("url").alias("node_url"), pick("datePublished").alias("node_date"))
    own = F.coalesce(F.col("node_url"), F.when(F.col("node_kind") == "iri", F.col("node")))
    urls = F.concat(extract_urls(F.coalesce("citation", F.lit(""))), F.array(own))
    found = archived.join(nodes, "node", "left").select("s", "at", urls.alias("urls"), "node_date")
    found = found.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("at", "urls"))).alias("found"), F.min_by("node_date", "at").alias("date"))
    x = x.join(found, "s", "left").withColumn("found", F.concat(F.flatten(F.transform(F.coalesce("found", F.array().cast("array<struct<at:long,urls:array<string>>>")), lambda f: f["urls"])), F.array("url")))
    each = x.select("s", F.posexplode(_safe_urls(F.filter("found", lambda u: u.isNotNull()))).alias("at", "u")).withColumn("u", sanitize_url(F.col("u"))).filter("u is not null")
    x = x.join(each.groupBy("s").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("at", "u"))), lambda e: e["u"])).alias("urls")), "s", "left")
    words, letters = F.size(F.regexp_extract_all("abstract", F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))), F.length(F.regexp_replace("abstract", r"[^\p{L}\p{N}]", ""))
    rules = _errors(abstract=blank(F.col("abstract")), url=blank(F.col("url")), publisher=blank(F.col("publisher")), fragment=(words < 2) | (letters < 4))
    return _observations(x.withColumn("errors", rules), source_name, "turtle_claims", native_id=F.col("s"), claim_text=F.col("abstract"), observed_url=F.col("url"), organization_site=F.col("publisher"), review_text=F.col("description"), date_published=F.col("date"), language=F.col("lang"), appearances=F.coalesce("urls", F.array().cast("array<string>")), errors=F.col("errors"))


def turtle_reviews(spark: SparkSession, path: str, source_name: str, schema: str = "https://schema.org/") -> DataFrame:
    """``ClaimReview`` resources that aren't claims: claim node, publisher or author node, rating node; English literals first.

    Authors that are persons become authors, and never the organization; the rating's numbers count only if its
    label is a known one; keywords of review and claim are split at commas, each once in any case of letters.
    """
    from .turtle import RDF, read_turtle

    t = read_turtle(spark, path)
    kinds = t.filter(F.col("p") == RDF + "type").groupBy("s").agg(F.collect_set("o").alias("kinds"))
    reviews = kinds.filter(F.array_contains("kinds", schema + "ClaimReview") & ~F.array_contains("kinds", schema + "Claim") & ~F.col("s").startswith("_:")).select("s")
    rank = F.when(F.col("o_lang") == "en", 0).when(F.col("o_lang") == "en-us", 1).when(F.col("o_lang") == "en-gb", 2).otherwise(3)
    best = lambda *names: F.min(F.when(F.col("p").isin(*[schema + n for n in names]) & (F.trim("o") != ""), F.struct(rank.alias("r"), "pos", "o")))["o"]
    every = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("p") == schema + name, F.struct("pos", "o")))), lambda k: k["o"])
    nodes = t.groupBy(F.col("s").alias("node")).agg(
        best("text", "headline").alias("n_text"), best("headline").alias("n_headline"), best("url").alias("n_url"), best("name").alias("n_name"), best("jobTitle").alias("n_role"),
        best("ratingValue").alias("n_value"), best("bestRating").alias("n_best"), best("worstRating").alias("n_worst"), best("ratingExplanation").alias("n_why"), every("keywords").alias("n_keywords"), every("citation").alias("n_citation"),
        F.max((F.col("p") == RDF + "type") & (F.col("o") == schema + "Person")).alias("n_person"),
    )
    authors = t.join(reviews, "s").filter(F.col("p").isin(schema + "author", schema + "publisher")).select("s", "pos", (F.col("p") == schema + "publisher").alias("publisher"), F.col("o").alias("node"), "o_kind").join(nodes, "node", "left")
    person = F.struct(F.when(F.col("o_kind") == "literal", F.col("node")).otherwise(F.col("n_name")).alias("name"), F.col("n_url").alias("website"), F.col("n_role").alias("role"), F.when(F.col("o_kind") == "iri", F.col("node")).alias("source_uri"))
    is_person = F.coalesce("n_person", F.lit(False)) & ~F.col("publisher")
    site = F.coalesce("n_url", F.when(F.col("o_kind") == "iri", F.col("node")))
    people = authors.groupBy("s").agg(
        F.transform(F.array_sort(F.collect_list(F.when(is_person, F.struct("pos", person.alias("a"))))), lambda r: r["a"]).alias("authors"),
        F.min(F.when(~is_person & site.isNotNull(), F.struct((~F.col("publisher")).alias("later"), "pos", site.alias("site"))))["site"].alias("site"),
    )
    x = t.join(reviews, "s").groupBy("s").agg(
        best("url").alias("url"), best("claimReviewed").alias("claimed"), best("reviewRating").alias("rated"), best("reviewBody", "text").alias("body"), best("description").alias("description"), best("abstract").alias("abstract"),
        best("dateCreated").alias("created"), best("inLanguage").alias("lang"), best("license").alias("license"), every("keywords").alias("words"),
    ).join(people, "s", "left")
    for key in ("claimed", "rated"):
        x = x.join(nodes.select(F.col("node").alias(key), *[F.col(c).alias(f"{key}_{c[2:]}") for c in nodes.columns if c != "node"]), key, "left")
    claim = first_text(F.col("claimed_text"), F.when(~F.col("claimed").rlike("^(https?://|_:)"), F.col("claimed")))
    no_texts = F.array().cast("array<string>")
    words = F.filter(F.transform(F.flatten(F.transform(F.concat(F.coalesce("words", no_texts), F.coalesce("claimed_keywords", no_texts)), lambda k: F.split(k, ","))), lambda k: F.trim(k)), lambda k: k != "")
    low = F.transform(words, F.lower)
    keywords = F.filter(words, lambda k, i: F.array_position(low, F.lower(k)) == i + 1)
    known = rating_label(F.col("rated_name")).isNotNull()
    number = lambda c: F.when(known, F.col(c).try_cast("double"))
    rules = _errors(claim=blank(claim), url=blank(F.col("url")))
    return _observations(
        x.withColumn("errors", rules), source_name, "turtle_reviews", native_id=F.col("s"), claim_text=claim, observed_url=F.col("url"), organization_site=F.col("site"), original_label=F.col("rated_name"), review_text=F.col("body"),
        date_published=any_date(F.col("created")), language=F.col("lang"), description=F.col("description"), abstract=F.col("abstract"), headline=F.col("claimed_headline"), license_url=F.col("license"), keywords=keywords, authors=F.coalesce("authors", F.array().cast(AUTHORS)),
        rating_value=number("rated_value"), best_rating=number("rated_best"), worst_rating=number("rated_worst"), explanation=F.when(known, F.col("rated_why")), appearances=_safe_urls(F.coalesce("claimed_citation", no_texts)), errors=F.col("errors"),
    )


FORMATS = {f.__name__: f for f in (review_items, articles, debunks, wiki_pages, evidence_lines, turtle_claims, turtle_reviews)}


def read_source(spark: SparkSession, kind: str, path: str, source_name: str) -> tuple[DataFrame, DataFrame]:
    """(observations, rejects) of one source snapshot."""
    rows = FORMATS[kind](spark, path, source_name)
    return rows.filter(F.size("errors") == 0).drop("errors"), rows.filter(F.size("errors") > 0).select("source_name", "observed_url", "native_id", "discriminator", "errors")
