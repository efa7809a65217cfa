"""Exact entity resolution: documents and claim reviews from observations.

Inside one organization, observations that share a normalised URL or an exact
identity-text hash are one document; a document and a claim make one review.
The classes are the connected components of that evidence, so neither order nor batches matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_uuid, digest, identity_text
from ..functions.urls import document_url
from ..sources.storage import checkpoint_root


def _cut(df: DataFrame) -> DataFrame:
    """Written in the shared folder and read again: later rounds don't repeat the work before."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/identity-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_document(observations: DataFrame, extractions: DataFrame) -> DataFrame:
    """Observations with what was extracted from their document: canonical_url, final_url, content, text_hash and words.

    ``extractions`` is (document_key, status, canonical_url, final_url, content, text_hash, words); only successes count.  Extracted
    text replaces the source's, and a stored hash or word count a computed one.
    """
    good = extractions.filter("status = 'success'").select("document_key", "canonical_url", "final_url", F.col("content").alias("_text"), F.col("text_hash").alias("_hash"), F.col("words").alias("_words"))
    x = observations.join(good, "document_key", "left").withColumn("content", F.coalesce("_text", "source_text"))
    words = identity_text(F.col("content"))
    x = x.withColumn("_plain", words)
    own = F.when(F.coalesce("_plain", F.lit("")) != "", F.sha2("_plain", 256))
    count = F.when(F.coalesce("_plain", F.lit("")) == "", 0).otherwise(F.size(F.split("_plain", " ")))
    return x.withColumn("text_hash", F.coalesce("_hash", own)).withColumn("words", F.coalesce("_words", count)).drop("_text", "_hash", "_words", "_plain")


def url_evidence(observations: DataFrame) -> DataFrame:
    """(organization_uri, record_key, value, rank, url): an observation's URLs, canonical (0), final (1) and observed (2), each value once with its smallest rank."""
    given = {f"_url{k}": c for k, c in enumerate(("canonical_url", "final_url")) if c in observations.columns}
    observations = observations.withColumns({n: F.coalesce(document_url(F.col(c)), F.col(c)) for n, c in given.items()})
    urls = [F.struct(F.lit(int(n[-1])).alias("rank"), F.col(n).alias("value"), F.col(c).alias("url")) for n, c in given.items()]
    shown = F.col("observed_url") if "observed_url" in observations.columns else F.col("document_key")
    urls.append(F.struct(F.lit(2).alias("rank"), F.col("document_key").alias("value"), shown.alias("url")))
    every = F.filter(F.array(*urls), lambda u: u["value"].isNotNull())
    first = F.filter(every, lambda u, i: ~F.exists(F.slice(every, F.lit(1), i), lambda v: v["value"] == u["value"]))
    return observations.select("organization_uri", "record_key", F.explode(first).alias("u")).select("organization_uri", "record_key", "u.value", "u.rank", "u.url")


def evidence(observations: DataFrame) -> DataFrame:
    """(organization_uri, record_key, kind, value): each URL and the text hash of an observation."""
    urls = url_evidence(observations).select("organization_uri", "record_key", F.lit("url").alias("kind"), "value")
    hashes = observations.filter("text_hash is not null").select("organization_uri", "record_key", F.lit("hash").alias("kind"), F.col("text_hash").alias("value"))
    return urls.unionByName(hashes)


def document_classes(facts: DataFrame) -> DataFrame:
    """(record_key, founder): founder is the smallest record key of the observation's document.

    Smallest-label propagation over the evidence values, with a pointer jump a round; ends when no label changes.
    """
    facts = _cut(facts.withColumn("fact", F.xxhash64("organization_uri", "kind", "value")).select("record_key", "fact", "organization_uri", "kind", "value").distinct())
    labels = _cut(facts.select("record_key", F.col("record_key").alias("founder")).distinct())
    while True:
        best = facts.join(labels, "record_key").groupBy("organization_uri", "kind", "value").agg(F.min("founder").alias("least"))
        seen = facts.join(best, ["organization_uri", "kind", "value"]).groupBy("record_key").agg(F.min("least").alias("next"))
        jump = labels.select(F.col("record_key").alias("next"), F.col("founder").alias("further"))
        moved = _cut(labels.join(seen, "record_key").join(jump, "next").select("record_key", F.col("founder").alias("before"), F.least("next", "further").alias("founder")))
        if not moved.filter("founder < before").limit(1).count():
            return moved.select("record_key", "founder")
        labels = moved.select("record_key", "founder")


def resolve(observations: DataFrame, previous: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """observations with document_id and claim_review_id.

    ``previous`` (record_key, document_id, claim_review_id) is sticky: those observations keep
    their ids, and a document with one known id keeps it.  ``known`` (organization_uri, kind, value,
    document_id) is the evidence of all earlier runs, of observations that are gone as well.  Two
    known ids in one class are an error.
    """
    facts = evidence(observations)
    if known is not None:  # what is known of a document counts as one more observation of it
        met = known.join(facts.select("organization_uri", "kind", "value").distinct(), ["organization_uri", "kind", "value"], "left_semi")
        facts = facts.unionByName(met.select("organization_uri", F.concat(F.lit(_KNOWN), "document_id").alias("record_key"), "kind", "value"))
    classes = document_classes(facts)
    own = classes.filter(~F.col("record_key").startswith(_KNOWN))
    founder = own.groupBy(F.col("founder").alias("class")).agg(F.min("record_key").alias("founder"))
    own = own.withColumnRenamed("founder", "class").join(founder, "class")
    out = observations.join(own, "record_key", "left").withColumn("founder", F.coalesce("founder", "record_key")).withColumn("class", F.coalesce("class", "record_key"))
    fresh = as_uuid(digest("document", F.col("organization_uri"), F.col("founder")))
    if previous is None and known is None:
        out = out.drop("class").withColumn("document_id", fresh)
        return out.withColumn("claim_review_id", as_uuid(digest("claim-review", F.col("document_id"), F.col("claim_uri"))))
    none = observations.sparkSession.createDataFrame([], "record_key string, document_id string, claim_review_id string")
    old = (none if previous is None else previous).select("record_key", F.col("document_id").alias("_doc"), F.col("claim_review_id").alias("_review"))
    out = out.join(old, "record_key", "left")
    ids = out.filter("_doc is not null").select("class", "_doc")
    if known is not None:
        ids = ids.unionByName(classes.filter(F.col("record_key").startswith(_KNOWN)).select(F.col("founder").alias("class"), F.substring("record_key", len(_KNOWN) + 1, 64).alias("_doc")))
    ids = _cut(ids.groupBy("class").agg(F.min("_doc").alias("_known"), F.max("_doc").alias("_other")))
    if ids.filter("_known <> _other").limit(1).count():
        raise ValueError("evidence joins two known documents")
    out = out.join(ids.drop("_other"), "class", "left").withColumn("document_id", F.coalesce("_doc", "_known", fresh))
    review = as_uuid(digest("claim-review", F.col("document_id"), F.col("claim_uri")))
    return out.withColumn("claim_review_id", F.coalesce("_review", review)).drop("_doc", "_known", "_review", "class")


#: Marks the known documents among the record keys (a record key is a hexadecimal digest); it sorts after all of them.
_KNOWN = "~document:"


def new_evidence(resolved: DataFrame, known: DataFrame | None) -> DataFrame:
    """(organization_uri, kind, value, document_id) to be added to ``known``; a value of two documents is an error."""
    facts = evidence(resolved).join(resolved.select("record_key", "document_id"), "record_key").groupBy("organization_uri", "kind", "value").agg(F.min("document_id").alias("document_id"), F.max("document_id").alias("other"))
    if known is not None:
        facts = facts.join(known.select("organization_uri", "kind", "value", F.col("document_id").alias("held")), ["organization_uri", "kind", "value"], "left")
    else:
        facts = facts.withColumn("held", F.lit(None).cast("string"))
    facts = _cut(facts)
    if facts.filter("document_id <> other or held <> document_id").limit(1).count():
        raise ValueError("a URL or text identifies two documents")
    return facts.filter("held is null").select("organization_uri", "kind", "value", "document_id")


DOCUMENTS = "document_id string, organization_uri string, preferred_url string, preferred_url_rank int, content string, text_hash string, words int, created_at timestamp, updated_at timestamp"


def absorb_documents(old: DataFrame, resolved: DataFrame, now: Column) -> DataFrame:
    """The table of documents after a run; organization and creation stay.

    The URL of the smallest (rank, value, URL) is preferred; the content of the most words stands, any hash before none,
    then the smaller hash, and what a document has before what is equal to it.
    """
    urls = url_evidence(resolved).join(resolved.select("record_key", "document_id"), "record_key")
    best = urls.groupBy("document_id").agg(F.min(F.struct("rank", "value", "url")).alias("u")).select("document_id", F.col("u.url").alias("url"), F.col("u.rank").alias("rank"))
    content = F.col("content") if "content" in resolved.columns else F.col("source_text")
    words = resolved.groupBy("document_id").agg(F.max_by(F.struct(content.alias("content"), "text_hash", F.col("words").cast("int").alias("words")), _content_order("words", "text_hash")).alias("c"), F.min("organization_uri").alias("org"))
    x = best.join(words, "document_id").join(old.withColumnRenamed("organization_uri", "held_org"), "document_id", "full")
    better_url = F.col("preferred_url").isNull() | (F.struct(F.col("rank"), F.col("url")) < F.struct(F.col("preferred_url_rank").alias("rank"), F.col("preferred_url").alias("url")))
    new, held = (_content_order("c.words", "c.text_hash"), _content_order("words", "text_hash"))
    better = F.col("c").isNotNull() & (F.col("created_at").isNull() | (new > held))
    pick = lambda cond, a, b: F.when(cond, a).otherwise(b)
    changed = F.col("c").isNotNull()
    return x.select(
        "document_id", F.coalesce("held_org", "org").alias("organization_uri"), pick(changed & better_url, F.col("url"), F.col("preferred_url")).alias("preferred_url"), pick(changed & better_url, F.col("rank"), F.col("preferred_url_rank")).alias("preferred_url_rank"),
        pick(better, F.col("c.content"), F.col("content")).alias("content"), pick(better, F.col("c.text_hash"), F.col("text_hash")).alias("text_hash"), pick(better, F.col("c.words"), F.col("words")).alias("words"),
        F.coalesce("created_at", now).alias("created_at"), pick(changed, now, F.col("updated_at")).alias("updated_at"),
    )


def preferred_urls(resolved: DataFrame) -> DataFrame:
    """(document_id, preferred_url): the URL of a document's smallest (rank, value, URL)."""
    urls = url_evidence(resolved).join(resolved.select("record_key", "document_id"), "record_key")
    return urls.groupBy("document_id").agg(F.min(F.struct("rank", "value", "url"))["url"].alias("preferred_url"))


def review_views(resolved: DataFrame) -> DataFrame:
    """One row a review: sources, aliases, keywords, the representative observation."""
    own = F.struct((F.col("claim_uri") != F.col("review_claim_uri")).alias("other"), "source_name", "record_key", "claim_text")
    w = Window.partitionBy("claim_review_id")
    claim = resolved.withColumn("review_claim_uri", F.min("claim_uri").over(w))
    return claim.groupBy("claim_review_id", "document_id", "organization_uri", "review_claim_uri").agg(
        F.count("*").alias("observations"),
        F.array_join(F.array_sort(F.collect_set("source_name")), ",").alias("sources"),
        F.array_join(F.array_sort(F.collect_set("observed_url")), ",").alias("urls"),
        F.min(own)["record_key"].alias("representative"),
    )


def _content_order(words: str, text_hash: str) -> Column:
    """More words, any hash before none, then the smaller hash."""
    down = F.translate(F.coalesce(F.col(text_hash), F.lit("")), "0123456789abcdef", "fedcba9876543210")
    return F.struct(F.coalesce(F.col(words).cast("int"), F.lit(0)).alias("n"), F.col(text_hash).isNotNull().alias("any"), down.alias("down"))


def absorb(resolved: DataFrame) -> DataFrame:
    """(document_id, text_hash, words): the best content of a document."""
    return resolved.groupBy("document_id").agg(F.max_by(F.struct("text_hash", "words"), _content_order("words", "text_hash")).alias("x")).select("document_id", "x.*")


def conflicts(resolved: DataFrame) -> DataFrame:
    """(organization_uri, kind, value, documents): evidence that points at more than one document."""
    facts = evidence(resolved).join(resolved.select("record_key", "document_id"), "record_key")
    x = facts.groupBy("organization_uri", "kind", "value").agg(F.min("document_id").alias("a"), F.max("document_id").alias("b"), F.count_distinct("document_id").alias("documents"))
    return x.filter("a <> b").drop("a", "b")


def broken_references(resolved: DataFrame, documents: DataFrame, reviews: DataFrame) -> DataFrame:
    """(record_key, problem): other_organization if the document is another organization's, missing_review if the review isn't stored.

    ``documents`` is (document_id, organization_uri), ``reviews`` (claim_review_id).
    """
    held = documents.select("document_id", F.col("organization_uri").alias("owner"))
    other = resolved.join(held, "document_id").filter("owner <> organization_uri").select("record_key", F.lit("other_organization").alias("problem"))
    missing = resolved.filter("claim_review_id is not null").join(reviews.select("claim_review_id"), "claim_review_id", "left_anti").select("record_key", F.lit("missing_review").alias("problem"))
    return other.unionByName(missing)


def per_source(observations: DataFrame, fields: list[str]) -> DataFrame:
    """The observation that stands for a review in each of its sources: most filled fields, then the greatest record key."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))
    row = F.struct(*[F.col(c) for c in observations.columns])
    return observations.groupBy("claim_review_id", "source_name").agg(F.max_by(row, F.struct(filled.alias("n"), "record_key")).alias("r")).select("r.*")


def longest(observations: DataFrame, column: str) -> DataFrame:
    """(claim_review_id, source_name, value): the longest text of a column, the first on ties."""
    order = F.struct((-F.length(column)).alias("n"), "record_key")
    return observations.filter(F.col(column).isNotNull()).groupBy("claim_review_id", "source_name").agg(F.min_by(column, order).alias(column))
