"""RDF projection: observations to named-graph quads, N-Triples lines, publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest


def _quad(graph, s, p, o, kind="iri", datatype="", when=None) -> Column:
    col = lambda x: F.lit(x) if isinstance(x, str) else x
    row = F.struct(col(graph).alias("graph"), col(s).alias("s"), col(p).alias("p"), col(o).alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).alias("o_datatype"))
    return row if when is None else F.when(when, row)


def observation_quads(obs: DataFrame) -> DataFrame:
    """(graph, s, p, o, o_kind, o_datatype), each quad once: reviews, claims, ratings, factors and mentions."""
    from ..plans.views import BASE, CLIMATE, ENTITY_GRAPH, FACTORS, ONTOLOGY, RDF_TYPE, SCHEMA, XSD

    iri = lambda *parts: F.concat(F.lit(f"{BASE}/"), *parts)
    c, lit, doc = F.col, F.lit, F.col("doc_id")
    graph, review, claim = iri(lit("graph/"), c("source_name")), iri(lit("review/"), c("record_key")), iri(c("claim_uri"))
    rating = iri(lit("rating/"), digest("organization-rating", c("organization_uri"), c("label")))
    org, rated = iri(c("organization_uri")), c("label").isNotNull()
    rows = [
        _quad(graph, review, RDF_TYPE, f"{SCHEMA}ClaimReview"), _quad(graph, review, f"{SCHEMA}itemReviewed", claim), _quad(graph, review, f"{SCHEMA}author", org),
        _quad(graph, review, f"{SCHEMA}url", c("observed_url")), _quad(graph, review, f"{SCHEMA}inLanguage", c("lang"), "literal", when=c("lang") != ""),
        _quad(graph, claim, RDF_TYPE, f"{SCHEMA}Claim"), _quad(graph, claim, f"{SCHEMA}text", c("claim_text"), "literal"),
        _quad(graph, review, f"{SCHEMA}reviewRating", rating, when=rated), _quad(graph, review, f"{ONTOLOGY}normalizedReviewRating", iri(lit("rating/"), c("label")), when=rated),
        _quad(graph, rating, RDF_TYPE, f"{SCHEMA}Rating", when=rated), _quad(graph, rating, f"{SCHEMA}author", org, when=rated), _quad(graph, rating, f"{SCHEMA}ratingValue", c("label"), "literal", when=rated),
        _quad(graph, claim, CLIMATE, F.when(doc % 3 == 0, "true").otherwise("false"), "literal", f"{XSD}boolean"),
        _quad(ENTITY_GRAPH, claim, f"{SCHEMA}mentions", iri(lit("entity/"), doc % 40), when=doc % 2 == 0),
        _quad(ENTITY_GRAPH, review, f"{SCHEMA}mentions", iri(lit("entity/"), doc % 17), when=doc % 5 == 0),
    ]
    rows += [_quad(graph, claim, p, iri(lit(f"{segment}/value_"), doc % n), when=doc % (k + 2) != 0) for k, (_, p, segment, n) in enumerate(FACTORS)]
    return obs.select(F.explode(F.array(*rows)).alias("q")).filter("q is not null").select("q.*").distinct()


def graph_of(source_name: str) -> str:
    from ..plans.views import BASE

    return f"{BASE}/graph/{source_name}"


def review_quads(reviews: DataFrame) -> DataFrame:
    """Quads of identified observations: review, claim, rating, dates, texts and appearances; empty values give none."""
    from ..plans.views import BASE, ONTOLOGY, RDF_TYPE, SCHEMA, XSD

    iri = lambda *parts: F.concat(F.lit(f"{BASE}/"), *parts)
    c, lit = F.col, F.lit
    graph, review, claim, org = iri(lit("graph/"), c("source_name")), iri(lit("review/"), c("claim_review_id")), iri(c("claim_uri")), iri(c("organization_uri"))
    rating = iri(lit("rating/"), digest("organization-rating", c("organization_uri"), F.coalesce("label", lit("")), F.coalesce("original_label", lit(""))))
    full = lambda name: F.coalesce(c(name), lit("")) != ""
    rows = [
        _quad(graph, review, RDF_TYPE, f"{SCHEMA}ClaimReview"), _quad(graph, review, f"{SCHEMA}itemReviewed", claim), _quad(graph, review, f"{SCHEMA}author", org),
        _quad(graph, review, f"{SCHEMA}url", c("document_key"), when=c("document_key").startswith("http")),
        _quad(graph, review, f"{SCHEMA}datePublished", c("date_published"), "literal", f"{XSD}date", full("date_published")), _quad(graph, review, f"{SCHEMA}inLanguage", c("language"), "literal", when=full("language")),
        _quad(graph, review, f"{SCHEMA}text", c("review_text"), "literal", when=full("review_text")), _quad(graph, claim, RDF_TYPE, f"{SCHEMA}Claim"), _quad(graph, claim, f"{SCHEMA}text", c("claim_text"), "literal"),
        _quad(graph, review, f"{SCHEMA}reviewRating", rating, when=full("original_label")), _quad(graph, rating, RDF_TYPE, f"{SCHEMA}Rating", when=full("original_label")), _quad(graph, rating, f"{SCHEMA}author", org, when=full("original_label")),
        _quad(graph, rating, f"{SCHEMA}name", c("original_label"), "literal", when=full("original_label")), _quad(graph, review, f"{ONTOLOGY}normalizedReviewRating", iri(lit("rating/"), c("label")), when=full("label")),
    ]
    quads = F.concat(F.array(*rows), F.transform(F.coalesce("appearances", F.array().cast("array<string>")), lambda u: _quad(graph, claim, f"{SCHEMA}appearance", u)))
    return reviews.select(F.explode(quads).alias("q")).filter("q is not null").select("q.*").distinct()


def _escaped(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def nt_lines(quads: DataFrame) -> DataFrame:
    """(graph, line): N-Triples lines of quads."""
    literal = F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"'), F.when(F.col("o_datatype") != "", F.concat(F.lit("^^<"), "o_datatype", F.lit(">"))).otherwise(""))
    term = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(literal)
    return quads.select("graph", F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), term, F.lit(" .")).alias("line"))


def nq_lines(quads: DataFrame) -> DataFrame:
    """(graph, line): N-Quads lines of quads."""
    return nt_lines(quads).select("graph", F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit("<"), "graph", F.lit("> .")).alias("line"))


def _object(c: str = "o") -> Column:
    literal = F.concat(F.lit('"'), _escaped(F.col(c)), F.lit('"'), F.when(F.col("o_datatype") != "", F.concat(F.lit("^^<"), "o_datatype", F.lit(">"))).otherwise(""))
    return F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), c, F.lit(">"))).otherwise(literal)


def _subjects(quads: DataFrame, each: Column) -> DataFrame:
    """(graph, s, parts): each subject's parts in order; a subject is one row."""
    return quads.select("graph", "s", each.alias("part")).groupBy("graph", "s").agg(F.array_sort(F.collect_set("part")).alias("parts"))


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def turtle_blocks(quads: DataFrame) -> DataFrame:
    """(graph, line): a Turtle statement for each subject, IRIs in full."""
    x = _subjects(quads, F.concat(F.lit("    <"), "p", F.lit("> "), _object()))
    return x.select("graph", F.concat(F.lit("<"), "s", F.lit(">\n"), F.array_join("parts", " ;\n"), F.lit(" .")).alias("line"))


def trig_blocks(quads: DataFrame) -> DataFrame:
    """(graph, line): the same inside its graph, a TriG block for each subject."""
    return turtle_blocks(quads).select("graph", F.concat(F.lit("<"), "graph", F.lit("> {\n"), "line", F.lit("\n}")).alias("line"))


def json_ld_lines(quads: DataFrame) -> DataFrame:
    """(graph, line): an expanded JSON-LD node object for each subject, one a line."""
    iri = F.struct(F.when(F.col("o_kind") == "iri", F.col("o")).alias("@id"), F.when(F.col("o_kind") != "iri", F.col("o")).alias("@value"), F.when((F.col("o_kind") != "iri") & (F.col("o_datatype") != ""), F.col("o_datatype")).alias("@type"))
    by = quads.select("graph", "s", "p", iri.alias("v")).groupBy("graph", "s", "p").agg(F.array_sort(F.collect_set(F.to_json("v"))).alias("vs"))
    quoted = F.to_json(F.array("p"))
    field = F.concat(F.expr("substring(field, 2, length(field) - 2)"), F.lit(":["), F.array_join("vs", ","), F.lit("]"))
    x = by.withColumn("field", quoted).withColumn("part", field).groupBy("graph", "s").agg(F.array_sort(F.collect_set("part")).alias("parts"))
    name = F.to_json(F.struct(F.col("s").alias("@id")))
    return x.withColumn("name", name).select("graph", F.concat(F.expr("substring(name, 1, length(name) - 1)"), F.lit(","), F.array_join("parts", ","), F.lit("}")).alias("line"))


def xml_blocks(quads: DataFrame) -> DataFrame:
    """(graph, line): an rdf:Description for each subject; predicates are split after their last ``#`` or ``/``."""
    cut = F.regexp_extract("p", r"^(.*[#/])([^#/]+)$", 1)
    name = F.regexp_extract("p", r"^(.*[#/])([^#/]+)$", 2)
    head = F.concat(F.lit("  <n:"), name, F.lit(' xmlns:n="'), _xml(cut), F.lit('"'))
    iri = F.concat(head, F.lit(' rdf:resource="'), _xml(F.col("o")), F.lit('"/>'))
    typed = F.when(F.col("o_datatype") != "", F.concat(F.lit(' rdf:datatype="'), _xml(F.col("o_datatype")), F.lit('"'))).otherwise("")
    literal = F.concat(head, typed, F.lit(">"), _xml(F.col("o")), F.lit("</n:"), name, F.lit(">"))
    x = _subjects(quads, F.when(F.col("o_kind") == "iri", iri).otherwise(literal))
    return x.select("graph", F.concat(F.lit('<rdf:Description xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" rdf:about="'), _xml(F.col("s")), F.lit('">\n'), F.array_join("parts", "\n"), F.lit("\n</rdf:Description>")).alias("line"))


#: Serialisations by name; runs publish N-Triples.
SERIALISATIONS = {"nt": nt_lines, "ntriples": nt_lines, "nquads": nq_lines, "nq": nq_lines, "turtle": turtle_blocks, "ttl": turtle_blocks, "n3": turtle_blocks, "trig": trig_blocks, "json-ld": json_ld_lines, "jsonld": json_ld_lines, "xml": xml_blocks, "rdf": xml_blocks, "pretty-xml": xml_blocks}


def serialise(quads: DataFrame, form: str) -> DataFrame:
    if form not in SERIALISATIONS:
        raise ValueError(f"no serialisation {form}; there are {sorted(SERIALISATIONS)}")
    return SERIALISATIONS[form](quads)


def read_lines(spark, path: str) -> DataFrame:
    """(graph, line) of a published snapshot."""
    return spark.read.option("basePath", path).text(path).select(F.col("graph").cast("string").alias("graph"), F.col("value").alias("line"))


def line_quads(lines: DataFrame) -> DataFrame:
    """Quads of N-Triples lines (graph, line), as ``nt_lines`` writes them."""
    pattern = r'(?s)^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"(.*)"(?:\^\^<([^>]*)>)?) \.$'
    part = lambda k: F.regexp_extract("line", pattern, k)
    iri = F.col("line").rlike(r"^<[^>]*> <[^>]*> <")
    plain = part(4)
    for a, b in (("\\\\", "\0"), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\0", "\\")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    return lines.select("graph", part(1).alias("s"), part(2).alias("p"), F.when(iri, part(3)).otherwise(plain).alias("o"), F.when(iri, "iri").otherwise("literal").alias("o_kind"), F.when(iri, "").otherwise(part(5)).alias("o_datatype"))


def publish(lines: DataFrame, root: str, incomplete: list[str] = (), previous: str | None = None, *, one_file: bool = False) -> DataFrame:
    """Sorted distinct lines of every graph as gzipped text under ``root``; (graph, lines, published).

    Graphs in ``incomplete`` aren't replaced: their lines come from the snapshot ``previous``, if it has
    them.  Lines are ranged by (graph, line), so a large graph is many sorted files and no task holds it
    whole; with ``one_file`` each graph is one file.
    """
    shut = list(incomplete)
    ready = lines.filter(~F.col("graph").isin(*shut)) if shut else lines
    if shut and previous:
        ready = ready.unionByName(read_lines(lines.sparkSession, previous).filter(F.col("graph").isin(*shut)))
    ready = ready.distinct()
    ready = ready.repartition("graph") if one_file else ready.repartitionByRange("graph", "line")
    ready.sortWithinPartitions("graph", "line").write.partitionBy("graph").option("compression", "gzip").mode("overwrite").text(root)
    fresh = lines.groupBy("graph").agg(F.count_distinct("line").alias("lines"))
    return fresh.withColumn("published", ~F.col("graph").isin(*shut) if shut else F.lit(True))


def vocabularies(spark, files: dict[str, str]) -> DataFrame:
    """Quads of Turtle files (graph: path), each in its own graph."""
    from ..sources.turtle import read_turtle

    found = None
    for graph, path in files.items():
        t = read_turtle(spark, path).select(F.lit(graph).alias("graph"), "s", "p", "o", "o_kind", "o_datatype")
        found = t if found is None else found.unionByName(t)
    return spark.createDataFrame([], "graph string, s string, p string, o string, o_kind string, o_datatype string") if found is None else found


def mention_quads(mentions: DataFrame, properties: DataFrame | None = None) -> DataFrame:
    """Quads of mentions (subject, uri), and of each mentioned entity's properties (uri, property, values) once, in the graph of entities."""
    from ..plans.views import BASE, ENTITY_GRAPH, SCHEMA

    subject = F.concat(F.lit(f"{BASE}/"), "subject")
    found = mentions.select(_quad(ENTITY_GRAPH, subject, f"{SCHEMA}mentions", F.col("uri")).alias("q")).select("q.*")
    if properties is not None:
        own = properties.join(mentions.select("uri").distinct(), "uri").select("uri", "property", F.explode("values").alias("v"))
        kind = F.when(F.col("v").rlike("^https?://"), "iri").otherwise("literal")
        found = found.unionByName(own.select(F.lit(ENTITY_GRAPH).alias("graph"), F.col("uri").alias("s"), F.col("property").alias("p"), F.col("v").alias("o"), kind.alias("o_kind"), F.lit("").alias("o_datatype")))
    return found.distinct()
