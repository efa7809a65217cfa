"""The organization catalog: RDF organizations checked by named rules, and their sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import organization_url
from .turtle import RDF


def organization_catalog(triples: DataFrame, prefix: str, schema: str = "http://schema.org/") -> tuple[DataFrame, DataFrame]:
    """((organization_uri, name, website, site), (organization_uri, error)) from triples (s, p, o, o_kind).

    Organizations are IRIs under ``prefix``.  Rules: one non-empty literal name; at least one URL;
    every URL an IRI; every URL a site; no site of two organizations; and, with the null
    organization, at least one organization at all.  ``website`` is the smallest site; one row a site.
    """
    own = triples.filter((F.col("p") == RDF + "type") & (F.col("o") == schema + "Organization") & F.col("s").startswith(prefix)).select("s").distinct()
    x = triples.filter(F.col("p").isin(schema + "name", schema + "url")).select("s", "p", "o", "o_kind").distinct()
    is_url, is_name = F.col("p") == schema + "url", F.col("p") == schema + "name"
    x = own.join(x, "s", "left").withColumn("site", organization_url(F.when(is_url & (F.col("o_kind") == "iri"), F.col("o"))))
    shared = x.filter("site is not null").groupBy("site").agg(F.count_distinct("s").alias("owners")).filter("owners > 1").drop("owners")
    x = x.join(shared.withColumn("shared", F.lit(True)), "site", "left")
    each = x.groupBy("s").agg(
        F.count_if(is_name).alias("names"), F.count_if(is_name & (F.col("o_kind") == "literal") & (F.trim("o") != "")).alias("good_names"),
        F.min(F.when(is_name, F.trim("o"))).alias("name"), F.count_if(is_url).alias("urls"), F.count_if(is_url & (F.col("o_kind") != "iri")).alias("texts"),
        F.count_if(is_url & (F.col("o_kind") == "iri") & F.col("site").isNull()).alias("broken"), F.count_if("shared").alias("shared"), F.array_sort(F.collect_set("site")).alias("sites"),
    )
    rules = {"name": "names <> 1 or good_names <> 1", "no_url": "urls = 0", "url_not_iri": "texts > 0", "url_invalid": "broken > 0", "site_shared": "shared > 0"}
    found = F.filter(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in rules.items()]), lambda e: e.isNotNull())
    each = each.withColumn("errors", found)
    errors = each.select(F.col("s").alias("organization_uri"), F.explode("errors").alias("error"))
    empty = own.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(None).cast("string").alias("organization_uri"), F.lit("no_organization").alias("error"))
    good = each.filter(F.size("errors") == 0).select(F.col("s").alias("organization_uri"), "name", F.get("sites", F.lit(0)).alias("website"), F.explode("sites").alias("site"))
    return good, errors.unionByName(empty)
