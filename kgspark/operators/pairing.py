"""Pairing of an item's claims with its reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def items(conversations: DataFrame) -> DataFrame:
    """(conv_id, claims, reviews, kind): user turns are claims, assistant turns are reviews, both in order of turns."""
    ordered = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda x: x["text"])
    x = conversations.groupBy("conv_id").agg(ordered("user").alias("claims"), ordered("assistant").alias("reviews"))
    a, b = F.size("claims"), F.size("reviews")
    kind = F.when((a == 0) | (b == 0), "invalid").when(a == b, "zip").when(a == 1, "claim_broadcast").when(b == 1, "review_broadcast").otherwise("ambiguous")
    return x.withColumn("kind", kind)


def pairs(rows: DataFrame) -> DataFrame:
    """(conv_id, pair_index, claim_text, review_text): equal numbers in order, one of a kind with each of the other; other items give none."""
    both = (
        F.when(F.col("kind") == "zip", F.zip_with("claims", "reviews", lambda c, r: F.struct(c.alias("c"), r.alias("r"))))
        .when(F.col("kind") == "claim_broadcast", F.transform("reviews", lambda r: F.struct(F.get("claims", F.lit(0)).alias("c"), r.alias("r"))))
        .when(F.col("kind") == "review_broadcast", F.transform("claims", lambda c: F.struct(c.alias("c"), F.get("reviews", F.lit(0)).alias("r"))))
    )
    x = rows.filter(~F.col("kind").isin("invalid", "ambiguous")).select("conv_id", F.posexplode(both).alias("pair_index", "p"))
    return x.select("conv_id", "pair_index", F.col("p.c").alias("claim_text"), F.col("p.r").alias("review_text"))
