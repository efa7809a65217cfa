"""Enrichment: subjects, work plans, batched model calls with tri-state results, applying stored results."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stable_hash
from .relational import classify_work


@dataclass(frozen=True)
class Enricher:
    """What one enricher does: name and version, key and input of a subject, a batch function of input texts to JSON payloads."""

    name: str
    version: str
    key: str
    input: str
    compute: Callable[[list[str]], list[str]]
    config: str = "{}"
    batch: int = 64
    workers: int | None = None
    requires: tuple[str, ...] = ()
    available: Callable[[], bool] | None = None
    graph: str | None = None  # the graph it writes; None: each source's own


def ordered(enrichers: list[Enricher]) -> list[Enricher]:
    """Enrichers after those they require, else in the order given; a missing or circular requirement is an error."""
    done, left = [], list(enrichers)
    while left:
        ready = next((e for e in left if set(e.requires) <= {d.name for d in done}), None)
        if ready is None:
            raise ValueError(f"requirements can't be met: {[(e.name, e.requires) for e in left]}")
        done.append(ready)
        left.remove(ready)
    return done


def is_available(e: Enricher) -> bool:
    """One probe of the backend; whatever it raises means no."""
    try:
        return e.available is None or bool(e.available())
    except Exception:
        return False


def subjects(items: DataFrame, e: Enricher) -> DataFrame:
    """(subject_key, input, input_hash), each key once; a key with two inputs is an error."""
    x = items.select(F.col(e.key).alias("subject_key"), F.col(e.input).alias("input")).filter("subject_key is not null and coalesce(input, '') <> ''")
    x = x.withColumn("input_hash", stable_hash(input=F.col("input"))).groupBy("subject_key").agg(F.min("input").alias("input"), F.min("input_hash").alias("input_hash"), F.max("input_hash").alias("other"))
    return x.select("subject_key", "input", F.when(F.col("input_hash") == F.col("other"), F.col("input_hash")).otherwise(F.raise_error(F.concat(F.lit("two inputs for "), "subject_key"))).alias("input_hash"))


def _is_current(e: Enricher) -> Column:
    return (F.col("r.enricher_version") == e.version) & (F.col("r.input_hash") == F.col("s.input_hash")) & (F.col("r.config_hash") == F.sha2(F.lit(e.config), 256))


def plan(subject: DataFrame, results: DataFrame, e: Enricher, now: Column, **flags) -> DataFrame:
    """(subject_key, input, input_hash, work): cached, permanent, deferred, pending or missing."""
    stored = results.filter(F.col("enricher") == e.name).alias("r")
    joined = subject.alias("s").join(stored, F.col("s.subject_key") == F.col("r.subject_key"), "left")
    return joined.select("s.subject_key", "s.input", "s.input_hash", classify_work(_is_current(e), F.col("r.status"), F.col("r.retry_at"), now, **flags).alias("work"))


def run(planned: DataFrame, e: Enricher, now: Column) -> DataFrame:
    """Results of the pending subjects; a failed batch is retryable for all its subjects.

    At most ``e.workers`` batches run at a time.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for lo in range(0, len(frame), e.batch):
                part = frame.iloc[lo : lo + e.batch]
                try:
                    payloads = e.compute(part["input"].tolist())
                    if len(payloads) != len(part):
                        raise ValueError("wrong number of results")
                    status = "success"
                except Exception:
                    payloads, status = [None] * len(part), "retryable_failure"
                yield pd.DataFrame({"subject_key": part["subject_key"], "input_hash": part["input_hash"], "status": status, "payload": payloads})

    pending = planned.filter("work = 'pending'").select("subject_key", "input", "input_hash")
    done = (pending.repartition(e.workers, "subject_key") if e.workers else pending).mapInPandas(work, "subject_key string, input_hash string, status string, payload string")
    retry = F.when(F.col("status") == "retryable_failure", now + F.expr("interval 1 hour"))
    return done.select(F.lit(e.name).alias("enricher"), "subject_key", F.lit(e.version).alias("enricher_version"), "input_hash", F.sha2(F.lit(e.config), 256).alias("config_hash"), "status", retry.alias("retry_at"), "payload", now.alias("updated_at"))


def apply(subject: DataFrame, results: DataFrame, e: Enricher) -> DataFrame:
    """(subject_key, payload) of successes that are still current."""
    stored = results.filter((F.col("enricher") == e.name) & (F.col("status") == "success")).alias("r")
    return subject.alias("s").join(stored, F.col("s.subject_key") == F.col("r.subject_key")).filter(_is_current(e)).select("s.subject_key", "r.payload")


LINKED = "Resources array<struct<`@URI`:string,`@surfaceForm`:string,`@types`:string,`@similarityScore`:string,`@support`:string,`@offset`:string>>"


def entities(payloads: DataFrame, confidence: float) -> DataFrame:
    """(subject_key, uri, surface_form, types, score, support, offset) of linker responses with at least ``confidence``."""
    x = payloads.select("subject_key", F.explode(F.from_json("payload", LINKED)["Resources"]).alias("e"))
    types = F.filter(F.split("e.`@types`", ","), lambda t: t != "")
    x = x.select("subject_key", F.col("e.`@URI`").alias("uri"), F.col("e.`@surfaceForm`").alias("surface_form"), types.alias("types"), F.col("e.`@similarityScore`").try_cast("double").alias("score"), F.col("e.`@support`").try_cast("int").alias("support"), F.col("e.`@offset`").try_cast("int").alias("offset"))
    return x.filter(F.col("score") >= confidence)


def skip_short(subject: DataFrame, shortest: int = 10) -> DataFrame:
    """Subjects with a payload column: texts under ``shortest`` characters have the empty result without a call, all others null."""
    return subject.withColumn("payload", F.when(F.length(F.coalesce("input", F.lit(""))) < shortest, F.lit('{"Resources":[]}')))


def entity_properties(mentions: DataFrame, facts: DataFrame, wanted: list[str]) -> DataFrame:
    """(uri, property, values) of the mentioned entities from facts (entity, property, value, kind), no blank nodes, each value once."""
    uris = mentions.select(F.col("uri").alias("entity")).distinct()
    x = facts.filter(F.col("property").isin(*wanted) & (F.col("kind") != "bnode")).join(uris, "entity")
    return x.groupBy(F.col("entity").alias("uri"), "property").agg(F.array_sort(F.collect_set("value")).alias("values"))


def summary(planned: DataFrame) -> DataFrame:
    """(work, n): additive counters of a stage."""
    return planned.groupBy("work").agg(F.count("*").alias("n"))


MENTION = "array<struct<uri:string,surface_form:string,source:string,properties:map<string,array<string>>>>"


def replace_mentions(held: Column, source: str, new: Column) -> Column:
    """Mentions after one linker's result is applied: those of other sources stay, its own are replaced."""
    none = F.array().cast(MENTION)
    return F.concat(F.filter(F.coalesce(held, none), lambda m: m["source"] != source), F.coalesce(new, none))


def merge_properties(held: Column, new: Column) -> Column:
    """Two maps of property to values as one, each value once, held ones first."""
    none = F.create_map().cast("map<string,array<string>>")
    both = F.map_zip_with(F.coalesce(held, none), F.coalesce(new, none), lambda _, a, b: F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))))
    return both


def fetch_properties(uris: DataFrame, get: Callable[[list[str]], list[tuple[str, str, str, str]]], batch: int = 50, retries: int = 2) -> DataFrame:
    """Facts (entity, property, value, kind) of the distinct ``uris`` (uri), by ``get`` on batches of at most ``batch``; a batch that keeps failing gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for lo in range(0, len(frame), batch):
                rows: list = []
                for attempt in range(retries + 1):
                    try:
                        rows = list(get(frame["uri"].iloc[lo : lo + batch].tolist()))
                        break
                    except Exception:
                        if attempt == retries:
                            rows = []
                yield pd.DataFrame(rows, columns=["entity", "property", "value", "kind"], dtype=object)

    return uris.select("uri").filter("uri is not null").distinct().mapInPandas(run, "entity string, property string, value string, kind string")
