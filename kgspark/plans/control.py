"""The control plane: run ledger with a single writer, versioned tables, result cache, the batch run, the command line."""

from __future__ import annotations

import argparse
import contextlib
import hashlib
import json
import logging
import logging.handlers
import os
import socket
import sys
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import analysis_text, digest
from ..functions.urls import document_url
from ..operators import enrichment, extraction, identity, projection, rdf
from ..operators.relational import classify_work, deactivate_missing, upsert
from ..sources import transport
from ..sources.catalog import organization_catalog
from ..sources.formats import AUTHORS, DETAILS, read_source
from ..sources.landing import Landing, SourceError, keep_newest, size_in_bytes
from ..sources.storage import files
from ..sources.turtle import read_turtle
from .config import RunConfig, SourceConfig  # noqa: F401
from .views import BASE, ENTITY_GRAPH

log = logging.getLogger("kgspark")


class Ledger:
    """One JSON file a run; a lease file, created only if it isn't there, lets one writer in.

    A run renews its lease between stages.  A lease that wasn't renewed for ``lease_s``, or whose process on this
    machine is gone, belongs to a run that died; the next run takes it over and marks that run failed.
    """

    def __init__(self, root: str, spark: SparkSession | None = None, lease_s: float = 6 * 3600):
        self.root, self.files, self.lease_s = str(root).rstrip("/"), files(spark, root), lease_s

    def _write(self, run: dict) -> None:
        self.files.write(f"{self.root}/{run['id']}.json", json.dumps(run))

    def runs(self) -> list[dict]:
        names = [n for n in self.files.names(self.root) if n.endswith(".json") and not n.startswith(".")]
        return sorted((json.loads(self.files.read(f"{self.root}/{n}")) for n in names), key=lambda r: (r["started_at"], r["id"]))

    def _mine(self) -> str:
        return json.dumps({"until": time.time() + self.lease_s, "host": socket.gethostname(), "pid": os.getpid()})

    @staticmethod
    def _dead(held: dict) -> bool:
        if held.get("host") != socket.gethostname() or not isinstance(held.get("pid"), int):
            return False
        try:
            os.kill(held["pid"], 0)
        except ProcessLookupError:
            return True
        except PermissionError:
            pass
        return False

    def renew(self) -> None:
        self.files.write(f"{self.root}/writer.lock", self._mine())

    def _lease(self) -> None:
        lock = f"{self.root}/writer.lock"
        mine = self._mine()
        if self.files.create(lock, mine):
            return
        try:
            held = json.loads(self.files.read(lock))
        except (OSError, ValueError):
            held = {}
        if held.get("until", time.time() + 1) > time.time() and not self._dead(held):
            raise RuntimeError("another run is under way")
        self.files.delete(lock)
        if not self.files.create(lock, mine):
            raise RuntimeError("another run is under way")

    @contextlib.contextmanager
    def run(self, config_hash: str) -> Iterator[dict]:
        self._lease()
        try:
            for old in self.runs():
                if old["status"] == "running":
                    self._write(old | {"status": "failed", "error": "abandoned", "finished_at": time.time()})
            run = {"id": uuid.uuid4().hex, "config_hash": config_hash, "status": "running", "error": None, "summary": {}, "started_at": time.time(), "finished_at": None}
            self._write(run)
            try:
                yield run["summary"]
                self._write(run | {"status": "complete", "finished_at": time.time()})
            except BaseException as e:
                self._write(run | {"status": "failed", "error": str(e)[:500], "finished_at": time.time()})
                raise
        finally:
            self.files.delete(f"{self.root}/writer.lock")


class Versions:
    """A table as numbered Parquet folders and a pointer that is replaced at once; readers never see half a version."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema, self.files = spark, str(root).rstrip("/"), schema, files(spark, root)

    def current(self) -> DataFrame:
        at = f"{self.root}/CURRENT"
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{self.files.read(at)}") if self.files.exists(at) else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, keep: int = 2) -> None:
        """Write a version and point at it; of older ones the newest stays, for readers that are under way."""
        name = f"v{time.time_ns():020}"
        rows.write.parquet(f"{self.root}/{name}")
        self.files.write(f"{self.root}/CURRENT", name)
        for old in sorted(n for n in self.files.names(self.root) if n.startswith("v"))[:-keep]:
            self.files.delete(f"{self.root}/{old}")


class ResultCache:
    """Results by query and parameters for ``ttl_s``; what was under way when the cache was cleared isn't kept."""

    def __init__(self, ttl_s: float = 300, clock: Callable[[], float] = time.monotonic):
        self.ttl, self.clock, self.held, self.generation = ttl_s, clock, {}, 0

    @staticmethod
    def key(namespace: str, query: str, parameters: dict) -> str:
        return f"{namespace}:{query}:{hashlib.sha256(json.dumps(parameters, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]}"

    def get(self, namespace: str, query: str, parameters: dict, compute: Callable[[], list], use_cache: bool = True) -> list:
        key, generation = self.key(namespace, query, parameters), self.generation
        if use_cache and key in self.held and self.clock() - self.held[key][0] < self.ttl:
            return self.held[key][1]
        rows = compute()
        if generation == self.generation:
            self.held[key] = (self.clock(), rows)
        return rows

    def clear(self) -> int:
        n, self.held, self.generation = len(self.held), {}, self.generation + 1
        return n

    def refresh(self, entries: list[tuple[str, str, dict, Callable[[], list]]]) -> dict[str, str]:
        """Compute (namespace, query, parameters, compute) anew; a failing one doesn't stop the others."""
        done = {}
        for namespace, query, parameters, compute in entries:
            try:
                self.get(namespace, query, parameters, compute, use_cache=False)
                done[f"{namespace}:{query}"] = "refreshed"
            except Exception as e:
                done[f"{namespace}:{query}"] = f"failed: {e}"
        return done

    def status(self) -> dict:
        live = sum(self.clock() - at < self.ttl for at, _ in self.held.values())
        return {"entries": len(self.held), "live": live, "ttl_s": self.ttl}


class Metrics:
    """The queries behind an HTTP surface: checked parameters, cached rows; ``queries`` is name to function of (spark frame, parameters)."""

    LIMITS = {"limit": (1, 1000), "hours": (1, 24 * 365)}

    def __init__(self, table: Callable[[], DataFrame], queries: dict[str, Callable[..., DataFrame]], cache: ResultCache | None = None):
        self.table, self.queries, self.cache = table, queries, cache or ResultCache()

    def get(self, name: str, *, use_cache: bool = True, **parameters) -> list[dict]:
        if name not in self.queries:
            raise KeyError(name)
        for k, v in parameters.items():
            low, high = self.LIMITS.get(k, (None, None))
            if low is not None and v is not None and not low <= v <= high:
                raise ValueError(f"{k} must lie in {low} to {high}")
        compute = lambda: [r.asDict(recursive=True) for r in self.queries[name](self.table(), **parameters).collect()]
        return self.cache.get("metrics", name, parameters, compute, use_cache)


def shown_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if abs(n) < 1024:
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def shown_duration(seconds: float) -> str:
    s = max(0, int(seconds))
    return f"{s // 3600}h {s // 60 % 60:02}m {s % 60:02}s" if s >= 3600 else f"{s // 60}m {s % 60:02}s" if s >= 60 else f"{s}s"


class Progress:
    """Log lines of a stage at most every ``every_s`` seconds, with rate and time left."""

    def __init__(self, name: str, total: int | None = None, every_s: float = 10.0, clock: Callable[[], float] = time.monotonic):
        self.name, self.total, self.every, self.clock = name, total, every_s, clock
        self.began = self.last = clock()

    def update(self, done: int, counters: dict | None = None, *, force: bool = False) -> str | None:
        now = self.clock()
        if not force and now - self.last < self.every:
            return None
        self.last, spent = now, now - self.began
        rate = done / spent if spent > 0 else 0.0
        left = f", {shown_duration((self.total - done) / rate)} left" if self.total and rate and done < self.total else ""
        line = f"{self.name}: {done}" + (f" of {self.total}" if self.total else "") + f", {rate:.1f}/s in {shown_duration(spent)}{left}" + "".join(f", {k}={v}" for k, v in (counters or {}).items())
        log.info(line)
        return line


_DETAILS = ", ".join(f"{k} {t}" for k, t in DETAILS.items())
_OBSERVED = f"""source_name string, source_type string, record_key string, native_id string, observed_url string, organization_site string, claim_text string,
claim_uri string, review_text string, original_label string, label string, date_published string, language string, appearances array<string>, discriminator string,
keywords array<string>, authors {AUTHORS}, {_DETAILS}, last_seen_run_id string, active boolean, first_seen_at timestamp"""
_IDENTIFIED = "record_key string, document_id string, claim_review_id string"
_EVIDENCE = "organization_uri string, kind string, value string, document_id string"
_RESULTS = "enricher string, subject_key string, enricher_version string, input_hash string, config_hash string, status string, retry_at timestamp, payload string, updated_at timestamp"
#: The tables of a root; a run makes those that are missing.
TABLES = {"observations": _OBSERVED, "identities": _IDENTIFIED, "evidence": _EVIDENCE, "documents": identity.DOCUMENTS, "extractions": extraction.EXTRACTIONS, "enrichments": _RESULTS}
SCHEMA_VERSION = 2


def bootstrap(spark: SparkSession, root: str) -> dict[str, Versions]:
    """The tables under ``root``, which is marked with the layout's version; a root of a later layout is refused."""
    disk, mark = files(spark, root), f"{root.rstrip('/')}/LAYOUT"
    if disk.exists(mark) and int(disk.read(mark)) > SCHEMA_VERSION:
        raise RuntimeError(f"{root} was written by a later version")
    if not disk.exists(mark) or int(disk.read(mark)) < SCHEMA_VERSION:
        disk.write(mark, str(SCHEMA_VERSION))
    return {name: Versions(spark, f"{root.rstrip('/')}/{name}", schema) for name, schema in TABLES.items()}


def organizations(spark: SparkSession, config: RunConfig) -> DataFrame | None:
    """(site, organization_uri) of the catalog, URIs without the base; a catalog with errors is refused."""
    if config.catalog is None:
        return None
    good, errors = organization_catalog(read_turtle(spark, config.catalog).select("s", "p", "o", "o_kind"), f"{BASE}/")
    bad = [tuple(r) for r in errors.limit(20).collect()]
    if bad:
        raise ValueError(f"the organization catalog has errors: {bad}")
    return good.select("site", F.regexp_replace("organization_uri", f"^{BASE}/", "").alias("organization_uri"))


def ingest(spark: SparkSession, config: RunConfig, run_id: str, *, skip_download: bool = False, transports: dict[str, dict] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """(new version of the observations, status by source).  A source is installed whole or not at all; ``transports`` are keyword arguments of its provider by source."""
    landing, table, catalog = Landing(f"{config.root}/landing", config.cache_ttl_s, spark=spark), bootstrap(spark, config.root)["observations"], organizations(spark, config)
    rows, status = table.current(), {}
    for s in (s for s in config.sources if s.enabled):
        try:
            landing.ttl = config.cache_ttl_s if s.cache_ttl_s is None else s.cache_ttl_s
            path = landing.fetch(s.name, s.provider, s.options, skip_download=skip_download, **(transports or {}).get(s.name, {}))
            good, bad = read_source(spark, s.kind, str(path), s.name)
            good = good.dropDuplicates(["record_key"]).withColumns({"last_seen_run_id": F.lit(run_id), "active": F.lit(True), "first_seen_at": F.current_timestamp()})
            unknown = good.filter("organization_site is null") if catalog is None else good.join(catalog, good["organization_site"] == catalog["site"], "left_anti")
            if unknown.limit(1).count() or not good.limit(1).count():
                raise SourceError("no valid row, or a row without a known organization")
            if bad.filter(F.array_contains("errors", "not_a_list")).limit(1).count():
                raise SourceError("not one whole list")
            rows = deactivate_missing(upsert(rows, good, ["record_key"], ["first_seen_at"]), good, run_id)
            status[s.name] = f"installed, {bad.count()} rejected"
        except Exception as e:
            if not isinstance(e, SourceError | OSError | ValueError | transport.FetchError):
                raise
            status[s.name] = f"failed: {e}"
    if not status or all(x.startswith("failed") for x in status.values()):
        raise SourceError(f"no source could be installed: {status}")
    table.replace(rows)
    return table.current(), status


def extract(active: DataFrame, table: Versions, config: RunConfig, now: Column, *, offline: bool = False, ignore_cache: bool = False, get: Callable[[str], dict] | None = None) -> dict[str, int]:
    """Fetch what is due of the active observations' documents, store it, and return the counters; offline only counts."""
    own, version = config.extraction, "1"
    config_hash = hashlib.sha256(json.dumps(own.header_profiles, sort_keys=True).encode()).hexdigest()
    targets = active.filter(F.col("document_key").rlike("(?i)^https?://")).groupBy("document_key").agg(F.min("observed_url").alias("url"))
    stored = table.current()
    current = (F.col("version") == version) & (F.col("config_hash") == config_hash) & (F.col("input_hash") == F.sha2("url", 256))
    planned = targets.join(stored, "document_key", "left").select("document_key", "url", classify_work(current, F.col("status"), F.col("retry_at"), now, offline=offline, ignore_cache=ignore_cache).alias("work"))
    work = {r["work"]: r["n"] for r in enrichment.summary(planned).collect()}
    if work.get("pending"):
        profiles, timeout = own.header_profiles, own.timeout_s
        fetch = get or (lambda url: transport.fetch_document(url, timeout, get=partial(transport.public_get, headers=lambda u: transport.headers_for(u, profiles))))
        done = extraction.fetch(planned.filter("work = 'pending'"), fetch, workers=own.workers, retries=own.retries, delay=own.delay_s)
        new = extraction.stored(done, version, config_hash, now, own.delays())
        path = f"{table.root}/work-{uuid.uuid4().hex}"  # fetched once, whatever is computed again
        new.write.parquet(path)
        new = table.spark.read.schema(table.schema).parquet(path)
        for r in new.groupBy("status").agg(F.count("*").alias("n")).collect():
            work[{"success": "succeeded", "retryable_failure": "retryable", "permanent_failure": "failed"}[r["status"]]] = r["n"]
        table.replace(upsert(stored, new, ["document_key"]))
        table.files.delete(path)
    return work


def enrich(items: DataFrame, table: Versions, e: enrichment.Enricher, now: Column, *, offline: bool = False, ignore_cache: bool = False) -> dict[str, int | bool]:
    """Compute what is due of one enricher, store it, and return the counters; an unavailable backend leaves all of it missing."""
    subject, stored = enrichment.subjects(items, e), table.current()
    up = not offline and enrichment.is_available(e)
    planned = enrichment.plan(subject, stored, e, now, offline=not up, ignore_cache=ignore_cache)
    work: dict[str, int | bool] = {r["work"]: r["n"] for r in enrichment.summary(planned).collect()} | {"available": up or offline}
    if work.get("pending"):
        path = f"{table.root}/work-{uuid.uuid4().hex}"
        enrichment.run(planned, e, now).write.parquet(path)
        new = table.spark.read.schema(table.schema).parquet(path)
        for r in new.groupBy("status").agg(F.count("*").alias("n")).collect():
            work["succeeded" if r["status"] == "success" else "retryable"] = r["n"]
        table.replace(upsert(stored, new, ["enricher", "subject_key"]))
        table.files.delete(path)
    return work


def complete(work: dict) -> bool:
    """Whether a stage has a result, or a lasting failure, for each of its subjects."""
    return not any(work.get(k) for k in ("missing", "deferred", "retryable")) and work.get("available", True) is not False


def records(final: DataFrame, evidence: DataFrame) -> DataFrame:
    """Identified observations as records of the canonical projection, with all URLs of their document."""
    urls = evidence.filter("kind = 'url'").groupBy("document_id").agg(F.array_sort(F.collect_set("value")).alias("urls"))
    return final.join(urls, "document_id", "left").withColumn("urls", F.coalesce("urls", F.array("document_key")))


def project(spark: SparkSession, rows: DataFrame, items: DataFrame, results: DataFrame, enrichers: Iterable[enrichment.Enricher], facts: DataFrame | None = None, confidence: float = 0.5) -> DataFrame:
    """All quads of a run: records by source, factors of claims, mentions of claims and reviews."""
    quads = projection.record_quads(projection.source_views(rows)).drop("part")
    graphs = rows.select(F.col("claim_uri").alias("subject_key"), "source_name")
    mentions = None
    for e in enrichers:
        found = enrichment.apply(enrichment.subjects(items, e), results, e)
        if e.name in projection.FACTOR_KINDS:
            values = projection.factor_values(found.select("subject_key", F.lit(e.name).alias("model"), "payload"))
            quads = quads.unionByName(projection.factor_quads(values, graphs))
        elif e.name.startswith("entities."):
            prefix = "" if e.key == "claim_uri" else "review/"
            own = enrichment.entities(found, confidence).select(F.concat(F.lit(prefix), "subject_key").alias("subject"), "uri")
            mentions = own if mentions is None else mentions.unionByName(own)
    if mentions is not None:
        properties = None
        if facts is not None:
            properties = enrichment.entity_properties(mentions, facts, [r[0] for r in facts.select("property").distinct().limit(1000).collect()])
        quads = quads.unionByName(rdf.mention_quads(mentions, properties))
    return quads


def snapshot_path(template: str, root: str, when: datetime, source: str = "") -> str:
    """A path with ROOT, DATE, TIME, DATETIME, TIMESTAMP and SOURCE filled in."""
    held = {"ROOT": root.rstrip("/"), "DATE": f"{when:%Y-%m-%d}", "TIME": f"{when:%H-%M-%S}", "DATETIME": f"{when:%Y-%m-%dT%H%M%S}", "TIMESTAMP": str(int(when.timestamp())), "SOURCE": source}
    for k, v in held.items():
        template = template.replace("{" + k + "}", v)
    return template


def run(
    spark: SparkSession, config: RunConfig, *, skip_download: bool = False, skip_extraction: bool = False, skip_enrichment: bool = False, ignore_extractions: bool = False, ignore_enrichments: bool = False, stamp: str | None = None,
    get: Callable[[str], dict] | None = None, enrichers: Iterable[enrichment.Enricher] = (), facts: DataFrame | None = None, transports: dict[str, dict] | None = None, now: datetime | None = None,
) -> dict:
    """Ingest, extract, resolve, enrich, project, publish.

    Graphs of sources that failed, with records that can't be projected, or with an incomplete stage keep the lines of
    the last snapshot.  The summary says ``degraded`` if anything of that kind happened.
    """
    if (skip_extraction and ignore_extractions) or (skip_enrichment and ignore_enrichments):
        raise ValueError("a stage can't be skipped and computed anew at once")
    moment = now or datetime.now(UTC)
    at = F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    ledger = Ledger(f"{config.root}/ledger", spark)
    with ledger.run(config.hash()) as summary:
        tables, enrichers = bootstrap(spark, config.root), enrichment.ordered(list(enrichers))
        observed, summary["sources"] = ingest(spark, config, uuid.uuid4().hex, skip_download=skip_download, transports=transports)
        active, catalog = observed.filter("active"), organizations(spark, config)
        if catalog is None:
            active = active.withColumn("organization_uri", F.concat(F.lit("organization/"), digest("organization", F.col("organization_site"))))
        else:
            active = active.join(catalog.withColumnRenamed("site", "organization_site"), "organization_site")
        active = active.withColumns({"document_key": F.coalesce(document_url(F.col("observed_url")), "observed_url"), "source_text": F.col("review_text")})
        if config.extraction.enabled:
            summary["extraction"] = extract(active, tables["extractions"], config, at, offline=skip_extraction, ignore_cache=ignore_extractions, get=get)
        ledger.renew()
        facts_of = identity.with_document(active, tables["extractions"].current())
        known, ids = tables["evidence"].current(), tables["identities"].current()
        resolved = identity.resolve(facts_of, ids, known)
        tables["evidence"].replace(known.unionByName(identity.new_evidence(resolved, known)))
        tables["documents"].replace(identity.absorb_documents(tables["documents"].current(), resolved, at))
        tables["identities"].replace(upsert(ids, resolved.select("record_key", "document_id", "claim_review_id"), ["record_key"]))
        final = facts_of.join(tables["identities"].current(), "record_key")
        summary["observations"], summary["documents"], summary["reviews"] = final.agg(F.count("*"), F.count_distinct("document_id"), F.count_distinct("claim_review_id")).first()
        rows = records(final, tables["evidence"].current())
        items = rows.withColumn("claim_analysis", analysis_text(F.col("claim_text"))).withColumn("review_analysis", analysis_text(F.col("content")))
        summary["enrichment"] = {e.name: enrich(items, tables["enrichments"], e, at, offline=skip_enrichment, ignore_cache=ignore_enrichments) for e in enrichers}
        ledger.renew()
        errors = {r["graph"]: [r["failed"], r["first_error"]] for r in projection.export_errors(rows).collect()}
        fit = rows.filter("claim_review_id is not null and trim(coalesce(claim_text, '')) <> '' and organization_uri is not null")
        quads = project(spark, fit, items, tables["enrichments"].current(), enrichers, facts, config.enrichment.linker.confidence).unionByName(rdf.vocabularies(spark, config.vocabularies))
        late = [e for e in enrichers if not complete(summary["enrichment"][e.name])]
        installed = [n for n, x in summary["sources"].items() if not x.startswith("failed")]
        shut = {rdf.graph_of(n) for n, x in summary["sources"].items() if x.startswith("failed")} | set(errors) | {e.graph for e in late if e.graph}
        shut |= {rdf.graph_of(n) for n in installed} if any(e.graph is None for e in late) else set()
        place = f"{config.root}/snapshots/{stamp}" if stamp else snapshot_path(config.output.path, config.root, moment)
        parent, disk = place.rsplit("/", 1)[0], files(spark, place)
        before = [n for n in disk.names(parent) if disk.is_folder(f"{parent}/{n}") and disk.exists(f"{parent}/{n}/_SUCCESS") and n != place.rsplit("/", 1)[1]]
        lines = rdf.nt_lines(quads)
        published = rdf.publish(lines, place, sorted(shut), f"{parent}/{before[-1]}" if before else None, one_file=config.output.one_file)
        table = published.collect()
        summary["graphs"], summary["lines"] = sum(r["published"] for r in table), sum(r["lines"] for r in table if r["published"])
        summary["kept_graphs"], summary["errors"] = sorted(shut), errors
        summary["snapshot"], summary["removed"] = place, keep_newest(parent, config.keep_snapshots, spark)
        summary["degraded"] = bool(shut or late or errors or len(installed) < len(summary["sources"]) or not complete(summary.get("extraction", {})))
        return dict(summary)


def activate(spark: SparkSession, root: str, snapshot: str, expected: Iterable[str]) -> str | None:
    """Serve ``snapshot`` (a folder's path) from now on; refused unless it is whole and has every expected graph.  Returns the one served before."""
    disk = files(spark, root)
    held = {r["graph"] for r in rdf.read_lines(spark, snapshot).select("graph").distinct().collect()} if disk.exists(f"{snapshot}/_SUCCESS") else set()
    if set(expected) - held:
        raise ValueError(f"the snapshot lacks {sorted(set(expected) - held)}")
    pointer = f"{root.rstrip('/')}/SERVED"
    before = disk.read(pointer) if disk.exists(pointer) else None
    if before and before != snapshot:
        disk.write(f"{root.rstrip('/')}/SERVED_BEFORE", before)
    disk.write(pointer, snapshot)
    return before


def roll_back(spark: SparkSession, root: str) -> str:
    """Serve the snapshot that was served before."""
    disk = files(spark, root)
    before = disk.read(f"{root.rstrip('/')}/SERVED_BEFORE")
    disk.write(f"{root.rstrip('/')}/SERVED", before)
    return before


def served(spark: SparkSession, root: str) -> DataFrame:
    """The quads of the snapshot that is served."""
    return rdf.line_quads(rdf.read_lines(spark, files(spark, root).read(f"{root.rstrip('/')}/SERVED")))


def purge(spark: SparkSession, root: str) -> int:
    """Delete all stored results that can be computed again; returns how many there were.  Identities stay."""
    tables, gone = bootstrap(spark, root), 0
    for name in ("extractions", "enrichments"):
        gone += tables[name].current().count()
        tables[name].replace(spark.createDataFrame([], tables[name].schema))
    return gone


def _log_to(config: RunConfig, debug: bool) -> None:
    own = config.logging
    kept = [logging.handlers.RotatingFileHandler(own.file, maxBytes=size_in_bytes(own.max_size), backupCount=own.backups)] if own.file else []
    logging.basicConfig(level="DEBUG" if debug else own.level, handlers=[logging.StreamHandler(sys.stderr), *kept], format="%(asctime)s - %(name)s - %(levelname)s - %(message)s", force=True)


def main(arguments: list[str] | None = None) -> int:
    """``run`` with its options, ``runs``, and ``purge-processing-results --yes``; 0, or 1 after a failure, 130 if interrupted."""
    parser = argparse.ArgumentParser(prog="kgspark")
    commands = parser.add_subparsers(dest="command")
    options = {"run": ("skip-download", "skip-extraction", "skip-enrichment", "no-cache-extraction", "no-cache-enrichment", "debug"), "runs": (), "purge-processing-results": ("yes",)}
    for name, flags in options.items():
        own = commands.add_parser(name)
        own.add_argument("--config", "-c", required=True)
        for f in flags:
            own.add_argument(f"--{f}", action="store_true")
    given = parser.parse_args(arguments)
    if not given.command:
        parser.print_help()
        return 1
    if given.command == "run" and ((given.skip_extraction and given.no_cache_extraction) or (given.skip_enrichment and given.no_cache_enrichment)):
        print("a stage can't be skipped and computed anew at once", file=sys.stderr)
        return 1
    if given.command == "purge-processing-results" and not given.yes:
        print("nothing is deleted without --yes; identities are never deleted", file=sys.stderr)
        return 1
    try:
        config = RunConfig.load(given.config)
        if given.command == "runs":
            print(json.dumps(Ledger(f"{config.root}/ledger").runs()))
            return 0
        spark = SparkSession.builder.getOrCreate()
        if given.command == "purge-processing-results":
            print(f"deleted {purge(spark, config.root)} results")
            return 0
        _log_to(config, given.debug)
        print(json.dumps(run(
            spark, config, skip_download=given.skip_download, skip_extraction=given.skip_extraction, skip_enrichment=given.skip_enrichment,
            ignore_extractions=given.no_cache_extraction, ignore_enrichments=given.no_cache_enrichment,
        )))
    except KeyboardInterrupt:
        print("interrupted; what was stored stays", file=sys.stderr)
        return 130
    except Exception as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
