"""Fetching documents: one request a host at a time, immediate retries, politeness, cool-down of hosts that answer 429."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import identity_text
from ..sources.transport import worth_another_try
from .relational import classify_failure

RESULT = "document_key string, url string, host string, error_type string, http_status int, content string, requested boolean, final_url string, canonical_url string, retry_at timestamp, error_message string, attempts int"
_FIELDS = [f.strip().split()[0] for f in RESULT.split(",")]


def fetch(targets: DataFrame, get: Callable[[str], dict], *, workers: int | None = None, retries: int = 0, delay: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Results of ``get(url)`` (see transport.fetch_document) for targets (document_key, url).

    Targets are dealt by host, so a host has one request at a time, and at most ``workers`` requests run at all.  A
    failure that may pass is tried again up to ``retries`` times, after 1 and then 2 seconds; after each URL the task waits
    ``delay`` seconds.  After a 429 a host's other rows become ``host_cooldown`` without a request, with the same retry_at.
    """

    def one(url: str) -> tuple[dict, int]:
        for attempt in range(retries + 1):
            try:
                x = get(url)
            except Exception as e:
                x = {"error_type": "unknown", "error_message": str(e)}
            if not x.get("error_type") or not worth_another_try(x) or attempt == retries:
                break
            sleep(min(2**attempt, 2))
        if delay:
            sleep(delay)
        return x, attempt + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cooling, until = None, None
        for batch in batches:
            out = []
            for key, url, host in zip(batch["document_key"], batch["url"], batch["host"]):
                if cooling == host:
                    out.append((key, url, host, "host_cooldown", 429, None, False, None, None, until, None, 0))
                    continue
                x, attempts = one(url)
                if x.get("http_status") == 429:
                    cooling, until = host, x.get("retry_at")
                out.append((key, url, host, x.get("error_type"), x.get("http_status"), x.get("content"), True, x.get("final_url"), x.get("canonical_url"), x.get("retry_at"), x.get("error_message"), attempts))
            frame = pd.DataFrame(out, columns=_FIELDS).astype({"http_status": "Int32", "attempts": "int32"})
            frame["retry_at"] = pd.to_datetime(frame["retry_at"], utc=True)
            yield frame

    host = F.lower(F.regexp_extract("url", r"^[^/]*//([^/?#]*)", 1))
    dealt = targets.select("document_key", "url", host.alias("host"))
    dealt = dealt.repartition(workers, "host") if workers else dealt.repartition("host")
    return dealt.sortWithinPartitions("host", F.xxhash64("url")).mapInPandas(run, RESULT)


EXTRACTIONS = """document_key string, requested_url string, final_url string, canonical_url string, content string, text_hash string, words int, version string, input_hash string, config_hash string,
status string, retry_at timestamp, category string, http_status int, error_type string, error_message string, requested boolean, updated_at timestamp"""


def stored(results: DataFrame, version: str, config_hash: str, now: Column, delays: dict[str, float] | None = None) -> DataFrame:
    """Rows to be stored of ``fetch`` results: successes with the fingerprint of their text, failures classified."""
    good = F.col("error_type").isNull() & F.col("content").isNotNull()
    kind = F.when(F.col("error_type") == "host_cooldown", "http_error").otherwise(F.coalesce("error_type", F.lit("extraction_failed")))
    x = results.withColumn("failure", classify_failure(kind, F.col("http_status"), F.col("retry_at"), now, delays)).withColumn("plain", identity_text(F.when(good, F.col("content"))))
    some = F.coalesce("plain", F.lit("")) != ""
    return x.select(
        "document_key", F.col("url").alias("requested_url"), "final_url", "canonical_url", F.when(good, F.col("content")).alias("content"), F.when(some, F.sha2("plain", 256)).alias("text_hash"),
        F.when(good, F.when(some, F.size(F.split("plain", " "))).otherwise(0)).alias("words"), F.lit(version).alias("version"), F.sha2("url", 256).alias("input_hash"), F.lit(config_hash).alias("config_hash"),
        F.when(good, "success").otherwise(F.col("failure.status")).alias("status"), F.when(~good, F.col("failure.retry_at")).alias("retry_at"), F.when(~good, F.col("failure.category")).alias("category"),
        "http_status", F.when(~good, kind).alias("error_type"), "error_message", "requested", now.alias("updated_at"),
    )
