"""Versioned tables without MERGE: upserts, snapshot differences, cache classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``new`` rows over ``old`` ones of the same key; columns in ``keep`` stay as the old row has them."""
    untouched = old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns)
    if not keep:
        return untouched.unionByName(new.select(*old.columns))
    held = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep])
    fresh = new.join(held, list(keys), "left").select(*[F.coalesce(f"_old_{c}", c).alias(c) if c in keep else F.col(c) for c in old.columns])
    return untouched.unionByName(fresh)


def with_extraction(observations: DataFrame, extractions: DataFrame) -> DataFrame:
    """Every observation with the content of its document's successful extraction, null without one; extractions is (document_key, status, content)."""
    return observations.join(extractions.filter("status = 'success'").select("document_key", "content"), "document_key", "left")


def deactivate_missing(table: DataFrame, sources: DataFrame, run_id: str) -> DataFrame:
    """Rows of the installed ``sources`` (source_name) that this run didn't see become inactive."""
    flag = sources.select("source_name").distinct().withColumn("_installed", F.lit(True))
    if flag.count() <= 10_000:
        flag = F.broadcast(flag)
    joined = table.join(flag, "source_name", "left")
    active = F.when(F.col("_installed") & (F.col("last_seen_run_id") != run_id), F.lit(False)).otherwise(F.col("active"))
    return joined.select(*[active.alias("active") if c == "active" else F.col(c) for c in table.columns])


def classify_work(current: Column, status: Column, retry_at: Column, now: Column, *, offline: bool = False, ignore_cache: bool = False) -> Column:
    """cached, permanent, deferred, pending or (offline) missing, from a stored result that may be current."""
    pending = F.lit("missing" if offline else "pending")
    if ignore_cache:
        return pending
    current = F.coalesce(current, F.lit(False))
    return (
        F.when(current & (status == "success"), "cached")
        .when(current & (status == "permanent_failure"), "permanent")
        .when(current & (status == "retryable_failure") & (retry_at > now), "deferred")
        .otherwise(pending)
    )


#: Hours until the next try, by failure category.
RETRY_HOURS = {"transient": 1, "access_blocked": 30 * 24, "dns": 7 * 24, "unextractable_content": 30 * 24}


def classify_failure(error_type: Column, http_status: Column, server_retry: Column, now: Column, delays: dict[str, float] | None = None) -> Column:
    """struct(status, category, retry_at) of a failed fetch; ``delays`` are hours by category that differ from RETRY_HOURS."""
    permanent_kind = error_type.isin("invalid_input", "invalid_url", "response_too_large", "unsupported_content")
    http = error_type == "http_error"
    gone = http & http_status.between(400, 499) & ~http_status.isin(401, 403, 408, 425, 429)
    category = (
        F.when(permanent_kind | F.coalesce(gone, F.lit(False)), "permanent")
        .when(http & http_status.isin(401, 403), "access_blocked")
        .when(http, "transient")
        .when(error_type == "access_challenge", "access_blocked")
        .when(error_type == "dns", "dns")
        .when(error_type == "extraction_failed", "unextractable_content")
        .otherwise("transient")
    )
    seconds = F.create_map(*[F.lit(x) for k, v in (RETRY_HOURS | (delays or {})).items() for x in (k, float(v) * 3600)])[category]
    own = F.when(http & http_status.isin(401, 403), F.lit(None).cast("timestamp")).otherwise(server_retry)
    again = F.when(category != "permanent", F.coalesce(own, now + F.make_dt_interval(secs=seconds)))
    status = F.when(category == "permanent", "permanent_failure").otherwise("retryable_failure")
    return F.struct(status.alias("status"), category.alias("category"), again.alias("retry_at"))
