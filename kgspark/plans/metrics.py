"""Stage metrics over stored results; parameters may be null, as in the API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import url_domain


def _scope(results: DataFrame, stage_name=None, from_ts=None, to_ts=None) -> DataFrame:
    for value, condition in ((stage_name, lambda v: F.col("stage_name") == v), (from_ts, lambda v: F.col("updated_at") >= F.lit(v).cast("timestamp")), (to_ts, lambda v: F.col("updated_at") <= F.lit(v).cast("timestamp"))):
        if value is not None:
            results = results.filter(condition(value))
    return results


def _text(key: str) -> Column:
    return F.get_json_object("payload", f"$.{key}")


def _code() -> Column:
    return F.when(_text("http_status").rlike("^[0-9]+$"), _text("http_status").cast("int"))


def _top(df: DataFrame, limit: int | None, *order) -> DataFrame:
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def success_rate(results: DataFrame, **scope) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    rate = F.round(ok * F.lit(100).cast("decimal(4,1)") / F.nullif(F.count("*"), F.lit(0)), 2).cast("double")
    out = _scope(results, **scope).groupBy("stage_name", "stage_version").agg(F.count("*").alias("total_results"), ok.alias("successful"), F.count_if(F.col("status") != "success").alias("failed"), rate.alias("success_rate_percent"))
    return out.orderBy(F.desc("success_rate_percent"), "stage_name", "stage_version")


def overall(results: DataFrame, **scope) -> DataFrame:
    by = success_rate(results, **scope)
    total, ok = F.sum("total_results"), F.sum("successful")
    return by.agg(total.alias("total_results"), ok.alias("successful"), F.sum("failed").alias("failed"), F.round(ok * 100.0 / F.nullif(total, F.lit(0)), 2).alias("success_rate_percent"))


def error_types(results: DataFrame, limit: int | None = 200, **scope) -> DataFrame:
    x = _scope(results, **scope).filter("status <> 'success'").select("stage_name", "stage_version", "status", _text("error_type").alias("error_type"), _text("failure_category").alias("failure_category"), _code().alias("http_status"))
    x = x.groupBy(*x.columns).agg(F.count("*").alias("error_count"))
    return _top(x, limit, F.desc("error_count"), "stage_name", "stage_version", "status", "error_type", "failure_category", "http_status")


def domain_failures(results: DataFrame, limit: int | None = 200, **scope) -> DataFrame:
    x = _scope(results, **scope).filter("stage_name = 'document.extract' and status <> 'success'").filter(F.array_contains(F.json_object_keys("payload"), "url"))
    x = x.groupBy("stage_name", "stage_version", "status", url_domain(_text("url")).alias("domain")).agg(F.count("*").alias("failure_count"))
    return _top(x, limit, F.desc("failure_count"), "domain", "status")


def recent_activity(results: DataFrame, limit: int | None = 200, **scope) -> DataFrame:
    x = _scope(results, **scope).groupBy("stage_name", "stage_version").agg(
        F.count("*").alias("recent_results"), F.min("updated_at").alias("earliest"), F.max("updated_at").alias("latest"),
        F.count_if(F.col("status") == "success").alias("successful"), F.count_if(F.col("status") != "success").alias("failed"),
    )
    return _top(x, limit, F.desc("recent_results"), "stage_name", "stage_version")


def retry_queue(results: DataFrame, limit: int | None = 200, **scope) -> DataFrame:
    x = _scope(results, **scope).filter("status <> 'success'").groupBy("stage_name", "stage_version", "status", _text("failure_category").alias("failure_category"), _code().alias("http_status"))
    x = x.agg(F.count("*").alias("result_count"), F.min("retry_at").alias("next_retry_at"))
    return _top(x, limit, F.asc_nulls_last("next_retry_at"), F.desc("result_count"), "stage_name", "stage_version", "status", "failure_category", "http_status")
