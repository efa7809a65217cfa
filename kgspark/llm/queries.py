"""The registered queries of this folder's operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sp_codec import decode_ids, encode_texts

    path = _path("piece_bpe_32k.model")
    done = decode_ids(encode_texts(_table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), _path("word_bpe_49k.json"), 2048, 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_total", "lines_removed")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), _path("piece_bpe_32k.model"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lang_id import identify

    return identify(_table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import packed_matrices

    return packed_matrices(_table(spark, sf_dir, "documents"), _path("word_bpe_49k.json"), 2048, 0)


#: Rules of the registered URL query: (verdict, host, path).
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls, rules_table

    return filter_urls(_table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .knn_join import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("score", "row")


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_near_duplicates, op3_best_fit_packing, op4_line_dedup, op5_token_counts,
        op6_language_id, op7_token_output, op8_url_filters, op9_exact_top_k, op10_quality_rules,
    )
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    from . import knn_join, line_dedup, near_dup, url_filter

    return {
        "op2_near_duplicates": near_dup.oracle_sql(),
        "op4_line_dedup": line_dedup.oracle_sql(),
        "op8_url_filters": url_filter.oracle_sql(URL_RULES),
        "op9_exact_top_k": knn_join.oracle_sql(),
    }
