"""A corpus pipeline: five stages from raw documents to packed training sequences.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of ``documents``.  What the stages do with nulls, empty texts, repeated rows and
empty tables stands in their operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm import lang_id, line_dedup, near_dup, packing, quality
from kgspark.llm.common import cut

#: Documents whose best language scores less are in none of the known languages.
MIN_LANGUAGE_SCORE = 0.25
CAPACITY, END_ID = 2048, 0
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a Python worker keeps: fewer than in packing alone, as the executors' heaps have grown by the last stage.
KEEP_WORDS = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; trusted texts are those that ``labels`` calls good."""
    judged = quality.quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, whose words are like those of its training texts; a missing lang is filled in."""
    learned = lang_id.training_rows(docs.select("doc_id", "text", "lang"))
    model = lang_id.fit(*learned)
    found = lang_id.predict(docs, model, words=lang_id.vocabulary(*learned, model)).filter((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share in different texts; copies are left to the next stage."""
    clean = line_dedup.dedup_lines(docs, many_texts_only=True)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicate texts, the one of the smallest id; rows alike in id and text once, rows without an id stay."""
    return near_dup.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in packed sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), CAPACITY, END_ID, keep=KEEP_WORDS)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: Sketches, a fitted classifier and a genetic search are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
