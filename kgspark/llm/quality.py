"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.  DataFrame functions only.

Words are ``[^\\x20\\x09-\\x0D]+``.  The features of a text are its lower-cased words and
pairs of neighbouring words, each hashed into one of ``buckets``.  Two multinomials
are fitted, one on trusted documents (a bounded number of labelled good ones), one on
the whole raw corpus, both with add-one smoothing.  A text's score is the sum of
its features' log ratios divided by their number.  Weights are rounded to
millionths and summed as integers, so every run gives the same score; a text is
kept if the score reaches ``threshold``.

Defined results: text null or empty: no words, every count 0, base_failed true, kept
false.  Without trusted rows (or with an empty corpus) all weights are 0 and only the base
rules decide.  Rows that repeat an id, and null ids, are judged one by one.  Further
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, TRUSTED, THRESHOLD, UNIT = 65_536, 20_000, -0.15, 1_000_000
WORD, BLANKS, SYMBOLS = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+", "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _features(hashes: str, buckets: int) -> Column:
    """Buckets of all words and all neighbouring pairs, from a column of the lower-cased words' hashes."""
    h = F.col(hashes)
    one = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    two = F.transform(h, lambda x, i: F.pmod(F.xxhash64(F.get(h, i - 1), x), F.lit(buckets)).cast("int"))
    return F.when(F.size(h) > 1, F.concat(one, F.slice(two, F.lit(2), F.size(h) - 1))).otherwise(one)


def fit_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, max_trusted: int = TRUSTED) -> list[int]:
    """Log ratio of each bucket in millionths, from all of ``docs`` and from the documents named in ``trusted`` (doc_id).

    Of more than ``max_trusted`` trusted ids those of the smallest hash are taken, so the
    table that is broadcast has at most so many numbers.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("t_id")).filter("t_id is not null").distinct()
    ids = F.broadcast(ids.orderBy(F.xxhash64("t_id"), "t_id").limit(max_trusted))
    hashes = F.transform(_words(F.lower("text")), lambda x: F.xxhash64(x))
    words = docs.select(F.col("doc_id").alias("d_id"), hashes.alias("hashes")).join(ids, F.col("d_id") == F.col("t_id"), "left")
    each = words.select(F.col("t_id").isNotNull().alias("good"), F.explode(_features("hashes", buckets)).alias("bucket"))
    counts = each.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("good").alias("good")).collect()
    raw, good = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["bucket"]], good[r["bucket"]] = r["n"], r["good"]
    if not sum(good):
        return [0] * buckets
    of = lambda n, all_: math.log((n + 1) / (all_ + buckets))
    n, g = sum(raw), sum(good)
    return [round(UNIT * (of(b, g) - of(a, n))) for a, b in zip(raw, good)]


def quality_columns(docs: DataFrame, weights: list[int], threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, row) of every row; row is the input row as a struct."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row)
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    x = x.select(
        "row", "doc_id",
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        _words(F.col("text")).alias("words"),
    )
    x = x.select("row", "doc_id", "word_chars", "n_symbols", "lines", "words", F.transform("words", lambda x: F.xxhash64(x)).alias("own"))
    w = F.col("own")
    windows = F.transform(F.slice(w, F.lit(5), F.greatest(F.size(w) - 4, F.lit(0))), lambda x, i: F.xxhash64(*(F.get(w, i + k) for k in range(4)), x))
    x = x.select(
        "row", "doc_id", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda x: F.xxhash64(F.lower(x))).alias("lower"),
        F.when(F.size("words") >= 5, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # equal windows stand side by side once sorted; texts without any skip the sort
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    x = x.select(
        "row", "doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_words",
        _features("lower", len(weights)).alias("features"),
        F.when(some, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("sorted"),
    )
    s = F.col("sorted")
    twice = F.filter(s, lambda e, k: (e["h"] == F.get(s, k - 1)["h"]).eqNullSafe(F.lit(True)) | (e["h"] == F.get(s, k + 1)["h"]).eqNullSafe(F.lit(True)))
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    total = F.aggregate("features", F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    x = x.select(
        "row", "doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_words",
        F.size("features").cast("long").alias("n_features"), total.alias("total"),
        F.sort_array(F.transform(twice, lambda e: e["i"])).alias("at"),
    )
    at = F.col("at")
    covered = F.aggregate(F.transform(at, lambda v, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - v, F.lit(5)))), F.lit(0).cast("long"), lambda a, v: a + v)
    x = x.select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_features", "total")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = F.col("total") >= F.lit(round(threshold * UNIT)).cast("long") * F.col("n_features")
    judged = F.struct(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & good).alias("kept"),
        F.when(F.col("n_features") > 0, F.col("total") / F.col("n_features") / UNIT).otherwise(F.lit(0.0)).alias("score"), "row",
    )
    # a generator of one row: a filter on the result isn't pushed below it, where it would repeat all the work above
    return x.select(F.inline(F.array(judged)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents that the labels call good and not toxic."""
    return labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Fit on ``docs`` and the trusted rows of ``labels``, then judge every row of ``docs``."""
    return quality_columns(docs, fit_weights(docs, trusted_ids(labels), buckets), threshold)
