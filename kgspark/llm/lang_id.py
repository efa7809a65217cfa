"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 2 and 3, blended)
present in both whole texts, divided by the root of each text's own number; of a text only the
n-grams that some landmark holds are counted.  Letters are lower-cased and folded onto a small alphabet: the most frequent characters of the
landmarks keep a code each, all others share the remaining codes.  A few training
texts are landmarks; the Nyström map turns the kernel with them into features, and
one ridge regression for each language (one against the rest) scores these.  Texts are
scored in batches: a presence matrix times the landmarks' presence matrix, then
times one matrix that holds map and regressions.

The training sample is bounded: at most ``per_lang`` documents a language, ``MAX_ROWS`` in all
and about ``SAMPLE_BYTES`` of text in all.  Rows are ranked by a hash of their id within their language on the
executors; the first of every language come before the second of any, and of a language at
least one is taken, whatever its length.  With many languages each has fewer landmarks, ``LANDMARKS``
(or two each) in all.

``predict`` may also be given a ``Vocabulary``: the triples of plain words that a language's
training texts hold, and the least share of its triples that a text of the language must
have in there.  That floor is two thirds of the share that all but a hundredth of the
training texts reach, each judged by the other texts alone.  Words with digits don't
count.  A text below the floor of its best language, or with no plain word, is in none of the
known languages.  Where a language has a single text to learn from, its floor is 0.

Defined results: text null or without a letter: ``und`` with score 0.  With no labelled
row to learn from every text is ``und``.  Rows keep their number and their id,
repeated or null ids too; null ids are never learned from.  An empty table gives an
empty table.  Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import positional, sole_cache

PER_LANG, LANDMARKS_PER_LANG, LANDMARKS, RIDGE, BITS, ROWS, MAX_ROWS, SAMPLE_BYTES, CHUNK = 300, 64, 256, 1e-3, 7, 64, 20_000, 64 << 20, 1 << 20
UNKNOWN = "und"
_WORD = re.compile(r"[^\W_]+")
FLOOR_SHARE, FLOOR_QUANTILE, MANY_TEXTS = 2 / 3, 0.01, 20


@dataclass
class KernelModel:
    langs: list[str]
    fold: np.ndarray  # code of each character
    slot: np.ndarray  # n-gram -> its place among the landmarks' n-grams, 0 for none
    landmarks: np.ndarray  # n-grams x landmarks, 0 or 1
    own: np.ndarray  # root of each landmark's own number of n-grams
    weights: np.ndarray  # landmarks (+ 1) x languages

    def presence(self, text: str) -> np.ndarray:
        """Which of the landmarks' n-grams the whole text holds."""
        here = np.zeros(self.landmarks.shape[0], dtype=bool)
        low = text.lower()
        for at in range(0, len(low), CHUNK):  # with two characters more, so that no n-gram is cut
            here[self.slot[grams(low[at : at + CHUNK + 2], self.fold)]] = True
        here[0] = False
        return here

    def scores(self, texts: list[str]) -> np.ndarray:
        p = np.stack([self.presence(t) for t in texts]).astype(np.float32)
        norm = np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        k = (p @ self.landmarks) / norm / self.own
        return np.c_[k, np.ones(len(texts), dtype=np.float32)] @ self.weights


def grams(text: str, fold: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a lower-cased text; pairs lie after the triples."""
    c = fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    two = (c[:-1] << BITS) | c[1:]
    three = (two[:-1] << BITS) | c[2:]
    return np.concatenate([three, two + (1 << 3 * BITS)])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _alphabet(texts: list[str]) -> np.ndarray:
    size = 1 << BITS
    fold = (np.arange(0x110000, dtype=np.int64) % (size // 4) + size - size // 4).astype(np.int32)
    seen = Counter()
    for t in texts:
        seen.update(t.lower())
    for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[: size - size // 4]):
        fold[ord(c)] = k
    return fold


def fit(texts: list[str], langs: list[str], landmarks_per_lang: int = LANDMARKS_PER_LANG, ridge: float = RIDGE) -> KernelModel | None:
    """Fit on given texts, in the order given; the first of each language are the landmarks."""
    names = sorted(set(langs))
    if not names:
        return None
    landmarks_per_lang = max(2, min(landmarks_per_lang, LANDMARKS // len(names)))
    marks = [i for n in names for i in [k for k, x in enumerate(langs) if x == n][:landmarks_per_lang]]
    fold = _alphabet([texts[i] for i in marks])
    held = [np.unique(grams(texts[i].lower(), fold)) for i in marks]
    every = np.unique(np.concatenate(held)) if held else np.empty(0, dtype=np.int64)
    slot = np.zeros((1 << 3 * BITS) + (1 << 2 * BITS), dtype=np.int32)
    slot[every] = np.arange(1, len(every) + 1)
    presence = np.zeros((len(every) + 1, len(marks)), dtype=np.float32)
    for j, h in enumerate(held):
        presence[slot[h], j] = 1
    own = np.sqrt(np.maximum(presence.sum(axis=0), 1))
    # Nyström: features are the kernel with the landmarks times the inverse root of the landmarks' own kernel
    kernel = (presence.T @ presence) / own[:, None] / own
    values, vectors = np.linalg.eigh(kernel.astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    model = KernelModel(names, fold, slot, presence, own, np.empty(0))
    p = np.concatenate([np.stack([model.presence(t) for t in texts[k : k + ROWS]]).astype(np.float32) @ presence for k in range(0, len(texts), ROWS)])
    size = np.array([max(1, model.presence(t).sum()) for t in texts])
    x = np.c_[(p / np.sqrt(size)[:, None] / own) @ root, np.ones(len(texts))]
    y = np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0)
    number = Counter(langs)
    share = np.array([1 / number[n] for n in langs])[:, None]  # each language weighs the same
    beta = np.linalg.solve(x.T @ (share * x) + ridge * np.eye(x.shape[1]), x.T @ (share * y))
    model.weights = np.r_[root @ beta[:-1], beta[-1:]].astype(np.float32)
    return model


def _word_triples(text: str, fold: np.ndarray) -> Iterator[np.ndarray]:
    """Codes of the triples of a text's plain words, lower-cased and with a blank around each."""
    plain = f" {' '.join(w for w in _WORD.findall(text.lower()) if w.isalpha())} "
    for at in range(0, len(plain) if plain.strip() else 0, CHUNK):
        c = fold[np.frombuffer(plain[at : at + CHUNK + 2].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        yield (((c[:-2] << BITS) | c[1:-1]) << BITS) | c[2:]


@dataclass
class Vocabulary:
    fold: np.ndarray
    known: dict[str, np.ndarray]  # for each language a bit for each triple
    floor: dict[str, float]

    def share(self, text: str, lang: str) -> float:
        """The share of the text's triples that the language knows."""
        bits, here, every = self.known[lang], 0, 0
        for t in _word_triples(text, self.fold):
            here += int(((bits[t >> 3] >> (7 - (t & 7))) & 1).sum())
            every += len(t)
        return here / every if every else -1.0

    def holds(self, text: str, lang: str) -> bool:
        return self.share(text, lang) >= self.floor[lang]


def vocabulary(texts: list[str], langs: list[str], model: KernelModel | None) -> Vocabulary | None:
    """What the training texts of each language hold; a triple counts if two of them do (one, if there are few)."""
    if model is None:
        return None
    known, floor = {}, {}
    for name in model.langs:
        own = [t for t, x in zip(texts, langs) if x == name]
        need = 2 if len(own) >= MANY_TEXTS else 1
        count = np.zeros(1 << 3 * BITS, dtype=np.int32)
        for t in own:
            here = [np.unique(x) for x in _word_triples(t, model.fold)]
            if here:
                count[np.unique(np.concatenate(here))] += 1
        known[name] = np.packbits(count >= need)
        without = Vocabulary(model.fold, {name: np.packbits(count > need)}, {})  # a text's own triples counted once less
        shares = [s for s in (without.share(t, name) for t in own) if s >= 0]
        floor[name] = FLOOR_SHARE * float(np.quantile(shares, FLOOR_QUANTILE)) if shares else 0.0
    return Vocabulary(model.fold, known, floor)


def training_rows(rows: DataFrame, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS, max_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """Texts and languages of the bounded sample of rows (doc_id, text, lang), in the order of a hash of doc_id."""
    rows = rows.filter("doc_id is not null and text is not null and lang is not null").filter(F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", "doc_id", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)).alias("part"))
    # first the hashes alone, then the texts of those that can be among the first
    light = rows.select("lang", "part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("part")))
    last = light.filter(F.col("rank") <= per_lang).groupBy("lang").agg(F.max("part").alias("last"))
    langs = min(max_rows, last.limit(max_rows).count())
    some = rows.join(F.broadcast(last) if langs < max_rows else last, "lang").filter("part <= last")
    order = Window.partitionBy("lang").orderBy("part", "doc_id", "text")
    ranked = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    ranked = ranked.withColumn("size", F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.filter((F.col("rank") == 1) | (F.col("size") <= max_bytes // max(1, langs)))
    found = ranked.orderBy("rank", "lang").limit(max_rows).select("part", "doc_id", "lang", "text").collect()
    found = sorted((r["part"], r["doc_id"], r["lang"], r["text"]) for r in found)
    return [r[3] for r in found], [r[2] for r in found]


def predict(docs: DataFrame, model: KernelModel | None, text_col: str = "text", *, words: Vocabulary | None = None) -> DataFrame:
    """``docs`` with the columns lang_pred and score (input columns of these names are replaced); score is the best regression's value, -1 to 1 drawn onto 0 to 1.

    With ``words``, texts that its languages don't hold are ``und`` with score 0.
    """
    held = docs.sparkSession.sparkContext.broadcast((model, words))
    stay = [k for k, c in enumerate(docs.columns) if c not in ("lang_pred", "score")]
    columns = [docs.columns[k] for k in stay]
    docs, place = positional(positional(docs).select(*[f"c{k}" for k in stay])), columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("languages")
        m, v = held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = part.column(place).to_pylist()
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                known = [i for i, t in enumerate(texts) if m and t and has_letter(t)]
                if known:
                    s = m.scores([texts[i] for i in known])
                    best = s.argmax(axis=1)
                    for i, b, x in zip(known, best.tolist(), s[np.arange(len(known)), best].tolist()):
                        if v is None or v.holds(texts[i], m.langs[b]):
                            langs[i], scores[i] = m.langs[b], min(1.0, max(0.0, (x + 1) / 2))
                yield pa.record_batch([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])).toDF(*columns, "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that are not held out, then predict every row: (doc_id, held_out, lang_pred, score)."""
    model = fit(*training_rows(docs.select("doc_id", "text", "lang").filter(~held_out()), per_lang))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return predict(rows, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
