"""Token counts of whole texts by a two-tier look-up on the map side.

Tier one is a table of the lengths of the corpus' most frequent pre-tokens.  Each
task of a first pass keeps a bounded summary of its own pre-tokens, the summaries
are added up, and the ``frequent`` most frequent (at most ``LONGEST`` characters each,
hence a proven size) are broadcast with their lengths.  Tier two is a bounded cache in
each Python worker, bounded in entries and bytes, for all others, which the tokeniser's library encodes.  No
pre-token is shuffled but those summaries, and both tiers are exact: the table changes
the cost, never a count.

Defined results: text null or empty: n_bytes 0, n_tokens 0.  Rows keep their number
and their id, repeated or null ids too; an empty table gives an empty table.
Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piece_bpe import LONG_PART, SPACE, pre_tokens
from .word_bpe import encoder

FREQUENT, LONGEST, PER_TASK, SUMMARY, KEEP, ROWS = 65_536, 48, 8_192, 200_000, 400_000, 500


class PieceLengths:
    """Lengths for a SentencePiece model whose pieces never cross ``pre_tokens``."""

    def __init__(self, path: str):
        from .piece_bpe import model

        self.library = model(path).library
        self.split = pre_tokens

    def lengths(self, parts: list[str]) -> list[int]:
        # the library puts its own blank first: it stands for a part's blank, or before a line feed, which joins nothing
        ids = self.library.encode([p[1:] if p[:1] == SPACE and p != SPACE and p[1] != SPACE else "\n" + p for p in parts], num_threads=1)
        return [len(x) if p[:1] == SPACE and p != SPACE and p[1] != SPACE else len(x) - 2 for p, x in zip(parts, ids)]


class WordLengths:
    """Lengths for a ``tokenizers`` file; where its words can't be told apart, a whole text is one part."""

    def __init__(self, path: str):
        self.words = encoder(path)

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        plain = self.words.separable and not any(c in text for c in "\x1c\x1d\x1e\x1f")
        return text.split() if plain else [text]

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.words.tokenizer.encode_batch(parts, add_special_tokens=False)]


_RULES: dict[str, PieceLengths | WordLengths] = {}
_TIERS: dict[tuple[str, int], dict[str, int]] = {}


def _rule(path: str) -> PieceLengths | WordLengths:
    if path not in _RULES:
        _RULES[path] = (PieceLengths if path.endswith(".model") else WordLengths)(path)
    return _RULES[path]


def frequent_parts(texts: DataFrame, path: str, frequent: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of the whole corpus, most frequent first; at most ``frequent`` short strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = _rule(path).split, Counter()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                for text in batch.column(0).slice(lo, ROWS).to_pylist():
                    seen.update([p for p in split(text) if 0 < len(p) <= LONGEST])
                    if len(seen) > SUMMARY:
                        seen = Counter(dict(seen.most_common(SUMMARY // 2)))
        top = seen.most_common(PER_TASK)
        yield pa.record_batch([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["part", "n"])

    found = texts.mapInArrow(run, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    return [r["part"] for r in found.orderBy(F.desc("n"), "part").limit(frequent).collect()]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", *, frequent: int = FREQUENT, keep: int = KEEP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``path`` is a ``.model`` or a ``.json`` file."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    common = frequent_parts(texts.select("text"), path, frequent)
    table = docs.sparkSession.sparkContext.broadcast((common, bytes(0) if not common else _packed(_rule(path).lengths(common))))
    stamp = hash((path, len(common), *common[:64]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        rule, first = _rule(path), _TIERS.get((path, stamp))
        if first is None:
            parts, sizes = table.value
            first = _TIERS[path, stamp] = dict(zip(parts, memoryview(sizes).cast("I"), strict=True)) | {"": 0}
        known = _TIERS.setdefault((path, 0), dict(first))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                texts = batch.column(1).slice(lo, ROWS)
                cut = [rule.split(t) for t in texts.to_pylist()]
                if len(known) > keep + len(first):
                    known.clear()
                    known.update(first)
                new = list({p for parts in cut for p in parts}.difference(known))
                known.update(zip(new, rule.lengths(new)))
                n = pa.array([sum([known[p] for p in parts]) for parts in cut], pa.int64())
                for p in new:
                    if len(p) > LONG_PART:  # not worth keeping
                        del known[p]
                size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                yield pa.record_batch([batch.column(0).slice(lo, ROWS), size, n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _packed(lengths: list[int]) -> bytes:
    import array

    return array.array("I", lengths).tobytes()
