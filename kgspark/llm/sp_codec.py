"""SentencePiece encoding and decoding of whole texts by a prefix table (see ``piece_bpe``).

Defined results: text null or empty: no ids, decoded text empty.  Rows keep their
number and their id, repeated or null ids too; an empty table gives an empty table.
Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piece_bpe import PieceEncoder, model

_ENCODERS: dict[str, PieceEncoder] = {}
ROWS = 500


def _lists(parts: list[bytes]) -> pa.Array:
    """int32 lists from their bytes, without a Python object for each id."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
    values = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row, as the library's ``encode`` gives them without begin, end or sampling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = PieceEncoder(path)
        encode = _ENCODERS[path].encode
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                ids = _lists([encode(t) for t in batch.column(1).slice(lo, ROWS).to_pylist()])
                yield pa.record_batch([batch.column(0).slice(lo, ROWS), ids], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded string) of rows (doc_id, ids), as the library's ``decode`` gives it; null ids: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model(path).decode
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                ids = batch.column(1).slice(lo, ROWS)
                flat = ids.flatten().to_numpy()  # the ids of all rows, without an object for each
                ends = np.cumsum([0, *(n or 0 for n in ids.value_lengths().to_pylist())]).tolist()
                texts = pa.array([decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())
                yield pa.record_batch([batch.column(0).slice(lo, ROWS), ids, texts], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
