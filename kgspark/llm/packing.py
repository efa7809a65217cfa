"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become pieces: their ids and an end id, cut only when longer than the
capacity.  The pieces are dealt at random into blocks of bounded size.  Each block is solved by
several islands (own random seeds and first people); after every epoch each island's elite
migrates to the next island of the ring, and the best island's solution stands.  Pieces
of bins that stayed poorly filled are pooled across blocks and packed again, as
long as that saves a sequence, so that a block boundary costs none.

Defined results: text null or empty: one piece that holds the end id.  Rows that
repeat a doc_id, and null ids, keep their own pieces.  An empty table gives an
empty table.  Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard
from .gga import evolve
from .piece_bpe import KEEP
from .word_bpe import encoder

CAPACITY, BLOCK, ISLANDS, EPOCHS, WELL_FILLED, ROWS = 2048, 4096, 3, 2, 0.97, 256


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", *, with_ids: bool = False, keep: int = 2 * KEEP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids binary]) of every row's pieces, in order; a Python worker keeps the ids of at most ``keep`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, keep)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                names = batch.column(0).slice(lo, ROWS).to_pylist()
                out: list[list] = [[], [], [], [], [], []]
                for name, ids in zip(names, enc.encode(batch.column(1).slice(lo, ROWS).to_pylist())):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        for column, value in zip(out, (name, k, start // 4, len(part) // 4, zlib.crc32(part), part)):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
                fields = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=fields)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _solution(block: int, island: int, rows: np.ndarray, sizes: list[int], bins: list[list[int]], generations: int) -> pd.DataFrame:
    which = np.empty(len(sizes), dtype="<i4")
    for b, items in enumerate(bins):
        which[items] = b
    return pd.DataFrame({"block": [block], "island": [island], "n_bins": [len(bins)], "generations": [generations], "rows": [rows.astype("<i8").tobytes()], "sizes": [np.array(sizes, dtype="<i4").tobytes()], "bins": [which.tobytes()]})


_STATE = "block long, island int, n_bins int, generations int, rows binary, sizes binary, bins binary"


def _first_epoch(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True])
        sizes, block, island = rows["length"].tolist(), int(rows["block"].iat[0]), int(rows["island"].iat[0])
        return _solution(block, island, rows["row"].to_numpy(), sizes, *evolve(sizes, capacity, hash((block, island))))

    return run


def _groups(bins: bytes) -> list[list[int]]:
    which = np.frombuffer(bins, dtype="<i4")
    order = np.argsort(which, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(which[order])) + 1)]


def _next_epoch(capacity: int, epoch: int):
    def run(elites: pd.DataFrame) -> pd.DataFrame:
        elites = elites.sort_values(["n_bins", "from"])
        sizes = np.frombuffer(elites["sizes"].iat[0], dtype="<i4").tolist()
        block, island = int(elites["block"].iat[0]), int(elites["island"].iat[0])
        bins, more = evolve(sizes, capacity, hash((block, island, epoch)), [_groups(b) for b in elites["bins"]])
        return _solution(block, island, np.frombuffer(elites["rows"].iat[0], dtype="<i8"), sizes, bins, int(elites["generations"].max()) + more)

    return run


def _placed(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                names, sizes = np.frombuffer(r.rows, dtype="<i8"), np.frombuffer(r.sizes, dtype="<i4").astype("int64")
                which = np.frombuffer(r.bins, dtype="<i4")
                order = np.argsort(which, kind="stable")
                at = np.concatenate([[0], np.cumsum(sizes[order])[:-1]])
                first = np.r_[True, np.diff(which[order]) != 0]
                offset = at - np.maximum.accumulate(np.where(first, at, 0))
                fill = np.bincount(which, weights=sizes)[which[order]]
                yield pd.DataFrame({"row": names[order], "length": sizes[order], "block": r.block, "bin": which[order], "offset": offset, "fill": fill / capacity, "generations": r.generations})

    return run


def _search(open_: DataFrame, level: int, blocks: int, capacity: int, islands: int, epochs: int) -> DataFrame:
    """(row, length, block, bin, offset, fill, generations): one level's solution of ``open_`` (row, length)."""
    dealt = open_.withColumn("block", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(blocks)))
    state = cut(dealt.withColumn("island", F.explode(F.array([F.lit(k) for k in range(islands)]))).groupBy("block", "island").applyInPandas(_first_epoch(capacity), _STATE))
    for epoch in range(1, epochs):
        to = F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(islands))))
        moved = state.withColumn("to", to).select("block", F.col("to").alias("island"), F.col("island").alias("from"), "n_bins", "generations", "rows", "sizes", "bins")
        old, state = state, cut(moved.groupBy("block", "island").applyInPandas(_next_epoch(capacity, epoch), _STATE))
        discard(old)
    best = state.groupBy("block").agg(F.min(F.struct("n_bins", "island")).alias("b")).select("block", "b.island")
    won = state.join(best, ["block", "island"]).select("block", "rows", "sizes", "bins", "generations")
    rows = cut(won.mapInPandas(_placed(capacity), "row long, length long, block long, bin int, offset long, fill double, generations int"))
    discard(state)
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, *, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (with a column length, 1 to capacity) and their sequence_id, offset and generations of the search that placed them (0: a piece of the whole capacity)."""
    # row numbers are written out once, so they stay the same whatever is run again
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()))
    whole = pieces.filter(F.col("length") >= capacity).select("row", (F.lit(1 << 62) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("generations"))
    poor, placed, level = F.col("fill") < WELL_FILLED, [whole], 0
    open_, before = pieces.filter(F.col("length") < capacity).select("row", "length"), None
    named = lambda rows, level: rows.select("row", (F.lit(level << 56) + F.shiftleft(F.col("block"), 20) + F.col("bin")).alias("sequence_id"), "offset", "generations")
    while True:
        blocks = max(1, math.ceil(open_.count() / block))
        rows = _search(open_, level, blocks, capacity, islands, epochs)
        opened, all_ = rows.filter("offset = 0").agg(F.count_if(poor), F.count("*")).first()
        if before is not None and all_ >= before[1]:  # nothing saved: what the level before made of these pieces stands
            placed.append(named(before[0], level - 1))
            discard(rows)
            break
        if before is not None:
            placed.append(named(before[0].filter(~poor), level - 1))
        if blocks == 1:
            placed.append(named(rows, level))
            break
        open_, before, level = rows.filter(poor).select("row", "length"), (rows, opened), level + 1
    found = placed[0]
    for p in placed[1:]:
        found = found.unionByName(p)
    return pieces.join(found, "row").drop("row")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, *, keep: int = 2 * KEEP, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, generations) of every piece of every row."""
    return pack(token_pieces(docs, path, capacity, end_id, keep=keep), capacity, **options)
