"""Packed id matrices: best-fit-decreasing with a segment tree over capacities.

Documents become pieces as in ``packing`` (ids and an end id, cut into pieces of at most
the width, nothing dropped).  Pieces are dealt into blocks whose number follows the input's
bytes, by a hash of their content, their task and which of the task's rows of this content they
are of: a task that is run again deals the same, in whatever order its rows come, and rows
that are alike spread as well.  In each block they go, longest first, to the fullest sequence that still
holds them: a segment tree over the residual capacities finds it in log(width)
steps.  Each sequence becomes one row of a matrix: its ids as little-endian
unsigned integers, padded to the width.

Defined results: text null or empty: one piece that holds the end id.  Rows
that repeat a doc_id, and null ids, keep their own pieces.  An empty table gives an
empty table.  Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_bpe import encoder

WIDTH, BLOCK_BYTES, TASK_BLOCKS, ROWS = 2048, 12_000_000, 4, 256


class CapacityTree:
    """Open sequences by residual capacity; each node knows whether its leaves hold any."""

    def __init__(self, width: int):
        self.base = 1 << width.bit_length()
        self.count = [0] * (2 * self.base)
        self.held: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, room: int, which: int) -> None:
        self.held[room].append(which)
        at = room + self.base
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) of the smallest room of at least ``least``."""
        at, count = least + self.base, self.count
        while not count[at]:
            while at & 1:  # a right child: the next leaves are further up
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of a level
                return None
        while at < self.base:
            at *= 2
            if not count[at]:
                at += 1
        room = at - self.base
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.held[room].pop()


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Sequences of item numbers; longer items first, ties by number."""
    tree, sequences = CapacityTree(width), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            sequences.append([i])
            tree.put(width - sizes[i], len(sequences) - 1)
        else:
            sequences[found[1]].append(i)
            tree.put(found[0] - sizes[i], found[1])
    return sequences


def packed_matrices(docs: DataFrame, path: str, width: int = WIDTH, end_id: int = 0, pad_id: int = 0, id_bytes: int = 2, id_col: str = "doc_id", text_col: str = "text", *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each packed sequence.

    block, row: its place; n_tokens: ids before the padding; ids: ``width`` ids of
    ``id_bytes`` bytes; cu_seqlens: 0 and the end of each segment; resets: where the position ids
    start again at 0; doc_ids, pieces: each segment's document and piece number.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks, kind = max(1, math.ceil(total / block_bytes)), {2: "<u2", 4: "<u4"}[id_bytes]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, seen, task = encoder(path), np.array([end_id], dtype="<u4").tobytes(), {}, TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                names = batch.column(0).slice(lo, ROWS).to_pylist()
                block, doc, piece, parts = [], [], [], []
                for name, ids in zip(names, enc.encode(batch.column(1).slice(lo, ROWS).to_pylist())):
                    content = xxhash.xxh3_64_intdigest(ids, hash(name) & 0xFFFFFFFF)
                    seen[content] = again = seen.get(content, 0) + 1
                    ids = np.frombuffer(ids + end, dtype="<u4")
                    if id_bytes == 2 and ids.max() > 0xFFFF:
                        raise ValueError("the vocabulary needs four bytes an id")
                    for k, start in enumerate(range(0, len(ids), width)):
                        block.append(xxhash.xxh3_64_intdigest(f"{content}:{k}:{again}:{task}") % blocks)
                        doc.append(name)
                        piece.append(k)
                        parts.append(ids[start : start + width].astype(kind).tobytes())
                yield pa.record_batch([pa.array(block, pa.int64()), pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(parts, pa.binary())], names=["block", "doc_id", "piece", "part"])

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece"], kind="stable", na_position="first").reset_index(drop=True)
        parts, sizes = rows["part"].tolist(), [len(p) // id_bytes for p in rows["part"]]
        doc, piece = [None if pd.isna(x) else int(x) for x in rows["doc_id"]], rows["piece"].tolist()
        out = []
        for k, items in enumerate(best_fit_decreasing(sizes, width)):
            ends = [0, *np.cumsum([sizes[i] for i in items]).tolist()]
            ids = b"".join([parts[i] for i in items])
            pad = np.full(width - ends[-1], pad_id, dtype=kind).tobytes()
            out.append((int(rows["block"].iat[0]), k, ends[-1], ids + pad, ends, ends[:-1], [doc[i] for i in items], [piece[i] for i in items]))
        return pd.DataFrame(out, columns=["block", "row", "n_tokens", "ids", "cu_seqlens", "resets", "doc_ids", "pieces"])

    parts = texts.mapInArrow(cut_up, "block long, doc_id long, piece int, part binary")
    tasks = blocks // TASK_BLOCKS
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):  # a task's input doesn't grow with the table
        parts = parts.repartition(tasks, "block")
    return parts.groupBy("block").applyInPandas(fill, "block long, row int, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, pieces array<int>")


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet, a folder for each run, rows of a block in order."""
    packed.sortWithinPartitions("block", "row").write.mode("errorifexists").parquet(path)


def position_ids(resets: list[int], n_tokens: int) -> np.ndarray:
    """Position ids that restart at 0 at each reset."""
    at = np.arange(n_tokens)
    starts = np.zeros(n_tokens, dtype=np.int64)
    starts[[r for r in resets if r < n_tokens]] = [r for r in resets if r < n_tokens]
    return at - np.maximum.accumulate(starts)
