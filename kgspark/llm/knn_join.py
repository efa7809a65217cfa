"""Exact top-k by integer inner product: a Voronoi join of queries and data.

Each component x becomes floor(scale * x).  Pivots, centres of a bounded sample whose number
grows with the root of the table, part the space into cells.

1. One pass gives every vector its nearest pivot.  A summary of each cell's queries
   goes to the driver, one row a cell: with u the pivot's direction, the least and the most of q.u,
   and the longest part of a query across u.
2. From these follow, for any vector x with a = x.u, a lower and an upper bound of its
   products with all queries of the cell: a * (least or most q.u) -+ (longest part across u)
   * |x - a u|.  The (k+1)-th best lower bound over all data is the cell's threshold (one more
   than k, as a query's own row takes no part).
3. Cells that lie together form groups of as many queries as ``query_bytes`` hold; a cell of more is
   split.  A vector is copied to a group only if its upper bound reaches the threshold of
   one of the group's cells; what is copied to a group is dealt into chunks.
4. Each task gives its queries' best k of its chunk by one matrix product, and the best k of
   these are the result.

On data without clusters the bounds keep nearly all vectors; then every vector is copied once a
group, and the result is exact all the same.

Defined results: vectors null, or with a null, NaN or infinite component, take no
part, nor do rows with a null id.  A shorter vector counts as padded with zeros.  Rows
count one by one: a query never meets its own row, but other rows of its id or its vector; ranks of
rows equal in score and id are in no certain order.  Fewer candidates than k: all of
them.  Components beyond 1e150 and products beyond 64 bits are drawn to the ends of these ranges.  An empty
table gives an empty table.  Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard

SCALE, K, MAX_PIVOTS, PIVOT_BYTES, SAMPLE, ROUNDS, QUERY_BYTES, CHUNK_BYTES, SLICE, HUGE = 64, 20, 1024, 4 << 20, 16, 4, 8 << 20, 4 << 20, 2 << 20, 1e150


def _encoded(batch: pa.Array, scale: float) -> list[bytes]:
    """floor(scale * x) of each list: a byte for the width of its numbers, then int16 or float64."""
    flat = np.clip(np.floor(np.asarray(batch.flatten(), dtype="<f8") * scale), -HUGE, HUGE)
    ends = np.cumsum([0, *batch.value_lengths().to_pylist()]).tolist()
    narrow = not len(flat) or float(np.abs(flat).max()) < 1 << 15
    mark, size, data = (b"\2", 2, flat.astype("<i2").tobytes()) if narrow else (b"\10", 8, flat.tobytes())
    return [mark + data[size * a : size * b] for a, b in zip(ends, ends[1:])]


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of float64, padded with zeros to ``width``."""
    if vectors and all(len(v) == 1 + 2 * width and v[0] == 2 for v in vectors):
        flat = np.frombuffer(b"".join(vectors), dtype=np.uint8).reshape(len(vectors), 1 + 2 * width)
        return np.ascontiguousarray(flat[:, 1:]).view("<i2").astype(np.float64)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        r = np.frombuffer(v, dtype="<i2" if v[0] == 2 else "<f8", offset=1)
        out[i, : len(r)] = r
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole-number matrices, as int64."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], dtype=object) @ np.array([[int(x) for x in row] for row in b], dtype=object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * (x @ centres.T)).argmin(axis=1)


def centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """``cells`` pivots: the sample's first rows, moved to the means of what is nearest to them."""
    found = sample[:cells].copy()
    for _ in range(ROUNDS):
        of = _nearest(sample, found)
        n = np.bincount(of, minlength=len(found))
        for j in np.flatnonzero(n):
            found[j] = sample[of == j].mean(axis=0)
    return found


@dataclass
class Bounds:
    """Each query cell's unit pivot, least and most q.u, longest part across u, and threshold."""

    unit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    across: np.ndarray
    floor: np.ndarray

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the products of each x with each cell's queries, with room for rounding."""
        size = np.linalg.norm(x, axis=1)[:, None]
        along = x @ self.unit.T
        rest = np.sqrt(np.maximum(0, size * size - along * along)) * self.across
        a, b = along * self.low, along * self.high
        slack = 1e-6 + 1e-9 * size * (np.maximum(np.abs(self.low), np.abs(self.high)) + self.across)
        ends = (-(2.0**63), 2.0**63)
        return np.clip(np.minimum(a, b) - rest - slack, *ends), np.clip(np.maximum(a, b) + rest + slack, *ends)

    def reach(self, x: np.ndarray) -> np.ndarray:
        """Which cells may have x among the best of one of their queries."""
        return ~(self.of(x)[1] < self.floor)


def grouped(pivots: np.ndarray, queries: list[int], most: int) -> list[list[int]]:
    """Places of the cells, those that lie together in one group of at most ``most`` queries (or one cell)."""
    left, groups, held = set(range(len(queries))), [], 0
    at = max(left, key=lambda j: queries[j], default=None)
    while left:
        left.remove(at)
        if not groups or held + queries[at] > most:
            groups.append([])
            held = 0
        groups[-1].append(at)
        held += queries[at]
        if left:
            rest = np.array(sorted(left))
            at = int(rest[((pivots[rest] - pivots[at]) ** 2).sum(axis=1).argmin()])
    return groups


def _best(q: pd.DataFrame, d: pd.DataFrame, width: int, k: int) -> Iterator[pd.DataFrame]:
    """The k best rows of d for each row of q, but never the same row."""
    d = d.sort_values(["vec_id", "row"], kind="stable")
    ids, rows, dm = d["vec_id"].to_numpy(), d["row"].to_numpy(), _matrix(d["vector"].tolist(), width)
    by_row = np.argsort(rows, kind="stable")
    step = max(1, SLICE // len(d))
    for lo in range(0, len(q), step):
        part = q.iloc[lo : lo + step]
        names = part["row"].to_numpy()
        s = _product(_matrix(part["vector"].tolist(), width), dm)
        take = np.ones(s.shape, dtype=bool)
        place = np.minimum(np.searchsorted(rows, names, sorter=by_row), len(rows) - 1)
        own = rows[by_row[place]] == names
        at = np.flatnonzero(own), by_row[place[own]]
        take[at], s[at] = False, np.iinfo(np.int64).min
        if s.shape[1] > k:
            take &= s >= np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]
        i, j = np.nonzero(take)
        score = s[i, j]
        order = np.lexsort((j, ~score, i))  # columns ascend by id, so ties go to the smaller
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(len(part)))
        keep = np.arange(len(i)) - first[i] < k
        i, j = i[keep], j[keep]
        yield pd.DataFrame({"q_row": names[i], "query_id": part["vec_id"].to_numpy()[i], "vec_id": ids[j], "score": score[keep]})


class VoronoiJoin:
    """The join's steps over (row, vec_id, query, vector, cell), written once."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int, scale: float, id_col: str, vector_col: str, pivots: int | None, query_bytes: int, chunk_bytes: int):
        self.k, self.query_bytes, self.chunk_bytes = k, query_bytes, chunk_bytes
        x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
        fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        x = x.filter("vec_id is not null and v is not null").filter(fine)
        self.n, self.width, self.queries = x.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if("query")).first()
        if not self.queries:
            return
        width, cells = self.width, pivots or max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * max(1, self.width)), math.isqrt(self.n) // 2))
        sample = x.select("v").orderBy(F.xxhash64("vec_id", "v", F.lit(9)), "vec_id", "v").limit(SAMPLE * cells).toArrow().column(0).combine_chunks()
        self.centre = centre = centres(_matrix(_encoded(sample, scale), width), cells)
        unit = centre / np.maximum(np.linalg.norm(centre, axis=1), 1e-300)[:, None]

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    part = batch.slice(lo, 1024)
                    held = _encoded(part.column(1), scale)
                    m = _matrix(held, width)
                    cell = _nearest(m, centre)
                    along = (m * unit[cell]).sum(axis=1)
                    across = np.sqrt(np.maximum(0, (m * m).sum(axis=1) - along * along))
                    yield pa.record_batch([part.column(0), part.column(2), pa.array(held, pa.binary()), pa.array(cell.astype("int32")), pa.array(along), pa.array(across)], names=["vec_id", "query", "vector", "cell", "along", "across"])

        placed = x.select("vec_id", "v", "query").mapInArrow(assign, "vec_id long, query boolean, vector binary, cell int, along double, across double")
        self.placed = cut(placed.withColumn("row", F.monotonically_increasing_id()))
        summary = self.placed.filter("query").groupBy("cell").agg(F.count("*").alias("n"), F.min("along").alias("a"), F.max("along").alias("b"), F.max("across").alias("w")).collect()
        self.cells = [r["cell"] for r in summary]
        self.sizes = [r["n"] for r in summary]
        low, high, across = (np.array([r[c] for r in summary]) for c in "abw")
        self.bounds = Bounds(unit[self.cells], low, high, across, np.full(len(summary), -np.inf))
        self._thresholds()
        most = max(1, query_bytes // (1 + 8 * width))
        self.groups = grouped(centre[self.cells], self.sizes, most)
        self.splits = [max(1, math.ceil(sum(self.sizes[j] for j in g) / most)) for g in self.groups]

    def _thresholds(self) -> None:
        """Each cell's (k+1)-th best lower bound: every task keeps its own k+1 best, and the best of these are ranked."""
        bounds, width, keep = self.bounds, self.width, self.k + 1

        def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = np.full((keep, len(bounds.floor)), -np.inf)
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    low, _ = bounds.of(_matrix(batch.column(0).slice(lo, 1024).to_pylist(), width))
                    both = np.concatenate([best, np.nan_to_num(low, nan=-np.inf)])
                    best = np.partition(both, len(both) - keep, axis=0)[len(both) - keep :]
            cell, value = np.repeat(np.arange(best.shape[1], dtype="int32"), keep), best.T.ravel()
            real = np.isfinite(value)
            yield pa.record_batch([pa.array(cell[real]), pa.array(value[real])], names=["place", "low"])

        ranked = self.placed.select("vector").mapInArrow(lowest, "place int, low double").withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(F.desc("low"))))
        for r in ranked.filter(F.col("rank") <= keep).groupBy("place").agg(F.min("low").alias("low"), F.count("*").alias("n")).collect():
            if r["n"] == keep:
                self.bounds.floor[r["place"]] = r["low"]

    def copies(self) -> DataFrame:
        """(row, vec_id, vector, groups): each vector with the groups that need it."""
        bounds, width = self.bounds, self.width
        order = np.array([j for g in self.groups for j in g])
        starts = np.cumsum([0, *(len(g) for g in self.groups)])[:-1]

        def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    part = batch.slice(lo, 1024)
                    need = np.logical_or.reduceat(bounds.reach(_matrix(part.column(2).to_pylist(), width))[:, order], starts, axis=1)
                    ends = np.concatenate([[0], np.cumsum(need.sum(axis=1))]).astype("int32")
                    groups = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(need)[1].astype("int32")))
                    yield pa.record_batch([*part.columns, groups], names=["row", "vec_id", "vector", "groups"])

        return self.placed.select("row", "vec_id", "vector").mapInArrow(reach, "row long, vec_id long, vector binary, groups array<int>")

    def result(self) -> DataFrame:
        spark, k, width = self.placed.sparkSession, self.k, self.width
        copies = cut(self.copies())
        held = {r["g"]: r["n"] for r in copies.select(F.explode("groups").alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect()}
        tasks, row_bytes = spark.sparkContext.defaultParallelism, 1 + 8 * width
        chunks = [max(1, math.ceil(held.get(g, 0) * row_bytes / self.chunk_bytes), min(math.ceil(2 * tasks / len(self.groups)), held.get(g, 0) // 1024)) for g in range(len(self.groups))]
        group_of = {self.cells[j]: g for g, own in enumerate(self.groups) for j in own}
        of = lambda table, at: F.get(F.array(*[F.lit(v) for v in table]), at)
        span = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        data = copies.select("row", "vec_id", "vector", F.explode("groups").alias("group"))
        data = data.withColumn("chunk", F.pmod(F.xxhash64("row"), of(chunks, F.col("group"))).cast("int")).withColumn("split", span(of(self.splits, F.col("group"))))
        group = of([group_of.get(c, -1) for c in range(len(self.centre))], F.col("cell"))
        queries = self.placed.filter("query").select("row", "vec_id", "vector", group.alias("group"))
        queries = queries.withColumn("split", F.pmod(F.xxhash64("row", F.lit(1)), of(self.splits, F.col("group"))).cast("int")).withColumn("chunk", span(of(chunks, F.col("group"))))

        def local(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
            parts = list(_best(q, d, width, k)) if len(q) and len(d) else []
            return pd.concat(parts) if parts else pd.DataFrame({"q_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

        keys = ["group", "split", "chunk"]
        found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(local, "q_row long, query_id long, vec_id long, score long")
        order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", *, pivots: int | None = None, query_bytes: int = QUERY_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of each row for which ``is_query`` holds, over columns vec_id and v (the vector)."""
    join = VoronoiJoin(vectors, is_query, k, scale, id_col, vector_col, pivots, query_bytes, chunk_bytes)
    if not join.queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return join.result()


def oracle_sql(every: int = 20, k: int = K, scale: int = SCALE) -> str:
    return f"""
WITH t AS (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
e AS (SELECT row, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM t WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score FROM e q JOIN e d ON q.row <> d.row WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= {k}"""
