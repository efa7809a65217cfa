"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

1. One pass over the documents makes each text's shingle set, its 128-bit name
   and, from the sketch, ``bands`` keys of ``rows`` bins.  Equal sets collapse to one
   node, whose text is the one of its smallest doc_id, so exact copies cost one row each.
2. Nodes that share a band key join that key's smallest member; the
   connected components of those stars are *clusters*.  Two sets of similarity s
   share no key with probability (1 - s^rows)^bands: 2.5e-7 at 0.75.
3. Two nodes are compared if they share a band key and their sketches agree in ``floor`` of the
   bins (five standard deviations under 0.75); the full sets confirm, best pairs first, and a
   pair already joined inside the task is not needed for reachability.  Each cluster is dealt into
   blocks of about ``block`` members, and every pair of blocks goes to one task, with the
   members' full sets.  A task returns only the confirmed links, fewer than its
   members, and no row per pair is ever made.
4. Components of the confirmed links give the classes.

A cluster over ``wide`` members (documents chained by shared passages) is dealt by
band key instead, in the same block-wise way.  The rule which nodes are compared is the
same both ways, only the cost differs; no group is capped.

Defined results: text null, empty or without words: n_shingles 0, linked with
nothing, component_id its own doc_id.  doc_id null: no links, component_id null,
kept true.  Rows that repeat a doc_id count as one document, with all their texts,
for links and each come back (``keep_one`` judges them row by row instead).  An empty
table gives an empty table.  Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, discard, positional, small, sole_cache
from .sketch import band_keys, forget, set_id, shingles, similar, sketch

BANDS, ROWS, FLOOR, BLOCK, WIDE = 40, 4, 0.58, 400, 20_000


def _signed(b: bytes) -> tuple[int, int]:
    return int.from_bytes(b[:8], "little", signed=True), int.from_bytes(b[8:], "little", signed=True)


#: Sketches are cut to so many bits, in keys and in bins, so that both tell the same.
_BITS = np.uint64(0xFFFFFFFF)


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("word hashes", forget)
        for batch in batches:
            texts = batch.column(3)
            for lo in range(0, batch.num_rows, 1000):
                n, s1, s2, keys = [], [], [], []
                for text in texts.slice(lo, 1000).to_pylist():
                    items = shingles(text)
                    n.append(len(items))
                    if len(items):
                        x, y = _signed(set_id(items))
                        s1.append(x)
                        s2.append(y)
                        keys.append(band_keys(sketch(items, bands * rows) & _BITS, bands, rows))
                    else:
                        s1.append(None)
                        s2.append(None)
                        keys.append(None)
                yield pa.record_batch(
                    [*(batch.column(k).slice(lo, 1000) for k in range(3)), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "h1", "h2", "n_shingles", "s1", "s2", "keys"],
                )

    return run


def _full_sets(t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("word hashes", forget)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                items = [shingles(x) for x in batch.column(1).slice(lo, 500).to_pylist()]
                some = [k for k, x in enumerate(items) if len(x)]
                names = [_signed(set_id(items[k])) for k in some]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, 500).take(pa.array(some, pa.int64())),
                        pa.array([x for x, _ in names], pa.int64()),
                        pa.array([y for _, y in names], pa.int64()),
                        pa.array([items[k].tobytes() for k in some], pa.binary()),
                        pa.array([(sketch(items[k], t) & _BITS).astype(np.uint32).tobytes() for k in some], pa.binary()),
                    ],
                    names=["doc_id", "s1", "s2", "items", "bins"],
                )

    return run


def _links(bands: int, per_band: int, floor: float, percent: int):
    """Confirmed links among the members of two blocks of one unit (or inside one block)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "node"]).reset_index(drop=True)
        ids = rows["node"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["items"]]
        bins = np.stack([np.frombuffer(x, dtype=np.uint32) for x in rows["bins"]])
        sizes = np.array([len(x) for x in sets])
        left = np.flatnonzero(rows["part"] == rows["i"])
        right = np.flatnonzero(rows["part"] == rows["j"])
        agree, fit = np.zeros((len(left), len(right)), dtype=np.int16), np.zeros((len(left), len(right)), dtype=bool)
        for band in range(bands):
            whole = True
            for k in range(band * per_band, (band + 1) * per_band):
                same = bins[left, k][:, None] == bins[right, k][None, :]
                agree += same
                whole = same & whole
            fit |= whole
        fit &= agree >= floor * bands * per_band
        small, large = np.minimum(sizes[left][:, None], sizes[right][None, :]), np.maximum(sizes[left][:, None], sizes[right][None, :])
        fit &= 100 * small >= percent * large
        if rows["i"].iat[0] == rows["j"].iat[0]:
            fit &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
        x, y = np.nonzero(fit)
        order = np.argsort(-agree[x, y], kind="stable")
        parent = list(range(len(ids)))

        def top(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        found = []
        for a, b in zip(left[x[order]].tolist(), right[y[order]].tolist()):
            p, q = top(a), top(b)
            if p != q and similar(sets[a], sets[b], percent):
                parent[p] = q
                found.append((ids[a], ids[b]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h1, h2, text): a 128-bit name of each text beside it."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), text.alias("text"))


def _classes(texts: DataFrame, *, by_id: bool, bands: int, rows: int, floor: float, block: int, wide: int, percent: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Of ``texts`` (doc_id, h1, h2, text): each row's signature, (s1, s2, class, component_id) of each distinct set, and the copies both read.

    class is a number of the set's class, component_id the smallest doc_id in it; with ``by_id`` the
    texts of one doc_id are in one class.
    """
    t = bands * rows
    signed = cut(texts.mapInArrow(_signatures(bands, rows), "doc_id long, h1 long, h2 long, n_shingles long, s1 long, s2 long, keys array<long>"))
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    nodes = cut(some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id()))
    twice = some.groupBy("doc_id").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in ("s1", "s2") for f in (F.min, F.max)])
    twice = cut(twice.filter("n > 1").select("doc_id", F.expr("s1_min <> s1_max or s2_min <> s2_max").alias("unlike")))
    repeated = twice.limit(1).count() > 0

    spread = nodes.select("node", F.explode("keys").alias("key"))
    hubs = spread.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").drop("last")
    members = cut(spread.join(hubs, "key"))
    cluster = components(members.select("node", "hub").filter("node <> hub").distinct(), "node", "hub")

    # only units of more than one block are looked up; all others are one block
    large = cut(cluster.groupBy("component").count().filter(F.col("count") > block))
    sized = cluster.join(small(large), "component", "left").withColumn("count", F.coalesce("count", F.lit(1)))
    blocks = F.ceil(F.col("count") / block).cast("int").alias("parts")
    units = sized.filter(F.col("count") <= wide).select("node", F.col("component").alias("unit"), F.lit(0).alias("kind"), blocks)
    if large.filter(F.col("count") > wide).limit(1).count():
        chained = sized.filter(F.col("count") > wide).select("node")
        by_key = cut(members.select("node", "key").join(chained, "node", "left_semi"))
        many = cut(by_key.groupBy("key").count().filter(F.col("count") > block))
        by_key = by_key.join(small(many), "key", "left").withColumn("count", F.coalesce("count", F.lit(1)))
        units = units.unionByName(by_key.select("node", F.col("key").alias("unit"), F.lit(1).alias("kind"), blocks))
    dealt = units.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = cut(nodes.select("s1", "s2", "rep", "node").join(small(dealt), "node"))
    wanted = dealt.select(F.col("rep").alias("doc_id"))
    sets = texts.select("doc_id", "text").join(small(wanted), "doc_id", "left_semi").mapInArrow(_full_sets(t), "doc_id long, s1 long, s2 long, items binary, bins binary")
    if repeated:  # rows alike give the same set
        sets = sets.dropDuplicates(["doc_id", "s1", "s2"])
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    tasks = sets.withColumnRenamed("doc_id", "rep").join(small(dealt), ["rep", "s1", "s2"]).select("unit", "kind", "part", "node", "items", "bins", F.explode(pairs).alias("at"))
    tasks = tasks.select("unit", "kind", "at.i", "at.j", "part", "node", "items", "bins")
    links = cut(tasks.groupBy("unit", "kind", "i", "j").applyInPandas(_links(bands, rows, floor, percent), "a long, b long"))
    edges = links
    if by_id and repeated:
        own = some.join(small(twice.filter("unlike").select("doc_id")), "doc_id", "left_semi").select("doc_id", "s1", "s2").distinct().join(nodes.select("s1", "s2", "node"), ["s1", "s2"])
        first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
        edges = links.unionByName(own.join(first, "doc_id").select("a", F.col("node").alias("b")))
    found = components(edges)
    least = found.join(nodes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    found = cut(found.join(small(cut(least)), "component"))
    named = nodes.select("s1", "s2", "rep", "node").join(small(found), "node", "left")
    discard(members, cluster, large, dealt, links, twice)
    return signed, named.select("s1", "s2", F.coalesce("component", "node").alias("class"), F.coalesce("component_id", "rep").alias("component_id")), [signed, nodes, found]


_OPTIONS = {"bands": BANDS, "rows": ROWS, "floor": FLOOR, "block": BLOCK, "wide": WIDE, "percent": 75}


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; see the module's text."""
    signed, named, _ = _classes(_texts(docs, id_col, text_col), by_id=True, **_OPTIONS | options)
    some = signed.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "s1", "s2")
    with_class = some.join(named, ["s1", "s2"]).select("doc_id", "n_shingles", "component_id")
    alone = signed.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_class.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(h1, h2, class) of the distinct texts with words of rows with an id; equal ids join nothing."""
    signed, named, copies = _classes(_texts(docs, id_col, text_col), by_id=False, **_OPTIONS | options)
    found = cut(signed.filter("n_shingles > 0 and doc_id is not null").join(named, ["s1", "s2"]).select("h1", "h2", "class").distinct())
    discard(*copies)
    return found


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of near-duplicate texts, the one of the smallest id (then of the smallest name of its text).

    Rows alike in id and text count once, rows without an id stay.  Decisions are carried by id and name of the
    text, so whole texts are not shuffled (but for rows alike, and where the decisions outgrow a broadcast).
    """
    names, plain = docs.columns, positional(docs)
    id_col, text_col = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    signed, named, copies = _classes(_texts(plain, id_col, text_col), by_id=False, **_OPTIONS | options)
    key = ["doc_id", "h1", "h2"]
    rows = signed.filter("n_shingles > 0 and doc_id is not null").select(*key, "s1", "s2").join(named, ["s1", "s2"]).select(*key, "class")
    rows = cut(rows.groupBy(*key, "class").agg(F.lit(1).alias("one")).drop("one"))
    alike = cut(signed.filter("doc_id is not null").groupBy(*key).count().filter("count > 1").select(*key))
    first = rows.groupBy("class").agg(F.min(F.struct(*key)).alias("f"), F.count("*").alias("n")).filter("n > 1")
    gone = cut(rows.join(first.drop("n"), "class").filter(F.struct(*key) != F.col("f")).select(*key))
    text = F.col(text_col)
    kept = plain.withColumns({"doc_id": F.col(id_col).cast("long"), "h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("second"), text)}).join(small(gone), key, "left_anti")
    if alike.limit(1).count():
        again = small(alike)
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates(key))
    discard(*copies, rows)
    return kept.select(*plain.columns).toDF(*names)


def oracle_sql(percent: int = 75) -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: w[i:i+4])) AS shingle FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= {percent} * (x.n + y.n - same)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS least FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.least, w.doc_id)) AS component_id, w.doc_id <= coalesce(m.least, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.a = w.doc_id"""
