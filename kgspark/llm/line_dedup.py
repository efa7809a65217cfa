"""Cross-site boilerplate: lines that occur on many distinct sites.

A line is what lies between line feeds, without the blanks at its ends; lines under
``min_chars`` characters are never boilerplate.  A line's name is two 64-bit hashes.

1. Lines that occur in fewer than ``min_sites`` rows can't be on as many sites.
   One aggregation with map-side combine finds the others.
2. For these, HyperLogLog sketches of the sites, one for each line, are built on the map
   side and merged by the aggregation.
3. Estimates over ``1 + margin`` times the threshold are boilerplate, those under
   ``1 - margin`` times it are not, and the lines between get exact distinct counts.  The
   margin is over ten standard errors of the sketch.
4. Rows lose their boilerplate lines.  The line names are broadcast, as two sorted arrays of 64-bit
   numbers, while there are at most ``max_broadcast`` of them (16 bytes each); beyond that they meet
   the rows' lines in a join.

The lines of step 1 are written once with their sites, so the texts are cut into lines three times in all.

``many_texts_only`` asks more of a boilerplate line: it must also occur in ``min_sites``
classes of near-equal texts (as in near_dup, among the texts that carry such a line), so
that a text copied to many sites keeps its lines and is left to a later near-dedup.  Where
texts of one class differ in lines of their own, the lines they share stay too.

Defined results: text null stays null with lines_total 0 and lines_removed 0; an
empty text has one empty line, which stays.  Site null counts as no site.  Rows that
repeat an id, and null ids, are treated one by one.  A text may lose all its lines
and is then empty.  An empty table gives an empty table.  Further columns are kept as they
are, whatever their names, but for input columns named lines_total or lines_removed, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import cut, discard, positional, small, sole_cache
from .near_dup import text_classes

MIN_SITES, MIN_CHARS, LG_K, MARGIN, MAX_BROADCAST, ROWS = 5, 20, 12, 0.2, 500_000, 500
BLANK = " \t\n\x0b\x0c\r"
#: Spark's xxhash64 starts from this seed, and goes on from one column's hash to the next.
_SEED1 = 42
_SEED2 = xxhash.xxh64_intdigest(b"second", _SEED1)


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, site, and the other columns but text) of the distinct long lines of each of ``rows`` (site, text, ...)."""
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), _bare), lambda s: F.length(s) >= min_chars))
    rest = [c for c in rows.columns if c != "text"]
    each = rows.select(*rest, F.explode(lines).alias("line"))
    return each.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), *rest)


def _often(rows: DataFrame, min_sites: int, min_chars: int) -> DataFrame:
    """Those of ``_lines`` whose line occurs in at least ``min_sites`` rows, written once."""
    lines = _lines(rows, min_chars).filter("site is not null")
    often = cut(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites).select("h1", "h2"))
    found = cut(lines.join(small(often), ["h1", "h2"]))
    discard(often)
    return found


def _on_many(lines: DataFrame, place: str, least: int, lg_k: int, margin: float) -> DataFrame:
    """(h1, h2) of the lines with at least ``least`` distinct values of ``place``: by sketches, and exactly near the threshold."""
    sketches = cut(lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg(place, lg_k)).alias("n")))
    sure = sketches.filter(F.col("n") > least * (1 + margin)).select("h1", "h2")
    near = sketches.filter((F.col("n") <= least * (1 + margin)) & (F.col("n") >= least * (1 - margin))).select("h1", "h2")
    each = lines.join(small(near), ["h1", "h2"], "left_semi").select("h1", "h2", place).distinct()
    exact = each.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    found = cut(sure.unionByName(exact.select("h1", "h2")))
    discard(sketches)
    return found


def _rows(docs: DataFrame, site: str, text: str) -> DataFrame:
    plain, names = positional(docs), docs.columns
    return plain.select(F.col(f"c{names.index(site)}").cast("string").alias("site"), F.col(f"c{names.index(text)}").alias("text"))


def boilerplate_lines(docs: DataFrame, site: str = "source", text: str = "text", *, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, lg_k: int = LG_K, margin: float = MARGIN, many_texts_only: bool = False) -> DataFrame:
    """(h1, h2) of the lines on at least ``min_sites`` distinct sites (and in as many classes of near-equal texts)."""
    rows = _rows(docs, site, text)
    if many_texts_only:
        rows = rows.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), "text")})
    often = _often(rows, min_sites, min_chars)
    found = _on_many(often, "site", min_sites, lg_k, margin)
    if many_texts_only:
        carried = often.join(small(found), ["h1", "h2"], "left_semi").select("h1", "h2", "t1", "t2").distinct()
        carried = cut(carried)
        wanted = carried.select("t1", "t2").distinct()
        carry = rows.filter("site is not null").join(small(cut(wanted)), ["t1", "t2"], "left_semi")
        classes = text_classes(carry.select("t1", "text"), "t1").select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), "class")
        found = cut(_on_many(carried.join(small(classes), ["t1", "t2"]), "class", min_sites, lg_k, margin))
        discard(carried)
    discard(often)
    return found


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _named(gone: np.ndarray, h1: np.ndarray, h2_of) -> np.ndarray:
    """Which lines are among ``gone`` (rows of h1 and h2, sorted); the second hash is asked for only where the first is there."""
    out = np.zeros(len(h1), dtype=bool)
    lo, hi = np.searchsorted(gone[0], h1, "left"), np.searchsorted(gone[0], h1, "right")
    for k in np.flatnonzero(lo < hi):
        out[k] = h2_of(k) in gone[1][lo[k] : hi[k]]
    return out


def remove_lines(docs: DataFrame, lines: DataFrame, text: str = "text", *, min_chars: int = MIN_CHARS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with the named lines gone from ``text``, and the columns lines_total and lines_removed."""
    stay = [k for k, c in enumerate(docs.columns) if c not in ("lines_total", "lines_removed")]
    names = [docs.columns[k] for k in stay]
    docs = positional(positional(docs).select(*[f"c{k}" for k in stay]))
    place = names.index(text)
    if lines.limit(max_broadcast + 1).count() > max_broadcast:
        return _remove_by_join(docs, lines, f"c{place}", min_chars).toDF(*names, "lines_total", "lines_removed")
    table = lines.select("h1", "h2").toArrow()
    gone = np.stack([table["h1"].to_numpy(), table["h2"].to_numpy()])
    held = docs.sparkSession.sparkContext.broadcast(gone[:, np.lexsort(gone[::-1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("lines")
        gone = held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                every = [None if t is None else t.split("\n") for t in part.column(place).to_pylist()]
                at, bare = [], []
                for r, own in enumerate(every):
                    for k, line in enumerate(own or ()):
                        if len(line) >= min_chars and len(line := line.strip(BLANK)) >= min_chars:
                            at.append((r, k))
                            bare.append(line.encode())
                h1 = np.array([_signed(xxhash.xxh64_intdigest(x, _SEED1)) for x in bare], dtype=np.int64)
                drop: dict[int, set[int]] = {}
                for x in np.flatnonzero(_named(gone, h1, lambda k: _signed(xxhash.xxh64_intdigest(bare[k], _SEED2)))):  # noqa: B023
                    drop.setdefault(at[x][0], set()).add(at[x][1])
                texts = part.column(place)
                if drop:
                    kept = texts.to_pylist()
                    for r, own in drop.items():
                        kept[r] = "\n".join([x for k, x in enumerate(every[r]) if k not in own])
                    texts = pa.array(kept, pa.string())
                total = pa.array([len(x or ()) for x in every], pa.int64())
                removed = pa.array([len(drop.get(r, ())) for r in range(len(every))], pa.int64())
                yield pa.record_batch([*(texts if k == place else c for k, c in enumerate(part.columns)), total, removed], names=[*part.schema.names, "lines_total", "lines_removed"])

    schema = StructType([*docs.schema.fields, StructField("lines_total", LongType()), StructField("lines_removed", LongType())])
    return docs.mapInArrow(run, schema).toDF(*names, "lines_total", "lines_removed")


def _remove_by_join(docs: DataFrame, lines: DataFrame, text: str, min_chars: int) -> DataFrame:
    """The same for any number of lines; ``docs`` has positional names, which no name here clashes with."""
    names = docs.columns
    docs = cut(docs.withColumn("row", F.monotonically_increasing_id()))
    each = docs.select("row", F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line")).withColumn("line", _bare(F.col("line"))).filter(F.length("line") >= min_chars)
    each = each.select("row", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))
    gone = each.join(lines, ["h1", "h2"], "left_semi").groupBy("row").agg(F.collect_set("at").alias("gone"))
    every, none = F.split(F.col(text), "\n", -1), F.col("gone").isNull()
    some = F.when(none, 0).otherwise(F.size("gone")).cast("long")
    total = F.when(F.col(text).isNull(), 0).otherwise(F.size(every)).cast("long")
    clean = F.when(none, F.col(text)).otherwise(F.array_join(F.filter(every, lambda x, i: ~F.array_contains("gone", i)), "\n"))
    joined = docs.join(gone, "row", "left")
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in names], total.alias("lines_total"), some.alias("lines_removed"))


def dedup_lines(docs: DataFrame, site: str = "source", text: str = "text", *, many_texts_only: bool = False, **options) -> DataFrame:
    """``docs`` without the lines that are boilerplate within ``docs``, and the columns lines_total and lines_removed."""
    own = {k: v for k, v in options.items() if k in ("min_chars", "max_broadcast")}
    rule = {k: v for k, v in options.items() if k != "max_broadcast"}
    return remove_lines(docs, boilerplate_lines(docs, site, text, many_texts_only=many_texts_only, **rule), text, **own)


def oracle_sql(min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> str:
    return f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
b AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
bad AS (SELECT bare FROM b WHERE length(bare) >= {min_chars} GROUP BY bare HAVING count(DISTINCT source) >= {min_sites})
SELECT b.doc_id, coalesce(string_agg(b.line, chr(10) ORDER BY b.pos) FILTER (WHERE bad.bare IS NULL), '') AS text,
       count(*) AS lines_total, count(bad.bare) AS lines_removed
FROM b LEFT JOIN bad ON b.bare = bad.bare GROUP BY b.doc_id"""
