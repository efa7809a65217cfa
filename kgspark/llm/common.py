"""What the operators of this folder share: cutting lineage, row-safe column names, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_HELD: dict[str, Callable[[], None]] = {}


def sole_cache(name: str, drop: Callable[[], None] = lambda: None) -> None:
    """Called by a task before it fills the cache ``name``, which ``drop`` empties: the other operators' caches go.

    Python workers outlive their stage, and what one operator keeps is of no use to the next.
    """
    for other in [n for n in _HELD if n != name]:
        _HELD.pop(other)()
    _HELD[name] = drop


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session that names none (as in tests) gets a folder of our own; on a cluster that is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not conf and current.isDefined():
        return current.get()
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    if not current.isDefined():
        spark.sparkContext.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The copy outlives lost executors, is columnar and compressed, and later
    plans start from its real size.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy.cut_path = path
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete copies that ``cut`` made and that nothing will read again."""
    for c in copies:
        if getattr(c, "cut_path", None):
            spark = c.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(c.cut_path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: input names may hold dots, clash with each other or with an operator's own."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, so that the other side of a join needn't be dealt by a key that may be hot."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node on an edge; component is its smallest node.

    Contraction: each round every node joins its neighbour (or itself) of the
    smallest random rank, so that the edge table shrinks by a constant factor;
    the ranks change each round, hence long chains need few rounds as well.  Each
    round is one aggregation with map-side combine and two joins; nothing is
    collected but the count of edges left.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null and a <> b")
    both = cut(pairs.union(pairs.select("b", "a")).distinct())
    label = cut(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    seed = 0
    while both.limit(1).count():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(seed)).alias("r"), F.col(c).alias("v"))  # noqa: B023, E731
        to = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(rank("a"), "m")["v"].alias("to"))
        to = cut(to)
        old = label, both, to
        label = cut(label.join(small(to), label["label"] == to["a"], "left").select("node", F.coalesce("to", "label").alias("label")))
        other = to.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        both = cut(both.join(to, "a").join(other, "b").select(F.col("to").alias("a"), F.col("to_b").alias("b")).filter("a <> b").distinct())
        discard(*old)
    least = label.groupBy("label").agg(F.min("node").alias("component"))
    found = cut(label.join(small(cut(least)), "label").select("node", "component"))
    discard(label, both)
    return found
