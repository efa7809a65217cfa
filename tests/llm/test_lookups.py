import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import knn_join, url_filter
from kgspark.llm.queries import QUERIES, URL_RULES, oracle_sql

from .conftest import DATA


@pytest.mark.parametrize("name", ["op8_url_filters", "op9_exact_top_k"])
def test_queries_are_their_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(f"select {', '.join(got.columns)} from ({oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def _judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for c in "?#":
            rest = rest.split(c, 1)[0]
        host, slash, path = rest.partition("/")
        host, path = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), slash + path
    fit = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"


def test_op8_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "x://", "http://COM/en/1", "http://a.b.example.com/en/7x?q=/en/", "http://example.com/en", "http://example.net/de/81", "http://xexample.net/de/8", "http://e.org/es/#/es/", "a://b://c.com/en/", "http://com?/en/", "http://.com/en/x", "http://com./en/x", "http://É.com/en/Ü", "http://example.com/en/7\n/x", "http://example.com/" + "y" * 50_000, "http://" + "a." * 5000 + "com/en/"]
    rows = [(k, u, "h", "v") for k, u in enumerate(urls)] + [(None, "http://q.com/en/1", "h", "v"), (5, "http://COM/en/1", "h", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = sorted(((r.page_id if r.page_id is not None else -1), r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.rules_table(spark, URL_RULES)).collect())
    assert got == sorted(((k if k is not None else -1), *_judge(u)) for k, u, *_ in rows)
    assert url_filter.filter_urls(pages.limit(0), url_filter.rules_table(spark, URL_RULES)).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, url_filter.rules_table(spark, URL_RULES).limit(0)).collect()} == {"allow"}


def _brute(rows, k):
    """Rows count one by one; of each query only its own row takes no part."""
    fit = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(fit):
        if q % 2 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for k2, (i, b) in enumerate(fit) if k2 != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("query_bytes,chunk_bytes", [(knn_join.QUERY_BYTES, knn_join.CHUNK_BYTES), (500, 300)])
def test_op9_odd_vectors(spark, query_bytes, chunk_bytes):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * (1 + (i % 3) * 5)]) for i in range(60)]
    rows += [(100 + i, [1.0] * 6) for i in range(30)] + [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf"), 1.0]), (204, []), (205, [2.0]), (None, [1.0] * 6)]
    rows += [(4, rows[4][1]), (4, rows[4][1]), (4, [0.5] * 6), (3, rows[3][1]), (206, [1e30, -1e20])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    small = [r for r in rows if r[0] != 206]
    own = {"query_bytes": query_bytes, "chunk_bytes": chunk_bytes}
    got = knn_join.top_k(df.filter("vec_id is null or vec_id <> 206"), F.col("vec_id") % 2 == 0, 4, pivots=5, **own)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == _brute(small, 4)
    assert knn_join.top_k(df, F.col("vec_id") % 2 == 0, 4, **own).filter("query_id = 206 and rank = 1").first().score > 0
    assert knn_join.top_k(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert knn_join.top_k(df, F.lit(False)).count() == 0


def test_op9_repeated_ids_are_its_sql(spark, duck, tmp_path):
    duck.sql(f"create or replace temp table twice as select * from '{DATA}/embeddings.parquet' union all select vec_id // 3, embedding, label from '{DATA}/embeddings.parquet' where vec_id % 4 = 0")
    duck.sql(f"copy twice to '{tmp_path}/twice.parquet'")
    table = spark.read.parquet(f"file://{tmp_path}/twice.parquet")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in knn_join.top_k(table, F.col("vec_id") % 20 == 0).collect())
    assert got == sorted(duck.sql("select query_id, rank, vec_id, score from (" + knn_join.oracle_sql().replace("FROM embeddings", "FROM twice") + ")").fetchall())


def test_op9_bounds_hold_and_prune_clustered_data(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(12, 16)) * 4
    of = rng.integers(0, 12, 1500)
    x = (centre[of] + rng.normal(size=(1500, 16)) * 0.2).astype("float32")
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    join = knn_join.VoronoiJoin(df, F.col("vec_id") % 2 == 0, 10, 64, "vec_id", "embedding", 24, 70 * 129, 1 << 20)
    copies = join.copies().select(F.size("groups").alias("n")).agg(F.sum("n")).first()[0]
    assert len(join.groups) > 5 and copies < 0.5 * len(rows) * len(join.groups)  # over half of all (vector, group) pairs are pruned
    whole = np.floor(64 * x.astype(float))
    low, high = join.bounds.of(whole)
    for j, cell in enumerate(join.cells):
        own = whole[[r.vec_id for r in join.placed.filter(f"query and cell = {cell}").select("vec_id").collect()]]
        s = own @ whole.T
        assert (s >= low[:, j] - 1e-6).all() and (s <= high[:, j] + 1e-6).all()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in join.result().collect())
    assert got == _brute(rows, 10)
