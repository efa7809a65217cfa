import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import lang_id, line_dedup, near_dup, quality, sketch
from kgspark.llm.common import components
from kgspark.llm.queries import QUERIES, oracle_sql

from .conftest import DATA

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    w = WORDS.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _classes(texts):
    sets = {i: _set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n) and top(a) != top(b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_op2_query_is_brute_force_and_its_sql(spark, docs, duck):
    rows = QUERIES["op2_near_duplicates"](spark, DATA).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert sorted(map(tuple, rows)) == sorted(duck.sql(f"select doc_id, n_shingles, component_id, kept from ({oracle_sql()['op2_near_duplicates']})").fetchall())
    assert got == _classes({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("wide,block", [(20_000, 3), (1, 3)])
def test_op2_chains_in_small_blocks_and_by_key(spark, wide, block):
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([f"x{j}" for j in range(k)] + base[k:])) for k in range(30)] + [(100 + k, " ".join(base)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, block=block, wide=wide).collect()}
    assert got == _classes(dict(rows))


def test_op2_odd_rows(odd_docs, no_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert len(rows) == odd_docs.count()
    assert by[1] == {(8, 1, True)} and by[2] == {(8, 1, False)} and by[3] == {(0, 3, True)} and by[4] == {(0, 4, True)} and by[5] == {(0, 5, True)}
    assert {x[1:] for x in by[None]} == {(None, True)} and by[7] == {(19_997, 6, False)} and by[10] == {(1, 10, True)}
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_op2_repeated_ids_join_their_texts(spark):
    rng = np.random.default_rng(5)
    a, b, c = (" ".join(f"{k}{x}" for x in rng.integers(0, 10**6, 40)) for k in "abc")
    rows = [(3, a), (5, a), (5, b), (9, b), (9, b), (4, c), (8, c + " end"), (7, c), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect())
    assert got == [(3, 3, True), (4, 4, True), (5, 3, False), (5, 3, False), (7, 4, False), (7, 7, True), (8, 4, False), (9, 3, False), (9, 3, False)]


@pytest.mark.parametrize("wide", [20_000, 1])
def test_op2_compares_the_same_pairs_in_clusters_of_any_size(spark, wide):
    base = [f"w{i}" for i in range(300)]
    rng = np.random.default_rng(3)
    rows = []
    for k in range(120):  # each a few edits away from the text before: similar neighbours, unlike ends
        base[int(rng.integers(0, 300))] = f"e{k}"
        base[int(rng.integers(0, 300))] = f"f{k}"
        rows.append((k, " ".join(base)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=4, block=7, wide=wide).collect()}
    other = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=4, block=400, wide=20_000).collect()}
    assert got == other


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 160, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        s = sketch.sketch(a, 160)
        assert len(s) == 160 and s.max() < np.iinfo(np.uint64).max and (s == sketch.sketch(a[::-1].copy(), 160)).all()
    err = []
    for _ in range(40):
        u = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
        err.append((sketch.sketch(u[:350], 160) == sketch.sketch(u[50:], 160)).mean() - 300 / 400)
    assert abs(np.mean(err)) < 0.02 and np.abs(err).max() < 0.17


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def _brute_lines(rows, min_sites, min_chars):
    sites = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if r.source is not None:
                sites[line.strip(line_dedup.BLANK)].add(r.source)
    bad = {k for k, v in sites.items() if len(k) >= min_chars and len(v) >= min_sites}
    return bad


def test_op4_query_is_its_sql(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["op4_line_dedup"](spark, DATA).select("doc_id", "text", "lines_total", "lines_removed").collect())
    assert got == sorted(duck.sql(f"select doc_id, text, lines_total, lines_removed from ({oracle_sql()['op4_line_dedup']})").fetchall())


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_op4_both_ways_and_odd_rows(spark, odd_docs, no_docs, max_broadcast):
    rows = [(k, f"shared line of some length {k % 3}\nown {k}\n  shared by four sites only  ", f"s{k % (4 + k % 2)}") for k in range(40)]
    x = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bad = _brute_lines(x.collect(), 5, 20)
    got = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(x, max_broadcast=max_broadcast).collect()}
    for k, t, _ in rows:
        kept = [s for s in t.split("\n") if s.strip() not in bad]
        assert got[k] == ("\n".join(kept), 3 - len(kept))
    odd = line_dedup.dedup_lines(odd_docs, min_sites=1, max_broadcast=max_broadcast)
    assert odd.count() == odd_docs.count() and set(odd.columns) == {*odd_docs.columns, "lines_removed"}
    by = {r.doc_id: r for r in odd.filter("doc_id in (3, 4, 11)").collect()}
    assert (by[3].text, by[3].lines_total, by[4].text, by[4].lines_total, by[11].text, by[11].lines_removed) == (None, 0, "", 1, "", 3)
    assert line_dedup.dedup_lines(no_docs, max_broadcast=max_broadcast).count() == 0


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_op4_takes_any_column_names(spark, max_broadcast):
    rows = [(k, f"shared line of some length\nown {k}", f"s{k % 6}", 1, 2, 3, 4, 5) for k in range(12)]
    x = spark.createDataFrame(rows, "doc_id long, text string, source string, _gone int, `a.b` int, row int, site int, h1 int")
    got = line_dedup.dedup_lines(x, max_broadcast=max_broadcast)
    assert got.columns == [*x.columns, "lines_total", "lines_removed"]
    assert sorted(tuple(r) for r in got.collect()) == [(k, f"own {k}", f"s{k % 6}", 1, 2, 3, 4, 5, 2, 1) for k in range(12)]


def test_op6_learns_and_never_reads_labels(spark, docs):
    got = QUERIES["op6_language_id"](spark, DATA).collect()
    truth = {r.doc_id: r for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    blind = docs.withColumn("lang", F.when(lang_id.held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: r.lang_pred for r in lang_id.identify(blind).collect()} == {r.doc_id: r.lang_pred for r in got}


def test_op6_odd_rows(odd_docs, no_docs, docs):
    model = lang_id.fit(*lang_id.training_rows(docs.select("doc_id", "text", "lang")))
    by = defaultdict(set)
    for r in lang_id.predict(odd_docs, model).collect():
        by[r.doc_id].add((r.lang_pred, r.score))
    assert by[3] == by[4] == by[5] == by[9] == {("und", 0.0)} and all(p != "und" for p, _ in by[10])
    assert {r.lang_pred for r in lang_id.predict(odd_docs, None).collect()} == {"und"} and lang_id.identify(no_docs).count() == 0
    assert lang_id.identify(odd_docs).count() == odd_docs.count()


def test_op6_signs_that_are_no_letters_and_odd_names(spark, docs):
    model = lang_id.fit(*lang_id.training_rows(docs.select("doc_id", "text", "lang")))
    rows = [(1, "² ½ ① Ⅷ 12", 0), (2, "the ª", 0), (3, "١٢", 0)]
    got = lang_id.predict(spark.createDataFrame(rows, "`a.b` int, text string, c0 int"), model)
    assert got.columns == ["a.b", "text", "c0", "lang_pred", "score"]
    assert [r.lang_pred == "und" for r in sorted(got.collect())] == [True, False, True]


def test_op6_sample_is_bounded(spark):
    rows = [(7, f"hot text {k % 9}", "xx") for k in range(900)] + [(k, "word " * 50, f"l{k % 40}") for k in range(400)] + [(1000, "w " * 5000, "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, langs = lang_id.training_rows(df, per_lang=5)
    assert max(Counter(langs).values()) == 5 and set(langs) == {"xx", "long"} | {f"l{k}" for k in range(40)}
    texts, langs = lang_id.training_rows(df, per_lang=5, max_rows=42)
    assert len(langs) == 42 and len(set(langs)) == 42  # the first of every language comes before the second of any
    texts, langs = lang_id.training_rows(df, per_lang=5, max_bytes=42 * 600)
    assert Counter(langs)["l0"] == 2 and Counter(langs)["long"] == 1
    assert lang_id.training_rows(df.limit(0)) == ([], [])


def test_op6_scores_are_the_kernel_method(docs):
    """Kernel, Nyström map and ridge once more, from sets and dense matrices."""
    rows = [r for r in docs.orderBy("doc_id").limit(60).collect() if r.text and lang_id.has_letter(r.text)]
    texts, langs = [r.text[:600] for r in rows[:40]], [r.lang for r in rows[:40]]
    m = lang_id.fit(texts, langs, landmarks_per_lang=4)
    fold = lambda t: [int(m.fold[ord(c)]) for c in t.lower()]
    grams = lambda c: {tuple(c[i : i + n]) for n in (2, 3) for i in range(len(c) - n + 1)}
    names, marks = sorted(set(langs)), []
    for n in names:
        marks += [i for i, x in enumerate(langs) if x == n][:4]
    held = [grams(fold(texts[i])) for i in marks]
    every = set().union(*held)

    def kernel(t):
        own = grams(fold(t)) & every
        return np.array([len(own & h) / np.sqrt(max(1, len(own)) * max(1, len(h))) for h in held])

    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in held] for a in held])
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-6 * values[-1]
    phi = lambda t: np.r_[kernel(t) @ (vectors[:, keep] / np.sqrt(values[keep])), 1]
    x, y = np.array([phi(t) for t in texts]), np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0)
    w = np.diag([1 / langs.count(n) for n in langs])
    beta = np.linalg.solve(x.T @ w @ x + lang_id.RIDGE * np.eye(x.shape[1]), x.T @ w @ y)
    fresh = [r.text[:600] for r in rows[40:]]
    assert np.abs(m.scores(fresh) - np.array([phi(t) for t in fresh]) @ beta).max() < 2e-2


def _brute_quality(t):
    w = WORDS.findall(t or "")
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    again = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed


def test_op10_base_rules_are_brute_force(odd_docs, docs, no_docs):
    for table in (docs, odd_docs):
        got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_columns(table, [0] * 16).collect())
        assert got == sorted(((r.doc_id if r.doc_id is not None else -1), *_brute_quality(r.text)) for r in table.collect())
    assert quality.quality_columns(no_docs, [0] * 16).count() == 0


def test_op10_scores_are_the_ratio(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    weights = quality.fit_weights(docs, quality.trusted_ids(labels), 500)
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    rows = docs.collect()
    bucket = {}
    every = sorted({x for r in rows for w in [WORDS.findall(r.text.lower())] for x in [(a,) for a in w] + list(zip(w, w[1:]))})
    table = spark.createDataFrame([(x[0], x[1] if len(x) > 1 else None) for x in every], "a string, b string")
    for r in table.select("a", "b", F.when(F.col("b").isNull(), F.pmod(F.xxhash64("a"), F.lit(500))).otherwise(F.pmod(F.xxhash64(F.xxhash64("a"), F.xxhash64("b")), F.lit(500))).alias("k")).collect():
        bucket[(r.a,) if r.b is None else (r.a, r.b)] = r.k
    feats = {r.doc_id: [bucket[x] for w in [WORDS.findall(r.text.lower())] for x in [(a,) for a in w] + list(zip(w, w[1:]))] for r in rows}
    raw, fine = np.ones(500), np.ones(500)
    for i, f in feats.items():
        np.add.at(raw, f, 1)
        if i in good:
            np.add.at(fine, f, 1)
    want = np.round(1e6 * (np.log(fine / fine.sum()) - np.log(raw / raw.sum())))
    assert np.abs(want - np.array(weights)).max() <= 1
    for r in quality.quality_columns(docs, weights).collect():
        f = feats[r.doc_id]
        total = sum(weights[k] for k in f)
        assert r.kept == (not r.base_failed and total >= round(quality.THRESHOLD * 1e6) * len(f)) and abs(r.score - (total / len(f) / 1e6 if f else 0)) < 1e-9


def test_op10_without_trusted_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.base_failed, r.kept) for r in quality.quality_rules(odd_docs, none).collect()} == {(True, False), (False, True)}
