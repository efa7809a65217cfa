import random

import corpus_pipeline
from kgspark.llm import near_dup, quality
from kgspark.llm.common import cut

from .conftest import DATA
from .test_documents import _brute_lines, _brute_quality, _classes


def test_each_stage_against_brute_force(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "line dedup", "MinHash near-dedup", "best-fit packing"]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(cut(stage(spark, tables[-1], DATA)))
    raw, good, known, lines, unique, packed = tables
    assert all(t.columns == docs.columns for t in tables[:-1])
    judged = {r.doc_id: r.kept for r in quality.quality_rules(raw, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, k in judged.items() if k} and not any(_brute_quality(r.text)[5] for r in good.collect())
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in good.collect()}
    bad = _brute_lines(known.collect(), 5, 20)
    before = {r.doc_id: r.text for r in known.collect()}
    for r in lines.collect():
        assert r.text == "\n".join(x for x in before[r.doc_id].split("\n") if x.strip(" \t\n\x0b\x0c\r") not in bad) and r.n_chars == len(r.text)
    classes = _classes({r.doc_id: r.text for r in lines.collect()})
    assert {r.doc_id for r in unique.collect()} == {i for i, (_, c) in classes.items() if i == c}
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in unique.collect()}


def test_stages_on_odd_and_empty_tables(spark, docs, odd_docs):
    odd = odd_docs.select(*docs.columns)
    for table in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, DATA).collect()
    rows = corpus_pipeline.near_duplicates(spark, odd, DATA).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 3, 4, 5, 6, 8, 9, 10, 11, 12]


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "generations"]
    assert near_dup.BANDS * near_dup.ROWS == 160


def _prose(rng, lines=12):
    return [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(9)) for _ in range(lines)]


def test_copies_on_many_sites_leave_one_full_text(spark, docs):
    rng = random.Random(4)
    notice, exact, base = "this notice stands on every site", _prose(rng), _prose(rng)
    near = []
    for k in range(50):
        words = [line.split() for line in base]
        words[k % 12][k % 9] = f"edit{k}"
        near.append("\n".join(map(" ".join, words)))
    texts = ["\n".join(exact)] * 50 + near + ["\n".join([*_prose(rng), notice]) for _ in range(20)]
    table = spark.createDataFrame([(k, t, "en", f"s{k % 20}", len(t)) for k, t in enumerate(texts)], docs.schema)
    lines = corpus_pipeline.line_deduplication(spark, table, DATA)
    assert {r.doc_id: r.text for r in lines.collect()} == {k: t.removesuffix("\n" + notice) for k, t in enumerate(texts)}
    left = {r.doc_id: r.text for r in corpus_pipeline.near_duplicates(spark, cut(lines), DATA).collect()}
    assert left == {k: texts[k].removesuffix("\n" + notice) for k in [0, 50, *range(100, 120)]}


def test_texts_in_no_known_language_go(spark, docs):
    rng = random.Random(9)
    latin = "abcdefghijklmnopqrstuvwxyz"
    words = lambda letters, n=60, size=10: " ".join("".join(rng.choices(letters, k=rng.randint(2, size))) for _ in range(n))
    planted = [words(latin) for _ in range(20)] + [words(latin, 12) for _ in range(20)]
    planted += [words("абвгдежзийклмнопрстуфхцчшщыьэюя") for _ in range(5)] + [words([chr(0x4E00 + k) for k in range(900)]) for _ in range(5)]
    planted += [" ".join("".join(rng.choices("0123456789abcdef", k=32)) for _ in range(20)) for _ in range(5)]
    planted += [" ".join("".join(rng.choices(latin + latin.upper() + "0123456789+/", k=76)) for _ in range(10)) for _ in range(10)]
    planted += [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    ]
    extra = spark.createDataFrame([(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(planted)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(extra), DATA).collect()}
    assert not {i for i in kept if i >= 10**6}
    wordy = {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 10}
    assert len(wordy & kept) >= 0.995 * len(wordy)


def test_a_repeated_id_with_another_text_loses_nothing(spark, docs):
    rng = random.Random(6)
    a, b, c = (" ".join(_prose(rng)) for _ in range(3))
    rows = [(3, a), (7, a + " end"), (7, b), (9, b), (9, b), (7, c), (8, c + " end"), (5, ""), (5, "")]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    left = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, table, DATA).collect())
    assert left == sorted([(3, a), (7, b), (7, c), (5, "")])
