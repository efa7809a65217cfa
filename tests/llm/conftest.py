import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, ids array<int>, row string, score string, lang_pred string, lines_total string, keys string, part string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows, a repeated id, clashing extra columns."""
    long = " ".join(f"w{i}" for i in range(20_000))
    same = "one two three four five six seven eight nine ten eleven twelve"
    texts = [
        (1, same), (2, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (None, same), (None, None), (6, long), (7, long + " end"),
        (8, "é̀ 日本 😀 ▁▁ \0 <|endoftext|> <s>"), (9, "!!! 123 ???"), (10, "two words"), (11, "line one is long enough here\n" * 3), (12, "a  b   c" + " " * 40),
    ]
    rows = [(i, t, "en" if (i or 0) % 2 else None, None if i == 5 else "s", None, [1], "x", "x", "x", "x", "x", "x") for i, t in texts]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c
