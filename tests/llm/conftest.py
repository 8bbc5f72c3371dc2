import zlib

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, one very long text, ties and repeated rows.
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t \n", "en", None, 5),
    (None, "no id here at all", None, None, None),
    (4, "the same words in this text", "en", "a", 27),
    (4, "the same words in this text", "en", "a", 27),
    (5, "the same words in this text", "en", "b", 27),
    (6, "12345 67890 !!! ???", None, "b", 19),
    (7, "word " * 200_000, "en", "c", 1_000_000),
    (8, "x", "de", "c", 1),
    (9, "ÄÖÜ ß é 漢字 \U0001f600 end", "de", "é", 20),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def crc():
    return lambda doc_id, n: zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n
