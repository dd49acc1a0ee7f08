"""Small tables with everything that real ones hold."""

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no sample tables")
    return SF_DIR


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


WORDS = "the quick brown fox jumps over a lazy dog while nobody in this small town looks at its long red tail".split()


def odd_rows() -> list[tuple]:
    long_text = " ".join(WORDS[i * i % len(WORDS)] + str(i % 97) for i in range(20000))
    copy = " ".join(WORDS * 4)
    return [
        (1, copy, "en", "s", 1),
        (1, copy, "en", "s", 1),
        (2, copy, None, None, None),
        (3, None, "en", "s", 0),
        (4, "", "en", "s", 0),
        (5, " \t\n", "en", None, 3),
        (6, long_text, "en", "s", 5),
        (7, copy + " end", "en", "s", 2),
        (None, "no id but words", "en", "s", 2),
        (8, "12 34 !?", "en", "s", 2),
        (9, "é漢字 <|endoftext|> 🙂  \n\n x", "fr", "s", 2),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ["id", "fp", "label", "key", "start", "length", "ids", "doc", "text_hash", "fingerprint", "component", "kept", "found"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.withColumns({c: F.lit("other") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
