"""SentencePiece files: ids and texts equal to the library's."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.llm.piece_bpe import PieceBpe, decode_pieces, encode_pieces
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def model():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=model)


@pytest.fixture(scope="module")
def own(model):
    with open(model, "rb") as file:
        return PieceBpe(file.read())


def same(own, library, text):
    ids = np.frombuffer(own.encode(text), np.int32).tolist()
    assert ids == library.encode(text), text[:100]
    assert own.decode_all(pa.array([ids], pa.list_(pa.int32()))) == [library.decode(ids)]


ODD = ["", " ", "   ", " a  b \n c\t", "\x00\x01\x02x", "é漢字 ﬁ ｆｕｌｌ", "<s> </s> <unk> <0x41>", "▁", "▁▁ a▁", "� x", "🙂 🙂🙂"]
LONG = ["a" * 20001, " " * 1_100_000, "\n" * 20000, "xyzabc" * 5000, "é" * 3000, "".join(map(chr, range(32, 0x3000, 7)))]


@pytest.mark.parametrize("text", ODD + LONG)
def test_odd_texts(own, library, text):
    same(own, library, text)


def test_random_pieces_and_letters(own, library):
    rng = random.Random(7)
    n = library.get_piece_size()
    for _ in range(4000):
        same(own, library, "".join(library.id_to_piece(rng.randrange(3, n)) for _ in range(rng.randrange(1, 8))))
        same(own, library, "".join(rng.choice("abcdetionsr  ▁") for _ in range(rng.randrange(1, 40))))


def test_any_ids_decode_as_the_library_does(own, library):
    rng = random.Random(8)
    n = library.get_piece_size()
    lists = [[rng.choice([rng.randrange(0, 300), rng.randrange(0, n)]) for _ in range(rng.randrange(0, 8))] for _ in range(4000)]
    assert own.decode_all(pa.array(lists, pa.list_(pa.int32()))) == [library.decode(ids) for ids in lists]


def test_columns(spark, odd_docs, no_docs, model, library):
    coded = odd_docs.select("text", encode_pieces(spark, "text", model).alias("ids"))
    rows = coded.select("*", decode_pieces(spark, "ids", model).alias("back")).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        assert row.ids == library.encode(row.text or "") and row.back == library.decode(row.ids)
    assert no_docs.select(encode_pieces(spark, "text", model)).collect() == []
    nothing = spark.range(1).select(decode_pieces(spark, F.lit(None).cast("array<int>"), model).alias("t")).first()
    assert nothing.t == ""
