"""The prefix coder against the tokenizers library, and packing by recount."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm.bpe import Bpe, LibraryBpe, decode, encode
from chatloom.llm.packing_mbs import fullest, minimum_slack_plan, pack_digests, pack_documents
from tests.llm.conftest import odd_rows

ALPHABET = "aab'sSTt  \t\n\r\x0b\x1c\x85\xa0  éñ漢字🙂é1٣½_-!?.,<|>endoftext​\x00"


@pytest.fixture(scope="module")
def library(vocabulary):
    coder = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    return lambda text: np.array(coder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("kind", [Bpe, LibraryBpe])
def test_ids_of_random_texts(vocabulary, library, kind):
    with open(vocabulary, "rb") as file:
        coder = kind(file.read())
    rng = random.Random(4)
    for i in range(4000):
        letters = rng.choice([ALPHABET, "abcdefghij", "ether ", "s", "aaab"])
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        if i % 7 == 0:
            text += "<|endoftext|>" + text
        assert coder.encode(text) == library(text)
        if kind is Bpe:
            assert coder.decode(coder.encode(text)) == text


def test_one_long_word(vocabulary, library):
    with open(vocabulary, "rb") as file:
        coder = Bpe(file.read())
    for text in ("a" * 5000, "abc" * 3000, " " * 3000 + "x"):
        assert coder.encode(text) == library(text)


def test_broken_bytes_decode_to_replacement(vocabulary):
    with open(vocabulary, "rb") as file:
        coder = Bpe(file.read())
    assert coder.decode(coder.encode("é")[:0]) == ""
    half = next(i for i, b in enumerate(coder._bytes) if b == b"\xc3")
    assert coder.decode(np.array([half], "<u4").tobytes()) == "�"


def test_encode_on_odd_rows(spark, odd_docs, no_docs, vocabulary, library):
    from pyspark.sql import functions as F

    def coded(df):
        ids = df.select("doc_id", F.col("text").alias("was"), encode(spark, "text", vocabulary).alias("ids"))
        return ids.withColumn("text", decode(spark, "ids", vocabulary))

    assert coded(no_docs).count() == 0
    for row in coded(odd_docs).collect():
        assert bytes(row["ids"]) == library(row["was"] or "") and row["text"] == (row["was"] or "")


def test_fullest_window():
    rng = random.Random(6)
    for _ in range(200):
        counts = {rng.randrange(1, 20): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 40)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = fullest(counts, room)
        assert all(n <= counts[length] for length, n in used.items())
        assert sum(length * n for length, n in used.items()) == max(s for s in sums if s <= room)


def test_plan_uses_all_pieces():
    counts = {1: 5, 7: 3, 300: 1000, 500: 77, 1023: 2, 1024: 9}
    left = dict(counts)
    for used, times in minimum_slack_plan(counts, 1024):
        assert sum(length * n for length, n in used.items()) <= 1024
        for length, n in used.items():
            left[length] -= n * times
    assert not any(left.values())


def check_packing(rows, texts, library):
    """*texts*: ``{doc_id: text}``; *rows* of one row for each piece."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        ids = library(texts[row["doc_id"]] or "") + b"\0\0\0\0"
        assert row["doc_tokens"] == len(ids) // 4 and 1 <= row["length"] <= 1024
        piece = ids[4 * row["start"] : 4 * (row["start"] + row["length"])]
        assert row["ids_crc32"] == zlib.crc32(piece)
        by_doc[row["doc_id"]].append((row["start"], row["length"]))
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    padding = tokens = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
        tokens += at
        padding += 1024 - at if at & (at - 1) else 0
    return by_doc, padding / max(1, tokens)


def test_packing(spark, sf_dir, vocabulary, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc, padding = check_packing(pack_digests(docs, vocabulary).collect(), texts, library)
    assert by_doc.keys() == texts.keys() and padding < 0.01
    for pieces in by_doc.values():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length


def test_packing_many_equal_lengths(spark, vocabulary, library):
    texts = {i: "word " * 600 for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, padding = check_packing(pack_digests(df, vocabulary).collect(), texts, library)
    assert padding < 0.02


def test_packing_odd_rows(spark, odd_docs, no_docs, vocabulary, library):
    assert pack_documents(no_docs, vocabulary).count() == 0
    texts = {r[0]: r[1] for r in odd_rows()}
    rows = pack_digests(odd_docs, vocabulary).collect()
    by_doc, _ = check_packing(rows, texts, library)
    assert by_doc.keys() == texts.keys() and sorted(by_doc[1]) == [(s, n) for s, n in sorted(by_doc[2]) for _ in range(2)]
    ids = {}
    for row in sorted(pack_documents(odd_docs, vocabulary).collect(), key=lambda r: r["start"]):
        if row["doc_id"] not in (1, None):
            ids[row["doc_id"]] = ids.get(row["doc_id"], b"") + bytes(row["ids"])
    assert all(packed == library(texts[i] or "") + b"\0\0\0\0" for i, packed in ids.items())


CONTROLS = "".join(map(chr, [*range(32), 0x7F, 0x85, 0xA0, 0x2028, 0xFEFF]))
HARD = [
    f"hello\x02 the cat {CONTROLS} sat",
    *(f"a {c} b{c}c" for c in CONTROLS),
    *(sign * 1_000_001 for sign in " \t\n\u2003"),
    "x" * 300_000,
    "-" * 150_000,
]


@pytest.mark.parametrize("kind", [Bpe, LibraryBpe])
def test_hard_texts_equal_the_library(kind, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    with open(vocabulary, "rb") as file:
        coder = kind(file.read())
    for text in HARD:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:40]


def test_hard_texts_are_packed_whole(spark, vocabulary):
    from chatloom.llm.packing_mbs import pack_digests

    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    packed = pack_digests(docs, vocabulary, capacity=1024).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    rows = packed.collect()
    assert len(rows) == len(HARD) and all(r.n == r["all"] for r in rows)
