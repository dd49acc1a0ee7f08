"""The permutation and the shards, by recount."""

import random

import numpy as np
import pytest

from chatloom.functions.folders import new_path
from chatloom.llm.training_order import materialise, read_in_training_order, slots_of
from tests.llm.conftest import odd_rows


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 65537])
def test_permutation(size):
    one, other = (slots_of(np.arange(size), size, key) for key in (1, 2))
    assert sorted(one.tolist()) == sorted(other.tolist()) == list(range(size))
    assert size < 16 or (one != other).any()
    assert (slots_of(np.arange(size)[::-1], size, 1) == one[::-1]).all()


def test_permutation_mixes():
    slots = slots_of(np.arange(20000), 20000, 9)
    assert abs(np.corrcoef(slots, np.arange(20000))[0, 1]) < 0.05
    assert np.mean(np.abs(np.diff(slots))) == pytest.approx(20000 / 3, rel=0.05)


def expected_pieces(texts, vocabulary, size):
    coder = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    out = []
    for number, text in texts:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids, "<u2")
        out += [(number, start, ids[start : start + size].tobytes()) for start in range(0, len(ids), size)]
    return out


@pytest.mark.parametrize("shard_records", [7, 65536])
def test_shards(spark, sf_dir, vocabulary, shard_records):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    shards = materialise(docs.repartition(3), vocabulary, new_path(spark, "shards"), 5, 32, shard_records=shard_records)
    rows = read_in_training_order(shards, 32).collect()
    pieces = expected_pieces(texts, vocabulary, 32)
    assert sorted((r["id"], r["start"], bytes(r["tokens"])) for r in rows) == sorted(pieces)
    assert sorted(r["slot"] for r in rows) == list(range(len(pieces)))
    listed = shards.orderBy("shard").collect()
    assert [r["shard"] for r in listed] == list(range(-(-len(pieces) // shard_records)))
    place = random.Random(1).randrange(len(pieces))
    later = read_in_training_order(shards, 32, from_slot=place).collect()
    key = lambda r: r["slot"]
    assert sorted(later, key=key) == sorted(rows, key=key)[place:]


def test_odd_rows(spark, odd_docs, no_docs, vocabulary):
    none = materialise(no_docs, vocabulary, new_path(spark, "shards"), 1)
    assert none.count() == 0 and read_in_training_order(none).count() == 0
    rows = read_in_training_order(materialise(odd_docs, vocabulary, new_path(spark, "shards"), 1)).collect()
    pieces = expected_pieces([r[:2] for r in odd_rows()], vocabulary, 256)
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    assert sorted(((r["id"], r["start"], bytes(r["tokens"])) for r in rows), key=order) == sorted(pieces, key=order)


def test_shards_are_shuffled_in_parts(spark, sf_dir, vocabulary, monkeypatch):
    from chatloom.llm import training_order

    parts = []

    def stored(df, name, *args, **options):
        out = plain(df, name, *args, **options)
        if name == "shards":
            parts.append(sorted(r["shard"] for r in out.collect()))
        return out

    plain = training_order.stored
    monkeypatch.setattr(training_order, "stored", stored)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    shards = materialise(docs, vocabulary, new_path(spark, "shards"), 3, 32, shard_records=50)
    number = shards.count()
    assert len(parts) == 2 and sorted(sum(parts, [])) == list(range(number))
    assert max(map(len, parts)) <= -(-number // 2)
