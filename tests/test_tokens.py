import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chatloom.functions.basics import SPACE_CHARS, py_strip, scan_states, word_count, words
from chatloom.operators import templates as t
from chatloom.operators import tokens as k
from chatloom.operators.mixing import Source, number_rows, with_row_key
from chatloom.operators.packing import pack_best_fit, pack_wrap
from chatloom.plans.inspect import inspect_source
from workload.token_queries import byte_tokenizer

MSG = "array<struct<role:string,content:string>>"
TEXTS = ["", " ", "a", f" {SPACE_CHARS}a b{SPACE_CHARS}c ", "é ö", "​x", "a\x1cb", "tail ", "\n\nx", None]


def word_id(word):
    return int(hashlib.md5(word.encode()).hexdigest()[:7], 16)


def test_white_space_is_pythons(spark):
    assert sorted(SPACE_CHARS) == [chr(c) for c in range(0x110000) if chr(c).isspace()]
    df = spark.createDataFrame([(x,) for x in TEXTS], "t string").coalesce(1)
    rows = df.select(py_strip(F.col("t")).alias("s"), words(F.col("t")).alias("w"), word_count(F.col("t")).alias("n")).collect()
    for text, row in zip(TEXTS, rows, strict=True):
        if text is None:
            assert tuple(row) == (None, None, None)
        else:
            assert (row.s, row.w, row.n) == (text.strip(), text.split(), len(text.split()))


def test_scan_states(spark):
    df = spark.createDataFrame([([],), ([5],), (list(range(1000)),)], "xs array<int>").coalesce(1)
    got = [r.s for r in df.select(scan_states(F.col("xs"), F.lit(0), lambda a, x: a + x).alias("s")).collect()]
    sums = [0]
    for x in range(1000):
        sums.append(sums[-1] + x)
    assert got == [[0], [0, 5], sums]


def segments(spark, *rows):
    schema = "id int, segments array<struct<text:string,train:boolean,turn:int>>"
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], schema).coalesce(1)


def test_word_labels(spark):
    df = segments(spark, [("you say\n", False, 0), ("I do", True, 1), (" end ", False, 2)], [("", True, 0)], [])
    rows = k.tokenize(df).collect()
    ids = [word_id(w) for w in ("you", "say", "I", "do", "end")]
    assert rows[0].input_ids == ids
    assert rows[0].labels == [-100, -100, ids[2], ids[3], -100]
    assert rows[1].input_ids == rows[1].labels == rows[2].input_ids == []


def test_file_labels_follow_bytes(spark):
    parts = [("né ", False, 0), ("", True, 1), ("öö!", True, 1), ("", False, 2), ("x", False, 2)]
    row = k.tokenize(segments(spark, parts), byte_tokenizer()).first()
    trained = [train for text, train, _ in parts for _ in text.encode()]
    assert len(row.input_ids) == len(trained)
    assert [label != -100 for label in row.labels] == trained
    assert all(a == b for a, b, train in zip(row.input_ids, row.labels, trained) if train)


def test_token_across_an_edge_is_trained(spark):
    """A merged token that begins before the span and ends inside it counts."""
    from tokenizers import Tokenizer, models

    tokenizer = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "ab": 2, "c": 3}, merges=[("a", "b")]))
    df = segments(spark, [("ca", False, 0), ("b", True, 1), ("c", False, 2)])
    row = k.tokenize(df, k.FileTokenizer(tokenizer.to_str())).first()
    assert row.input_ids == [3, 2, 3] and row.labels == [-100, 2, -100]


def test_real_vocabulary(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    texts = ["Hello world, naïve café.", "", None, "x" * 5000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    tokenizer = k.FileTokenizer.from_file(path)
    got = {r.id: r.input_ids for r in k.tokenize_text(df, tokenizer).collect()}
    direct = Tokenizer.from_file(path)
    for i, x in enumerate(texts):
        assert got[i] == (None if x is None else direct.encode(x, add_special_tokens=False).ids)


def test_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3], [-100, 2, 3])], "input_ids array<int>, labels array<int>")
    assert tuple(k.truncate(df, 2).first()) == ([1, 2], [-100, 2])
    assert k.truncate(df.drop("labels"), 9).first().input_ids == [1, 2, 3]


def test_cut_while_encoding(spark):
    parts = [("a b ", False, 0), ("c d", True, 1)]
    for tokenizer in (k.WORDS, byte_tokenizer()):
        full = k.tokenize(segments(spark, parts), tokenizer).first()
        cut = k.tokenize(segments(spark, parts), tokenizer, max_length=3).first()
        assert (cut.input_ids, cut.labels) == (full.input_ids[:3], full.labels[:3])
        texts = spark.createDataFrame([("a b c d",)], "text string")
        assert len(k.tokenize_text(texts, tokenizer, max_length=3).first().input_ids) == 3


# -- packing --------------------------------------------------------------------------


def token_rows(spark, lengths, parts=3):
    rows, at = [], 0
    for i, n in enumerate(lengths):
        rows.append((i, at, list(range(at, at + n)), [-x for x in range(at, at + n)]))
        at += n
    return spark.createDataFrame(rows, "position bigint, start bigint, input_ids array<int>, labels array<int>").repartition(parts)


@pytest.mark.parametrize("lengths", [[3, 0, 5, 4, 25, 1, 0, 2], [10], [0], [9, 1, 10, 10], [100]])
def test_wrap(spark, lengths):
    packed = pack_wrap(token_rows(spark, lengths), 10).orderBy("bin").collect()
    stream = list(range(sum(lengths)))
    assert [r.bin for r in packed] == list(range(-(-len(stream) // 10)))
    for r in packed:
        assert r.input_ids == stream[r.bin * 10 : r.bin * 10 + 10]
        assert r.labels == [-x for x in r.input_ids]


def brute_force_bins(lengths, size):
    """Longest first, each into the fullest bin that still has room."""
    bins = []
    for row in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fitting = [b for b in bins if sum(lengths[i] for i in b) + lengths[row] <= size]
        if fitting:
            max(fitting, key=lambda b: sum(lengths[i] for i in b)).append(row)
        else:
            bins.append([row])
    return sorted(sorted(b) for b in bins)


def test_best_fit_splits_long_rows(spark):
    packed = pack_best_fit(token_rows(spark, [25, 3, 0, 10]), 10).collect()
    assert sorted(x for r in packed for x in r.input_ids) == list(range(38))
    assert sorted(sorted(r.row_lengths) for r in packed) == [[3, 5], [10], [10], [10]]
    with pytest.raises(ValueError, match="'split' or 'cut'"):
        pack_best_fit(token_rows(spark, [1]), 10, long_rows="drop")


def test_best_fit(spark):
    import random

    lengths = [random.Random(i).randint(0, 14) for i in range(70)] + [0, 12]
    packed = pack_best_fit(token_rows(spark, lengths), 10, long_rows="cut", group_tokens=150).collect()
    starts, group_of = {}, {}
    at = 0
    for i, n in enumerate(lengths):
        starts[at if n else None] = i
        group_of[i] = at // 150
        at += n
    for group in range(max(group_of.values()) + 1):
        cut = {i: min(n, 10) for i, n in enumerate(lengths) if group_of[i] == group and n}
        expected = brute_force_bins(list(cut.values()), 10)
        names = list(cut)
        found = []
        for r in (r for r in packed if r.group == group):
            assert len(r.input_ids) == sum(r.row_lengths) <= 10
            members, place = [], 0
            for n in r.row_lengths:
                row = starts[r.input_ids[place]]
                assert n == cut[row]
                members.append(names.index(row))
                place += n
            found.append(sorted(members))
        # The same rows, once each, in bins that are as full; ties may swap equal lengths.
        assert sorted(i for b in found for i in b) == list(range(len(cut)))
        sizes = [sorted(cut[names[i]] for i in b) for b in found]
        assert sorted(sizes) == sorted(sorted(cut[names[i]] for i in b) for b in expected)


def test_packing_does_not_depend_on_partitions(spark):
    df = spark.range(300).select("id", F.sequence(F.lit(0), (F.col("id") % 9).cast("int")).alias("input_ids"))
    results = []
    for parts in (1, 5):
        rows = number_rows(df.repartition(parts), 2, ["id"], size=F.size("input_ids"), partitions=parts)
        wrapped = sorted((r.bin, tuple(r.input_ids)) for r in pack_wrap(rows, 16).collect())
        fitted = sorted((r.group, r.bin, tuple(r.input_ids)) for r in pack_best_fit(rows, 16, group_tokens=400).collect())
        results.append((wrapped, fitted))
    assert results[0] == results[1]


# -- statistics -------------------------------------------------------------------------


def test_stats(spark):
    df = spark.createDataFrame([(2,), (4,), (9,)], "n int")
    got = k.token_stats(df, "n").first()
    assert tuple(got)[:5] == (3, 15, 5.0, 2, 9) and got.std_tokens == pytest.approx(13**0.5)
    assert k.token_stats(df.limit(1), "n").first().std_tokens is None
    assert k.token_stats(df.where("n > 100"), "n").first()[:2] == (0, None)


def test_length_sample(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"))
    assert tuple(k.length_sample(df, "n", ["id"], 100).first()) == (50, 0, 98, 49.0)


def test_budgets(spark):
    assert (k.steps_for_rows(65, 32), k.steps_for_rows(64, 32)) == (3, 2)
    assert (k.steps_for_tokens(8193, 2, 4096), k.steps_for_tokens(8192, 2, 4096)) == (2, 1)
    with pytest.raises(ValueError, match="packing"):
        k.steps_for_tokens(10, 1, 10, packing=False)
    with pytest.raises(ValueError, match="positive"):
        k.steps_for_rows(0, 32)
    df = spark.createDataFrame([(10,), (11,)], "n int")
    assert tuple(k.step_budget(df, "n", 2, 10).first()) == (2, 21, 1, 2)


def test_order_by_length(spark):
    df = spark.range(100).withColumn("n", F.col("id") % 50)
    rows = k.order_by_length(df, F.col("n"), 10, 1, ["id"]).collect()
    assert [r.length_bucket for r in rows] == sorted(r.n // 10 for r in rows)
    other = k.order_by_length(df, F.col("n"), 10, 2, ["id"]).collect()
    assert [r.id for r in rows] != [r.id for r in other] and sorted(r.id for r in rows) == list(range(100))


def test_number_by_length(spark):
    df = spark.range(200).select((F.col("id") % 150).alias("id"), (F.col("id") % 47).alias("n"), F.lit("x").alias("position"))
    df = df.union(spark.sql("SELECT 7L, CAST(NULL AS BIGINT), 'y'"))
    ordered = k.order_by_length(df, F.col("n"), 10, 1, ["id"]).collect()
    numbered = k.number_by_length(df.repartition(5), F.col("n"), 10, 1, ["id"])
    assert numbered.columns == ["id", "n", "length_bucket", "position"]
    numbered = sorted(numbered.collect(), key=lambda r: r.position)
    assert [r.position for r in numbered] == list(range(201)) and numbered[0].length_bucket is None
    assert [(r.length_bucket, r.id) for r in numbered] == [(r.length_bucket, r.id) for r in ordered]
    again = k.number_by_length(df.repartition(3), F.col("n"), 10, 1, ["id"]).collect()
    assert sorted(again, key=lambda r: r.position) == numbered  # rows of one key too
    assert k.number_by_length(df.where("n < 0"), F.col("n"), 10, 1, ["id"]).count() == 0


# -- previews ------------------------------------------------------------------------------


def test_previews(spark):
    df = spark.createDataFrame([(1, "x" * 600, ["a"]), (2, "y", None)], "id int, text string, tags array<string>")
    rows = k.preview_rows(df.orderBy("id"), 2).collect()
    assert rows[0].text == "x" * 500 + " …" and rows[0].tags == '["a"]' and rows[1].text == "y"
    ids = spark.createDataFrame([(1, list(range(50))), (2, [7])], "id int, input_ids array<int>")
    tokens = k.preview_tokens(ids, "id").orderBy("id", "pos").collect()
    assert len(tokens) == 41 and (tokens[0].n_tokens, tokens[40].token_id) == (50, 7)
    labeled = spark.createDataFrame([(1, [-100, 5, -100], "z" * 210)], "id int, labels array<int>, text string")
    got = k.preview_labels(labeled, "id", F.col("text")).first()
    assert tuple(got) == (1, 3, 2, "z" * 200 + " ... [truncated, 10 more chars]")
    assert tuple(k.dataset_facts(df).first()) == (2, "id, text, tags")


def test_inspection_stages(spark, tmp_path):
    rows = [(f"question {i}", f"answer {i}") for i in range(20)]
    spark.createDataFrame(rows, "prompt string, chosen string").coalesce(1).write.parquet(str(tmp_path / "train"))
    source = Source("a", str(tmp_path), transform="human_like_dpo")

    def stage(name, **options):
        return inspect_source(spark, source, name, options=t.RenderOptions(), **options)

    assert stage("raw", n=2).count() == 2
    assert re.search(r'"role":"assistant"', stage("transformed", n=1).first().messages)
    assert stage("formatted", n=1).first().text.startswith("<|im_start|>user\nquestion ")
    assert stage("tokens", n=1).count() == 6
    assert tuple(stage("facts").first()) == (20, "prompt, chosen")
    assert stage("lengths", sample_rows=10).first().sampled_rows == 10
    assert stage("lengths", tokenizer=byte_tokenizer()).first().sampled_rows == 20
    with pytest.raises(ValueError, match="Unknown stage"):
        stage("nope")


def test_inspection_shows_what_cannot_be_rendered(spark):
    chats = "array<struct<role:string,content:string>>"
    rows = [(1, [("user", "a")]), (2, [("user", None)]), (3, None), (4, [("user", "b")])]
    df = spark.createDataFrame(rows, f"id int, messages {chats}")
    source = Source("a", "unused", key=("id",))
    shown = inspect_source(spark, source, "formatted", template="tulu3", options=t.RenderOptions(), read=lambda s, x: with_row_key(df, ["id"]))
    assert [r.text for r in shown.orderBy("_row_key").collect()] == [
        "<|user|>\na\n", "<ERROR: template 'tulu3' cannot render this chat>", "<no chat in this row>"
    ]
