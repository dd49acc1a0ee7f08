"""Suffix-array removal and SimHash groups against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from chatloom.llm.common import connected_components
from chatloom.llm.simhash_bk import BkTree, near_duplicate_components, simhash_components
from chatloom.llm.suffix_dedup import _common, maximal_extents, prefix_intervals, remove_repeats


def cut_by_hand(texts, size):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in datas for i in range(len(d) - size + 1))
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = True
        gone = gone[: len(d)]
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def mixed_texts(rng, alphabet, size):
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(size // 2, 3 * size))) for _ in range(8)]
    texts = []
    for _ in range(80):
        text = ""
        for _ in range(rng.randrange(5)):
            p = rng.choice(shared)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            text += rng.choice([p, p[a:b], "".join(rng.choice("xyzwé123") for _ in range(rng.randrange(1, 40)))])
        texts.append(text)
    return [*texts, None, "", "a" * 5 * size, "ab" * 3 * size, texts[3], texts[3], "x" * size]


@pytest.mark.parametrize("group_rows", [256, 2])
@pytest.mark.parametrize("size,alphabet", [(16, "ab"), (40, "abcdé ")])
def test_repeats(spark, size, alphabet, group_rows):
    texts = mixed_texts(random.Random(size), alphabet, size)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = remove_repeats(df, min_bytes=size, group_rows=group_rows).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    assert [got[i] for i in range(len(texts))] == cut_by_hand(texts, size)


def test_anchors_of_long_texts_do_not_depend_on_their_place():
    from chatloom.llm import suffix_dedup

    finder = suffix_dedup._Anchors(40)
    rng = random.Random(2)
    body = bytes(rng.randrange(97, 101) for _ in range(suffix_dedup._SPAN + 5000))
    places, hashes = finder.of(body)
    shifted, again = finder.of(b"0123456789" * 7 + body)
    inner = shifted[(shifted >= 150)] - 70
    assert set(inner.tolist()) <= set(places.tolist()) and len(inner) >= len(places) - 40
    assert dict(zip(places.tolist(), hashes.tolist())).items() >= dict(zip(inner.tolist(), again[shifted >= 150].tolist())).items()


def test_whole_characters(spark):
    shared = "ééééééééééééé"
    df = spark.createDataFrame([(1, "a" + shared + "ü"), (2, "b" + shared + "û")], "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in remove_repeats(df, min_bytes=10, whole_characters=True).collect()}
    assert kept == {1: "aü", 2: "bû"}


def test_extents_compare_all_pairs():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(2, 9)
        before = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(8))) for _ in range(n)]
        after = [b"q" + bytes(rng.choice(b"ab") for _ in range(rng.randrange(8))) for _ in range(n)]
        left, right = maximal_extents(before, after, 8)
        for i in range(n):
            pairs = [(_common(before[i], before[j]), _common(after[i], after[j])) for j in range(n) if j != i]
            good = [p for p in pairs if sum(p) >= 8]
            assert (left[i], right[i]) == (max([0, *(p[0] for p in good)]), max([0, *(p[1] for p in good)]))


def test_prefix_intervals():
    # banana, sorted suffixes: a ana anana banana na nana
    assert sorted(prefix_intervals([1, 3, 0, 0, 2])) == [(0, 0, 5), (1, 0, 2), (2, 4, 5), (3, 1, 2)]


def test_repeats_on_odd_rows(odd_docs, no_docs):
    assert remove_repeats(no_docs).count() == 0
    rows = remove_repeats(odd_docs, min_bytes=100).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        if row["doc_id"] in (1, 2):
            assert row["n_removed"] == row["n_bytes"] and row["n_spans"] == 1
        if row["doc_id"] in (3, 4, 5, 8, 9, None):
            assert row["n_removed"] == 0


def fingerprint_by_hand(text, words=3):
    xxhash = pytest.importorskip("xxhash")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    digests = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def groups_by_hand(prints, radius):
    labels = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, p in prints.items():
            for j, q in prints.items():
                if (p ^ q).bit_count() <= radius and labels[j] < labels[i]:
                    labels[i], changed = labels[j], True
    return labels


def test_simhash_components(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: fingerprint_by_hand(t) for i, t in texts.items()}
    rows = simhash_components(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] & (1 << 64) - 1 for r in rows} == prints
    assert {r["doc_id"]: r["component"] for r in rows} == groups_by_hand(prints, 2)


def test_links_of_dense_and_split_shards(spark):
    from chatloom.llm.simhash_bk import link_fingerprints

    rng = random.Random(3)
    centre = rng.getrandbits(62)
    values = {centre ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for _ in range(150)}
    values |= {rng.getrandbits(62) for _ in range(150)} | {0, 1, 7}
    points = spark.createDataFrame([(v, v, 0) for v in values], "fp long, id long, space int")
    expected = groups_by_hand({v: v for v in values}, 2)
    for shard_rows in (16384, 8):
        links = link_fingerprints(points, 2, shard_rows=shard_rows)
        assert links.count() <= 3 * 28 * len(values)
        found = {r["node"]: r["label"] for r in connected_components(links).collect()}
        assert {v: found.get(v, v) for v in values} == expected


def test_bk_tree():
    rng = random.Random(1)
    values = list({rng.getrandbits(10) for _ in range(300)})
    tree = BkTree()
    for value in values:
        tree.add(value)
    for radius in (0, 1, 3):
        for target in values[:20]:
            found = {values[i] for _, i in tree.within(target, radius)}
            assert found == {v for v in values if (v ^ target).bit_count() <= radius}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 9), (9, 7), (5, 5)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found if r["node"] != 5} == {**dict.fromkeys(range(100, 141), 100), 7: 7, 9: 7}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_on_odd_rows(odd_docs, no_docs):
    assert simhash_components(no_docs).count() == 0
    rows = simhash_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == by_id[5]["fingerprint"] == 0
    assert by_id[5]["component"] == by_id[4]["component"] == 3 and by_id[2]["component"] == 1
    assert by_id[None]["component"] is None


def test_near_duplicates(spark, odd_docs, no_docs):
    assert near_duplicate_components(no_docs).count() == 0
    groups = {(r["doc_id"], r["component"]) for r in near_duplicate_components(odd_docs).collect()}
    assert groups == {(1, 1), (2, 1), (7, 1), (3, 3), (4, 3), (5, 5), (6, 6), (8, 8), (9, 9)}


def test_near_duplicates_of_edited_texts(spark):
    rng = random.Random(8)
    rows, expected = [], {}
    for base in range(12):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(250)]
        for copy in range(4):
            edited = list(words)
            for _ in range(copy and 2):
                edited[rng.randrange(250)] = "edit" + str(rng.random())
            rows.append((base * 10 + copy, " ".join(edited)))
            expected[base * 10 + copy] = base * 10
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component"] for r in near_duplicate_components(df).collect()} == expected


def shingles_by_hand(text, words=5):
    tokens = text.encode().lower().split()
    return {tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))}


def test_near_duplicates_of_block_edits(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows, likeness = [], []
    for pair in range(240):
        words = [word() for _ in range(rng.randrange(60, 400))]
        share = rng.uniform(0.82, 0.95)
        extra = [word() for _ in range(int(len(words) * (1 / share - 1)))]
        at = rng.randrange(len(words))
        cut = int(len(words) * (1 - share))
        start = rng.randrange(cut, len(words) - cut)
        edited = [words + extra, extra + words, words[:at] + extra + words[at:], words[:-cut], words[cut:], words[:start] + words[start + cut :]][pair % 6]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(edited))]
        p, q = shingles_by_hand(rows[-1][1]), shingles_by_hand(rows[-2][1])
        likeness.append(len(p & q) / len(p | q))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component"] for r in near_duplicate_components(df).collect()}
    assert sum(0.8 <= x < 0.85 for x in likeness) > 40 and sum(x >= 0.85 for x in likeness) > 100
    assert [found[2 * i + 1] == 2 * i for i in range(len(likeness))] == [x >= 0.8 for x in likeness]


def test_a_link_is_not_lost_behind_a_failed_one(spark):
    from chatloom.llm.simhash_bk import _verified

    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    other = rng.sample(words, 200)
    edited = [*words[:100], "edit", *words[101:]]
    df = spark.createDataFrame([(1, " ".join(other)), (2, " ".join(words)), (3, " ".join(edited))], "doc_id long, text string")
    assert {r["doc_id"]: r["component"] for r in near_duplicate_components(df).collect()} == {1: 1, 2: 2, 3: 2}
    # One key for all: nine groups of texts, of which each id meets all the others first.
    texts = [(i, " ".join(f"g{i % 9}w{k}" if k != i else "edit" for k in range(100))) for i in range(90)]
    texts = spark.createDataFrame(texts, "id long, text string")
    links = _verified(texts, texts.selectExpr("id", "96 AS size", "7L AS key"), 5, 0.8)
    assert {r["node"]: r["label"] for r in connected_components(links).collect()} == {i: i % 9 for i in range(90)}


def test_simhash_trees_lead_the_near_duplicates(spark, monkeypatch):
    """Close SimHashes alone make a group of near copies; a close SimHash of an unlike text does not."""
    from chatloom.llm import simhash_bk

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, " ".join(words[:2000])), (4, " \n"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    trees = simhash_bk.link_fingerprints
    monkeypatch.setattr(simhash_bk, "link_fingerprints", lambda *a, **k: seen.append(1) or trees(*a, **k))
    monkeypatch.setattr(simhash_bk, "shingle_bands", lambda text, *a: simhash_bk.F.expr("named_struct('size', 1, 'keys', array(xxhash64(text)))"))
    found = {r["doc_id"]: r["component"] for r in near_duplicate_components(df).collect()}
    assert seen and found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_a_pair_that_shares_many_keys_is_one_candidate(spark, monkeypatch):
    from chatloom.llm import simhash_bk

    texts = spark.createDataFrame([(i, f"text{i} " * 9) for i in range(20)], "id long, text string")
    members = texts.selectExpr("id", "9 AS size", "array(1L, 2L, 3L) AS keys", "explode(array(1L, 2L, 3L)) AS key")
    joined = []
    links_of = simhash_bk.similar_links
    monkeypatch.setattr(simhash_bk, "similar_links", lambda t, p, *a: joined.extend(map(tuple, p.collect())) or links_of(t, p, *a))
    assert simhash_bk._verified(texts, members, 5, 0.8).count() == 0
    assert sorted(joined) == [(a, b) for a in range(20) for b in range(a)]


def test_unlike_members_of_a_large_key_are_not_all_compared(spark, monkeypatch):
    """Copies of one text with few or many changed words share a key; each finds its group without the square of pairs."""
    from chatloom.llm import simhash_bk

    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        share = rng.choice([0.02, 0.05, 0.3])
        texts.append(" ".join(f"e{rng.randrange(500)}" if rng.random() < share else w for w in base))
    rows = list(enumerate(texts)) + [(300 + i, " ".join([*t.split(), "end"])) for i, t in enumerate(texts[:20])]
    sets = [shingles_by_hand(t) for _, t in rows]
    expected = list(range(len(rows)))
    for i, p in enumerate(sets):
        for j, q in enumerate(sets[:i]):
            if len(p & q) >= 0.8 * len(p | q) and expected[i] != expected[j]:
                least, most = sorted((expected[i], expected[j]))
                expected = [least if x == most else x for x in expected]
    df = spark.createDataFrame([(i, t, len(p)) for (i, t), p in zip(rows, sets)], "id long, text string, size int")
    joined = []
    links_of = simhash_bk.similar_links
    monkeypatch.setattr(simhash_bk, "similar_links", lambda t, p, *a: joined.extend(map(tuple, p.collect())) or links_of(t, p, *a))
    links = simhash_bk._verified(df.select("id", "text"), df.selectExpr("id", "size", "7L AS key"), 5, 0.8)
    found = {r["node"]: r["label"] for r in connected_components(links).collect()}
    assert [found.get(i, i) for i, _ in rows] == expected
    assert 60 < len(set(expected)) < len(rows)
    # All pairs are 51,040.
    assert len(joined) < 30 * len(rows)


@pytest.mark.parametrize("group_rows", [256, 1])
def test_repeats_of_rows_without_id(spark, group_rows):
    rng = random.Random(9)
    random_text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two = random_text(300), random_text(300)
    texts = [random_text(80) + one + random_text(90), random_text(70) + one + random_text(60), random_text(50) + two, two + random_text(75)]
    ids = [None, None, None, 1]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    rows = remove_repeats(df, min_bytes=100, group_rows=group_rows).collect()
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows)
    assert got == sorted(cut_by_hand(texts, 100))
