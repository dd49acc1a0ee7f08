"""Phrase mining and source divergence against brute force in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from chatloom.llm.phrase_mining import Scan, collocations, phrase_counts
from chatloom.llm.source_divergence import scaled_share, source_divergence, term_stripes
from tests.llm.conftest import SCHEMA, odd_rows

ALPHABET = ["a", "b", "c", "New", "York", "city", "é漢", "the", "of", "x\x00y", " ", "q"]


def corpus(seed, rows):
    """Few words, so that phrases repeat; with ties, empty pieces, NULLs, repeated rows and one source of a third of the rows."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        words = [rng.choice(ALPHABET) + rng.choice(["", "", "", ".", ",", "\n", "\t", "  "]) for _ in range(rng.randrange(0, 30))]
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "lone", None])
        out.append((i // 2, " ".join(words) if i % 17 else None, rng.choice(["en", "fr", None]), source, i))
    return out + out[:5]


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def counted(rows, most):
    """``{lang: {words as a tuple: occurrences}}``."""
    out = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                out[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return out


def brute_collocations(rows, threshold, top, most=3):
    out = []
    for lang, f in counted(rows, most).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        scored = []
        for p, a in found.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = [
                q for q, b in found.items()
                if len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("shards,slot_bits", [(1, 24), (2, 16), (5, 6)])
def test_collocations(spark, shards, slot_bits):
    rows = corpus(3, 160)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = collocations(df, threshold=4, top=25, shards=shards, slot_bits=slot_bits)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 4, 25)


def test_longer_phrases(spark):
    rows = [(i, "one two three four five " * 4 + "w" * 100 + " six", "en", "s", i) for i in range(6)] + corpus(4, 60)
    phrases, sizes = phrase_counts(spark.createDataFrame(rows, SCHEMA), max_words=4, threshold=5, shards=2, slot_bits=12)
    exact = counted(rows, 4)
    expected = {(lang, " ".join(p), c) for lang, f in exact.items() for p, c in f.items() if c >= 5}
    assert {(r.lang, r.phrase, r["count"]) for r in phrases.collect()} == expected
    assert dict(tuple(r) for r in sizes.collect()) == {
        lang: sum(c for p, c in f.items() if len(p) == 1) for lang, f in exact.items()
    }


@pytest.mark.parametrize("block", [1, 40, 10**6])
def test_a_scan_counts_the_same_in_parts_of_any_size(block):
    """Texts are cut into parts at edges, within a piece, and after a word that is longer than a part."""
    rows = [(i, "one two three four five " * 4 + "w" * 100 + " six", "en", "s", i) for i in range(3)] + corpus(4, 40)
    begun = [np.zeros(1 << 8, np.uint8) for _ in range(3)]
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] or "" for r in rows]})
    found = Counter()
    for out in Scan(1, 2, 4, begun, 8, block)(iter([batch])):
        for lang, _, phrase, _, count in zip(*(c.to_pylist() for c in out.columns)):
            found[lang, phrase] += count
    assert found == {(lang, " ".join(p)): c for lang, f in counted(rows, 4).items() for p, c in f.items()}


def test_phrases_of_odd_rows(spark, odd_docs, no_docs):
    got = collocations(odd_docs, threshold=2, top=50, slot_bits=10)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(odd_rows(), 2, 50)
    assert collocations(no_docs, slot_bits=10).collect() == []
    with pytest.raises(ValueError):
        phrase_counts(odd_docs, threshold=300)


def test_no_rare_phrase_is_written(spark, monkeypatch):
    """Scans hand on slots; of the phrases only those with the threshold become a table."""
    from chatloom.llm import phrase_mining

    written = []

    def stored(df, name, *args, **options):
        out = plain(df, name, *args, **options)
        if "phrase" in out.columns:
            written.extend(r["count"] for r in out.where("phrase <> ''").collect())
        return out

    plain = phrase_mining.stored
    monkeypatch.setattr(phrase_mining, "stored", stored)
    rows = corpus(6, 120)
    phrases, _ = phrase_counts(spark.createDataFrame(rows, SCHEMA).repartition(3), threshold=5, slot_bits=14)
    exact = counted(rows, 3)
    assert phrases.count() == sum(c >= 5 for f in exact.values() for c in f.values())
    assert written and min(written) >= 5


def brute_divergence(rows, least, top):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", small(text))
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found)[:most], 1):
                    out.append((lang, s, part, item.decode(), -value, rank))
    return sorted(out)


@pytest.mark.parametrize("held", [10**6, 7])
def test_source_divergence(spark, held):
    rows = corpus(5, 200) + [(900, "only here", "xx", "a", 1), (901, None, "xx", None, 1), (902, "12 !", "yy", "z", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = source_divergence(df, least_documents=6, top_terms=4, held_entries=held)
    result = sorted(tuple(r) for r in got.collect())
    assert result == brute_divergence(rows, 6, 4)
    # Nothing is kept in xx, so its two sources differ in nothing; yy has one source and no row.
    assert [r for r in result if r[0] in ("xx", "yy")] == [("xx", "", "pair", "a", 0, 1), ("xx", "a", "pair", "", 0, 1)]


def test_divergence_of_odd_rows(spark, odd_docs, no_docs):
    got = source_divergence(odd_docs, least_documents=1, top_terms=10**6)
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(odd_rows(), 1, 10**6)
    assert source_divergence(no_docs).collect() == []


def test_stripes_are_whole(spark):
    rows = corpus(6, 90)
    stripes = term_stripes(spark.createDataFrame(rows, SCHEMA).repartition(5), least_documents=1, held_entries=3)
    seen = [(r.lang, r.term) for r in stripes.collect()]
    assert len(seen) == len(set(seen))


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(1)
    for _ in range(2000):
        total = rng.randrange(0, 9 * 10**14)
        terms = rng.randrange(1, 10**6)
        count = rng.randrange(0, total + 1)
        assert scaled_share(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def test_each_length_is_stored_by_itself(spark, monkeypatch):
    """No copy of the texts is made, and the shuffle of a length goes before that of the next begins."""
    from chatloom.llm import phrase_mining

    tables = []
    stored = phrase_mining.stored
    monkeypatch.setattr(phrase_mining, "stored", lambda df, *a, **k: tables.append(stored(df, *a, **k)) or tables[-1])
    docs = spark.createDataFrame([("a b c. A b c", "en")] * 5, "text string, lang string")
    phrases, sizes = phrase_counts(docs, threshold=5, slot_bits=8)
    assert [{r["words"] for r in t.select("words").collect()} for t in tables] == [{0, 1, 2}, {3}]
    found = {(r["phrase"], r["count"]) for r in phrases.collect()}
    assert found == {(p, 10) for p in ("a", "b", "c", "a b", "b c", "a b c")}
    assert [tuple(r) for r in sizes.collect()] == [("en", 30)]


@pytest.mark.parametrize("several", [7, 1 << 22, 1 << 32])
def test_phrases_are_packed_whole(several):
    """Numbers of any size, also where those of a phrase pass 64 bits together."""
    from chatloom.llm.phrase_mining import _keys, _pack, _unpack

    rng = np.random.default_rng(several)
    rows = sorted(tuple(int(n) for n in row) for row in rng.choice([0, 1, several // 2, several - 1], (300, 4)))
    columns = np.array(rows, np.int64).T
    keys = _keys(list(columns), several)
    assert [a < b for a, b in zip(keys, keys[1:])] == [a < b for a, b in zip(rows, rows[1:])]
    assert np.array_equal(_unpack(_pack(columns.astype(np.uint32)), 4, len(rows)), columns)


def test_the_last_scans_rows_follow_the_input(spark, monkeypatch):
    """Five times the text lets far more than five times the pairs reach the threshold."""
    rng = random.Random(5)
    made = None

    def counting(self, function, *args, **options):
        total = made

        def run(batches):
            for batch in function(batches):
                total.add(batch.num_rows)
                yield batch

        return plain(self, run if function.__name__ in ("word_scan", "last_scan") else function, *args, **options)

    texts = [" ".join(f"w{rng.randrange(100)}" for _ in range(40)) for _ in range(1000)]
    rows, found = [], []
    for several in (200, 1000):
        docs = spark.createDataFrame([(t, "en") for t in texts[:several]], "text string, lang string").coalesce(1)
        plain, made = type(docs).mapInArrow, spark.sparkContext.accumulator(0)
        with monkeypatch.context() as patch:
            patch.setattr(type(docs), "mapInArrow", counting)
            phrases, _ = phrase_counts(docs, max_words=2, threshold=5, slot_bits=16)
        exact = counted([(0, t, "en") for t in texts[:several]], 2)["en"]
        assert {(r["phrase"], r["count"]) for r in phrases.collect()} == {(" ".join(p), c) for p, c in exact.items() if c >= 5}
        rows.append(made.value)
        found.append(phrases.where("words = 2").count())
    assert found[1] > 12 * found[0]
    assert rows[1] <= 5 * rows[0]
