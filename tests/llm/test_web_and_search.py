"""WARC round trips and damage, URL verdicts, nearest neighbours, block tables, language and the pipeline."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest

from chatloom.functions.folders import new_path
from chatloom.llm import language_crf, simhash_blocks, warc
from chatloom.llm.url_reputation import host_and_path, host_reputation, judge_urls
from chatloom.llm.vamana import beam_search, build_graph, nearest_by_inner_product


# -- WARC ------------------------------------------------------------------------


def archive(rng, compressed):
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randrange(3000))) for _ in range(30)]
    parts = []
    for i, p in enumerate(payloads):
        raw = warc.record_bytes("response", f"<urn:page:{i}>", None, "http://a/b", hashlib.sha1(p).hexdigest(), p)
        if compressed:
            coder = zlib.compressobj(6, wbits=31)
            raw = coder.compress(raw) + coder.flush()
        parts.append(raw)
    return payloads, parts


def damaged(rng, part):
    kind = rng.randrange(5)
    if kind == 0:
        return part[: rng.randrange(len(part))]
    if kind == 1:
        out = bytearray(part)
        for _ in range(3):
            out[rng.randrange(len(out))] ^= rng.randrange(1, 256)
        return bytes(out)
    if kind == 2:
        return part[rng.randrange(1, len(part)) :]
    if kind == 3:
        return b""
    return bytes(rng.randrange(256) for _ in range(200)) + part


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage(compressed):
    rng = random.Random(7)
    payloads, parts = archive(rng, compressed)
    for _ in range(40):
        bad = set(rng.sample(range(30), rng.randrange(5)))
        data = b"".join(damaged(rng, p) if i in bad else p for i, p in enumerate(parts))
        at, found = 0, {}
        for start, end, record in warc.salvage(io.BytesIO(data)):
            assert start == at and end > start
            at = end
            if record:
                found[int(record["record_id"][10:-1])] = record["payload"]
        assert at == len(data)
        assert found.keys() >= set(range(30)) - bad
        assert all(payloads[i] == p for i, p in found.items())


class Short(io.BytesIO):
    """A stream that returns a few bytes for each read, so that each place is at the edge of what is held."""

    most = 1

    def read(self, size=-1):
        return super().read(self.most if size < 0 else min(size, self.most))


@pytest.mark.parametrize("most", [1, 2, 3, 7, 500])
@pytest.mark.parametrize("compressed", [True, False])
def test_records_across_reads(compressed, most):
    rng = random.Random(11)
    payloads, parts = archive(rng, compressed)
    stream = Short(b"".join(parts))
    stream.most = most
    assert [r and r["payload"] for _, _, r in warc.salvage(stream)] == payloads
    for _ in range(5):
        bad = set(rng.sample(range(30), 3))
        data = b"".join(damaged(rng, p) if i in bad else p for i, p in enumerate(parts))
        stream = Short(data)
        stream.most = most
        assert list(warc.salvage(stream)) == list(warc.salvage(io.BytesIO(data)))


def test_member_at_the_edge_of_a_read():
    def member(i, payload):
        raw = warc.record_bytes("response", f"<urn:page:{i}>", None, "http://h/", hashlib.sha1(payload).hexdigest(), payload)
        coder = zlib.compressobj(0, wbits=31)
        return coder.compress(raw) + coder.flush()

    size = 1_040_000
    base = len(member(0, b"x" * size))
    for before in range(9):
        # Uncompressed blocks: a byte more of payload is a byte more of the member.
        first = member(0, b"x" * (size + warc._READ_BYTES - before - base))
        assert len(first) == warc._READ_BYTES - before
        found = list(warc.salvage(io.BytesIO(first + member(1, b"second"))))
        assert [r and r["record_id"] for _, _, r in found] == ["<urn:page:0>", "<urn:page:1>"]


def test_pages_to_archives_and_back(spark):
    same = "x" * 1500
    rows = [(1, same), (2, same), (5, same), (3, "small"), (4, "small"), (6, None), (7, ""), (8, "é" * 600), (8, "é" * 600)]
    pages = spark.createDataFrame([(i, "http://h/\r\nx", h) for i, h in [*rows, (None, same)]], "page_id long, url string, html string")
    folder = new_path(spark, "warc-test")
    archives = warc.write_pages(pages, folder)
    records = [r.asDict() for r in warc.read_pages(archives).collect()]
    got = sorted((r["record_id"], r["kind"], r["refers_to"], r["payload_bytes"]) for r in records)
    page = "<urn:page:{}>".format
    assert got == sorted(
        [
            (page(1), "revisit", page(5), 1500),
            (page(2), "revisit", page(5), 1500),
            (page(5), "response", None, 1500),
            (page(""), "response", None, 1500),
            *[(page(i), "response", None, n) for i, n in ((3, 5), (4, 5), (6, 0), (7, 0), (8, 1200), (8, 1200))],
        ]
    )
    assert {r["digest"] for r in records if r["payload_bytes"] == 1500} == {hashlib.sha1(same.encode()).hexdigest()}
    path = archives.first()["path"].removeprefix("file:")
    path = "/" + path.lstrip("/")
    with open(path, "r+b") as file:
        file.seek(3)
        file.write(b"\xff\xff")
    again = warc.read_pages(archives).collect()
    assert sum(r["kind"] == "gap" for r in again) == 1 and len(again) == len(records)
    none = warc.write_pages(pages.limit(0), new_path(spark, "warc-test"))
    assert none.count() == 0 and warc.read_pages(none).count() == 0


@pytest.mark.parametrize("compressed", [True, False])
def test_long_urls(compressed):
    parts = []
    urls = ["data:text/html," + "x%20y" * 100_000, "http://h/" + "q" * 65_500, "http://h/" + "z" * (3 << 20), "http://h/"]
    for i, url in enumerate(urls):
        raw = warc.record_bytes("response", f"<urn:page:{i}>", None, url, hashlib.sha1(b"body").hexdigest(), b"body")
        coder = zlib.compressobj(6, wbits=31)
        parts.append(coder.compress(raw) + coder.flush() if compressed else raw)
    assert [r and r["target"] for _, _, r in warc.salvage(io.BytesIO(b"".join(parts)))] == urls
    # A header without end stops where no header goes on, and the next record is found.
    found = list(warc.salvage(io.BytesIO(b"WARC/1.1\r\nname: " + b"n" * (2 << 20) + b"\x00" + parts[0] + parts[3])))
    assert [r and r["target"] for _, _, r in found] == [None, urls[0], urls[3]]


def test_pages_with_long_urls(spark):
    rows = [(1, "data:," + "x" * 300_000, "h" * 2000), (2, "http://h/", "h" * 2000), (3, "http://h/" + "y" * 300_000, "h" * 2000)]
    archives = warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), new_path(spark, "warc-test"))
    kinds = {r["record_id"]: r["kind"] for r in warc.read_pages(archives, whole=True).collect()}
    assert kinds == {"<urn:page:1>": "revisit", "<urn:page:2>": "revisit", "<urn:page:3>": "response"}
    with pytest.raises(Exception, match="records instead of"):
        warc.read_pages(archives.selectExpr("path", "records + 1 AS records"), whole=True).collect()


# -- URLs ------------------------------------------------------------------------


def test_hosts(spark):
    urls = [None, "", "no scheme", "http://A.É.com:80/P?q#f", "x://h#f/p", "a://b://c/d", "://", "http://h?/x", "s://h/a\nb"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = host_and_path("url")
    got = [tuple(r) for r in df.select(host, path).collect()]
    assert got == [("", ""), ("", ""), ("", ""), ("a.É.com:80", "/P"), ("h", ""), ("b:", "//c/d"), ("", ""), ("h", ""), ("h", "/a\nb")]


def test_verdicts(spark):
    outcomes = [("bad.one.com", 1)] * 30 + [("good.one.com", 0)] * 30 + [("new.two.com", 1), (None, 0), ("bad.one.com", None)]
    outcomes = spark.createDataFrame(outcomes, "host string, bad int")
    rates = {r["host"]: r for r in host_reputation(outcomes).collect()}
    assert rates["bad.one.com"]["n"] == 30 and rates["bad.one.com"]["rate"] > 0.9
    assert rates["good.one.com"]["rate"] < 0.1 < rates["new.two.com"]["rate"] < rates["bad.one.com"]["rate"]
    urls = ["http://bad.one.com/x", "http://good.one.com/x", "http://new.two.com/", "http://bad.one.com/ok/", None, "http://one.com"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = [("allow", "one.com/ok/"), ("block", "com/"), ("allow", "one.com/")]
    plain = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages, outcomes, []).collect()}
    assert [plain[i][1] for i in range(6)] == ["block", "allow", "allow", "block", "allow", "allow"]
    ruled = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages, outcomes, rules).collect()}
    assert ruled[3] == ("one.com/ok/", "allow") and ruled[2] == ("com/", "block") and ruled[5] == (None, "allow")
    assert judge_urls(pages, outcomes.limit(0), rules).count() == 6
    assert judge_urls(pages.limit(0), outcomes, rules).count() == 0


# -- nearest neighbours ----------------------------------------------------------


def test_graph_finds_neighbours():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(1500, 24)).astype(np.float32)
    links, entry = build_graph(points)
    assert all(len(set(row[row >= 0].tolist())) == (row >= 0).sum() for row in links)
    targets = rng.normal(size=(50, 24)).astype(np.float32)
    true = np.argsort(((targets[:, None] - points) ** 2).sum(2), axis=1)[:, :10]
    found, _ = beam_search(points, links, entry, targets, 64)
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(true, found)]) > 0.95


def test_nearest_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids])
    rows = nearest_by_inner_product(table, table.where("vec_id % 20 = 0"), k=20, shard_rows=100).collect()
    found = {(r["query_id"], r["rank"]): r for r in rows}
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        scores = matrix @ vectors[query]
        others = sorted((-s, i) for s, i in zip(scores, ids) if i != query)[:20]
        mine = [found[query, rank] for rank in range(1, len(others) + 1)]
        assert all(abs(r["score"] - vectors[query] @ vectors[r["vec_id"]]) < 1e-12 for r in mine)
        assert mine == sorted(mine, key=lambda r: (-r["score"], r["vec_id"]))
        hits += len({i for _, i in others} & {r["vec_id"] for r in mine})
        total += len(others)
    assert hits >= 0.95 * total


def test_nearest_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, 9) for i, v in [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0])]]
    rows += [(i, v, 9) for i, v in [(6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [0.0, 3.0]), (40, [inf, 1.0])]]
    rows += [(20, [1.0, 1.0], 9)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = nearest_by_inner_product(df, df.where("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 7, 1.0), (20, 1, 8, 3.0), (20, 2, 2, 2.0), (20, 3, 0, 1.0),
    ]
    assert nearest_by_inner_product(df.limit(0), df.limit(0)).count() == 0
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "vec_id long, embedding array<double>")
    rows = nearest_by_inner_product(copies, copies.where("vec_id = 20"), k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in rows] == [0, 1, 2, 3, 4]


def test_queries_stream_past_a_shard():
    import pyarrow as pa

    from chatloom.llm.vamana import answers

    rng = np.random.default_rng(1)
    points, targets = rng.normal(size=(2, 40, 8)), rng.normal(size=(2000, 8))
    pulled = []

    def rows(shard, ids, vectors, asks):
        columns = {"shard": [shard] * len(ids), "ids": [[i] for i in ids], "vector": vectors.tolist(), "asks": [asks] * len(ids)}
        pulled.append(shard)
        return pa.RecordBatch.from_pydict(columns)

    def batches():
        for shard in (0, 1):
            yield rows(shard, range(40 * shard, 40 * shard + 40), points[shard], False)
            for at in range(0, 2000, 100):
                yield rows(shard, range(1000 + at, 1100 + at), targets[at : at + 100], True)

    longest, found = float((points**2).sum(2).max()), {}
    for number, out in enumerate(answers(batches(), 1.0, longest, 1, 32, 64, 96)):
        # No more than the batch that is answered has been read.
        assert len(pulled) == number + 2 + (number >= 20) and out.num_rows == 100
        for r in out.to_pylist():
            found[r["query_id"]] = max(found.get(r["query_id"], (-np.inf, 0)), (r["score"], r["id"]))
    best = (targets @ points.reshape(80, 8).T).argmax(1)
    assert np.mean([found[1000 + i][1] == b for i, b in enumerate(best)]) > 0.99


# -- fingerprints in functions ---------------------------------------------------


def test_edited_texts(spark, odd_docs, no_docs):
    assert simhash_blocks.edited_fingerprints(no_docs).count() == 0
    rng = random.Random(1)
    many = [(rng.randrange(10**9), " ".join(rng.choice(["aé", "b", "dd😀"]) for _ in range(rng.randrange(30)))) for _ in range(900)]
    tables = [odd_docs, spark.createDataFrame([(3, "only one")], "doc_id long, text string")]
    tables.append(spark.createDataFrame(many, "doc_id long, text string"))
    for df in tables:
        rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "") for r in df.collect())
        expected = []
        for i, (key, text) in enumerate(rows):
            half = len(text) // 2
            edited = text[: len(text) - half] + rows[(i + 1) % len(rows)][1][:half]
            expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        got = simhash_blocks.edited_fingerprints(df).collect()
        mine = [((r["doc_id"] is not None, r["doc_id"] or 0), r["n_chars"], r["edited_sha256"]) for r in got]
        assert sorted(mine) == sorted(expected)
        assert all(len(r["fingerprint"]) == 16 and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_likeness_follows_the_texts(spark, sf_dir):
    rows = simhash_blocks.edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    gap = np.array([r["near_edited"] - r["near_next"] for r in rows])
    assert gap.mean() > 0.1 and (gap > 0).mean() > 0.9
    texts = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None), (4, "")], "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in simhash_blocks.fingerprints(texts).collect()}
    assert prints[1] == prints[2] and prints[3] == prints[4]


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_block_tables(spark, radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    values += [v ^ (1 << rng.randrange(60)) for v in values[:150]] + [v ^ 7 for v in values[:50]]
    index = spark.createDataFrame([(v,) for v in values], "fp long")
    queries = spark.createDataFrame([(v,) for v in values[:80]], "query long")
    found = {(r["query"], r["fp"]) for r in simhash_blocks.near_fingerprints(index, queries, radius).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    assert found == {(a, b) for a in set(values[:80]) for b in set(values) if near(a, b)}


# -- language --------------------------------------------------------------------


def test_forward_backward_over_chunks():
    rng = np.random.default_rng(0)
    moves = np.exp(rng.normal(size=(3, 3)))
    lengths = np.array([1, 64, 65, 200, 5])
    scores = np.exp(rng.normal(size=(lengths.sum(), 3)))
    got, at = language_crf._sums(scores, lengths, moves), 0
    for i, n in enumerate(lengths):
        own, ahead, state = scores[at : at + n], [], np.ones(3) / 3
        at += n
        for row in own:
            state = (state @ moves) * row
            state /= state.sum()
            ahead.append(state)
        total, back = np.zeros(3), np.ones(3)
        for row, before in zip(own[::-1], ahead[::-1]):
            total += before * back / (before * back).sum()
            back = moves @ (row * back)
            back /= back.sum()
        assert np.allclose(total, got[i])


def test_held_out_accuracy_and_switching(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_crf.fit_on(docs)
    truth = {r["doc_id"]: r for r in docs.select("doc_id", "lang", "text", language_crf.held_out().alias("out")).collect()}
    found = {r["doc_id"]: r for r in language_crf.predict(docs, model).collect()}
    tested = [i for i, r in truth.items() if r["out"]]
    assert len(tested) > 20 and np.mean([found[i]["lang_pred"] == truth[i]["lang"] for i in tested]) > 0.95
    parts = {r["lang"]: language_crf.words_of(r["text"])[:60] for r in truth.values() if len(r["text"]) > 2000}
    a, b = sorted(parts)[:2]
    share = model.shares([parts[a] + parts[b]])[0]
    assert share[model.labels.index(a)] > 0.35 and share[model.labels.index(b)] > 0.35


def test_language_on_odd_rows(spark, odd_docs, no_docs):
    model = language_crf.fit_on(odd_docs.drop("label"))
    rows = language_crf.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["lang_pred"], r["score"]) == ("und", 0) for r in rows if r["doc_id"] in (3, 4, 5, 8))
    assert language_crf.predict(no_docs, model).count() == 0
    empty = language_crf.fit_on(no_docs)
    assert empty.labels == [] and {r["lang_pred"] for r in language_crf.predict(odd_docs, empty).collect()} == {"und"}


# -- pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark, odd_docs, no_docs, sf_dir):
    import corpus_pipeline

    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
    named = dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"] for r in named["language"](spark, odd_docs, sf_dir).collect()}
    assert kept.isdisjoint({3, 4, 5, 8}) and kept >= {1, 2, 6, 7}
    assert {r["doc_id"] for r in named["near_duplicates"](spark, odd_docs, sf_dir).collect()} == {None, 1, 3, 5, 6, 8, 9}
    cut = {r["doc_id"]: r for r in named["repeated_passages"](spark, odd_docs, sf_dir).collect()}
    assert cut[3]["text"] is None and cut[2]["text"] == "" and cut[7]["text"].strip() == "end" and cut[2]["n_chars"] == 0
    assert cut[9]["text"].startswith("é漢字") and cut[9]["label"] == "other"


def test_pipeline_keeps_single_documents(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(rows[0].asDict())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["text"], []).append(r["doc_id"])
    kept = {r["doc_id"] for r in rows}
    assert all(len(kept & set(ids)) <= 1 for ids in texts.values()) and len(kept) > 0.8 * len(texts)


def test_language_of_texts_with_control_signs(spark):
    """Any sign may stand inside a word."""
    from pyspark.sql import functions as F

    signs = "".join(map(chr, [*range(1, 32), 0x7F]))
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr", "s", 1) for i in range(60)]
    rows += [(100 + i, f"hello{sign} the{sign}cat {sign}and the dog", "en", "s", 1) for i, sign in enumerate(signs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = language_crf.predict(docs, language_crf.fit_on(docs)).where(F.col("doc_id") >= 100).collect()
    assert len(found) == len(signs) and {r.lang_pred for r in found} == {"en"}


@pytest.mark.parametrize("factor", [1e20, 1e-25, 1e150])
def test_nearest_of_very_long_and_short_vectors(spark, factor):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 8)) * factor
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = nearest_by_inner_product(df, df.where("vec_id % 20 = 0"), k=20).collect()
    assert len(rows) == 300
    products = vectors[::20] @ vectors.T
    hits = 0
    for q in range(15):
        products[q, q * 20] = -np.inf
        best = set(np.argsort(-products[q])[:20].tolist())
        hits += len(best & {r.vec_id for r in rows if r.query_id == q * 20})
    assert hits >= 285


def test_a_search_that_is_cut_off_is_still_whole():
    """Two far groups: whatever the links, each query gets its k points."""
    import pyarrow as pa

    from chatloom.llm.vamana import answers

    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(40, 4)) * 1e-9 + 1, rng.normal(size=(40, 4)) * 1e-9 - 1])
    rows = [(0, [i], p.tolist(), False) for i, p in enumerate(points)] + [(0, [1000 + i], p.tolist(), True) for i, p in enumerate(points)]
    schema = pa.schema({"shard": pa.int64(), "ids": pa.list_(pa.int64()), "vector": pa.list_(pa.float64()), "asks": pa.bool_()})
    batch = pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    scale = float(np.abs(points).max())
    longest = float(((points / scale) ** 2).sum(1).max())
    out = pa.Table.from_batches(list(answers(iter([batch]), scale, longest, 20, 2, 4, 4)))
    assert out.num_rows == 80 * 20


def test_stages_send_small_batches(spark, odd_docs, sf_dir):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(name, "10000")
            stage(spark, odd_docs, sf_dir)
            assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.set(name, before)


def test_language_of_many_words_takes_little_memory():
    import tracemalloc

    words = [f"{chr(97 + i % 26)}word{i:x}" for i in range(150000)]
    model = language_crf.fit([("a", words[:40]), ("b", ["uno", "dos", "tres"] * 5)], rounds=2)
    tracemalloc.start()
    scores = model.emissions(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000, peak
    some = range(0, len(words), 9973)
    assert np.allclose(scores[list(some)], np.concatenate([model.emissions([words[i]]) for i in some]))
