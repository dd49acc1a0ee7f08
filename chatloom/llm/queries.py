"""One query for each operator over its whole table. Where SQL can say the same, the SQL stands beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Whole texts go to Python in Arrow batches; a batch is counted in rows, and texts may be long.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_simhash_bk")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word SimHashes differ in at most 2 bits."""
    from chatloom.llm.simhash_bk import simhash_components

    found = simhash_components(_table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op3_packing_mbs")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, by minimum bin slack."""
    from chatloom.llm.packing_mbs import pack_digests

    return pack_digests(_table(spark, sf_dir, "documents"), _vocabulary(), capacity=1024)


@query("op4_bpe_prefix_dp")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to ids and back."""
    from chatloom.llm.bpe import decode, encode

    docs = _table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", encode(spark, "text", _vocabulary()).alias("ids"))
    coded = coded.withColumn("decoded", decode(spark, "ids", _vocabulary()))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that strings of 400 bytes repeat."""
    from chatloom.llm.suffix_dedup import remove_repeats

    cut = remove_repeats(_table(spark, sf_dir, "documents"), min_bytes=400)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_language_crf")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from two thirds of them."""
    from chatloom.llm.language_crf import fit_on, held_out, predict

    docs = _table(spark, sf_dir, "documents")
    found = predict(docs, fit_on(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _shrunk_sql(level: str, groups: str) -> str:
    return f"""{level}_weight AS (
  SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n * (n - 1) * parent * (1 - parent)) > 0 THEN
      (sum((bad - n * parent) ** 2) - sum(n * parent * (1 - parent))) / sum(n * (n - 1) * parent * (1 - parent))
    ELSE 0.0 END, 0.0), 0.001), 1 / 3.0::DOUBLE) - 1 AS weight FROM {groups}),
{level}_rates AS (
  SELECT *, (bad + weight * parent) / (n + weight) AS rate FROM {groups}, {level}_weight)"""


@query(
    "op8_url_reputation",
    f"""WITH judged AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*).*$', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*).*$', 2), '') AS path FROM pages),
outcomes AS (
  SELECT host, CAST(quality = 0 OR toxic = 1 AS DOUBLE) AS bad
  FROM judged JOIN labels ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT)
  WHERE (quality = 0 OR toxic = 1) IS NOT NULL),
hosts AS (SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
  string_split(host, '.')[-1] AS suffix, CAST(count(*) AS DOUBLE) AS n, sum(bad) AS bad FROM outcomes GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
suffix_groups AS (SELECT *, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM suffixes) AS parent FROM suffixes),
{_shrunk_sql("suffix", "suffix_groups")},
domain_groups AS (SELECT d.*, s.rate AS parent FROM domains d JOIN suffix_rates s USING (suffix)),
{_shrunk_sql("domain", "domain_groups")},
host_groups AS (SELECT h.*, d.rate AS parent FROM hosts h JOIN domain_rates d USING (domain)),
{_shrunk_sql("host", "host_groups")},
bounds AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + weight + 1)) AS bound FROM host_rates),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM judged)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
    WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN bounds USING (host)""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All urls under four rules and their hosts' reputation.

    A page's outcome is the label of the document whose number is in its path: bad if of low quality or toxic.
    """
    from chatloom.llm.url_reputation import host_and_path, judge_urls

    pages = _table(spark, sf_dir, "pages")
    host, path = host_and_path("url")
    number = F.regexp_extract(path, "/([0-9]+)", 1).try_cast("long")
    numbered = pages.select(host.alias("host"), number.alias("doc_id"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    outcomes = numbered.join(labels, "doc_id").select("host", F.col("bad").cast("int").alias("bad"))
    return judge_urls(pages, outcomes, _RULES).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op5_warc_salvage",
    """WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN octet_length(payload) >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(payload) >= 1000 AND page_id <> first THEN first END AS refers_to
FROM marked""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to WARC archives in the shared folder and back."""
    from chatloom.llm.warc import new_archive_folder, read_pages, write_pages

    archives = write_pages(_table(spark, sf_dir, "pages"), new_archive_folder(spark))
    # Nothing may be missing in archives that were just written.
    records = read_pages(archives, whole=True)
    return records.select(
        F.regexp_extract("record_id", "<urn:page:(-?[0-9]+)>", 1).try_cast("long").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.regexp_extract("refers_to", "<urn:page:(-?[0-9]+)>", 1).try_cast("long").alias("refers_to"),
    )


@query("op9_simhash_blocks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    from chatloom.llm.simhash_blocks import edited_fingerprints

    return edited_fingerprints(_table(spark, sf_dir, "documents"))


@query("op7_vamana")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every row whose id is divisible by 20."""
    from chatloom.llm.vamana import nearest_by_inner_product

    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_by_inner_product(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op2_training_order")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in fixed-stride shards in training order, read back: a row for each sequence."""
    from chatloom.functions.folders import new_path
    from chatloom.llm.training_order import materialise, read_in_training_order

    docs = _table(spark, sf_dir, "documents")
    shards = materialise(docs, _vocabulary(), new_path(spark, "training"), key=42, shard_records=16384)
    return read_in_training_order(shards).select(
        "slot",
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("tokens") / 2).cast("long").alias("length"),
        F.crc32("tokens").alias("tokens_crc32"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op13_source_stripes",
    rf"""WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
every AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, count(*) OVER (PARTITION BY lang, source) AS v,
    sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
    sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_total
  FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT AS q FROM every),
apart AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and by which terms."""
    from chatloom.llm.source_divergence import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"), least_documents=30, top_terms=50)


@query("op12_piece_prefix_table")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to the ids of a SentencePiece file and back."""
    import public_tokenizers

    from chatloom.llm.piece_bpe import decode_pieces, encode_pieces

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", encode_pieces(spark, "text", model).alias("ids"))
    coded = coded.withColumn("decoded", decode_pieces(spark, "ids", model))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query(
    "op11_phrase_itemsets",
    rf"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) AS lengths(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT lang, phrase, k, f AS a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') AS rest
  FROM counts, (VALUES (1), (2)) AS places(cut) WHERE f >= 10 AND cut < k),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, h.f AS l, t.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS f FROM (
    SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
    FROM best WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.f IS NULL OR 100 * x.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    from chatloom.llm.phrase_mining import collocations

    return collocations(_table(spark, sf_dir, "documents"), max_words=3, threshold=10, top=2000, covered=50)
