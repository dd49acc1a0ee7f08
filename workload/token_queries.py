"""Token, packing, statistics and preview queries."""

from __future__ import annotations

import json
from functools import cache

from pyspark.sql import functions as F

from chatloom.functions.basics import word_count
from chatloom.functions.folders import new_path
from chatloom.operators import templates as t
from chatloom.operators import tokens as k
from chatloom.operators.mixing import Mix, Source, number_rows, with_row_key
from chatloom.operators.packing import pack_best_fit, pack_wrap
from chatloom.plans.inspect import inspect_source
from chatloom.plans.prepare import count_tokens, mix_token_stats, prepare_dpo, prepare_once, prepare_sft
from workload import shapes
from workload.mix_queries import SEED
from workload.template_queries import NO_FUNCTIONS, OPTIONS, THINK_SYSTEM, olmo_segments
from workload.transform_queries import FACTS, TURNS, WHITESPACE

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# -- SQL pieces ---------------------------------------------------------------------

WORD_ID = "CAST('0x' || substr(md5(word), 1, 7) AS BIGINT)"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WHITESPACE}+'), lambda w: w <> '')"


SEGMENTS = f"WITH {TURNS}, {olmo_segments(THINK_SYSTEM, NO_FUNCTIONS)}"
CHAT_WORDS = f"""seg_words AS (SELECT id, turn, part, train, {words("text")} AS ws FROM segs),
tokens AS (
  SELECT id, turn, part, train, {WORD_ID} AS token, i AS word_no
  FROM (SELECT *, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM seg_words))"""
DOC_COUNTS = f"counts AS (SELECT doc_id AS id, len({words('text')}) AS n FROM documents)"


def _segments(spark, sf_dir):
    return t.render_segments(shapes.chats(spark, sf_dir), "olmo3-think-sft", OPTIONS).select("id", "segments")


def _doc_counts(spark, sf_dir):
    return shapes.spread_documents(spark, sf_dir).select("id", word_count(F.col("text")).alias("n"))


# -- encode -----------------------------------------------------------------------------


@query(
    "tokenize_words",
    f"""SELECT id, count(*) AS n_tokens, CAST(sum({WORD_ID}) AS BIGINT) AS id_sum, CAST(max({WORD_ID}) AS BIGINT) AS id_max
FROM (SELECT doc_id AS id, unnest({words("text")}) AS word FROM documents) GROUP BY id""",
)
def tokenize_words(spark, sf_dir):
    encoded = k.tokenize_text(shapes.spread_documents(spark, sf_dir).select("id", "text"))
    return encoded.select("id", *_id_facts("input_ids"))


def _id_facts(column: str):
    total = F.aggregate(column, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return [
        F.size(column).cast("bigint").alias("n_tokens"),
        total.alias("id_sum"),
        F.array_max(column).cast("bigint").alias("id_max"),
    ]


@cache
def byte_tokenizer() -> k.FileTokenizer:
    """A byte-level tokenizer without merges, as a ``tokenizers`` definition: one token per byte."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers

    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    tokenizer = Tokenizer(models.BPE(vocab={c: i for i, c in enumerate(alphabet)}, merges=[]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tokenizer.decoder = decoders.ByteLevel()
    return k.FileTokenizer(json.dumps(json.loads(tokenizer.to_str())))


@query("tokenize_file", "SELECT doc_id AS id, strlen(text) AS n_tokens FROM documents")
def tokenize_file(spark, sf_dir):
    encoded = k.tokenize_text(shapes.spread_documents(spark, sf_dir).select("id", "text"), byte_tokenizer())
    return encoded.select("id", F.size("input_ids").cast("bigint").alias("n_tokens"))


@query(
    "tokenize_file_labels",
    f"""{SEGMENTS} SELECT id, CAST(sum(strlen(text)) AS BIGINT) AS n_labels,
  CAST(coalesce(sum(strlen(text)) FILTER (NOT train), 0) AS BIGINT) AS n_masked FROM segs GROUP BY id""",
)
def tokenize_file_labels(spark, sf_dir):
    encoded = k.tokenize(_segments(spark, sf_dir), byte_tokenizer())
    return encoded.select("id", *k.label_counts())


@query(
    "label_counts",
    f"""{SEGMENTS}, {CHAT_WORDS}
SELECT id, count(*) AS n_labels, count(*) FILTER (NOT train) AS n_masked,
  CAST(coalesce(sum(token) FILTER (train), 0) AS BIGINT) AS trained_sum FROM tokens GROUP BY id""",
)
def label_counts(spark, sf_dir):
    encoded = k.tokenize(_segments(spark, sf_dir))
    trained = F.aggregate(
        F.filter("labels", lambda x: x != k.IGNORED), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    return encoded.select("id", *k.label_counts(), trained.alias("trained_sum"))


@query(
    "truncate",
    f"""SELECT id, CAST(len(ws) AS BIGINT) AS n_tokens,
  CAST(coalesce(list_sum(list_transform(ws, lambda word: {WORD_ID})), 0) AS BIGINT) AS id_sum
FROM (SELECT doc_id AS id, list_slice({words("text")}, 1, 128) AS ws FROM documents)""",
)
def truncate(spark, sf_dir):
    rows = shapes.spread_documents(spark, sf_dir).select("id", "text")
    return k.tokenize_text(rows, max_length=128).select("id", *_id_facts("input_ids")[:2])


@query(
    "truncate_labels",
    f"""{SEGMENTS}, {CHAT_WORDS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn, part, word_no) AS place FROM tokens)
SELECT id, count(*) AS n_labels, count(*) FILTER (NOT train) AS n_masked FROM numbered WHERE place <= 64 GROUP BY id""",
)
def truncate_labels(spark, sf_dir):
    encoded = k.tokenize(_segments(spark, sf_dir))
    return k.truncate(encoded, 64).select("id", *k.label_counts())


# -- packing ----------------------------------------------------------------------------

PLACED = f"""placed AS (
  SELECT doc_id AS id, row_number() OVER (ORDER BY md5(concat_ws(':', 'shuffle', {SEED}, md5(concat_ws(':', {SEED}, doc_id)), 0))) - 1 AS position
  FROM documents)"""


def _numbered_documents(spark, sf_dir):
    """Texts are counted first, then shuffled, then encoded where they arrive."""
    rows = shapes.spread_documents(spark, sf_dir).select("id", "text")
    numbered = number_rows(rows, SEED, ["id"], size=word_count(F.col("text")))
    return k.tokenize_text(numbered).drop("text")


@query(
    "pack_wrap",
    f"""WITH {PLACED},
doc_words AS (SELECT position, {words("text")} AS ws FROM placed JOIN documents ON id = doc_id),
stream AS (
  SELECT {WORD_ID} AS token, row_number() OVER (ORDER BY position, i) - 1 AS place
  FROM (SELECT position, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM doc_words))
SELECT CAST(place // 512 AS BIGINT) AS bin, count(*) AS n_tokens, CAST(sum(token * (place % 512 + 1)) AS BIGINT) AS weighted_sum
FROM stream GROUP BY ALL""",
)
def pack_wrap_query(spark, sf_dir):
    packed = pack_wrap(_numbered_documents(spark, sf_dir), 512)
    return packed.select("bin", *_weighted("input_ids"))


def _weighted(column: str):
    """Number of tokens, and a sum that depends on their order."""
    weighted = F.aggregate(
        F.transform(column, lambda x, i: x.cast("bigint") * (i + 1)), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    return [F.size(column).cast("bigint").alias("n_tokens"), weighted.alias("weighted_sum")]


@query("pack_best_fit", None)
def pack_best_fit_query(spark, sf_dir):
    packed = pack_best_fit(_numbered_documents(spark, sf_dir), 512)
    rows = F.size("row_lengths").cast("bigint").alias("n_rows")
    return packed.select("group", "bin", rows, *_weighted("input_ids"))


@query(
    "pack_best_fit_totals",
    f"""WITH {DOC_COUNTS} SELECT CAST(sum((n + 511) // 512) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_tokens, true AS fits
FROM counts WHERE n > 0""",
)
def pack_best_fit_totals(spark, sf_dir):
    """What any correct packing shares: every piece once, no token lost, no bin too long."""
    packed = pack_best_fit(_numbered_documents(spark, sf_dir), 512)
    return packed.agg(
        F.sum(F.size("row_lengths")).alias("n_rows"),
        F.sum(F.size("input_ids")).alias("n_tokens"),
        (F.max(F.size("input_ids")) <= 512).alias("fits"),
    )


# -- counts and budgets -------------------------------------------------------------------


@query(
    "token_stats",
    f"""{SEGMENTS}, counts AS (SELECT id, sum(len({words("text")})) AS n FROM segs GROUP BY id)
SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total_tokens, round(avg(n), 6) AS mean_tokens,
  CAST(min(n) AS BIGINT) AS min_tokens, CAST(max(n) AS BIGINT) AS max_tokens, round(stddev_samp(n), 6) AS std_tokens FROM counts""",
)
def token_stats(spark, sf_dir):
    counted = _segments(spark, sf_dir).select(k.segment_word_count(F.col("segments")).alias("n"))
    return _rounded(k.token_stats(counted, "n"))


@query(
    "token_stats_documents",
    f"""WITH {DOC_COUNTS}
SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total_tokens, round(avg(n), 6) AS mean_tokens,
  CAST(min(n) AS BIGINT) AS min_tokens, CAST(max(n) AS BIGINT) AS max_tokens, round(stddev_samp(n), 6) AS std_tokens FROM counts""",
)
def token_stats_documents(spark, sf_dir):
    return _rounded(k.token_stats(_doc_counts(spark, sf_dir), "n"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query(
    "length_sample",
    f"""WITH {DOC_COUNTS}, first AS (SELECT n FROM counts ORDER BY id LIMIT 200)
SELECT count(*) AS sampled_rows, CAST(min(n) AS BIGINT) AS min_tokens, CAST(max(n) AS BIGINT) AS max_tokens,
  round(avg(n), 6) AS mean_tokens FROM first""",
)
def length_sample(spark, sf_dir):
    return _rounded(k.length_sample(_doc_counts(spark, sf_dir), "n", ["id"]))


@query(
    "step_budget",
    f"""WITH {DOC_COUNTS} SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_tokens,
  CAST(ceil(count(*) / 32) AS BIGINT) AS steps_by_rows, CAST(ceil(sum(n) / (32 * 4096)) AS BIGINT) AS steps_by_tokens
FROM counts""",
)
def step_budget(spark, sf_dir):
    return k.step_budget(_doc_counts(spark, sf_dir), "n", 32, 4096)


@query(
    "length_buckets",
    f"WITH {DOC_COUNTS} SELECT CAST(n // 64 AS BIGINT) AS length_bucket, count(*) AS n_rows FROM counts GROUP BY ALL",
)
def length_buckets(spark, sf_dir):
    rows = _doc_counts(spark, sf_dir).select(k.length_bucket(F.col("n"), 64).alias("length_bucket"))
    return rows.groupBy("length_bucket").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "order_by_length",
    f"WITH {DOC_COUNTS} SELECT id, CAST(n // 64 AS BIGINT) AS length_bucket FROM counts",
)
def order_by_length(spark, sf_dir):
    rows = k.order_by_length(_doc_counts(spark, sf_dir), F.col("n"), 64, SEED, ["id"])
    return rows.select("id", "length_bucket")


@query(
    "number_by_length",
    f"""WITH {DOC_COUNTS} SELECT id, CAST(n // 64 AS BIGINT) AS length_bucket,
  row_number() OVER (ORDER BY n // 64, md5(concat_ws(':', {SEED}, id))) - 1 AS position FROM counts""",
)
def number_by_length(spark, sf_dir):
    rows = k.number_by_length(_doc_counts(spark, sf_dir), F.col("n"), 64, SEED, ["id"])
    return rows.select("id", "length_bucket", "position")


@query(
    "dataset_facts",
    "SELECT count(*) AS n_rows, 'id, text, lang, source, n_chars' AS columns FROM documents",
)
def dataset_facts(spark, sf_dir):
    return k.dataset_facts(shapes.documents(spark, sf_dir))


# -- previews ---------------------------------------------------------------------------------


@query(
    "preview_tokens",
    f"""SELECT id, CAST(len(ws) AS BIGINT) AS n_tokens, i - 1 AS pos, {WORD_ID} AS token_id, word AS token_text
FROM (SELECT id, ws, unnest(list_slice(ws, 1, 40)) AS word, generate_subscripts(list_slice(ws, 1, 40), 1) AS i
      FROM (SELECT doc_id AS id, {words("text")} AS ws FROM documents ORDER BY doc_id LIMIT 3))""",
)
def preview_tokens(spark, sf_dir):
    from chatloom.functions.basics import words as word_list

    first = shapes.documents(spark, sf_dir).select("id", "text").orderBy("id").limit(3)
    return k.preview_tokens(k.tokenize_text(first), "id", word_list(F.col("text")))


@query(
    "preview_labels",
    f"""{SEGMENTS}, {CHAT_WORDS},
totals AS (SELECT id, count(*) AS n_labels, count(*) FILTER (NOT train) AS n_masked FROM tokens GROUP BY id),
texts AS (SELECT id, string_agg(text, '' ORDER BY turn, part) FILTER (train) AS text FROM segs GROUP BY id)
SELECT id, n_labels, n_masked, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || ' ... [truncated, '
  || (length(text) - 200) || ' more chars]' ELSE text END AS trained_text
FROM totals JOIN texts USING (id) ORDER BY id LIMIT 3""",
)
def preview_labels(spark, sf_dir):
    rows = t.render_segments(
        shapes.chats(spark, sf_dir).orderBy("id").limit(3), "olmo3-think-sft", OPTIONS
    ).select("id", "segments")
    trained = t.segments_text(F.filter("segments", lambda s: s["train"]))
    kept = rows.withColumn("trained", trained)
    return k.preview_labels(k.tokenize(kept), "id", F.col("trained"))


@query(
    "preview_rows",
    """SELECT doc_id AS id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || ' …' ELSE text END AS text, source
FROM documents ORDER BY doc_id LIMIT 3""",
)
def preview_rows(spark, sf_dir):
    rows = shapes.documents(spark, sf_dir).select("id", "text", "source").orderBy("id")
    return k.preview_rows(rows, 3).withColumn("id", F.col("id").cast("bigint"))


_INSPECTED = Source("chats", "unused", transform="rename_to_messages", key=("id",))
FIRST_CHATS = "first AS (SELECT DISTINCT id FROM turns ORDER BY id LIMIT {})"


def _read_inspected(spark, sf_dir):
    renamed = shapes.chats(spark, sf_dir).withColumnRenamed("messages", "conversation")
    return lambda s, source: with_row_key(renamed, source.key)


@query(
    "inspect_formatted",
    f"""WITH {TURNS}, {FIRST_CHATS.format(5)}
SELECT id, string_agg('<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM turns JOIN first USING (id) GROUP BY id""",
)
def inspect_formatted(spark, sf_dir):
    shown = inspect_source(spark, _INSPECTED, "formatted", n=5, read=_read_inspected(spark, sf_dir))
    return shown.select(F.col("_row_key").cast("bigint").alias("id"), "text")


@query(
    "inspect_lengths",
    f"""WITH {TURNS}, {FIRST_CHATS.format(200)},
counts AS (
  SELECT id, sum(len({words("'<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)")})) AS n
  FROM turns JOIN first USING (id) GROUP BY id)
SELECT count(*) AS sampled_rows, CAST(min(n) AS BIGINT) AS min_tokens, CAST(max(n) AS BIGINT) AS max_tokens,
  round(avg(n), 6) AS mean_tokens FROM counts""",
)
def inspect_lengths(spark, sf_dir):
    return _rounded(inspect_source(spark, _INSPECTED, "lengths", read=_read_inspected(spark, sf_dir)))


# -- everything together ------------------------------------------------------------------------

_SFT_SOURCES = (
    Source("system", "unused", 2.5, "rename_to_messages", key=("id",)),
    Source("plain", "unused", 0.5, "rename_to_messages", key=("id",)),
)


def _read_by_opening(spark, source, sf_dir):
    facts = shapes.chat_facts(shapes.chats(spark, sf_dir))
    wanted = F.col("has_system") if source.name == "system" else ~F.col("has_system")
    return facts.where(wanted).select("id", F.col("messages").alias("conversation"))


SFT_ORDER = f"""ranked AS (
  SELECT CASE WHEN has_system THEN 0 ELSE 1 END AS dataset, id,
    md5(concat_ws(':', CASE WHEN has_system THEN 0 ELSE 1 END + {SEED}, id)) AS h FROM facts),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY h) AS rk, count(*) OVER (PARTITION BY dataset) AS n FROM ranked),
kept AS (
  SELECT * FROM (SELECT *, unnest([0, 1, 2]) AS copy FROM numbered)
  WHERE copy * n + rk <= CAST(round_even(CASE dataset WHEN 0 THEN CAST(2.5 AS DOUBLE) ELSE 0.5 END * n, 0) AS BIGINT)),
mixed AS (
  SELECT id, row_number() OVER (ORDER BY md5(concat_ws(':', 'shuffle', {SEED}, h, copy))) - 1 AS position FROM kept)"""


def prepare_sft_rows(spark, sf_dir):
    mix = Mix(_SFT_SOURCES, SEED, "olmo3-think-sft")
    return prepare_sft(
        spark,
        mix,
        options=OPTIONS,
        max_length=256,
        read=lambda s, source: _read_by_opening(s, source, sf_dir),
    )


PACKED_CHATS = f"""{SEGMENTS}, {CHAT_WORDS}, {FACTS}, {SFT_ORDER},
stream AS (
  SELECT token, train, row_number() OVER (ORDER BY position, turn, part, word_no) - 1 AS place
  FROM mixed JOIN tokens USING (id))
SELECT CAST(place // 256 AS BIGINT) AS bin, count(*) AS n_tokens, CAST(sum(token * (place % 256 + 1)) AS BIGINT) AS weighted_sum,
  count(*) FILTER (train) AS n_trained
FROM stream GROUP BY ALL"""


@query("prepare_sft", PACKED_CHATS)
def prepare_sft_query(spark, sf_dir):
    return _packed_chats(prepare_sft_rows(spark, sf_dir).rows)


def _packed_chats(packed):
    trained = F.size(F.filter("labels", lambda x: x != k.IGNORED)).cast("bigint")
    return packed.select("bin", *_weighted("input_ids"), trained.alias("n_trained"))


@query("prepare_once", PACKED_CHATS)
def prepare_once_query(spark, sf_dir):
    """The set of ``prepare_sft``, stored under its fingerprint and found again by it."""
    mix = Mix(_SFT_SOURCES, SEED, "olmo3-think-sft")
    settings = {"options": OPTIONS, "max_length": 256, "read": lambda s, source: _read_by_opening(s, source, sf_dir)}
    out = new_path(spark, "prepared")
    prepare_once(spark, mix, out, **settings)
    return _packed_chats(prepare_once(spark, mix, out, **settings).rows)


@query(
    "count_mix_tokens",
    f"""{SEGMENTS}, {CHAT_WORDS}, {FACTS}, {SFT_ORDER}
SELECT CASE WHEN has_system THEN 'system' ELSE 'plain' END AS dataset, count(DISTINCT position) AS n_rows, count(*) AS n_tokens
FROM mixed JOIN tokens USING (id) JOIN facts USING (id) GROUP BY ALL""",
)
def count_mix_tokens(spark, sf_dir):
    mix = Mix(_SFT_SOURCES, SEED, "olmo3-think-sft")
    return count_tokens(spark, mix, options=OPTIONS, read=lambda s, source: _read_by_opening(s, source, sf_dir))


@query(
    "mix_token_stats",
    f"""{SEGMENTS}, {CHAT_WORDS}, {FACTS}, {SFT_ORDER},
lengths AS (
  SELECT CASE WHEN has_system THEN 'system' ELSE 'plain' END AS dataset, position, count(*) AS n
  FROM mixed JOIN tokens USING (id) JOIN facts USING (id) GROUP BY ALL)
SELECT dataset, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total_tokens, round(avg(n), 6) AS mean_tokens, min(n) AS min_tokens,
  max(n) AS max_tokens, round(stddev_samp(n), 6) AS std_tokens
FROM lengths GROUP BY GROUPING SETS ((dataset), ())""",
)
def mix_token_stats_query(spark, sf_dir):
    """Token statistics of a mix that repeats one dataset and thins the other."""
    mix = Mix(_SFT_SOURCES, SEED, "olmo3-think-sft")
    stats = mix_token_stats(spark, mix, options=OPTIONS, read=lambda s, source: _read_by_opening(s, source, sf_dir))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_tokens", "std_tokens")})


def _read_pairs(spark, sf_dir):
    """The whole chat is the chosen side, its first two turns are the rejected one."""
    return shapes.chats(spark, sf_dir).select(
        "id", F.col("messages").alias("chosen"), F.slice("messages", 1, 2).alias("rejected")
    )


@query(
    "prepare_dpo",
    f"""{SEGMENTS}, {CHAT_WORDS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn, part, word_no) AS place FROM tokens),
chosen AS (
  SELECT id, count(*) AS n_chosen, count(*) FILTER (train) AS n_trained,
    CAST(sum(token * place) AS BIGINT) AS weighted_sum FROM numbered WHERE place <= 128 GROUP BY id)
SELECT id, n_chosen, n_trained, weighted_sum FROM chosen""",
)
def prepare_dpo_query(spark, sf_dir):
    mix = Mix((Source("pairs", "unused", key=("id",)),), SEED, "olmo3-think-sft")
    rows = prepare_dpo(
        spark, mix, options=OPTIONS, max_length=128, read=lambda s, source: _read_pairs(s, sf_dir)
    ).rows
    n, weighted = _weighted("chosen_input_ids")
    trained = F.size(F.filter("chosen_labels", lambda x: x != k.IGNORED)).cast("bigint")
    return rows.select("id", n.alias("n_chosen"), trained.alias("n_trained"), weighted)
