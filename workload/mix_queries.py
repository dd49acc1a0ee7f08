"""Mixing, sampling, shuffling, filters and schema queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.folders import new_path
from chatloom.functions.turns import flatten_turns, merge_turns
from chatloom.operators.mixing import (
    Mix,
    Part,
    Source,
    check_weights,
    mix_parts,
    number_rows,
    sample_exact,
    with_row_key,
)
from chatloom.operators.registry import get_transform, register_transform, transform_names
from chatloom.operators.shaping import (
    apply_transform,
    dpo_filter,
    enforce_messages,
    first_message_list,
    keep_columns,
    sft_filter,
)
from chatloom.plans.prepare import prepare_mix, prepare_preferences, row_outcomes
from chatloom.sources.readers import list_splits, load_dataset, map_tags
from workload import shapes
from workload.transform_queries import FACTS, RELABELED, TURNS, merged

QUERIES = {}
ORACLES = {}

SEED = 7


def query(name: str, sql: str | None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# -- mixing: documents split by language are the datasets -------------------------------


def _language_parts(spark, sf_dir, weights, cap=None):
    docs = shapes.documents(spark, sf_dir).select("id", "lang", "n_chars")
    return [
        Part(lang, with_row_key(docs.where(F.col("lang") == lang), ["id"]), weight, cap)
        for lang, weight in weights.items()
    ]


def mix_sql(weights, cap=None) -> str:
    """CTEs up to ``placed``: every copy of every row, with its position."""
    rows = ", ".join(f"({i}, '{lang}', CAST({w} AS DOUBLE))" for i, (lang, w) in enumerate(weights.items()))
    capped = "count(*) OVER (PARTITION BY part)"
    if cap is not None:
        capped = f"least({capped}, {cap})"
    return f"""WITH parts(part, dataset, weight) AS (VALUES {rows}),
hashed AS (
  SELECT part, dataset, weight, doc_id AS id, n_chars, md5(concat_ws(':', part + {SEED}, doc_id)) AS h
  FROM documents JOIN parts ON lang = dataset),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY h) AS rk, {capped} AS n FROM hashed),
sized AS (SELECT *, CAST(round_even(weight * n, 0) AS BIGINT) AS target FROM ranked WHERE rk <= n),
copied AS (
  SELECT *, unnest(generate_series(0, CAST(target // n AS BIGINT))) AS copy FROM sized),
kept AS (SELECT * FROM copied WHERE copy * n + rk <= target),
placed AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', 'shuffle', {SEED}, h, copy))) - 1 AS position FROM kept)
"""


UNDER = {"en": 0.35, "fr": 0.5, "de": 0.25, "es": 0.75}
OVER = {"en": 1.25, "fr": 2.5, "de": 3.0, "es": 1.0}
BOTH = {"en": 0.6, "fr": 2.1, "de": 1.0, "es": 0.0}


@query("mix_under", mix_sql(UNDER) + "SELECT dataset, id, n_chars FROM placed")
def mix_under(spark, sf_dir):
    mixed = mix_parts(_language_parts(spark, sf_dir, UNDER), SEED)
    return mixed.rows.select(F.col("_dataset").alias("dataset"), "id", "n_chars")


@query("mix_over", mix_sql(OVER) + "SELECT dataset, id, n_chars FROM placed")
def mix_over(spark, sf_dir):
    mixed = mix_parts(_language_parts(spark, sf_dir, OVER), SEED)
    return mixed.rows.select(F.col("_dataset").alias("dataset"), "id", "n_chars")


@query("mix_full", mix_sql(BOTH) + "SELECT dataset, id, position FROM placed")
def mix_full(spark, sf_dir):
    mixed = mix_parts(_language_parts(spark, sf_dir, BOTH), SEED, position=True)
    return mixed.rows.select(F.col("_dataset").alias("dataset"), "id", "position")


@query(
    "mix_manifest",
    mix_sql(BOTH)
    + """SELECT dataset, weight, rows_before, coalesce(rows_after, 0) AS rows_after
FROM (SELECT dataset, weight, count(*) AS rows_before FROM hashed WHERE weight > 0 GROUP BY ALL
      UNION ALL SELECT dataset, weight, 0 FROM parts WHERE weight = 0)
LEFT JOIN (SELECT dataset, count(*) AS rows_after FROM kept GROUP BY ALL) USING (dataset)""",
)
def mix_manifest(spark, sf_dir):
    return mix_parts(_language_parts(spark, sf_dir, BOTH), SEED, shuffle=False).manifest


@query("mix_capped", mix_sql(OVER, 100) + "SELECT dataset, id, n_chars FROM placed")
def mix_capped(spark, sf_dir):
    mixed = mix_parts(_language_parts(spark, sf_dir, OVER, cap=100), SEED)
    return mixed.rows.select(F.col("_dataset").alias("dataset"), "id", "n_chars")


@query(
    "resample_to_size",
    f"""WITH ranked AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY md5(concat_ws(':', {SEED},
           md5('{{"conv_id":' || conv_id || ',"turn":' || turn || '}}')))) AS rk, count(*) OVER () AS n
  FROM conversations)
SELECT conv_id, turn FROM (SELECT *, unnest(generate_series(0, CAST(800 // n AS BIGINT))) AS copy FROM ranked) WHERE copy * n + rk <= 800""",
)
def resample_to_size(spark, sf_dir):
    turns = shapes.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return sample_exact(turns, 800, SEED, ["conv_id", "turn"])


@query(
    "resample_without_key",
    f"""WITH copies AS (
  SELECT quality, toxic, md5('{{"quality":' || quality || ',"toxic":' || toxic || '}}') AS content FROM labels),
keyed AS (SELECT *, content || ':' || row_number() OVER (PARTITION BY content) AS row_key FROM copies),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', {SEED}, row_key))) AS rk, count(*) OVER () AS n FROM keyed)
SELECT quality, toxic FROM (SELECT *, unnest(generate_series(0, CAST(300 // n AS BIGINT))) AS copy FROM ranked)
WHERE copy * n + rk <= 300""",
)
def resample_without_key(spark, sf_dir):
    return sample_exact(shapes.table(spark, sf_dir, "labels").select("quality", "toxic"), 300, SEED)


@query("load_split", "SELECT doc_id, lang, n_chars FROM documents")
def load_split(spark, sf_dir):
    return load_dataset(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")


@query(
    "read_csv_and_json",
    """SELECT 'csv' AS format, doc_id AS id, text, lang FROM documents
UNION ALL SELECT 'json', doc_id, text, lang FROM documents""",
)
def read_csv_and_json(spark, sf_dir):
    """Texts with line breaks and quotes through CSV, and through a folder that has JSON lists beside JSON lines."""
    docs = shapes.documents(spark, sf_dir).select("id", "text", "lang")
    out, schema = new_path(spark, "formats"), "id bigint, text string, lang string"
    cells = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(**cells).csv(f"{out}/cells.csv")
    # Lists of at most a thousand documents, each in a file of its own.
    listed = docs.where("lang <> 'en'").groupBy(F.expr("id div 1000").alias("n"))
    lists = listed.agg(F.to_json(F.collect_list(F.struct("id", "text", "lang"))).alias("value"))
    lists.select("value").write.option("maxRecordsPerFile", 1).text(f"{out}/mixed.json")
    docs.where("lang = 'en'").write.mode("append").json(f"{out}/mixed.json")
    frames = [
        load_dataset(spark, f"{out}/{name}", schema=schema).select(F.lit(kind).alias("format"), "id", "text", "lang")
        for name, kind in (("cells.csv", "csv"), ("mixed.json", "json"))
    ]
    return frames[0].union(frames[1])


@query(
    "read_text_lines",
    """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def read_text_lines(spark, sf_dir):
    out = new_path(spark, "lines") + "/lines.txt"
    shapes.documents(spark, sf_dir).select("text").write.text(out)
    return load_dataset(spark, out).groupBy(F.col("text").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "load_split_words",
    """SELECT CASE lang WHEN 'de' THEN 'test' ELSE 'train' END AS split, doc_id AS id, lang FROM documents
WHERE lang IN ('en', 'fr', 'de')""",
)
def load_split_words(spark, sf_dir):
    """``train`` reads all folders named for training data and none that is named for tests."""
    docs = shapes.documents(spark, sf_dir).select("id", "lang")
    out = new_path(spark, "splits")
    for folder, lang in (("train_sft", "en"), ("train-more", "fr"), ("test_sft", "de"), ("dev", "es")):
        docs.where(F.col("lang") == lang).write.parquet(f"{out}/{folder}")
    frames = [load_dataset(spark, out, name).select(F.lit(name).alias("split"), "id", "lang") for name in ("train", "test")]
    return frames[0].union(frames[1])


@query(
    "refused_weights",
    """SELECT lang AS dataset, CASE WHEN count(*) < 0.2 * (SELECT count(*) FROM documents) THEN 'weights must be non-negative'
  ELSE 'fine' END AS verdict FROM documents GROUP BY lang""",
)
def refused_weights(spark, sf_dir):
    """A weight for each language, negative for those with less than a fifth of the rows; one row for each comes to the driver."""
    counts = {r["lang"]: r["count"] for r in shapes.documents(spark, sf_dir).groupBy("lang").count().collect()}

    def verdict(lang: str) -> str:
        try:
            check_weights([Source(lang, "unused", counts[lang] / sum(counts.values()) - 0.2), Source("other", "unused")])
        except ValueError as refused:
            return str(refused).rpartition("; ")[2].rstrip(".")
        return "fine"

    return spark.createDataFrame([(lang, verdict(lang)) for lang in counts], "dataset string, verdict string")


@query(
    "shuffle_position",
    f"""SELECT doc_id AS id, row_number() OVER (ORDER BY md5(concat_ws(':', 'shuffle', {SEED},
  md5(concat_ws(':', {SEED}, doc_id)), 0))) - 1 AS position FROM documents""",
)
def shuffle_position(spark, sf_dir):
    return number_rows(shapes.documents(spark, sf_dir).select("id"), SEED, ["id"])


# -- the whole read-transform-filter-mix path ---------------------------------------------

_CHAT_SOURCES = (
    Source("replied", "unused", 0.5, "mt_bench_judgments", key=("id",)),
    Source("all", "unused", 2.0, "rename_to_messages", key=("id",)),
)


def _read_chats(spark, source, sf_dir):
    facts = shapes.chat_facts(shapes.chats(spark, sf_dir))
    if source.name == "all":
        return facts.select("id", F.col("messages").alias("conversation"))
    winner = F.when(F.col("has_system"), "tie").otherwise("model_b")
    return facts.select("id", F.col("messages").alias("conversation_b"), winner.alias("winner"))


@query(
    "prepare_mix",
    f"""WITH {TURNS}, {FACTS},
rows_in AS (
  SELECT 0 AS part, 0.5 AS weight, id, n FROM facts WHERE NOT has_system
  UNION ALL SELECT 1, 2.0, id, n FROM facts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY md5(concat_ws(':', part + {SEED}, id))) AS rk,
         count(*) OVER (PARTITION BY part) AS total FROM rows_in),
kept AS (
  SELECT * FROM (SELECT *, unnest([0, 1, 2]) AS copy FROM ranked)
  WHERE copy * total + rk <= CAST(round_even(CAST(weight AS DOUBLE) * total, 0) AS BIGINT))
SELECT CASE part WHEN 0 THEN 'replied' ELSE 'all' END AS dataset, pos, role, content
FROM kept JOIN turns USING (id)""",
)
def prepare_mix_query(spark, sf_dir):
    mixed = prepare_mix(
        spark,
        Mix(_CHAT_SOURCES, SEED),
        row_filter=sft_filter,
        keep=["messages"],
        enforce_schema=True,
        read=lambda s, source: _read_chats(s, source, sf_dir),
    )
    return flatten_turns(mixed.rows.withColumnRenamed("_dataset", "dataset"), "dataset")


@query(
    "row_outcomes",
    f"""WITH {FACTS} SELECT 'replied' AS dataset, count(*) AS rows_read, count(*) FILTER (has_system) AS rejected_rows,
  CAST(0 AS BIGINT) AS bad_rows FROM facts
UNION ALL SELECT 'all', count(*), 0, 0 FROM facts""",
)
def row_outcomes_query(spark, sf_dir):
    return row_outcomes(spark, Mix(_CHAT_SOURCES, SEED), read=lambda s, source: _read_chats(s, source, sf_dir))


_PREFERENCES = (Source("pairs", "unused", 1.5, key=("id",)),)


@query(
    "prepare_preferences",
    f"""WITH pairs AS (
  SELECT doc_id AS id, row_number() OVER (ORDER BY md5(concat_ws(':', {SEED}, doc_id))) AS rk, count(*) OVER () AS n
  FROM documents WHERE length(text) > 0 AND lang <> 'es')
SELECT id, length(text) AS chosen_chars, source AS rejected
FROM (SELECT *, unnest([0, 1]) AS copy FROM pairs) JOIN documents ON id = doc_id
WHERE copy * n + rk <= CAST(round_even(CAST(1.5 AS DOUBLE) * n, 0) AS BIGINT)""",
)
def prepare_preferences_query(spark, sf_dir):
    def read(s, source):
        rejected = F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("source"))
        return shapes.documents(s, sf_dir).select("id", F.col("text").alias("chosen"), rejected.alias("rejected"))

    mixed = prepare_preferences(spark, Mix(_PREFERENCES, SEED), read=read)
    return mixed.rows.select("id", F.length("chosen").cast("bigint").alias("chosen_chars"), "rejected")


# -- schema and filters ---------------------------------------------------------------------


@query(
    "filter_sft",
    f"WITH {TURNS}, {FACTS} SELECT id, n FROM facts WHERE has_system",
)
def filter_sft(spark, sf_dir):
    facts = shapes.chat_facts(shapes.chats(spark, sf_dir))
    emptied = facts.withColumn("messages", F.expr("IF(has_system, messages, slice(messages, 1, 0))"))
    return sft_filter(emptied).select("id", F.size("messages").cast("bigint").alias("n"))


@query(
    "filter_dpo",
    "SELECT doc_id AS id, length(text) AS chosen_chars FROM documents WHERE length(text) > 0 AND lang NOT IN ('en', 'de')",
)
def filter_dpo(spark, sf_dir):
    rejected = F.expr("CASE lang WHEN 'en' THEN array() WHEN 'de' THEN NULL ELSE array(source) END")
    rows = shapes.documents(spark, sf_dir).select("id", F.col("text").alias("chosen"), rejected.alias("rejected"))
    return dpo_filter(rows).select("id", F.length("chosen").cast("bigint").alias("chosen_chars"))


@query("keep_columns", "SELECT doc_id AS id, lang FROM documents")
def keep_columns_query(spark, sf_dir):
    return keep_columns(shapes.documents(spark, sf_dir), ["id", "messages", "lang"], "documents")


@query("enforce_messages", f"WITH {TURNS} SELECT id, pos, role, content FROM turns")
def enforce_messages_query(spark, sf_dir):
    wide = shapes.chats(spark, sf_dir).withColumn(
        "messages",
        F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.lit(1).alias("extra"), m["content"].alias("content"))),
    )
    return flatten_turns(enforce_messages(wide), "id")


@query(
    "first_message_list",
    f"WITH {TURNS}, {FACTS} SELECT id, pos, role, content FROM turns WHERE id NOT IN (SELECT id FROM facts WHERE n = 2 AND has_system)",
)
def first_message_list_query(spark, sf_dir):
    facts = shapes.chat_facts(shapes.chats(spark, sf_dir))
    split = facts.select(
        "id",
        F.expr("IF(has_system, slice(messages, 1, 0), messages)").alias("messages"),
        F.expr("IF(has_system AND n <> 2, messages, NULL)").alias("chosen"),
    )
    found = split.select("id", first_message_list(split, ["messages", "chosen"]).alias("messages"))
    return flatten_turns(found, "id")


@query(
    "append_messages",
    "SELECT doc_id AS id, lang, n_chars, 2 AS n_turns FROM documents",
)
def append_messages(spark, sf_dir):
    """Without a column list the transform's output is added and the originals stay."""
    rows = shapes.documents(spark, sf_dir).select(
        "id", "lang", "n_chars", F.col("source").alias("prompt"), F.col("text").alias("chosen")
    )
    added = apply_transform(rows, "human_like_dpo")
    return added.select("id", "lang", "n_chars", F.size("messages").alias("n_turns"))


@query(
    "merge_turns",
    f"WITH {TURNS}, {RELABELED}, {merged('relabeled')} SELECT id, pos, role, content FROM merged",
)
def merge_turns_query(spark, sf_dir):
    rows = shapes.chats(spark, sf_dir).select("id", F.expr(shapes.RELABELED).alias("messages"))
    return flatten_turns(
        rows.select("id", merge_turns(F.col("messages"), ["role", "content"], "fail").alias("messages")), "id"
    )


@query(
    "row_function_transform",
    """SELECT doc_id AS id, CAST(0 AS BIGINT) AS pos, 'user' AS role, upper(lang) AS content FROM documents
UNION ALL SELECT doc_id, CAST(1 AS BIGINT), 'assistant', source FROM documents""",
)
def row_function_transform(spark, sf_dir):
    if "example_row_function" not in transform_names():

        @register_transform("example_row_function", row_function=True)
        def example(row):
            return {
                "messages": [
                    {"role": "user", "content": row["lang"].upper()},
                    {"role": "assistant", "content": row["source"]},
                ]
            }

    assert get_transform("example_row_function").row_function
    rows = shapes.documents(spark, sf_dir).select("id", "lang", "source")
    shaped = apply_transform(rows, "example_row_function", enforce_schema=True, carry=["id"])
    return flatten_turns(shaped, "id")


# -- sources ----------------------------------------------------------------------------------


@query(
    "list_splits",
    " UNION ALL ".join(
        f"SELECT 'default' AS subset, '{t}' AS split, count(*) AS n_rows FROM {t}"
        for t in (
            "region nation customer supplier part orders lineitem events documents embeddings pages "
            "benchmark labels conversations"
        ).split()
    ),
)
def list_splits_query(spark, sf_dir):
    return list_splits(spark, sf_dir)


@query("tag_mapping", f"WITH {TURNS} SELECT id, pos, role, content FROM turns")
def tag_mapping(spark, sf_dir):
    tagged = shapes.chats(spark, sf_dir).select(
        "id",
        F.expr(
            """transform(messages, m -> struct(
              CASE m.role WHEN 'assistant' THEN 'gpt' WHEN 'user' THEN 'human' ELSE 'sys' END AS who, m.content AS said))"""
        ).alias("dialogue"),
    )
    tags = {
        "role_tag": "who",
        "content_tag": "said",
        "user_tag": "human",
        "assistant_tag": "gpt",
        "system_tag": "sys",
    }
    return flatten_turns(map_tags(tagged, {"messages": "dialogue"}, tags), "id")
