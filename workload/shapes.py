"""Input shapes for the queries, built from the sample tables.

Each shape is a row-wise view of a table, except chats: a chat is stored as one row per turn
and is one row in the library's data model, so its turns are gathered by chat id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, messages)``: one row per conversation, turns in order."""
    gathered = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("id"))
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    )
    turns = F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
    return gathered.select("id", turns.alias("messages"))


# The same chat with system turns as user turns: gives neighbours of one role.
RELABELED = """transform(messages, m -> struct(
  CASE m.role WHEN 'system' THEN 'user' ELSE m.role END AS role, m.content AS content))"""


def chat_facts(df: DataFrame) -> DataFrame:
    """Adds number of turns, first and last text, and whether a system turn opens the chat."""
    return df.select(
        "*",
        F.size("messages").alias("n"),
        F.expr("messages[0].content").alias("first_text"),
        F.expr("element_at(messages, -1).content").alias("last_text"),
        F.expr("messages[0].role = 'system'").alias("has_system"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per row, dealt out evenly: the sample files are single row groups."""
    return documents(spark, sf_dir).repartition("id")


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ``quality`` and ``toxic``, NULL where not labeled."""
    return documents(spark, sf_dir).join(
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), "id", "left"
    )


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, ts, tokens_seen)`` from events; error events carry no token count."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr("CASE WHEN event_type <> 'error' THEN event_id * 1000 + CAST(value AS BIGINT) END").alias("tokens_seen"),
        "event_type",
    )


def run_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, ts)``: each run starts with its first event of any kind."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("run"))
        .agg(F.min("ts").cast("timestamp").alias("ts"))
    )
