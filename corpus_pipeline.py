"""A corpus in four stages: language ID, near duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``documents``, further columns included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import small_batches, stored
from chatloom.llm.language_crf import UNDETERMINED, fit_on, language
from chatloom.llm.packing_mbs import pack_documents
from chatloom.llm.simhash_bk import near_duplicate_components
from chatloom.llm.suffix_dedup import remove_repeats

#: A document goes if no language has at least this share of its words.
LEAST_LANGUAGE_SHARE = 0.4
#: Passages are made of strings of this many bytes that repeat, and have this many words at least. Fifty-one words of
#: fewer than three letters each can be shorter, and stay.
PASSAGE_BYTES = 200
PASSAGE_WORDS = 51
SEQUENCE_TOKENS = 1024


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Those without a letter go, and those of which no language has a fair share.

    The model learns from the documents' own labels. Where there are none, nothing is known and all documents stay.
    """
    small_batches(spark)
    model = fit_on(docs)
    if not model.labels:
        return docs
    # A struct beside the row keeps its name apart from any column of the documents.
    rows = docs.select(F.struct("*").alias("doc"), language(spark, "text", model).alias("found"))
    kept = rows.where((F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= LEAST_LANGUAGE_SHARE))
    return kept.select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id. Rows without id stay.

    Near copies are found by SimHash and BK-trees, then by MinHash bands where those lie too far apart, and all are verified.

    Rows that share an id count as one document and stay or go together.
    """
    small_batches(spark)
    groups = near_duplicate_components(docs)
    copies = groups.where(F.col("doc_id") > F.col("component")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also occur elsewhere; ``n_chars`` is that of what is left.

    NULL texts stay NULL. A text of which nothing is left is empty.
    """
    small_batches(spark)
    cut = remove_repeats(
        docs, min_bytes=PASSAGE_BYTES, min_words=PASSAGE_WORDS, whole_characters=True, carry=tuple(docs.columns)
    )
    text = F.when(F.col("carried.text").isNotNull(), F.decode("kept", "UTF-8"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[changed.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their ids, sequence and offset."""
    import public_tokenizers

    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=SEQUENCE_TOKENS)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: The stages use a trained model, hashes and a tokenizer that SQL does not have; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
