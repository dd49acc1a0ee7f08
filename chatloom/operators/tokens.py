"""Tokens: encode rendered chats, mask labels, truncate, count, preview, budget.

Two encoders: :data:`WORDS`, white-space words with hashed ids, which is a native column
expression; and any ``tokenizers`` file, which runs in Arrow batches with one tokenizer per
Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.basics import hash_bucket, let, order_hash, word_count, words
from chatloom.operators.templates import segments_text

IGNORED = -100  # fixed value: label of a token that is not trained on


@dataclass(frozen=True)
class FileTokenizer:
    """A ``tokenizers`` JSON, read once on the driver and sent with the task."""

    definition: str

    @classmethod
    def from_file(cls, path: str) -> FileTokenizer:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())


WORDS = "words"


def word_id(word: Column) -> Column:
    """Id of a white-space word: the first 28 bits of its md5."""
    return F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("int")


# -- encode and mask ----------------------------------------------------------------


def tokenize(
    df: DataFrame, tokenizer: str | FileTokenizer = WORDS, max_length: int | None = None
) -> DataFrame:
    """Replace ``segments`` by ``input_ids`` and ``labels``, cut at *max_length*.

    A label equals its id inside trained spans and is -100 elsewhere; a token that crosses
    the edge of a span counts as inside.
    """
    if isinstance(tokenizer, FileTokenizer):
        encode = _masked_encoder(tokenizer.definition, max_length)
        encoded = encode(segments_text(), _signed_lengths(F.col("segments")))
    else:
        encoded = _word_tokens(F.col("segments"), max_length)
    return (
        df.withColumn("_encoded", encoded)
        .withColumn("input_ids", F.col("_encoded.input_ids"))
        .withColumn("labels", F.col("_encoded.labels"))
        .drop("_encoded", "segments")
    )


def tokenize_text(
    df: DataFrame,
    tokenizer: str | FileTokenizer = WORDS,
    text: str = "text",
    max_length: int | None = None,
) -> DataFrame:
    """Add ``input_ids`` of a plain text column, cut at *max_length*."""
    if isinstance(tokenizer, FileTokenizer):
        return df.withColumn("input_ids", _text_encoder(tokenizer.definition, max_length)(F.col(text)))
    return df.withColumn("input_ids", F.transform(_cut(words(F.col(text)), max_length), word_id))


def _cut(tokens: Column, max_length: int | None) -> Column:
    return tokens if max_length is None else F.slice(tokens, 1, max_length)


def _word_tokens(segments: Column, max_length: int | None) -> Column:
    tokens = F.flatten(
        F.transform(
            segments,
            lambda s: F.transform(
                words(s["text"]), lambda w: F.struct(w.alias("word"), s["train"].alias("train"))
            ),
        )
    )

    def encode(t: Column) -> Column:
        ids = F.transform(t, lambda x: F.struct(word_id(x["word"]).alias("id"), x["train"].alias("train")))
        return let(
            ids,
            lambda known: F.struct(
                known["id"].alias("input_ids"),
                F.transform(known, lambda x: F.when(x["train"], x["id"]).otherwise(IGNORED)).alias("labels"),
            ),
        )

    return encode(_cut(tokens, max_length))


def _signed_lengths(segments: Column) -> Column:
    """Lengths of the segments, in order; the sign tells trained (+) from not trained (-).

    A length is stored plus one, so that an empty segment keeps its sign.
    """
    return F.transform(
        segments,
        lambda s: F.when(s["train"], F.length(s["text"]) + 1).otherwise(-F.length(s["text"]) - 1),
    )


# Texts encoded at a time: the encoder's own records are far larger than the ids.
_ENCODE_ROWS = 64


def _load_encoder(definition: str):
    """The tokenizer, once per Python worker task; Spark's tasks are the parallelism."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_str(definition)
    encoder.no_padding()
    encoder.no_truncation()
    return encoder


def _list_array(rows: list, valid: list[bool]) -> pa.Array:
    """``array<int>`` from one numpy array per row, without a Python object per token."""
    import numpy as np

    ends = np.cumsum([0, *map(len, rows)])
    values = pa.array(np.concatenate([np.empty(0, np.int32), *rows]), pa.int32())
    bounds = pa.array(ends.astype(np.int32), mask=~np.array([*valid, True]))
    return pa.ListArray.from_arrays(bounds, values)


def _text_encoder(definition: str, max_length: int | None):
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        encoder = _load_encoder(definition)
        for texts in batches:
            rows, valid = [], []
            for at in range(0, len(texts), _ENCODE_ROWS):
                part = texts.slice(at, _ENCODE_ROWS).to_pylist()
                found = encoder.encode_batch_fast([t or "" for t in part], add_special_tokens=False)
                rows.extend(np.asarray(e.ids, np.int32)[:max_length] for e in found)
                valid.extend(t is not None for t in part)
            yield _list_array(rows, valid)

    return encode


def _masked_encoder(definition: str, max_length: int | None):
    ignored = IGNORED

    @F.arrow_udf("struct<input_ids:array<int>,labels:array<int>>")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import numpy as np

        encoder = _load_encoder(definition)

        def mask(ids, offsets, lengths):
            """Keep the ids of tokens that overlap a trained span."""
            signed = np.asarray(lengths, np.int64)
            trained = np.repeat(signed > 0, np.abs(signed) - 1)
            before = np.concatenate([[0], np.cumsum(trained)])
            bounds = np.minimum(np.asarray(offsets, np.int64).reshape(-1, 2), len(trained))
            inside = before[bounds[:, 1]] > before[bounds[:, 0]]
            return np.where(inside, ids, ignored).astype(np.int32)

        for texts, spans in batches:
            all_ids, all_labels, valid = [], [], []
            for at in range(0, len(texts), _ENCODE_ROWS):
                part = texts.slice(at, _ENCODE_ROWS).to_pylist()
                lengths = spans.slice(at, _ENCODE_ROWS).to_pylist()
                found = encoder.encode_batch([t or "" for t in part], add_special_tokens=False)
                for encoding, spans_of_row in zip(found, lengths, strict=True):
                    ids = np.asarray(encoding.ids, np.int32)
                    all_ids.append(ids[:max_length])
                    all_labels.append(mask(ids, encoding.offsets, spans_of_row or [])[:max_length])
                valid.extend(t is not None for t in part)
            yield pa.StructArray.from_arrays(
                [_list_array(all_ids, valid), _list_array(all_labels, valid)], names=["input_ids", "labels"]
            )

    return encode


def truncate(df: DataFrame, length: int, columns: Sequence[str] = ("input_ids", "labels")) -> DataFrame:
    """Cut token lists at *length*."""
    present = {c: F.slice(c, 1, length) for c in columns if c in df.columns}
    return df.withColumns(present)


# -- counting -----------------------------------------------------------------------


def segment_word_count(segments: Column) -> Column:
    """Number of word tokens of a rendered chat, without encoding it."""
    return F.aggregate(
        F.transform(segments, lambda s: word_count(s["text"])), F.lit(0), lambda acc, n: acc + n
    )


def token_stats(df: DataFrame, n_tokens: Column | str) -> DataFrame:
    """Rows, total, mean, min, max, and sample standard deviation, as one aggregate."""
    n = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    return df.agg(
        F.count(n).alias("n_rows"),
        F.sum(n).cast("bigint").alias("total_tokens"),
        F.avg(n).alias("mean_tokens"),
        F.min(n).cast("bigint").alias("min_tokens"),
        F.max(n).cast("bigint").alias("max_tokens"),
        F.stddev_samp(n).alias("std_tokens"),
    )


def length_sample(df: DataFrame, n_tokens: Column | str, order_by: Sequence[str], rows: int = 200) -> DataFrame:
    """Min, max and mean length of the first *rows* rows; rows without a length are skipped."""
    n = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    first = df.orderBy(*order_by).limit(rows).select(n.alias("_n")).where(F.col("_n").isNotNull())
    return first.agg(
        F.count(F.lit(1)).alias("sampled_rows"),
        F.min("_n").cast("bigint").alias("min_tokens"),
        F.max("_n").cast("bigint").alias("max_tokens"),
        F.avg("_n").alias("mean_tokens"),
    )


def steps_for_rows(rows: int, effective_batch: int) -> int:
    """Training steps for a number of rows."""
    _positive(rows=rows, effective_batch=effective_batch)
    return math.ceil(rows / effective_batch)


def steps_for_tokens(tokens: int, effective_batch: int, max_length: int, packing: bool = True) -> int:
    """Training steps for a number of tokens; only packed sequences have a known size."""
    if not packing:
        raise ValueError("A token budget is only valid with packing.")
    _positive(tokens=tokens, effective_batch=effective_batch, max_length=max_length)
    return math.ceil(tokens / (effective_batch * max_length))


def _positive(**values: int) -> None:
    for name, value in values.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive, got {value}.")


def step_budget(
    df: DataFrame, n_tokens: Column | str, effective_batch: int, max_length: int
) -> DataFrame:
    """Rows, tokens, and the steps that one pass over the rows, or over the packed tokens, takes."""
    _positive(effective_batch=effective_batch, max_length=max_length)
    n = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_tokens")
    ).select(
        "n_rows",
        "n_tokens",
        F.ceil(F.col("n_rows") / effective_batch).cast("bigint").alias("steps_by_rows"),
        F.ceil(F.col("n_tokens") / (effective_batch * max_length)).cast("bigint").alias("steps_by_tokens"),
    )


def length_bucket(n_tokens: Column, width: int) -> Column:
    """Index of the length bucket of *width* tokens."""
    return F.floor(n_tokens / width).cast("bigint")


def order_by_length(df: DataFrame, n_tokens: Column, width: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Bring rows of similar length together, in a repeatable random order inside a bucket."""
    return df.withColumn("length_bucket", length_bucket(n_tokens, width)).orderBy(
        "length_bucket", order_hash(seed, *[F.col(k) for k in key])
    )


def number_by_length(df: DataFrame, n_tokens: Column, width: int, seed: int, key: Sequence[str]) -> DataFrame:
    """The order of :func:`order_by_length` as numbers: adds ``length_bucket`` and ``position`` from 0, without gaps.

    Rows are counted by length bucket and the first 16 bits of their order hash; sums of these counts tell where such a
    cell starts, and rows are ranked inside their cell. So neither a sort of all rows is needed nor a task for a whole
    length bucket, even if most rows have one length. Rows of equal *key* in a length bucket are ordered by content. A
    NULL length is a bucket of its own, the first one. Columns of the names used here are replaced.
    """
    content = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns])
    rows = df.withColumns({"length_bucket": length_bucket(n_tokens, width), "_ties": content})
    rows = rows.withColumn("_order", order_hash(seed, *[F.col(k) for k in key]))
    rows = rows.withColumn("_cell", hash_bucket(F.col("_order")))
    counts = rows.groupBy("length_bucket", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("length_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("length_bucket").agg(F.sum("_n").alias("_n"))
    totals = totals.select("length_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shorter"))
    inside = Window.partitionBy("length_bucket").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("length_bucket", "_cell", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_earlier"))
    same = cells["length_bucket"].eqNullSafe(totals["length_bucket"])
    starts = cells.join(totals, same).select(
        cells["length_bucket"].alias("_length"), F.col("_cell").alias("_at"), (F.col("_shorter") + F.col("_earlier")).alias("_first")
    )
    rank = Window.partitionBy("length_bucket", "_cell").orderBy("_order", "_ties")
    ranked = rows.withColumn("_rank", F.row_number().over(rank))
    placed = ranked.join(starts, F.col("length_bucket").eqNullSafe(F.col("_length")) & (F.col("_cell") == F.col("_at")))
    position = (F.col("_first") + F.col("_rank") - 1).alias("position")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("length_bucket", "position")], "length_bucket", position)


# -- previews -----------------------------------------------------------------------


def shorten(text: Column, limit: int, note: bool = False) -> Column:
    """Cut a long value for display; with *note* say how much is missing."""
    more = F.lit(" …")
    if note:
        missing = (F.length(text) - limit).cast("string")
        more = F.concat(F.lit(" ... [truncated, "), missing, F.lit(" more chars]"))
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), more)).otherwise(text)


def preview_rows(df: DataFrame, n: int = 3, limit: int = 500) -> DataFrame:
    """The first *n* rows as text, long values cut."""

    def shown(name: str, kind: str) -> Column:
        text = F.col(name) if kind == "string" else F.to_json(F.struct(F.col(name).alias("v")))
        if kind != "string":
            text = F.regexp_replace(text, r"^\{(?:\"v\":)?|\}$", "")
        return shorten(text, limit).alias(name)

    return df.limit(n).select(*[shown(name, kind) for name, kind in df.dtypes])


def preview_tokens(df: DataFrame, id_column: str, decode: Column | None = None, rows: int = 3, first: int = 40) -> DataFrame:
    """The first tokens of the first rows, one per line, with the row's length.

    *decode* is an optional array column of the tokens' texts.
    """
    head = df.orderBy(id_column).limit(rows).select(
        id_column,
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        F.slice("input_ids", 1, first).alias("_ids"),
        (F.slice(decode, 1, first) if decode is not None else F.lit(None).cast("array<string>")).alias("_texts"),
    )
    return head.select(id_column, "n_tokens", "_texts", F.posexplode("_ids").alias("pos", "token_id")).select(
        id_column,
        "n_tokens",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("token_id").cast("bigint").alias("token_id"),
        F.get("_texts", F.col("pos")).alias("token_text"),
    )


def label_counts(labels: Column | str = "labels") -> tuple[Column, Column]:
    """``(all labels, masked labels)`` per row."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    masked = F.size(F.filter(labels, lambda x: x == IGNORED))
    return F.size(labels).cast("bigint").alias("n_labels"), masked.cast("bigint").alias("n_masked")


def preview_labels(df: DataFrame, id_column: str, trained_text: Column, n: int = 3, limit: int = 200) -> DataFrame:
    """Label counts and the trained-on text of the first rows; no text where all is masked."""
    total, masked = label_counts()
    shown = F.when(F.exists("labels", lambda x: x != IGNORED), shorten(trained_text, limit, note=True))
    return df.orderBy(id_column).limit(n).select(id_column, total, masked, shown.alias("trained_text"))


def dataset_facts(df: DataFrame) -> DataFrame:
    """Row count and column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "columns", F.lit(", ".join(df.columns))
    )
