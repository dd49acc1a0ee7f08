"""Looking at a dataset stage by stage, as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.mixing import KEY, Source
from chatloom.operators.shaping import apply_transform, first_message_list
from chatloom.operators.templates import RenderOptions, render_segments, segments_text
from chatloom.operators.tokens import (
    WORDS,
    FileTokenizer,
    dataset_facts,
    length_sample,
    preview_rows,
    preview_tokens,
    segment_word_count,
    tokenize,
)
from chatloom.plans.prepare import read_source

#: What a preview shows instead of a text.
NO_CHAT = "<no chat in this row>"
NOT_RENDERED = "<ERROR: template '{}' cannot render this chat>"

STAGES = ("raw", "transformed", "formatted", "tokens", "facts", "lengths")


def inspect_source(
    spark: SparkSession,
    source: Source,
    stage: str,
    *,
    template: str = "chatml",
    options: RenderOptions | None = None,
    tokenizer: str | FileTokenizer = WORDS,
    n: int = 3,
    sample_rows: int = 200,
    read=read_source,
) -> DataFrame:
    """One inspection stage of one dataset; the row key gives the order.

    The first *n* rows are picked before anything is rendered, so a preview costs a preview. The stage ``'formatted'`` has
    a line for each of them: where a chat cannot be rendered, or a row has no chat, the text says so. ``'tokens'`` and
    ``'lengths'`` pass over such rows.
    """
    if stage not in STAGES:
        raise ValueError(f"Unknown stage '{stage}'. Available: {', '.join(STAGES)}")
    raw = read(spark, source)
    if stage == "facts":
        return dataset_facts(raw.drop(KEY))
    # Row numbers at the end of a key are numbers, not text. Each task keeps only the rows asked for.
    number = F.regexp_extract(KEY, r"([0-9]+)$", 1).try_cast("decimal(38,0)")
    first = raw.orderBy(F.regexp_replace(KEY, r"[0-9]+$", ""), number, KEY).limit(sample_rows if stage == "lengths" else n)
    if stage == "raw":
        return preview_rows(first.drop(KEY), n)
    if source.transform is not None:
        carry = [KEY]
        first = apply_transform(first, source.transform, on_bad_row="drop", carry=carry)
    if stage == "transformed":
        return preview_rows(first.drop(KEY), n)
    chats = first.withColumn("messages", first_message_list(first))
    if stage == "formatted":
        shown = render_segments(chats, template, options, "null")
        broken = F.when(F.col("messages").isNull(), F.lit(NO_CHAT)).otherwise(F.lit(NOT_RENDERED.format(template)))
        text = F.when(F.col("segments").isNotNull() & F.col("messages").isNotNull(), segments_text()).otherwise(broken)
        return shown.select(KEY, text.alias("text"))
    chats = chats.where(F.col("messages").isNotNull())
    segments = render_segments(chats, template, options, "drop").select(KEY, "segments")
    if stage == "tokens":
        return preview_tokens(tokenize(segments, tokenizer), KEY, rows=n)
    if isinstance(tokenizer, FileTokenizer):
        return length_sample(tokenize(segments, tokenizer), F.size("input_ids"), [KEY], sample_rows)
    return length_sample(segments, segment_word_count(F.col("segments")), [KEY], sample_rows)
