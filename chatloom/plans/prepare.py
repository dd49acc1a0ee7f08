"""From a list of datasets to a training-ready table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, fields, is_dataclass
from inspect import Parameter, signature
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.mixing import (
    KEY,
    Mix,
    Mixed,
    Part,
    Source,
    check_weights,
    mix_fingerprint,
    mix_parts,
    mix_stats,
    with_row_key,
)
from chatloom.operators.packing import pack_best_fit, pack_wrap
from chatloom.operators.registry import get_transform
from chatloom.operators.shaping import apply_transform, dpo_filter, keep_columns, sft_filter
from chatloom.operators.templates import RenderOptions, render_segments, require_markers, train_last_turn_only
from chatloom.operators.tokens import WORDS, FileTokenizer, segment_word_count, tokenize
from chatloom.sources.readers import load_dataset, read_prepared, stored_fingerprint, write_prepared

RowFilter = Callable[[DataFrame], DataFrame] | Column


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """Rows of one dataset with a unique row key."""
    df = load_dataset(
        spark,
        source.path,
        source.split,
        source.data_dir,
        source.subset,
        schema=source.schema,
        row_key=not source.key,
        splittable=source.splittable,
    )
    df = with_row_key(df, source.key)
    return df.repartition(source.spread, KEY) if source.spread else df


def shape_source(
    rows: DataFrame,
    source: Source,
    *,
    row_filter: RowFilter | None = None,
    keep: Sequence[str] | None = None,
    enforce_schema: bool = False,
    on_bad_row: str = "fail",
) -> DataFrame:
    """Transform, keep columns, filter: the row-wise part, one projection per dataset."""
    if source.transform is not None:
        try:
            get_transform(source.transform)
        except KeyError as unknown:
            raise KeyError(
                f"Dataset '{source.name}' asks for an unknown transform. {unknown.args[0]}"
            ) from unknown
        rows = apply_transform(
            rows,
            source.transform,
            drop_sources=keep is not None,
            enforce_schema=enforce_schema,
            on_bad_row=on_bad_row,
            carry=[KEY] if KEY in rows.columns else [],
        )
    if keep is not None:
        carry = [KEY] if KEY in rows.columns else []
        rows = keep_columns(rows, keep, source.name, carry)
    if row_filter is not None:
        rows = row_filter(rows) if callable(row_filter) and not isinstance(row_filter, Column) else rows.where(row_filter)
    return rows


def prepare_mix(
    spark: SparkSession,
    mix: Mix,
    *,
    row_filter: RowFilter | None = None,
    keep: Sequence[str] | None = None,
    enforce_schema: bool = False,
    on_bad_row: str = "fail",
    position: bool = False,
    partitions: int | None = None,
    read: Callable[[SparkSession, Source], DataFrame] = read_source,
    finish: Callable[[DataFrame, Source], DataFrame] | None = None,
    size: Column | None = None,
) -> Mixed:
    """Read, shape and mix all datasets. Datasets of weight zero are not read.

    *finish* adds row-wise work per dataset before the mix (rows that are then repeated
    need it once); *size* is a column of the finished rows to total up, see :func:`mix_parts`.
    """
    parts = mix_sources(
        spark, mix, row_filter=row_filter, keep=keep, enforce_schema=enforce_schema, on_bad_row=on_bad_row,
        read=read, finish=finish, size=size,
    )
    return mix_parts(parts, mix.seed, position=position, partitions=partitions)


def mix_sources(
    spark: SparkSession,
    mix: Mix,
    *,
    row_filter: RowFilter | None = None,
    keep: Sequence[str] | None = None,
    enforce_schema: bool = False,
    on_bad_row: str = "fail",
    read: Callable[[SparkSession, Source], DataFrame] = read_source,
    finish: Callable[[DataFrame, Source], DataFrame] | None = None,
    size: Column | None = None,
) -> list[Part]:
    """The datasets of a mix, read and shaped, with what :func:`mix_parts` needs to mix them."""
    check_weights(mix.sources)
    parts = []
    for source in mix.sources:
        if source.weight == 0:
            parts.append(Part(source.name, spark.createDataFrame([], f"{KEY} string"), 0.0))
            continue
        rows = shape_source(
            with_row_key(read(spark, source), source.key),
            source,
            row_filter=row_filter,
            keep=keep,
            enforce_schema=enforce_schema,
            on_bad_row=on_bad_row,
        )
        if finish is not None:
            rows = finish(rows, source)
        parts.append(Part(source.name, rows, source.weight, source.max_samples, size))
    return parts


def row_outcomes(spark: SparkSession, mix: Mix, read=read_source) -> DataFrame:
    """Per dataset with a transform: rows read, rejected (empty list) and bad (NULL list)."""
    out = None
    for source in mix.sources:
        if source.transform is None or source.weight == 0:
            continue
        rows = apply_transform(read(spark, source), source.transform, enforce_schema=True, on_bad_row="drop")
        size = F.size("messages")
        # Both counts look at one number per row, so the transform runs once.
        one = rows.select(F.explode(F.array(F.coalesce(size, F.lit(-1)))).alias("n")).agg(
            F.lit(source.name).alias("dataset"),
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(F.col("n") == 0).alias("rejected_rows"),
            F.count_if(F.col("n") < 0).alias("bad_rows"),
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("No dataset of the mix has a transform.")
    return out


def prepare_preferences(spark: SparkSession, mix: Mix, **options) -> Mixed:
    """Preference data: all columns stay, rows need non-empty ``chosen`` and ``rejected``."""
    return prepare_mix(spark, mix, row_filter=dpo_filter, **options)


@dataclass(frozen=True)
class Prepared:
    """Token rows, what became of each dataset, and the name of the mix."""

    rows: DataFrame
    manifest: DataFrame
    fingerprint: str

    def write(self, out: str) -> None:
        """Store rows, manifest and fingerprint, see :func:`~chatloom.sources.readers.write_prepared`."""
        write_prepared(self.rows, self.manifest, out, self.fingerprint)


def settings_fingerprint(mix: Mix, settings: Mapping[str, object]) -> str:
    """Names all that decides what a prepared set holds: the mix in the order given, with every field, and the settings.

    A tokenizer file counts by its content. A column is named by its expression and a function by its module and name, so
    a function that changes inside keeps its fingerprint.
    """

    def plain(value):
        if is_dataclass(value) and not isinstance(value, type):
            return {f.name: plain(getattr(value, f.name)) for f in fields(value)}
        if isinstance(value, Mapping):
            return {str(k): plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple)):
            return [plain(v) for v in value]
        if callable(value) and hasattr(value, "__qualname__"):
            return f"{value.__module__}.{value.__qualname__}"
        return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)

    text = json.dumps([plain(mix), plain(settings)], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def prepare_once(spark: SparkSession, mix: Mix, out: str, prepare: Callable[..., Prepared] | None = None, **settings) -> Prepared:
    """The prepared set in *out*; prepared by *prepare* (:func:`prepare_sft` if not given) and stored there if it is not there yet.

    The same mix and settings are found again and only read. A folder that holds another set is refused, and so is one
    that holds no whole set. The settings that only say how the work is done (``partitions``, ``staging``, ``read``) do not
    count. Data that changes under the same path is not noticed.
    """
    prepare = prepare or prepare_sft
    # Settings left out count with their defaults.
    defaults = {k: p.default for k, p in signature(prepare).parameters.items() if p.default is not Parameter.empty}
    counted = {k: v for k, v in {**defaults, **settings}.items() if k not in ("partitions", "staging", "read")}
    fingerprint = settings_fingerprint(mix, {"prepare": prepare, **counted})
    found = stored_fingerprint(spark, out)
    if found is None:
        made = prepare(spark, mix, **settings)
        Prepared(made.rows, made.manifest, fingerprint).write(out)
    elif found != fingerprint:
        raise FileExistsError(f"'{out}' holds another prepared set ({found}, asked for is {fingerprint}).")
    return Prepared(*read_prepared(spark, out), fingerprint)


def prepare_sft(
    spark: SparkSession,
    mix: Mix,
    *,
    tokenizer: str | FileTokenizer = WORDS,
    options: RenderOptions | None = None,
    max_length: int = 4096,
    packing: str | None = "wrap",
    last_turn_only: bool = False,
    on_bad_row: str = "fail",
    partitions: int | None = None,
    read: Callable[[SparkSession, Source], DataFrame] = read_source,
    staging: str | None = None,
) -> Prepared:
    """Everything up to tokens: shape, render, mask, encode, mix, then pack or cut.

    *packing* is ``'wrap'``, ``'best_fit'`` or None. The template must mark the trained text.
    Encoding comes before the mix, so repeated rows are encoded once. The mix looks at each
    row's length first and at its tokens later; with a *staging* folder the encoded rows are
    written there in between, which saves encoding them a second time.
    """
    if packing not in (None, "wrap", "best_fit"):
        raise ValueError(f"packing must be 'wrap', 'best_fit' or None, got '{packing}'.")
    template = require_markers(mix.chat_template)
    places = count()

    def encode(rows: DataFrame, source: Source) -> DataFrame:
        rows = render_segments(rows, template, options, on_bad_row).drop("messages")
        if last_turn_only:
            rows = rows.withColumn("segments", train_last_turn_only(F.col("segments")))
        if not isinstance(tokenizer, FileTokenizer):
            # Counting words is cheaper than encoding them, and the first pass only counts.
            rows = rows.withColumn("n_tokens", segment_word_count(F.col("segments")))
        cut = None if packing == "wrap" else max_length
        rows = tokenize(rows, tokenizer, cut)
        if isinstance(tokenizer, FileTokenizer):
            rows = rows.withColumn("n_tokens", F.size("input_ids"))
        elif cut is not None:
            rows = rows.withColumn("n_tokens", F.least("n_tokens", F.lit(cut)))
        if staging is not None:
            place = f"{staging}/{next(places):04d}"
            rows.write.mode("errorifexists").parquet(place)
            rows = spark.read.parquet(place)
        return rows

    mixed = prepare_mix(
        spark,
        mix,
        row_filter=sft_filter,
        keep=["messages"],
        enforce_schema=True,
        on_bad_row=on_bad_row,
        position=packing is not None,
        partitions=partitions,
        read=read,
        finish=encode,
        size=F.col("n_tokens"),
    )
    rows = mixed.rows
    if packing == "wrap":
        rows = pack_wrap(rows, max_length)
    elif packing == "best_fit":
        rows = pack_best_fit(rows, max_length)
    return Prepared(rows, mixed.manifest, mix_fingerprint(mix.sources))


def mix_token_stats(
    spark: SparkSession,
    mix: Mix,
    *,
    tokenizer: str | FileTokenizer = WORDS,
    options: RenderOptions | None = None,
    on_bad_row: str = "fail",
    read: Callable[[SparkSession, Source], DataFrame] = read_source,
) -> DataFrame:
    """Rows, total, mean, least, most and sample deviation of the tokens of the mixed chats, see :func:`mix_stats`.

    Chats are rendered and their tokens counted, once; no row of the mix is made.
    """

    def count_each(rows: DataFrame, source: Source) -> DataFrame:
        rendered = render_segments(rows, mix.chat_template, options, on_bad_row)
        if not isinstance(tokenizer, FileTokenizer):
            return rendered.select(KEY, segment_word_count(F.col("segments")).alias("n_tokens"))
        return tokenize(rendered, tokenizer, None).select(KEY, F.size("input_ids").alias("n_tokens"))

    parts = mix_sources(
        spark,
        mix,
        row_filter=sft_filter,
        keep=["messages"],
        enforce_schema=True,
        on_bad_row=on_bad_row,
        read=read,
        finish=count_each,
        size=F.col("n_tokens"),
    )
    return mix_stats(parts, mix.seed).withColumnsRenamed(
        {c: f"{c}_tokens" for c in ("total", "mean", "min", "max", "std")}
    )


def count_tokens(spark: SparkSession, mix: Mix, **options) -> DataFrame:
    """``(dataset, n_rows, n_tokens)`` of the mixed chats, repeated rows counted each time."""
    stats = mix_token_stats(spark, mix, **options).where(F.col("dataset").isNotNull())
    return stats.select("dataset", "n_rows", F.col("total_tokens").alias("n_tokens"))


def prepare_dpo(
    spark: SparkSession,
    mix: Mix,
    *,
    tokenizer: str | FileTokenizer = WORDS,
    options: RenderOptions | None = None,
    max_length: int = 2048,
    on_bad_row: str = "fail",
    partitions: int | None = None,
    read: Callable[[SparkSession, Source], DataFrame] = read_source,
) -> Prepared:
    """Preference pairs up to tokens: shape, render both sides, encode, cut at *max_length*, mix.

    Rows keep their columns except ``chosen`` and ``rejected``, which become ``<side>_input_ids`` and ``<side>_labels``.
    """

    def encode(rows: DataFrame, source: Source) -> DataFrame:
        for side in ("chosen", "rejected"):
            rows = render_segments(rows, mix.chat_template, options, on_bad_row, messages=side).drop(side)
            rows = tokenize(rows, tokenizer, max_length)
            rows = rows.withColumnsRenamed({"input_ids": f"{side}_input_ids", "labels": f"{side}_labels"})
        return rows

    mixed = prepare_preferences(
        spark, mix, on_bad_row=on_bad_row, partitions=partitions, read=read, finish=encode
    )
    return Prepared(mixed.rows, mixed.manifest, mix_fingerprint(mix.sources))
