"""Applying transforms, keeping columns, enforcing the message schema, row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.basics import check_policy
from chatloom.functions.turns import MESSAGES_TYPE, narrow
from chatloom.operators import transforms  # noqa: F401  (fills the registry)
from chatloom.operators.registry import get_transform


def apply_transform(
    df: DataFrame,
    name: str,
    *,
    drop_sources: bool = False,
    enforce_schema: bool = False,
    on_bad_row: str = "fail",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Add (or, with *drop_sources* / *enforce_schema*, leave only) ``messages``.

    *carry* names bookkeeping columns that stay in any case.
    """
    check_policy(on_bad_row)
    transform = get_transform(name)
    if transform.row_function:
        return _apply_row_function(df, transform.fn, drop_sources or enforce_schema, on_bad_row, carry)
    schema = T.StructType([f for f in df.schema.fields if f.name not in carry])
    messages = transform.fn(schema, on_bad_row)
    if enforce_schema:
        messages = _narrow_if_wide(df, messages)
    if drop_sources or enforce_schema:
        return df.select(*carry, messages.alias("messages"))
    return df.withColumn("messages", messages)


def _narrow_if_wide(df: DataFrame, messages: Column) -> Column:
    out_type = df.select(messages.alias("m")).schema["m"].dataType
    if [f.name for f in out_type.elementType.fields] == ["content", "role"]:
        return messages
    return narrow(messages)


def _apply_row_function(
    df: DataFrame, fn, replace: bool, on_bad_row: str, carry: Sequence[str]
) -> DataFrame:
    """Run a ``dict -> dict`` function in Arrow batches."""
    if replace:
        kept = [df.schema[c] for c in carry]
    else:
        kept = [f for f in df.schema.fields if f.name != "messages"]
    schema = T.StructType([*kept, T.StructField("messages", MESSAGES_TYPE)])
    names = [f.name for f in kept]
    hidden = set(carry)

    def run(batches):
        import pyarrow as pa

        turns_type = pa.list_(pa.struct([("content", pa.string()), ("role", pa.string())]))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    turns = fn({k: v for k, v in row.items() if k not in hidden})["messages"]
                    out.append([{"content": t["content"], "role": t["role"]} for t in turns])
                except Exception:
                    if on_bad_row == "fail":
                        raise
                    out.append(None)
            columns = [batch.column(n) for n in names] + [pa.array(out, turns_type)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "messages"])

    return df.mapInArrow(run, schema)


def enforce_messages(df: DataFrame) -> DataFrame:
    """Cast ``messages`` to the narrow ``{content, role}`` schema."""
    return df.withColumn("messages", narrow(F.col("messages")))


def keep_columns(df: DataFrame, wanted: Sequence[str], dataset: str = "", carry: Sequence[str] = ()) -> DataFrame:
    """Keep those of *wanted* that exist; none at all is an error."""
    present = [c for c in wanted if c in df.columns]
    if not present:
        raise KeyError(
            f"Dataset '{dataset}' has none of the columns {list(wanted)}; "
            f"it has {[c for c in df.columns if c not in carry]}."
        )
    return df.select(*carry, *[c for c in present if c not in carry])


def first_message_list(df: DataFrame, candidates: Sequence[str] = ("messages",)) -> Column:
    """The first candidate column that holds a non-empty list, else NULL."""
    present = [F.when(F.size(c) > 0, F.col(c)) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast(MESSAGES_TYPE)


def sft_filter(df: DataFrame) -> DataFrame:
    """Keep rows with a non-empty ``messages`` list.

    Written as a one-element ``explode``: a plain filter is pushed below the
    projection by the optimizer, and a costly transform would then run twice.
    """
    if "messages" not in df.columns:
        return df.where(F.lit(False))
    kept = F.filter(F.array(F.col("messages")), lambda m: F.size(m) > 0)
    others = [c for c in df.columns if c != "messages"]
    return df.select(*others, F.explode(kept).alias("messages")).select(*df.columns)


def dpo_filter(df: DataFrame) -> DataFrame:
    """Keep rows whose ``chosen`` and ``rejected`` (text or list) are non-empty."""

    def filled(name: str) -> Column:
        if name not in df.columns:
            return F.lit(False)
        if isinstance(df.schema[name].dataType, T.ArrayType):
            return F.size(name) > 0
        return F.length(name) > 0

    return df.where(filled("chosen") & filled("rejected"))
