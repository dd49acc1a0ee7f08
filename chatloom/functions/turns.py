"""Building blocks for lists of chat turns (``array<struct<content, role>>``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.basics import fail_when, let

MESSAGE_TYPE = T.StructType(
    [T.StructField("content", T.StringType()), T.StructField("role", T.StringType())]
)
MESSAGES_TYPE = T.ArrayType(MESSAGE_TYPE)


def no_turns() -> Column:
    """The empty message list, which the row filter removes."""
    return F.array().cast(MESSAGES_TYPE)


def turn(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(content.cast("string").alias("content"), role.alias("role"))


def pair(user: Column, assistant: Column) -> Column:
    """``[user, assistant]``."""
    return F.array(turn("user", user), turn("assistant", assistant))


def with_system(system: Column, turns: Column) -> Column:
    """Put a system turn first when *system* is neither NULL nor empty."""
    return F.when(
        F.length(system) > 0, F.concat(F.array(turn("system", system)), turns)
    ).otherwise(turns)


def narrow(turns: Column) -> Column:
    """Keep only ``content`` and ``role`` of each turn."""
    return F.transform(turns, lambda m: turn(m["role"], m["content"]))


def answer_after(context: Column, answer: Column, on_bad_row: str) -> Column:
    """``[*context, assistant answer]``; a NULL context is a bad row."""
    return fail_when(
        context.isNull(),
        "context is null",
        F.concat(narrow(context), F.array(turn("assistant", answer))),
        on_bad_row,
    )


def role_from(role: Column, names: Mapping[str, str]) -> Column:
    """Look up a role name; NULL for a role that is not in *names*."""
    out = F.lit(None).cast("string")
    for old, new in names.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


def merge_turns(turns: Column, fields: list[str], on_bad_row: str) -> Column:
    """Join neighbouring turns of one role, contents separated by a newline.

    The first turn's other fields stay. Runs are cut out by their start positions
    (array access is constant time), so the cost is linear in the list, also for
    very long chats. A NULL content inside a run of two or more is a bad row.
    """

    def merge(m: Column) -> Column:
        def is_start(i: Column) -> Column:
            return (i == 0) | ~F.get(m, i)["role"].eqNullSafe(F.get(m, i - 1)["role"])

        starts = F.when(
            F.size(m) > 0, F.filter(F.sequence(F.lit(0), F.size(m) - 1), is_start)
        ).otherwise(F.array().cast("array<int>"))

        def cut(s: Column) -> Column:
            def one(first: Column, k: Column) -> Column:
                length = F.coalesce(F.get(s, k + 1), F.size(m)) - first
                run = F.transform(F.slice(m, first + 1, length), lambda t: t["content"])
                text = F.when(length == 1, F.get(m, first)["content"]).otherwise(
                    F.array_join(run, "\n")
                )
                if on_bad_row == "fail":
                    text = fail_when(
                        (length > 1) & F.exists(run, lambda c: c.isNull()),
                        "null content in a run of turns of one role",
                        text,
                    )
                return F.struct(
                    *[
                        (text if f == "content" else F.get(m, first)[f]).alias(f)
                        for f in fields
                    ]
                )

            return F.transform(s, one)

        merged = let(starts, cut)
        if on_bad_row == "drop":
            neighbours = F.sequence(F.lit(1), F.size(m) - 1)
            broken = (F.size(m) > 1) & F.exists(
                neighbours,
                lambda i: ~is_start(i)
                & (F.get(m, i)["content"].isNull() | F.get(m, i - 1)["content"].isNull()),
            )
            merged = F.when(broken, F.lit(None)).otherwise(merged)
        return merged

    return let(turns, merge)


def flatten_turns(df, *ids: str):
    """One row per turn: ids, ``pos``, ``role``, ``content``."""
    return df.select(*ids, F.posexplode("messages").alias("pos", "m")).select(
        *ids, F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content"
    )
