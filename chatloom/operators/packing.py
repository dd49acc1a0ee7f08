"""Packing token lists into sequences of a fixed length.

Rows come numbered by :func:`chatloom.operators.mixing.number_rows` or by the mix: ``position``
is a row's place in the shuffled order, ``start`` the number of tokens before it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack_wrap(df: DataFrame, length: int, columns: tuple[str, ...] = ("input_ids", "labels")) -> DataFrame:
    """Cut the stream of all tokens, in shuffled order, every *length* tokens.

    Needs ``start``. Returns ``bin`` and the token columns. Each row is cut where bins end, and the pieces meet
    by bin, so a group never holds more than *length* tokens.
    """
    columns = tuple(c for c in columns if c in df.columns)
    n = F.size(columns[0])
    first_bin = F.expr(f"start div {length}")
    last_bin = F.expr(f"(start + size({columns[0]}) - 1) div {length}")
    cut = df.select("start", *columns, F.explode(F.when(n > 0, F.sequence(first_bin, last_bin))).alias("bin"))
    skipped = F.greatest(F.col("bin") * length - F.col("start"), F.lit(0))
    upto = F.least((F.col("bin") + 1) * length - F.col("start"), n.cast("bigint"))
    pieces = cut.select(
        "bin",
        (F.col("start") + skipped).alias("at"),
        *[F.slice(c, (skipped + 1).cast("int"), (upto - skipped).cast("int")).alias(c) for c in columns],
    )
    ordered = F.sort_array(F.collect_list(F.struct("at", *columns)))
    joined = pieces.groupBy("bin").agg(ordered.alias("_pieces"))
    return joined.select("bin", *[F.flatten(F.col("_pieces")[c]).alias(c) for c in columns])


def _best_fit(length: int):
    """UDF ``array<int> -> array<array<int>>``: row lengths of a group to the row numbers of each bin."""

    @F.arrow_udf("array<array<int>>")
    def assign(groups: pa.Array) -> pa.Array:
        import bisect

        import numpy as np

        out = []
        for group in groups.to_pylist():
            sizes = np.asarray(group)
            bins: list[list[int]] = []
            room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
            for row in np.argsort(-sizes, kind="stable").tolist():
                need = int(sizes[row])
                if need == 0:
                    break
                at = bisect.bisect_left(room, (need, -1))
                if at < len(room):
                    free, number = room.pop(at)
                else:
                    free, number = length, len(bins)
                    bins.append([])
                bins[number].append(row)
                bisect.insort(room, (free - need, number))
            out.append([sorted(members) for members in bins])
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    return assign


def pack_best_fit(
    df: DataFrame,
    length: int,
    columns: tuple[str, ...] = ("input_ids", "labels"),
    long_rows: str = "split",
    group_tokens: int = 1 << 20,
) -> DataFrame:
    """Put whole rows into bins of *length* tokens, the longest first, each where it leaves least room.

    Needs ``position`` and ``start``. A row longer than *length* becomes several rows (*long_rows* is ``'split'``) or
    loses its end (``'cut'``). Rows without tokens are in no bin. Bins are filled inside groups of rows that start in the
    same *group_tokens* tokens of the shuffled order, so a group is bounded and results do not depend on partitioning.
    Rows move once, to their group; only their lengths go to Python. Returns ``group``, ``bin``, the token columns and
    ``row_lengths``.
    """
    if long_rows not in ("split", "cut"):
        raise ValueError(f"long_rows must be 'split' or 'cut', got '{long_rows}'.")
    columns = tuple(c for c in columns if c in df.columns)
    last = F.expr(f"(size({columns[0]}) - 1) div {length}") if long_rows == "split" else F.lit(0).cast("bigint")
    pieces = F.explode(F.when(F.size(columns[0]) > 0, F.sequence(F.lit(0).cast("bigint"), last))).alias("_piece")
    rows = df.select("position", "start", *columns, pieces)
    skipped = (F.col("_piece") * length).cast("int")
    cut = rows.select(
        F.expr(f"(start + _piece * {length}) div {group_tokens}").alias("group"),
        F.struct("position", "_piece", *[F.slice(c, skipped + 1, length).alias(c) for c in columns]).alias("_row"),
    )
    groups = cut.groupBy("group").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    sizes = F.transform("_rows", lambda r: F.size(r[columns[0]]))
    binned = groups.withColumn("_bins", _best_fit(length)(sizes))

    def column_of(members: Column, name: str) -> Column:
        return F.transform(members, lambda i: F.get("_rows", i)[name])

    def fill(members: Column) -> Column:
        lengths = F.transform(column_of(members, columns[0]), F.size)
        return F.struct(
            *[F.flatten(column_of(members, c)).alias(c) for c in columns], lengths.alias("row_lengths")
        )

    # Bins are filled before the explode: it then carries one bin per row, not the whole group.
    filled = binned.select("group", F.posexplode(F.transform("_bins", fill)).alias("bin", "_packed"))
    return filled.select("group", F.col("bin").cast("bigint").alias("bin"), "_packed.*")
