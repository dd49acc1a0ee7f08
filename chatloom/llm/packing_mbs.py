"""Packing by minimum bin slack.

Full windows are cut off each document; what is left over is shorter than a window. How many pieces there are of each
length is a histogram of at most *capacity* numbers, whatever the data, so the windows are planned on the driver: the
longest piece left opens a window, a subset-sum bitset over the remaining multiset finds the fullest sum that fits, and
walking back through the bitsets gives how many pieces of each length it takes. The same filling is used as often as the
counts allow. Spark ranks the pieces of each length and looks up the place of each rank in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.bpe import LibraryBpe, loaded, shared_file
from chatloom.llm.common import stored

#: Bytes of ids in one output batch of :func:`token_pieces`.
_BATCH_BYTES = 4 << 20


def token_pieces(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    capacity: int = 1024,
) -> DataFrame:
    """``(id, start, length, ids, doc_tokens)``: each document's ids and *end_id*, cut every *capacity* ids.

    *ids* are packed little-endian unsigned 32-bit integers. NULL and empty texts are *end_id* alone. A NULL id stays,
    repeated rows repeat, other columns are not read.
    """
    shared = shared_file(df.sparkSession, tokenizer)
    own = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out_type = own.select("id").schema.add("start", "long").add("length", "long").add("ids", "binary")
    out_type = out_type.add("doc_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(shared.value, LibraryBpe)
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows, starts, ids, totals, held = [], [], [], [], 0

            def flush() -> pa.RecordBatch:
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(totals, pa.int64()),
                ]
                return pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids", "doc_tokens"])

            for row, text in enumerate(batch.column(1)):
                packed = coder.encode(text.as_py() or "") + end
                for at in range(0, len(packed), step):
                    rows.append(row)
                    starts.append(at // 4)
                    ids.append(packed[at : at + step])
                    totals.append(len(packed) // 4)
                    held += len(ids[-1])
                    if held >= _BATCH_BYTES:
                        yield flush()
                        rows, starts, ids, totals, held = [], [], [], [], 0
            yield flush()

    return own.mapInArrow(run, out_type).withColumnRenamed("id", id_column)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill *room* best, as ``{length: pieces}``.

    A bit of an integer says whether a sum can be reached. Each length is added in powers of two, so *n* pieces need about
    log *n* shifts.
    """
    full, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if counts[n] and n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << length * take) & full
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    best, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            best -= length * take
            used[length] = used.get(length, 0) + take
    return used


def minimum_slack_plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Window fillings and how often each is used, ``[({length: pieces}, times)]``; together they use all *counts*.

    After each entry some length has fewer pieces left than the entry takes, so there are at most as many entries as
    ``capacity / length`` summed over the lengths, whatever the counts.
    """
    left = {length: n for length, n in counts.items() if n}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest(left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[length] // n for length, n in used.items())
        plan.append((used, times))
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return plan


def _powers(length: int) -> list[int]:
    return [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]


def _plan_rows(counts: dict[int, int], capacity: int, max_slack: int) -> list[tuple]:
    """``(length, first rank, end rank, per window, first sequence, first offset, cut)`` for all pieces."""
    rows, used_before, sequence = [], dict.fromkeys(counts, 0), 0
    for used, times in minimum_slack_plan(counts, capacity):
        total = sum(length * n for length, n in used.items())
        cut = capacity - total > max_slack and total & (total - 1) != 0
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            first = used_before[length]
            used_before[length] = end = first + n * times
            rows.append((length, first, end, n, sequence, offset, cut))
            offset += length * n
            if cut:
                sequence += n * times * len(_powers(length))
        sequence += 0 if cut else times
    return rows


def pack_pieces(
    pieces: DataFrame, capacity: int = 1024, max_slack: int = 8, order: tuple[str, ...] = (), rank_rows: int = 1000
) -> DataFrame:
    """*pieces* (``start``, ``length`` up to *capacity*, ``ids``) with ``sequence_id`` and ``offset``.

    Pieces of a window with more than *max_slack* free places are cut into powers of two instead, each a sequence of its
    own that needs no padding. *order* names columns that tell pieces apart; pieces equal in all of them are
    interchangeable. *pieces* is read twice and should be a stored table. An empty table gives none.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = spark.createDataFrame(
        _plan_rows(counts, capacity, max_slack),
        "_length long, _first long, _end long, _per long, _sequence long, _offset long, _cut boolean",
    )
    # Pieces of a frequent length are ranked in many small groups; a group's first rank is the sum of those before it.
    groups = F.create_map(*[F.lit(x).cast("long") for n, c in counts.items() for x in (n, 1 + c // rank_rows)])
    key = F.xxhash64(*order, "start") if order else F.xxhash64("ids", "start")
    ranked = pieces.withColumn("_group", F.pmod(key, F.element_at(groups, F.col("length"))))
    sizes = ranked.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_group").orderBy(*order, "start")
    ranked = ranked.withColumn("_row", F.row_number().over(within) - 1).join(sizes, ["length", "_group"])
    ranked = ranked.withColumn("_rank", F.col("_row") + F.col("_before"))
    # The plan's size is bounded by the capacity alone.
    placed = ranked.join(
        F.broadcast(plan), F.expr("length = _length AND _rank >= _first AND _rank < _end")
    ).withColumn("_place", F.expr("_rank - _first"))
    bits = range(capacity.bit_length() - 1, -1, -1)
    powers = F.filter(F.array(*[F.lit(1 << k).cast("long") for k in bits]), lambda p: p.bitwiseAND(F.col("length")) > 0)
    parts = F.transform(
        powers,
        lambda p, k: F.struct(
            # The larger powers come first, so what is above a power is the length without its lower bits.
            (F.col("length") - F.pmod(F.col("length"), p * 2)).alias("skip"),
            p.alias("length"),
            (F.col("_sequence") + F.col("_place") * F.size(powers) + k).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        ),
    )
    whole = F.struct(
        F.lit(0).cast("long").alias("skip"),
        F.col("length").alias("length"),
        F.expr("_sequence + _place div _per").alias("sequence_id"),
        F.expr("_offset + (_place % _per) * length").alias("offset"),
    )
    cut = placed.withColumn("_part", F.explode(F.when(F.col("_cut"), parts).otherwise(F.array(whole))))
    ids = F.when(
        F.col("_cut"), F.substring("ids", (F.col("_part.skip") * 4 + 1).cast("int"), (F.col("_part.length") * 4).cast("int"))
    ).otherwise(F.col("ids"))
    own = [c for c in pieces.columns if c not in ("start", "length", "ids", "sequence_id", "offset")]
    return cut.select(
        *own,
        (F.col("start") + F.col("_part.skip")).alias("start"),
        F.col("_part.length").alias("length"),
        ids.alias("ids"),
        F.col("_part.sequence_id").alias("sequence_id"),
        F.col("_part.offset").alias("offset"),
        F.col("_cut").alias("is_cut"),
    )


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    capacity: int = 1024,
    max_slack: int = 8,
) -> DataFrame:
    """All pieces of all documents with their ids and places; see :func:`token_pieces` and :func:`pack_pieces`."""
    pieces = stored(token_pieces(df, tokenizer, id_column, text_column, end_id, capacity), "pieces")
    packed = pack_pieces(pieces, capacity, max_slack, order=(id_column, "doc_tokens"))
    return packed.select(id_column, "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def pack_digests(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    capacity: int = 1024,
    max_slack: int = 8,
) -> DataFrame:
    """As :func:`pack_documents`, with the CRC-32 of the ids in their place: full pieces drop theirs before the shuffle."""
    pieces = token_pieces(df, tokenizer, id_column, text_column, end_id, capacity)
    full = F.col("length") == capacity
    slim = stored(
        pieces.withColumn("crc", F.crc32("ids")).withColumn("ids", F.when(full, F.lit(None)).otherwise(F.col("ids"))),
        "pieces",
    )
    packed = pack_pieces(slim, capacity, max_slack, order=(id_column, "doc_tokens", "crc"))
    crc: Column = F.when(F.col("is_cut"), F.crc32("ids")).otherwise(F.col("crc"))
    return packed.select(
        id_column, "start", "length", crc.alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
