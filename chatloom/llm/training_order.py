"""Token sequences in training order: a keyed permutation, and shards that can be read from any place.

Every sequence gets a dense index, and a Feistel network with the run's key maps the index to its slot. The network permutes
the next power of four; an index that lands beyond the number of sequences goes through it again until it does not
(cycle-walking), which keeps it a permutation. No sort and no table of the order is needed: a slot follows from the key
alone. A shard is a range of slots, sorted, with records of one size, so record *k* of a shard is at ``k * stride`` and a
reader resumes at any slot by seeking.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.bpe import LibraryBpe, loaded, shared_file
from chatloom.llm.common import forget, stored
from chatloom.llm.warc import _file_system

#: A record's head: id of the row that the tokens are from (the least long is NULL), first token, number of tokens.
_HEAD = np.dtype([("id", "<i8"), ("start", "<i8"), ("length", "<u4")])
_NO_ID = -(1 << 63)
_ROUNDS = 4
_READ_RECORDS = 4096
#: The shards are written in so many parts, so that only a part of the ids is on disk once more as a shuffle.
_PARTS = 2
#: Offsets go to all tasks up to so many (16 bytes each); beyond, they are joined by a shuffle.
_SENT_PARTS = 1 << 18


def _mixed(half: np.ndarray, key: int, round_number: int, mask: int) -> np.ndarray:
    salt = (key * 0x9E3779B97F4A7C15 + (round_number + 1) * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1
    value = (half ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return (value ^ (value >> np.uint64(29))) & np.uint64(mask)


def slots_of(indexes: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slot below *size* of each index below *size*: a permutation that *key* chooses."""
    bits = max(1, -(-max(1, size - 1).bit_length() // 2))
    mask, shift = (1 << bits) - 1, np.uint64(bits)
    out = np.asarray(indexes).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & np.uint64(mask)
        for number in range(_ROUNDS):
            left, right = right, left ^ _mixed(right, key, number, mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def token_sequences(
    df: DataFrame, tokenizer: str, sequence_tokens: int = 256, token_bytes: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(part, row, id, start, length, tokens)``: all ids of all texts in sequences, numbered in each task's output.

    NULL and empty texts have no sequence. Ids must fit into *token_bytes* bytes. The numbers hold once the table is stored.
    """
    shared = shared_file(df.sparkSession, tokenizer)
    own = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, kind = loaded(shared.value, LibraryBpe), f"<u{token_bytes}"
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, starts, tokens = [], [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                wide = np.frombuffer(coder.encode(text.as_py() or ""), "<u4")
                if len(wide) and wide.max() >= 1 << 8 * token_bytes:
                    raise ValueError(f"Token id {wide.max()} needs more than {token_bytes} bytes")
                packed = wide.astype(kind)
                for start in range(0, len(packed), sequence_tokens):
                    ids.append(number)
                    starts.append(start)
                    tokens.append(packed[start : start + sequence_tokens].tobytes())
            n = len(ids)
            columns = [
                pa.array(np.full(n, part, np.int64)),
                pa.array(np.arange(row, row + n, dtype=np.int64)),
                pa.array(ids, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array(tokens, pa.binary()),
            ]
            row += n
            yield pa.RecordBatch.from_arrays(columns, names=["part", "row", "id", "start", "tokens"])

    return own.mapInArrow(run, "part long, row long, id long, start long, tokens binary")


def write_in_training_order(
    sequences: DataFrame, folder: str, key: int, sequence_tokens: int = 256, token_bytes: int = 2, shard_records: int = 65536
) -> DataFrame:
    """Write stored *sequences* to shards in *folder*; returns ``(shard, path, first_slot, records)``, stored.

    Each record is a head, the tokens, and zeros up to the stride. A shard is written under a temporary name until it is
    whole, so a task that runs again leaves one whole file with the same content.
    """
    spark = sequences.sparkSession
    counts = sequences.groupBy("part").agg(F.max("row").alias("last"))
    # One row for each task that wrote the sequences, in one running sum.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("before"))
    size, parts = counts.agg(F.coalesce(F.sum(F.col("last") + 1), F.lit(0)), F.count("*")).first()
    if parts <= _SENT_PARTS:
        offsets = F.broadcast(offsets)
    stride = _HEAD.itemsize + sequence_tokens * token_bytes

    @F.arrow_udf("long")
    def slot(indexes: pa.Array) -> pa.Array:
        return pa.array(slots_of(indexes.to_numpy(zero_copy_only=False), size, key))

    placed = sequences.join(offsets, "part").withColumn("slot", slot(F.col("row") + F.col("before")))
    placed = placed.select(F.expr(f"slot div {shard_records}").alias("shard"), "slot", "id", "start", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        shard = out = temporary = None
        first = count = 0

        def close() -> pa.RecordBatch:
            out.close()
            name = f"shard-{shard:08d}.bin"
            files.move(temporary, f"{root}/{name}")
            row = {"shard": [shard], "path": [f"{folder}/{name}"], "first_slot": [first], "records": [count]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            heads = np.zeros(batch.num_rows, _HEAD)
            heads["id"] = batch.column(2).fill_null(_NO_ID).to_numpy()
            heads["start"] = batch.column(3).to_numpy()
            tokens = batch.column(4).to_pylist()
            heads["length"] = [len(t) // token_bytes for t in tokens]
            for i, number in enumerate(numbers.tolist()):
                if number != shard:
                    if out is not None:
                        yield close()
                    shard, first, count = number, number * shard_records, 0
                    temporary = f"{root}/_shard-{shard:08d}.{uuid4().hex}"
                    out = files.open_output_stream(temporary, compression=None)
                out.write(heads[i].tobytes() + tokens[i].ljust(stride - _HEAD.itemsize, b"\0"))
                count += 1
        if out is not None:
            yield close()

    shards = -(-size // shard_records)
    step = max(1, -(-shards // _PARTS))
    written = []
    for first in range(0, max(1, shards), step):
        own = placed.where((F.col("shard") >= first) & (F.col("shard") < first + step))
        ordered = own.repartition("shard").sortWithinPartitions("shard", "slot")
        written.append(stored(ordered.mapInArrow(run, "shard long, path string, first_slot long, records long"), "shards"))
    return reduce(DataFrame.unionByName, written)


def read_in_training_order(
    shards: DataFrame, sequence_tokens: int = 256, token_bytes: int = 2, from_slot: int = 0
) -> DataFrame:
    """``(slot, id, start, tokens)`` of all records from slot *from_slot* on; earlier ones are skipped by seeking."""
    stride = _HEAD.itemsize + sequence_tokens * token_bytes
    todo = shards.where(F.col("first_slot") + F.col("records") > from_slot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = _file_system(row["path"])
                skipped = max(0, from_slot - row["first_slot"])
                slot = row["first_slot"] + skipped
                with files.open_input_file(path) as file:
                    file.seek(skipped * stride)
                    while data := file.read(stride * _READ_RECORDS):
                        if len(data) % stride:
                            raise ValueError(f"'{row['path']}' ends inside a record")
                        parts = [data[i : i + stride] for i in range(0, len(data), stride)]
                        heads = np.frombuffer(b"".join(p[: _HEAD.itemsize] for p in parts), _HEAD)
                        ids = pa.array(heads["id"].astype(np.int64), mask=heads["id"] == _NO_ID)
                        body = [p[_HEAD.itemsize :][: n * token_bytes] for p, n in zip(parts, heads["length"].tolist())]
                        columns = [
                            pa.array(np.arange(slot, slot + len(parts), dtype=np.int64)),
                            ids,
                            pa.array(heads["start"].astype(np.int64)),
                            pa.array(body, pa.binary()),
                        ]
                        slot += len(parts)
                        yield pa.RecordBatch.from_arrays(columns, names=["slot", "id", "start", "tokens"])

    # As many tasks as shards, up to a bound for the scheduler.
    files = todo.select("path", "first_slot").repartition(min(10000, max(1, todo.count())))
    return files.mapInArrow(run, "slot long, id long, start long, tokens binary")


def materialise(
    df: DataFrame,
    tokenizer: str,
    folder: str,
    key: int,
    sequence_tokens: int = 256,
    token_bytes: int = 2,
    shard_records: int = 65536,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All texts of *df* as shards in training order; returns the list of shards.

    NULL and empty texts have no sequence, a NULL id stays NULL, repeated rows have sequences of their own, and an empty
    table gives no shard. Other columns are not read.
    """
    sequences = stored(token_sequences(df, tokenizer, sequence_tokens, token_bytes, id_column, text_column), "sequences", compression="zstd")
    shards = write_in_training_order(sequences, folder, key, sequence_tokens, token_bytes, shard_records)
    forget(sequences)
    return shards
