"""Repeated byte strings: enhanced suffix arrays over sampled suffixes.

A string of *min_bytes* bytes that occurs twice holds the same *anchor* at the same place in both: the byte position
whose short hash is least in the string. Only anchors' suffixes are sorted, about one in *min_bytes* / 2. All suffixes
that start with the same anchor text meet in one group; there they form a suffix array with common-prefix lengths, a
stack scan gives the intervals of the common-prefix tree, and the bytes before the suffixes tell how far each interval
extends to the left, where its occurrences differ (left diversity), and so which repeats are maximal. An occurrence is
compared with all others of its group that way, not only with its neighbours.

Occurrences with the same *context*, all bytes that a string through the anchor can reach, are one row with a count. An
anchor with more than *group_rows* different contexts is not gathered: blocks of its strings are hashed, counted with
pre-aggregation and halved where neither all nor none repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import forget, sorted_groups, stored

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPAN = 1 << 19  # Positions looked at at once; the place of a position in its span fits into 20 bits.
_LEVELS = 3


def _powers(factor: int) -> np.ndarray:
    out = np.full(_SPAN + (1 << 12), factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each *width* neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    to_right = np.minimum.accumulate(blocks, axis=1).ravel()
    to_left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_left[: n - width + 1], to_right[width - 1 : n])


class _Anchors:
    """Finds the anchors of a text: leftmost least hash of *short* bytes in each string of *min_bytes* bytes."""

    def __init__(self, min_bytes: int) -> None:
        self.min_bytes = min_bytes
        self.short = max(1, min_bytes // 8)
        self.width = min_bytes - self.short + 1
        self._up, self._down = _powers(_BASE), _powers(_INVERSE)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, hashes)``."""
        places, hashes = [], []
        step = _SPAN - self.min_bytes
        for start in range(0, max(1, len(data) - self.min_bytes + 1), step):
            part = np.frombuffer(data, np.uint8)[start : start + _SPAN]
            if len(part) < self.min_bytes:
                break
            place, value = self._of_span(part)
            places.append(place + start)
            hashes.append(value)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, first = np.unique(np.concatenate(places), return_index=True)
        return place, np.concatenate(hashes)[first]

    def _of_span(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=sums[1:])
        value = (sums[self.short :] - sums[: -self.short]) * self._down[: n - self.short + 1]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        # The place breaks ties, so the leftmost of equal hashes is the anchor.
        low = np.uint64((1 << 20) - 1)
        keyed = (value & ~low) | np.arange(len(value), dtype=np.uint64)
        least = _sliding_least(keyed, self.width)
        chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
        place = (chosen & low).astype(np.int64)
        return place, value[place].view(np.int64)

    def context(self, data: bytes, place: int) -> tuple[int, bytes]:
        """``(bytes before the anchor, context)``: all that a string through the anchor can reach."""
        start = max(0, place - self.width + 1)
        return place - start, data[start : place + self.min_bytes]


def _context_hash(before: int, context: bytes) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(context, before)
    return value - (1 << 64) if value >> 63 else value


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


def prefix_intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(length, first, last)`` of each interval of the common-prefix tree, inner ones first, by one stack scan.

    ``common[i]`` is the length that suffixes *i* and *i + 1* of the sorted array share.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][0] > length:
            shared, first = stack.pop()
            yield shared, first, i
        if not stack or stack[-1][0] < length:
            stack.append((length, first))


def maximal_extents(befores: list[bytes], afters: list[bytes], min_bytes: int) -> tuple[list[int], list[int]]:
    """How far to the left and right each occurrence is covered by repeats of at least *min_bytes* bytes.

    *befores* are the bytes before each anchor, last byte first; *afters* those from the anchor on. An interval's repeat
    is maximal where its left extension ends: there its occurrences differ in the byte before. If all of them together
    are long enough they are covered at once, else each with the one that shares most to its left.
    """
    left, right = [0] * len(afters), [0] * len(afters)
    array = sorted(range(len(afters)), key=afters.__getitem__)
    common = [_common(afters[a], afters[b]) for a, b in zip(array, array[1:])]
    for length, first, last in prefix_intervals(common):
        members = sorted(array[first : last + 1], key=befores.__getitem__)
        shared = [_common(befores[a], befores[b]) for a, b in zip(members, members[1:])]
        for i, member in enumerate(members):
            before = max(shared[i - 1] if i else 0, shared[i] if i < len(shared) else 0)
            if before + length >= min_bytes:
                left[member] = max(left[member], before)
                right[member] = max(right[member], length)
    return left, right


def _anchor_rows(docs: DataFrame, min_bytes: int) -> DataFrame:
    """``(doc, text_hash, place, anchor, context)`` for every anchor of every document."""
    out_type = docs.select("doc").schema
    for name in ("text_hash", "place", "anchor", "context"):
        out_type = out_type.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Anchors(min_bytes)
        for batch in batches:
            rows, places, anchors, contexts = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                data = text.as_py().encode()
                place, anchor = finder.of(data)
                rows.append(np.full(len(place), row))
                places.append(place)
                anchors.append(anchor)
                contexts += [_context_hash(*finder.context(data, p)) for p in place.tolist()]
            if rows:
                at = pa.array(np.concatenate(rows).astype(np.int64))
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(places))]
                columns += [pa.array(np.concatenate(anchors)), pa.array(contexts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=out_type.names)

    long_enough = docs.where(F.octet_length("text") >= min_bytes)
    return long_enough.select("doc", "text_hash", "text").mapInArrow(run, out_type)


def _context_rows(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """``(anchor, context, n, before, body, hot)`` for each *wanted* ``(doc, text_hash, place, anchor, context, n, hot)``."""
    lists = wanted.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("place", "anchor", "context", "n", "hot")).alias("wanted"))
    same = docs["doc"].eqNullSafe(lists["doc"]) & (docs["text_hash"] == lists["text_hash"])
    both = docs.join(lists, same).select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Anchors(min_bytes)
        for batch in batches:
            out: list[tuple] = []
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode()
                for w in wanted.as_py():
                    before, body = finder.context(data, w["place"])
                    # Different texts may, if hardly ever, share a hash.
                    if _context_hash(before, body) == w["context"]:
                        out.append((w["anchor"], w["context"], w["n"], before, body, w["hot"]))
                if len(out) > 10000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "n", "before", "body", "hot"])

    return both.mapInArrow(run, "anchor long, context long, n long, before int, body binary, hot boolean")


def _extents_in_groups(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """``(anchor, context, left, right)`` by the suffix array of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int]] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in held], pa.int64()) for i in range(4)]
            return pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "left", "right"])

        for group in sorted_groups(batches, "anchor"):
            once: dict[int, tuple[int, bytes]] = {}
            columns = (group.column(c).to_pylist() for c in ("context", "before", "body"))
            for context, before, body in zip(*columns):
                once[context] = (before, body)
            befores = [body[:before][::-1] for before, body in once.values()]
            afters = [body[before:] for before, body in once.values()]
            anchor = group.column("anchor")[0].as_py()
            for context, left, right in zip(once, *maximal_extents(befores, afters, min_bytes)):
                if right:
                    held.append((anchor, context, left, right))
            if len(held) > 10000:
                yield flush()
                held = []
        yield flush()

    rows = contexts.select("anchor", "context", "before", "body")
    rows = rows.repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, "anchor long, context long, left long, right long")


def _extents_by_counting(contexts: DataFrame, min_bytes: int, width: int, held: list[DataFrame]) -> DataFrame:
    """``(anchor, context, left, right)`` for anchors with very many contexts. Tables that it still reads go to *held*.

    A string through the anchor is named by *o*, the bytes it has before the anchor. A block of neighbouring *o* is covered
    if all its bytes occur twice, and not looked into if not even the bytes common to its strings do.
    """
    fan = 2
    while fan**_LEVELS < width:
        fan += 1
    size = fan ** (_LEVELS - 1)
    low = F.greatest(F.lit(0), min_bytes - (F.octet_length("body") - F.col("before")))
    high = F.least(F.lit(width - 1), F.col("before"))
    # Repeated rows of one document must not count as two contexts.
    once = stored(contexts.dropDuplicates(["anchor", "context"]), "hot-contexts")
    held.append(once)
    every = F.explode(F.sequence(F.lit(0), F.lit(width - 1), F.lit(size)))
    open_blocks = found = None
    while True:
        # At first each context has all blocks; later only those with open blocks meet their bytes again.
        if open_blocks is None:
            rows = once.select("anchor", "context", "n", "before", "body", every.alias("o"))
        else:
            rows = open_blocks.join(once.select("anchor", "context", "before", "body"), ["anchor", "context"])
        rows = rows.withColumns({"low": low, "high": high}).where((F.col("o") <= F.col("high")) & (F.col("o") + size > F.col("low")))
        inner = F.substring("body", F.col("before") - F.col("o") + 1, F.lit(min_bytes - size + 1))
        outer = F.substring("body", F.col("before") - F.col("o") - size + 2, F.lit(min_bytes + size - 1))
        whole = (F.col("o") >= F.col("low")) & (F.col("o") + size - 1 <= F.col("high"))
        rows = rows.select(
            "anchor", "context", "n", "o",
            F.xxhash64(inner).alias("inner"),
            F.when(whole, F.xxhash64(outer)).alias("outer"),
        )
        rows = stored(rows, "blocks")
        inners = rows.groupBy("anchor", "o", "inner").agg((F.sum("n") > 1).alias("some"))
        outers = rows.where("outer IS NOT NULL").groupBy("anchor", "o", "outer").agg((F.sum("n") > 1).alias("all"))
        known = rows.join(inners.where("some").drop("some"), ["anchor", "o", "inner"], "left_semi")
        known = stored(known.join(outers.where("all"), ["anchor", "o", "outer"], "left"), "known-blocks")
        forget(rows)
        held.append(known)
        covered = known.where("all").select("anchor", "context", F.col("o").alias("least"), (F.col("o") + size - 1).alias("most"))
        found = covered if found is None else found.union(covered)
        if size == 1:
            break
        step = size // fan
        parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(fan - 1)), lambda i: F.col("o") + i * step))
        # Of the covered ones with the same bytes one goes on, as others may share only some of its strings.
        shared = known.where("all").groupBy("anchor", "o", "outer")
        shared = shared.agg(F.min("context").alias("context"), F.lit(2).cast("long").alias("n"))
        left = known.where("all IS NULL").select("anchor", "context", "n", "o")
        left = left.union(shared.select("anchor", "context", "n", "o"))
        open_blocks = left.select("anchor", "context", "n", parts.alias("o"))
        size = step
    extents = found.groupBy("anchor", "context").agg(F.max("most").alias("left"), F.min("least").alias("least"))
    return extents.select(
        "anchor", "context", F.col("left").cast("long"), (min_bytes - F.col("least")).cast("long").alias("right")
    )


def repeated_spans(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_bytes: int = 400, group_rows: int = 256
) -> DataFrame:
    """``(doc, text_hash, starts, ends)``: byte spans covered by a string of *min_bytes* bytes that occurs elsewhere too.

    Spans may overlap and come in any order. Documents without such a span are left out. ``text_hash`` is the XXH64 of the
    text, which tells documents that share an id apart.
    """
    docs = df.select(
        F.col(id_column).alias("doc"),
        F.xxhash64(text_column).alias("text_hash"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    anchors = stored(_anchor_rows(docs, min_bytes), "anchors")
    finder_width = min_bytes - max(1, min_bytes // 8) + 1
    contexts = anchors.groupBy("anchor", "context").agg(
        F.count("*").alias("n"),
        F.min("text_hash").alias("text_hash"),
        # By the hash of the text, which is never NULL as ids may be: equal texts have equal places.
        F.min_by("doc", "text_hash").alias("doc"),
        F.min_by("place", "text_hash").alias("place"),
    )
    contexts = stored(contexts, "contexts")
    # Stored, so that the join is one of two plain shuffles, of which Spark can split the skewed partitions.
    many = stored(contexts.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"), "many")
    # Whether an anchor is hot travels with its contexts, so that their bytes are not shuffled to find out.
    wanted = contexts.join(many, "anchor").withColumn("hot", F.col("m") > group_rows).drop("m")
    bodies = stored(_context_rows(docs, wanted, min_bytes), "bodies")
    hot = many.where(F.col("m") > group_rows).select("anchor")
    held = [contexts, many, bodies]
    extents = _extents_in_groups(bodies.where("NOT hot"), min_bytes)
    if not hot.isEmpty():
        extents = extents.union(_extents_by_counting(bodies.where("hot").drop("hot"), min_bytes, finder_width, held))
    # A context that occurs twice is covered whole.
    whole = contexts.where("n > 1").select(
        "anchor", "context", F.lit(finder_width - 1).cast("long").alias("left"), F.lit(min_bytes).cast("long").alias("right")
    )
    extents = whole.union(extents).groupBy("anchor", "context").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    extents = stored(extents, "extents")
    for table in held:
        forget(table)
    spans = anchors.join(extents, ["anchor", "context"])
    start = F.greatest(F.lit(0).cast("long"), F.col("place") - F.col("left"))
    spans = spans.select("doc", "text_hash", start.alias("start"), (F.col("place") + F.col("right")).alias("end"))
    spans = spans.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans.select("doc", "text_hash", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))


def remove_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_bytes: int = 400,
    whole_characters: bool = False,
    group_rows: int = 256,
    carry: tuple[str, ...] = (),
    min_words: int = 0,
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept binary)`` for each row: its text without repeated bytes.

    A byte goes if a string of *min_bytes* bytes over it also starts anywhere else in the table, the same text included;
    all occurrences go, judged on the input. NULL and empty texts, and texts shorter than *min_bytes*, stay as they
    are. Copies of a row repeat each other. ``whole_characters`` keeps characters of which only a part would go, so that
    *kept* is UTF-8. A run of fewer than *min_words* words, between white space, stays. The columns named in *carry* come along in a struct ``carried``; others are not read.
    """
    spans = repeated_spans(df, id_column, text_column, min_bytes, group_rows)
    docs = df.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("hash"),
        F.col(text_column).alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    both = docs.join(spans, docs["id"].eqNullSafe(spans["doc"]) & (docs["hash"] == spans["text_hash"]), "left")

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(texts: pa.Array, all_starts: pa.Array, all_ends: pa.Array) -> pa.Array:
        out = []
        for text, starts, ends in zip(texts, all_starts, all_ends):
            data = (text.as_py() or "").encode()
            pieces, at, spans = [], 0, 0
            merged: list[list[int]] = []
            if starts.is_valid:
                for start, end in sorted(zip(starts.as_py(), ends.as_py())):
                    end = min(end, len(data))
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
            for start, end in merged:
                if whole_characters:
                    while start < end and data[start] & 0xC0 == 0x80:
                        start += 1
                    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                if start < end and (not min_words or len(data[start:end].split()) >= min_words):
                    pieces.append(data[at:start])
                    at, spans = end, spans + 1
            pieces.append(data[at:])
            kept = b"".join(pieces)
            out.append({"n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": spans, "kept": kept})
        return pa.array(out, cut_type)

    cut_type = pa.struct(
        [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    )
    more = ["carried"] if carry else []
    done = both.select(F.col("id").alias(id_column), cut("text", "starts", "ends").alias("cut"), *more)
    return done.select(id_column, "cut.*", *more)
