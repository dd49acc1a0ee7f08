"""Frequent phrases by dynamic itemset counting, and the collocations among them.

The texts are dealt to a few shards by their hash, which are scanned in a cycle; a scan counts phrases of all lengths at once. Words
are counted from the start. A longer phrase joins in as soon as both phrases that it holds one word less of have
reached the threshold, and it is counted for one full cycle of shards, whichever it starts with, so no occurrence is missed.

What is counted is slots: a phrase hashes to one of 2^slot_bits counters, and its slot's step of reaching the threshold
is what a scan asks. A slot that phrases share is reached no later than any of them, so no phrase is missed or joins in
halfway; it only lets in phrases that turn out rare. The slots' size is fixed whatever the data, which makes them fit to
be sent to all tasks and to come back from them. At the end all texts are read once more for the phrases themselves, once
for each length: those whose slots, and those of the phrases within, reached the threshold are counted, and the rare ones are left out.
Words that reached the threshold are numbered. The longer phrases of a task leave it as these numbers, sorted, packed and dealt to
buckets, a row for each bucket; a phrase is spelt once, where its counts meet. However full the slots are, a task hands on no
more than its different phrases of frequent words, a few bytes each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm import common
from chatloom.llm.common import forget, sorted_groups, stored

_COUNTED = "lang string, words int, phrase string, slot int, count long"
_BUCKETS = "bucket long, phrases int, packed binary"
_TOTALS = "lang string, words int, phrase string, count long"
_SLOTS = "words int, chunk int, counts binary"
#: Slots that travel in one row, a byte each before they are packed.
_CHUNK_BITS = 16
#: A byte that no UTF-8 text has stands for the edge of a piece.
_EDGE = b"\xff"
_NEVER = 255
#: Bytes of text of one language that are counted together in a task. Bounds memory, not results.
_BLOCK = 8_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _clean() -> bytes:
    """Small letters, one kind of blank, one kind of edge."""
    table = bytearray(bytes(range(256)).lower())
    table[9] = 32
    for sign in b".,;:!?\n\x0b\x0c\r":
        table[sign] = _EDGE[0]
    return bytes(table)


_CLEAN = _clean()


def _blocks(data: bytes, overlap: int, size: int) -> Iterator[tuple[list[bytes], int]]:
    """The words and edges of *data* in parts of about *size* bytes, with the number of words that were there before.

    A part ends at an edge; where there is none, the next part repeats the last *overlap* words.
    """
    start, carry = 0, []
    while start < len(data):
        end = min(start + size, len(data))
        cut = False
        if end < len(data):
            edge = data.rfind(_EDGE, start, end)
            blank = data.rfind(b" ", start, end)
            if edge > start:
                end = edge
            elif blank > start:
                end, cut = blank, True
            else:
                # One word is longer than a part.
                places = [p for p in (data.find(_EDGE, end), data.find(b" ", end)) if p >= 0]
                end = min(places, default=len(data))
                cut = end < len(data) and data[end] == 32
        words = carry + data[start:end].replace(_EDGE, b" \xff ").split()
        yield words, len(carry)
        carry = words[-overlap:] if cut and overlap else []
        start = end


class Scan:
    """One scan of a shard: counts the phrases that are active in it."""

    def __init__(
        self, step: int, shards: int, max_words: int, reached: list[np.ndarray], bits: int, block: int = _BLOCK,
        lengths: range | None = None,
    ) -> None:
        self.step, self.shards, self.max_words, self.reached = step, shards, max_words, reached
        self.bits, self.block = bits, block
        # Phrases of other lengths are not counted.
        self.lengths = lengths or range(1, max_words + 1)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MIX) >> np.uint64(64 - self.bits)).astype(np.int32)

    def count(self, lang: str, tokens: list[bytes], before: int) -> Iterator[pa.RecordBatch]:
        """Counts of the active phrases that end after the first *before* words."""
        from xxhash import xxh64_intdigest

        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        place, texts = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        seed, several = zlib.crc32(lang.encode()), len(texts)
        hashes = np.array([xxh64_intdigest(t, seed) for t in texts], np.uint64)
        word = np.array([t != _EDGE for t in texts], bool)
        slots = self._slots(hashes)
        if self.step < self.shards and 1 in self.lengths:
            number = np.bincount(place[before:], minlength=several) * word
            yield from self._words(lang, texts, slots, number)
        if self.lengths[-1] == 1:
            return
        # For each place: when the phrase of this length that starts there had reached the threshold.
        since = np.where(word, self.reached[0][slots], _NEVER)[place].astype(np.int16)
        hashes = hashes[place]
        phrase = hashes
        for length in range(2, self.max_words + 1):
            since = np.maximum(since[:-1], since[1:]) + 1
            phrase = phrase[:-1] * _STEP + hashes[length - 1 :]
            begun = np.flatnonzero(since <= self.step)
            if not len(begun):
                return
            begun_slots = self._slots(phrase[begun])
            active = (self.step < since[begun] + self.shards) & (begun >= before - length + 1)
            at = begun[active]
            if len(at) and length in self.lengths:
                yield from self._phrases(lang, length, at, begun_slots[active], place, texts)
            if length == self.lengths[-1]:
                return
            if length < self.max_words:
                later = np.full(len(since), _NEVER, np.int16)
                later[begun] = self.reached[length - 1][begun_slots]
                since = later

    def _words(self, lang: str, texts: list[bytes], slots: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = np.flatnonzero(number)
        yield _counted(lang, 1, [texts[i] for i in found.tolist()], slots[found], number[found])

    def _phrases(
        self, lang: str, length: int, at: np.ndarray, slots: np.ndarray, place: np.ndarray, texts: list[bytes]
    ) -> Iterator[pa.RecordBatch]:
        """Counts of the phrases of *length* words that start at the places *at*."""
        key, several = place[at], len(texts)
        for more in range(1, length - 1):
            key = np.unique(key * several + place[at + more], return_inverse=True)[1]
        _, first, number = np.unique(key * several + place[at + length - 1], return_index=True, return_counts=True)
        columns = [place[at[first] + more].tolist() for more in range(length)]
        phrases = [b" ".join([texts[i] for i in row]) for row in zip(*columns)]
        yield _counted(lang, length, phrases, slots[first], number)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = text.as_py().translate(_CLEAN)
                held.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data) + 1
                if sizes[lang] >= self.block:
                    yield from self._flush(lang, held.pop(lang))
                    sizes.pop(lang)
                elif sum(sizes.values()) >= 4 * self.block:
                    for each in list(held):
                        yield from self._flush(each, held.pop(each))
                    sizes.clear()
        for lang, texts in held.items():
            yield from self._flush(lang, texts)

    def _flush(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for tokens, before in _blocks(_EDGE.join(texts), self.max_words - 1, self.block):
            if tokens:
                yield from self.count(lang, tokens, before)


class WordScan(Scan):
    """A scan that counts the words, and all words of a language."""

    def _words(self, lang, texts, slots, number):
        if number.any():
            yield _counted(lang, 0, [b""], np.zeros(1, np.int32), number.sum(keepdims=True))
        yield from super()._words(lang, texts, slots, number)


class Vocabulary:
    """The words that reached the threshold; a word's number is its place, the most frequent first."""

    def __init__(self, found: pa.Table) -> None:
        found = found.take(pc.sort_indices(found, [("count", "descending")])).combine_chunks()
        self.langs = found["lang"].combine_chunks().dictionary_encode()
        self.words = found["phrase"].combine_chunks().cast(pa.binary())

    def __len__(self) -> int:
        return len(self.words)

    def numbers(self, lang: str, texts: list[bytes]) -> np.ndarray:
        """The number of each text, or -1."""
        code = pc.index_in(pa.scalar(lang), value_set=self.langs.dictionary.cast(pa.string())).as_py()
        own = np.flatnonzero(self.langs.indices.to_numpy() == code) if code is not None else np.zeros(0, np.int64)
        place = pc.index_in(pa.array(texts, pa.binary()), value_set=self.words.take(pa.array(own)))
        place = place.fill_null(len(own)).to_numpy().astype(np.int64)
        return np.append(own, -1)[place]

    def phrases(self, numbers: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
        """Languages and texts of phrases, given by the numbers of their first words, second words and so on."""
        langs = self.langs.take(pa.array(numbers[0])).cast(pa.string())
        texts = [self.words.take(pa.array(each)) for each in numbers]
        return langs, pc.binary_join_element_wise(*texts, pa.scalar(b" ")).cast(pa.string())


class PhraseScan(Scan):
    """A scan that packs the counts of phrases of vocabulary words in slots that reached the threshold, by bucket."""

    def __init__(self, *scan, vocabulary: Vocabulary, buckets: int, **options) -> None:
        super().__init__(*scan, **options)
        self.vocabulary, self.buckets = vocabulary, buckets

    def _phrases(self, lang, length, at, slots, place, texts):
        at = at[self.reached[length - 1][slots] != _NEVER]
        numbers = self.vocabulary.numbers(lang, texts)[place]
        for more in range(length):
            at = at[numbers[at + more] >= 0]
        if not len(at):
            return
        numbers = [numbers[at + more] for more in range(length)]
        _, first, count = np.unique(_keys(numbers, len(self.vocabulary)), return_index=True, return_counts=True)
        numbers = [each[first] for each in numbers]
        mixed = np.zeros(len(first), np.uint64)
        for each in numbers:
            mixed = (mixed + each.astype(np.uint64)) * _MIX
            mixed ^= mixed >> np.uint64(32)
        bucket = ((mixed >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        columns = np.stack([each[order] for each in (*numbers, count)]).astype(np.uint32)
        found, starts = np.unique(bucket[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)]
        packed = [_pack(columns[:, start:end]) for start, end in zip(starts.tolist(), ends)]
        several = np.diff([*starts, len(order)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int64)), pa.array(several), pa.array(packed, pa.binary())], ["bucket", "phrases", "packed"]
        )


def _keys(columns: list[np.ndarray], several: int) -> np.ndarray:
    """A number for each row of numbers below *several*: equal for equal rows, and in their order."""
    key, size = columns[0], several
    for column in columns[1:]:
        if size * several >= 1 << 63:
            found, key = np.unique(key, return_inverse=True)
            size = len(found)
        key = key * several + column
        size *= several
    return key


def _pack(columns: np.ndarray) -> bytes:
    """Rows of 32-bit numbers, of which the first does not fall: what it rises by, then byte after byte of all, compressed."""
    columns = columns.copy()
    columns[0, 1:] -= columns[0, :-1].copy()
    return pa.compress(columns.view(np.uint8).reshape(*columns.shape, 4).transpose(0, 2, 1).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, width: int, several: int) -> np.ndarray:
    planes = _unpacked(packed, width * 4 * several).reshape(width, 4, several).transpose(0, 2, 1)
    columns = np.ascontiguousarray(planes).view(np.uint32).reshape(width, several).astype(np.int64)
    columns[0] = columns[0].cumsum()
    return columns


class SlotScan(Scan):
    """A scan that counts slots, up to the threshold, and hands them on when its task has no more texts."""

    def __init__(self, *scan, threshold: int) -> None:
        super().__init__(*scan)
        self.threshold = threshold
        self.totals: dict[int, np.ndarray] = {}

    def _add(self, length: int, slots: np.ndarray, number: np.ndarray) -> None:
        if length not in self.totals:
            self.totals[length] = np.zeros(1 << self.bits, np.uint8)
        own = self.totals[length]
        own[slots] = np.minimum(own[slots] + np.minimum(number, self.threshold), self.threshold)

    def _words(self, lang, texts, slots, number):
        order = np.argsort(slots, kind="stable")
        found, first = np.unique(slots[order], return_index=True)
        self._add(1, found, np.add.reduceat(number[order], first))
        return iter(())

    def _phrases(self, lang, length, at, slots, place, texts):
        self._add(length, *np.unique(slots, return_counts=True))
        return iter(())

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from super().__call__(batches)
        chunk = 1 << min(self.bits, _CHUNK_BITS)
        for length, own in self.totals.items():
            yield from _chunks((length, i, each) for i, each in enumerate(own.reshape(-1, chunk)))


def _chunks(chunks: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of those chunks that hold a count, packed."""
    for words, number, counts in chunks:
        if counts.any():
            packed = pa.compress(counts.tobytes(), codec="zstd", asbytes=True)
            columns = [pa.array([words], pa.int32()), pa.array([number], pa.int32()), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["words", "chunk", "counts"])


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)


class Reached:
    """The slots' steps as they are sent to the tasks: packed, and unpacked once in a worker."""

    def __init__(self, reached: list[np.ndarray]) -> None:
        self._packed = [zlib.compress(each, 1) for each in reached]
        self._arrays = None

    def __getstate__(self):
        return self._packed

    def __setstate__(self, packed) -> None:
        self._packed, self._arrays = packed, None

    def arrays(self) -> list[np.ndarray]:
        if self._arrays is None:
            self._arrays = [np.frombuffer(zlib.decompress(each), np.uint8) for each in self._packed]
        return self._arrays


def _counted(lang: str, length: int, phrases: list[bytes], slots: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, length, np.int32))]
    columns += [pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(slots), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "slot", "count"])


def _add_slots(counted: DataFrame, totals: list[np.ndarray], threshold: int) -> None:
    """Add a step's counts to the slots' totals, which stop at *threshold*. A byte for each slot comes to the driver at most."""
    size = min(len(totals[0]), 1 << _CHUNK_BITS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All chunks together have a byte for each slot and length.
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for words, chunk, packed in zip(*(column.to_pylist() for column in batch.columns)):
                more = _unpacked(packed, size)
                own = sums.get((words, chunk))
                # Both are 255 at most: what is missing to the threshold is added at most.
                sums[words, chunk] = more if own is None else own + np.minimum(more, threshold - own)
        yield from _chunks((*key, counts) for key, counts in sums.items())

    rows = counted.repartition("words", "chunk").mapInArrow(add, _SLOTS).toArrow()
    for words, chunk, packed in zip(*(column.to_pylist() for column in rows.columns)):
        own = totals[words - 1].reshape(-1, size)[chunk]
        own += np.minimum(_unpacked(packed, size), threshold - own)


def phrase_counts(
    docs: DataFrame, max_words: int = 3, threshold: int = 10, shards: int = 2, slot_bits: int = 24
) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, phrase, count)`` for phrases with a count of *threshold* or more, and ``(lang, n)``, all words.

    Texts are cut at ``.,;:!?`` and line ends into pieces and these at blanks and tabs into words; A-Z are lower-cased.
    Phrases lie within a piece, and their occurrences may overlap. Counts are exact and by language; a NULL language is
    ``und``, a NULL text empty. Repeated rows count as often as they are there. An empty table gives no rows.

    *threshold* is 255 at most, *shards* 60 and *slot_bits* 4 to 28. More slots let fewer rare phrases be counted in vain; each takes
    a byte for each length in a task. The words with a count of *threshold* or more go through the driver to all tasks. *docs* is read in every scan and must give the same rows each time; store it if it may not. Results do not depend on *shards* or *slot_bits*.
    """
    if not 1 <= threshold <= 255 or not 1 <= shards <= 60 or not 4 <= slot_bits <= 28 or max_words not in (1, 2, 3, 4):
        raise ValueError("threshold, shards, slot_bits or max_words out of range")
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # Which rows make a shard does not matter, only that it stays so: their hash tells, and no copy of the texts is made.
    rows = docs.select(lang, text)
    part = F.pmod(F.xxhash64("lang", "text"), F.lit(shards))
    reached = [np.full(1 << slot_bits, _NEVER, np.uint8) for _ in range(max_words)]
    totals = [np.zeros(1 << slot_bits, np.uint8) for _ in range(max_words)]
    step = 0
    while step < shards or any(step <= _last(each) + shards for each in reached[:-1]):
        sent = spark.sparkContext.broadcast(Reached(reached[:-1]))

        def scan(batches, step=step, sent=sent):
            yield from SlotScan(step, shards, max_words, sent.value.arrays(), slot_bits, threshold=threshold)(batches)

        shard = rows.where(part == step % shards)
        _add_slots(shard.mapInArrow(scan, _SLOTS), totals, threshold)
        for each, total in zip(reached, totals):
            each[(each == _NEVER) & (total >= threshold)] = step
        sent.destroy()
        step += 1
    # From here on all that reached the threshold did so before: one scan counts all of a length.
    def word_scan(batches):
        yield from WordScan(1, 2, max_words, [], slot_bits, lengths=range(1, 2))(batches)

    words = rows.mapInArrow(word_scan, _COUNTED).groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))
    # Read by the driver, then stored with the pairs.
    words = common.stored(words.where((F.col("count") >= threshold) | (F.col("words") == 0)), "words")
    counted = words
    if max_words > 1:
        vocabulary = Vocabulary(words.where("words = 1").select("lang", "phrase", "count").toArrow())
        known = [np.where(each == _NEVER, _NEVER, 0).astype(np.uint8) for each in reached]
        sent, sent_words = spark.sparkContext.broadcast(Reached(known)), spark.sparkContext.broadcast(vocabulary)
        buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        for length in range(2, max_words + 1):

            def last_scan(batches, length=length):
                scan = PhraseScan(
                    1, 2, max_words, sent.value.arrays(), slot_bits, lengths=range(length, length + 1),
                    vocabulary=sent_words.value, buckets=buckets,
                )
                yield from scan(batches)

            def spelt(batches, length=length):
                for group in sorted_groups(batches, "bucket"):
                    yield _totals(group, length, sent_words.value, threshold)

            packed = rows.mapInArrow(last_scan, _BUCKETS).repartition("bucket").sortWithinPartitions("bucket")
            # Each length has a shuffle of its own, which goes once its phrases are stored.
            own = packed.mapInArrow(spelt, _TOTALS)
            if length == 2:
                counted = stored(words.union(own), "phrases")
                forget(words)
            else:
                counted = counted.union(stored(own, "phrases"))
        sent.destroy()
        sent_words.destroy()
    return counted.where("words > 0"), counted.where("words = 0").select("lang", F.col("count").alias("n"))


def _totals(group: pa.Table, length: int, vocabulary: Vocabulary, threshold: int) -> pa.RecordBatch:
    """The phrases of a bucket that have *threshold* occurrences in all tasks."""
    parts = zip(group["packed"].to_pylist(), group["phrases"].to_pylist())
    *numbers, count = np.concatenate([_unpack(packed, length + 1, several) for packed, several in parts], axis=1)
    key = _keys(numbers, len(vocabulary))
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    total = np.add.reduceat(count[order], first)
    often = total >= threshold
    at = order[first[often]]
    langs, phrases = vocabulary.phrases([each[at] for each in numbers])
    columns = [langs, pa.array(np.full(len(at), length, np.int32)), phrases, pa.array(total[often])]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "count"])


def _last(reached: np.ndarray) -> int:
    """The last step in which a slot reached the threshold; long ago if none did."""
    known = reached[reached != _NEVER]
    return int(known.max()) if len(known) else -(10**6)


def collocations(
    docs: DataFrame, max_words: int = 3, threshold: int = 10, top: int = 2000, covered: int = 50, shards: int = 2, slot_bits: int = 24
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the *top* phrases of each language by their weakest cut.

    A phrase with count ``a``, cut into two parts with counts ``l`` and ``r``, scores ``floor(10^6 a a / (l r))``; the cut with the
    lowest score counts, of equal ones the first. A phrase within a longer one that has at least *covered* percent of
    its occurrences is left out. Ties in score go by count, largest first, then by phrase in byte order. See
    :func:`phrase_counts` for odd texts.
    """
    phrases, sizes = phrase_counts(docs, max_words, threshold, shards, slot_bits)
    found = phrases.where("words >= 2").select("lang", "words", "phrase", F.col("count").alias("a"))
    cuts = found.withColumn("parts", F.split("phrase", " ")).withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("head", F.expr("array_join(slice(parts, 1, k), ' ')"))
    cuts = cuts.withColumn("rest", F.expr("array_join(slice(parts, k + 1, words - k), ' ')")).drop("parts", "words")
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    wide = "decimal(19, 0)"
    score = F.expr(
        f"(cast(1000000 as decimal(38, 0)) * (cast(a as {wide}) * cast(a as {wide}))) div (cast(l as {wide}) * cast(r as {wide}))"
    )
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    inside = found.where("words > 2").withColumn("parts", F.split("phrase", " "))
    inside = inside.withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
    inside = inside.withColumn("start", F.explode(F.expr("sequence(1, words - size + 1)")))
    inside = inside.select("lang", F.expr("array_join(slice(parts, start, size), ' ')").alias("phrase"), "a")
    longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("cut.a") * covered)
    )
    kept = kept.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
