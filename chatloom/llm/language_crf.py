"""Language of each word by a linear-chain conditional random field.

A word's features are its character n-grams with the word's ends marked (those at an end are its affixes) and its entry in
a lexicon; learned transitions tie the labels of neighbouring words together. Forward-backward gives each word the
probability of each language, also where a text switches between languages; a text's language is the one with most of
that probability. Only words with a letter take part.

The model is fitted on the driver, on a bounded sample of labelled rows: at most *rows_per_label* rows for each label and
*row_words* words of each. Everything else runs in tasks over whole texts. Long texts are cut into chunks whose transfer
matrices are chained, which is exact and keeps the number of steps small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
_EDGES = "\"'`´’‘“”«»()[]{}<>.,;:!?¡¿…*%$#&@/\\|+=~^_-–—0123456789"
_BUCKETS = 1 << 16
_ORDERS = (1, 2, 3, 4)
_CHUNK = 64
#: Words of texts that are judged together, and characters of different words whose features are made together. Both bound
#: a task's memory, not results.
_WORDS = 1 << 17
_CHARACTERS = 1 << 16


def words_of(text: str | None) -> list[str]:
    """Lower-cased words with a letter, without signs and digits at their ends."""
    words = [w.strip(_EDGES) for w in (text or "").lower().split()]
    return [w for w in words if w and (w.isalpha() or any(c.isalpha() for c in w))]


def _numbered(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The different words, and the number of each word among them."""
    number: dict[str, int] = {}
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return list(number), at


def _word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, first, names)``: the n-gram buckets of all words, where each word's begin, and a hash of each word."""
    line = "\x02" + "\x02".join(words) + "\x02"
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64)
    # Ends are known by their places: a word may hold any sign.
    ends = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
    end = np.zeros(len(codes), bool)
    end[ends] = True
    parts, owners = [], []
    place = np.searchsorted(ends, np.arange(len(codes)), side="right") - 1
    for order in _ORDERS:
        n = len(codes) - order + 1
        value = np.full(n, order, np.uint64)
        for k in range(order):
            value = (value * np.uint64(0x100000001B3)) ^ codes[k : n + k]
            value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        # An n-gram belongs to one word: no end mark inside it, and not an end mark alone.
        marks = np.concatenate(([0], np.cumsum(end)))
        inside = marks[order - 1 : order - 1 + n] - marks[1 : n + 1] if order > 2 else np.zeros(n, np.int64)
        good = (inside <= 0) if order > 1 else ~end
        if order == 2:
            good = ~(end[:-1] & end[1:])
        kept = np.flatnonzero(good)
        parts.append((value[kept] & np.uint64(_BUCKETS - 1)).astype(np.int64))
        owners.append(place[kept])
    owner = np.concatenate(owners)
    order_by_word = np.argsort(owner, kind="stable")
    owner = owner[order_by_word]
    first = np.searchsorted(owner, np.arange(len(words)))
    mixed = (codes + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * (np.arange(len(codes), dtype=np.uint64) - ends[place].astype(np.uint64) + np.uint64(7))
    names = np.add.reduceat(mixed, ends[:-1] + 1) if len(words) else np.zeros(0, np.uint64)
    return np.concatenate(parts)[order_by_word], first, names


@dataclass
class Crf:
    """Labels, n-gram weights by bucket, lexicon (sorted word hashes and their weights), transitions."""

    labels: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    entries: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each label for each of *words* (all different)."""
        if not words:
            return np.zeros((0, len(self.labels)))
        part = np.cumsum([len(w) + 1 for w in words]) // _CHARACTERS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(words)]
        return np.concatenate([self._emissions(words[a:b]) for a, b in zip(cuts, cuts[1:])])

    def _emissions(self, words: list[str]) -> np.ndarray:
        buckets, first, names = _word_features(words)
        scores = np.add.reduceat(self.grams[buckets], first)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, names), len(self.lexicon) - 1)
            scores = scores + self.entries[at] * (self.lexicon[at] == names)[:, None]
        return scores

    def shares(self, texts: list[list[str]]) -> np.ndarray:
        """The mean probability of each label over the words of each text; zeros for a text without words."""
        lengths = np.array([len(t) for t in texts], np.int64)
        total = np.zeros((len(texts), len(self.labels)))
        words, number = _numbered([w for t in texts for w in t])
        if not words:
            return total
        scores = self.emissions(words)
        scores = np.exp(scores - scores.max(1, keepdims=True))[number]
        for rows in _in_turn(lengths):
            spans = np.concatenate([np.arange(a, a + n) for a, n in zip(np.cumsum(lengths)[rows] - lengths[rows], lengths[rows])])
            total[rows] = _sums(scores[spans], lengths[rows], np.exp(self.transitions))
        return total / np.maximum(lengths, 1)[:, None]


def _in_turn(lengths: np.ndarray, words: int = _WORDS) -> Iterator[np.ndarray]:
    """Row numbers in groups of about that many words."""
    group = (np.cumsum(lengths) - lengths) // words
    for g in np.unique(group[lengths > 0]):
        yield np.flatnonzero((group == g) & (lengths > 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(tuple(range(1, x.ndim)), keepdims=True)


def _sums(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities summed over each text's words, by forward-backward over chunks."""
    n_labels = scores.shape[1]
    chunks_of = -(-lengths // _CHUNK)
    text_of = np.repeat(np.arange(len(lengths)), chunks_of)
    nth = np.arange(len(text_of)) - np.repeat(np.cumsum(chunks_of) - chunks_of, chunks_of)
    begin = np.repeat(np.cumsum(lengths) - lengths, chunks_of) + nth * _CHUNK
    size = np.minimum(_CHUNK, np.repeat(lengths, chunks_of) - nth * _CHUNK)
    by_size = np.argsort(-size, kind="stable")
    begin, size = begin[by_size], size[by_size]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(_CHUNK)]  # chunks with more than t words
    transfer = np.broadcast_to(np.eye(n_labels), (len(size), n_labels, n_labels)).copy()
    for t in range(_CHUNK):
        k = active[t]
        transfer[:k] = _scaled((transfer[:k] @ moves) * scores[begin[:k] + t][:, None, :])
    # Chain the chunks of each text: what comes in from the left and from the right.
    where = np.empty_like(by_size)
    where[by_size] = np.arange(len(by_size))
    first = np.cumsum(chunks_of) - chunks_of
    left = np.full((len(size), n_labels), 1 / n_labels)
    right = np.full((len(size), n_labels), 1 / n_labels)
    for c in range(1, int(chunks_of.max())):
        texts = np.flatnonzero(chunks_of > c)
        here, before = where[first[texts] + c], where[first[texts] + c - 1]
        left[here] = _scaled((left[before][:, None, :] @ transfer[before])[:, 0])
    for c in range(int(chunks_of.max()) - 2, -1, -1):
        texts = np.flatnonzero(chunks_of > c + 1)
        here, after = where[first[texts] + c], where[first[texts] + c + 1]
        right[here] = _scaled((transfer[after] @ right[after][:, :, None])[:, :, 0])
    ahead = np.zeros((len(size), _CHUNK, n_labels))
    state = left
    for t in range(_CHUNK):
        k = active[t]
        state = _scaled((state[:k] @ moves) * scores[begin[:k] + t])
        ahead[:k, t] = state
    total = np.zeros((len(size), n_labels))
    back = right
    for t in range(_CHUNK - 1, -1, -1):
        k = active[t]
        if k:
            total[:k] += _scaled(ahead[:k, t] * back[:k])
            back[:k] = _scaled((scores[begin[:k] + t] * back[:k]) @ moves.T)
    out = np.zeros((len(lengths), n_labels))
    np.add.at(out, text_of, total[where])
    return out


def fit(rows: list[tuple[str, list[str]]], rounds: int = 25, step: float = 0.5, penalty: float = 1e-4) -> Crf:
    """Fit on ``(label, words)`` rows by gradient ascent on the conditional likelihood.

    Each row is a sequence; each is also joined to a row of another label, so that transitions between labels are seen.
    """
    rows = [r for r in rows if r[1]]
    labels = sorted({label for label, _ in rows})
    n_labels = len(labels)
    rng = np.random.default_rng(7)
    sequences = [[r] for r in rows]
    for i, j in enumerate(rng.permutation(len(rows))):
        if rows[i][0] != rows[j][0]:
            sequences.append([rows[i], rows[j]])
    longest = max((sum(len(w) for _, w in s) for s in sequences), default=1)
    flat = [w for s in sequences for _, ws in s for w in ws]
    words, number = _numbered(flat)
    gold = np.array([labels.index(lab) for s in sequences for lab, ws in s for _ in ws], np.int64)
    model = Crf(labels, np.zeros((_BUCKETS, n_labels)), np.zeros(0, np.uint64), np.zeros((0, n_labels)), np.zeros((n_labels, n_labels)))
    if not words:
        return model
    buckets, first, names = _word_features(words)
    owner = np.repeat(np.arange(len(words)), np.diff([*first, len(buckets)]))
    often = np.bincount(number, minlength=len(words)) >= 4
    model.lexicon = np.unique(names[often])
    model.entries = np.zeros((len(model.lexicon), n_labels))
    in_lexicon = np.searchsorted(model.lexicon, names[often])
    lengths = np.array([sum(len(w) for _, w in s) for s in sequences])
    at = np.full((len(sequences), longest), -1)
    at[np.arange(longest) < lengths[:, None]] = np.arange(len(flat))
    one_hot = np.eye(n_labels)[gold]
    seen = np.zeros((n_labels, n_labels))
    follows = (at[:, 1:] >= 0) & (at[:, :-1] >= 0)
    np.add.at(seen, (gold[at[:, :-1][follows]], gold[at[:, 1:][follows]]), 1)
    speed = [np.full(x.shape, 1e-6) for x in (model.grams, model.entries, model.transitions)]
    for _ in range(rounds):
        scores = model.emissions(words)
        scores = np.exp(scores - scores.max(1, keepdims=True))[number]
        moves = np.exp(model.transitions)
        ahead, state = np.zeros((len(flat), n_labels)), np.full((len(sequences), n_labels), 1 / n_labels)
        for t in range(longest):
            on = at[:, t] >= 0
            state[on] = _scaled((state[on] @ moves) * scores[at[on, t]])
            ahead[at[on, t]] = state[on]
        back, state = np.zeros((len(flat), n_labels)), np.full((len(sequences), n_labels), 1 / n_labels)
        pairs = np.zeros((n_labels, n_labels))
        for t in range(longest - 1, -1, -1):
            on = at[:, t] >= 0
            back[at[on, t]] = state[on]
            into = scores[at[on, t]] * state[on]
            if t:
                joint = ahead[at[on, t - 1]][:, :, None] * moves * into[:, None, :]
                pairs += _scaled(joint).sum(0)
            state[on] = _scaled(into @ moves.T)
        missing = one_hot - _scaled(ahead * back)
        by_word = np.stack([np.bincount(number, missing[:, j], len(words)) for j in range(n_labels)], 1)
        gram_step = np.stack([np.bincount(buckets, by_word[owner, j], _BUCKETS) for j in range(n_labels)], 1)
        entry_step = np.zeros_like(model.entries)
        np.add.at(entry_step, in_lexicon, by_word[often])
        moves_step = seen - pairs
        for weights, change, pace in zip((model.grams, model.entries, model.transitions), (gram_step, entry_step, moves_step), speed):
            change = change / len(sequences) - penalty * weights
            pace += change**2
            weights += step * change / np.sqrt(pace) * (pace > 1e-6)
    model.grams = model.grams.astype(np.float32)
    return model


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept from learning: CRC-32 of its id as text, modulo 3, is 1 (no: NULL id)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def fit_on(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    rows_per_label: int = 400,
    row_words: int = 60,
) -> Crf:
    """Fit on a sample of the rows that are not held out and have a label, text and id.

    The rows with the least hashes of id and text are taken, *rows_per_label* of each label; of each, *row_words* words
    from a place that the hash chooses. That bounds what reaches the driver, whatever the table's size.
    """
    known = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    order = known.select("id", "label", F.xxhash64("id", F.length("text")).alias("rank"))
    # First within parts of a label, so that one task never gets the candidates of all others.
    parts = Window.partitionBy("label", F.pmod("rank", F.lit(64))).orderBy("rank", "id")
    order = order.withColumn("_n", F.row_number().over(parts)).where(F.col("_n") <= rows_per_label)
    least = Window.partitionBy("label").orderBy("rank", "id")
    chosen = order.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= rows_per_label)
    chosen = chosen.select("id", "rank").distinct()

    @F.arrow_udf("array<string>")
    def window(texts: pa.Array, ranks: pa.Array) -> pa.Array:
        out = []
        for text, rank in zip(texts, ranks):
            words = words_of(text.as_py())
            start = rank.as_py() % max(1, len(words) - row_words + 1)
            out.append(words[start : start + row_words])
        return pa.array(out, pa.list_(pa.string()))

    sample = known.join(F.broadcast(chosen), "id").select("label", "id", window("text", "rank").alias("words"))
    return fit([(r["label"], r["words"]) for r in sorted(sample.collect(), key=lambda r: (r["label"], r["id"], r["words"]))])


def language(spark: SparkSession, text: Column | str, model: Crf) -> Column:
    """``struct(lang_pred, score)``: the label with the largest share of the words' probability, and the share.

    ``und`` with score 0 where the text is NULL, empty or has no letter, or nothing was learned. Equal shares give the
    label that sorts first.
    """
    # The model's size follows from the number of labels and the bounds of the sample.
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def run(texts: pa.Array) -> pa.Array:
        crf = shared.value
        out_names, out_scores = [], []
        held: list[list[str]] = []
        size = 0

        def flush() -> None:
            if crf.labels:
                for words, share in zip(held, crf.shares(held)):
                    best = int(share.argmax())
                    out_names.append(crf.labels[best] if words else UNDETERMINED)
                    out_scores.append(min(1.0, float(share[best])) if words else 0.0)
            else:
                out_names.extend([UNDETERMINED] * len(held))
                out_scores.extend([0.0] * len(held))

        for text in texts:
            held.append(words_of(text.as_py()))
            size += len(held[-1])
            if size > _WORDS:
                flush()
                held, size = [], 0
        flush()
        arrays = [pa.array(out_names, pa.string()), pa.array(out_scores, pa.float64())]
        return pa.StructArray.from_arrays(arrays, ["lang_pred", "score"])

    return run(text)


def predict(df: DataFrame, model: Crf, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for each row, see :func:`language`. Repeated rows repeat, a NULL id stays."""
    found = df.select(F.col(id_column), language(df.sparkSession, text_column, model).alias("found"))
    return found.select(id_column, "found.lang_pred", "found.score")
