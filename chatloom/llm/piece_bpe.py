"""SentencePiece files of the BPE type: exact ids from one last token for each prefix.

Any two neighbours may merge whose text is a piece; the piece with the best score goes first, the leftmost among equals.
The steps inside a token do not depend on what stands outside, so a row of tokens is the encoding exactly if no merge
crosses the edge of any two neighbours. For each prefix one token alone can be the last: candidates come from an
automaton over all pieces, and a candidate stays if it and the last token of the prefix before it are compatible. That is
tested by replaying how the two are built, side by side, and looking for a merge across the edge that would go first.
Back-pointers from the end give the ids, in time linear in the length.
"""

from __future__ import annotations

import codecs
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.bpe import loaded, shared_file

#: Fixed values of the format: the sign that stands for a space, and what an unknown id is printed as.
_SPACE, _UNKNOWN = "▁", " ⁇ "
#: Kinds of pieces and the model type in the file's format.
_NORMAL, _UNKNOWN_KIND, _CONTROL, _BYTE, _TYPE_BPE = 1, 2, 3, 6, 2
_LEAST = float("-inf")

#: Words kept with their ids in one worker, the longest word kept, and token pairs kept. They bound memory, not results.
_CACHED_WORDS = 150_000
_CACHED_LENGTH = 64
_CACHED_PAIRS = 1_000_000

codecs.register_error("chatloom.each_byte", lambda error: ("�", error.start + 1))


class PieceBpe:
    """Encoder and decoder for one SentencePiece file (BPE with byte fallback, no normalisation rules)."""

    def __init__(self, content: bytes) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(content)
        trainer, rules = model.trainer_spec, model.normalizer_spec
        if trainer.model_type != _TYPE_BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("Only BPE models with byte fallback and white space in front are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("Only models that change no text but spaces are supported")
        if not {p.type for p in model.pieces} <= {_NORMAL, _UNKNOWN_KIND, _CONTROL, _BYTE}:
            raise ValueError("User-defined and unused pieces are not supported")
        self._prefix = " " if rules.add_dummy_prefix else ""
        self._score: dict[str, float] = {}
        self._bytes: list[bytes] = []
        self._kinds = np.array([p.type for p in model.pieces], np.int8)
        self._byte_ids = [0] * 256
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._text: dict[int, str] = {}
        self._size = [0] * len(model.pieces)
        for number, piece in enumerate(model.pieces):
            # A space sign in a text is the same as a space.
            text = piece.piece.replace(_SPACE, " ")
            if piece.type == _BYTE:
                value = int(piece.piece[3:5], 16)
                self._byte_ids[value] = number
                self._bytes.append(bytes([value]))
            elif piece.type == _NORMAL:
                self._score[text] = piece.score
                self._automaton.add_word(text, number)
                self._text[number] = text
                self._size[number] = len(text)
                self._bytes.append(text.encode())
            else:
                self._bytes.append(_UNKNOWN.encode() if piece.type == _UNKNOWN_KIND else b"")
        self._automaton.make_automaton()
        self._table = pa.array(self._bytes, pa.large_binary())
        self._known = {text for text in self._score if len(text) == 1}
        # Where no piece goes on from another sign to a space, a text may be cut before its spaces.
        whole = any(re.search("[^ ] ", text) for text in self._score)
        self._words = (lambda text: [text]) if whole else re.compile(" +[^ ]*|[^ ]+").findall
        self._steps: dict[int, tuple | None] = {}
        self._fits: dict[int, bool] = {}
        self._recent: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _built(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """How *token* is built: the score of each merge, then the first and the last part before it and at the end.

        None if its own text is not encoded as this token.
        """
        if token in self._steps:
            return self._steps[token]
        parts, score = list(self._text[token]), self._score
        scores, first, last = [], [], []
        while True:
            first.append(parts[0])
            last.append(parts[-1])
            best, at = _LEAST, -1
            for i in range(len(parts) - 1):
                merged = score.get(parts[i] + parts[i + 1])
                if merged is not None and (merged > best or at < 0):
                    best, at = merged, i
            if at < 0:
                break
            scores.append(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        scores.append(_LEAST)
        known = self._steps[token] = (scores, first, last) if len(parts) == 1 else None
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when they stand side by side."""
        a, b = self._built(left), self._built(right)
        if a is None or b is None:
            return False
        (left_scores, _, ends), (right_scores, begins, _) = a, b
        i = j = 0
        score = self._score.get
        while True:
            across, left_next, right_next = score(ends[i] + begins[j]), left_scores[i], right_scores[j]
            # Among equal scores the leftmost goes first: a merge in the left token, then the one across.
            if across is not None and across >= right_next and (across > left_next or i == len(left_scores) - 1):
                return False
            if i == len(left_scores) - 1 and j == len(right_scores) - 1:
                return True
            if j == len(right_scores) - 1 or (i < len(left_scores) - 1 and left_next >= right_next):
                i += 1
            else:
                j += 1

    def _known_ids(self, word: str) -> list[int]:
        """Ids of a word all of whose signs are pieces."""
        last, fits, size = [-1] * (len(word) + 1), self._fits, self._size
        last[0] = -2
        for end, token in self._automaton.iter(word):
            end += 1
            if last[end] == -1:
                before = last[end - size[token]]
                if before >= 0:
                    pair = before << 32 | token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = fits[pair] = self._fit(before, token)
                    if fit:
                        last[end] = token
                elif before == -2 and self._built(token) is not None:
                    last[end] = token
        if len(fits) > _CACHED_PAIRS:
            fits.clear()
        ids, at = [], len(word)
        while at:
            token = last[at]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        return ids

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word with the spaces before it. A sign without a piece becomes its bytes."""
        if self._known.issuperset(word):
            return self._known_ids(word)
        ids, start = [], 0
        for i, sign in enumerate(word):
            if sign not in self._known:
                ids += self._known_ids(word[start:i])
                ids += [self._byte_ids[b] for b in sign.encode()]
                start = i + 1
        return ids + self._known_ids(word[start:])

    def _packed(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = array("i", self.word_ids(word)).tobytes()
        if len(word) <= _CACHED_LENGTH:
            if len(self._recent) >= _CACHED_WORDS:
                self._older, self._recent = self._recent, {}
            self._recent[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of *text* as 32-bit integers in the machine's byte order."""
        if not text:
            return b""
        words = self._words(self._prefix + text.replace(_SPACE, " "))
        # Most words are known; only the others take a call each.
        found = list(map(self._recent.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self._packed(words[i])
        return b"".join(found)

    def _by_runs(self, ids: np.ndarray) -> str:
        """Text of ids whose byte pieces are not all whole signs: each stray byte becomes U+FFFD."""
        edges = np.flatnonzero(np.diff((self._kinds[ids] == _BYTE).astype(np.int8))) + 1
        runs = [b"".join(self._bytes[i] for i in run.tolist()) for run in np.split(ids, edges)]
        return "".join(run.decode("utf-8", "chatloom.each_byte") for run in runs)

    def decode_all(self, ids: pa.ListArray) -> list[str]:
        """The texts of lists of ids. One space in front goes if the first piece has it."""
        values, offsets = ids.flatten(), ids.offsets.to_numpy()
        offsets = offsets - offsets[0]
        pieces = pc.take(self._table, values)
        data, numbers = pieces.buffers()[2], values.to_numpy()
        places = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = memoryview(data) if data is not None else memoryview(b"")
        # A control piece is empty, but no sign goes on across it.
        controls = np.flatnonzero(self._kinds[numbers] == _CONTROL)
        texts = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            raw = bytes(data[places[a] : places[b]]) if b > a else b""
            try:
                if len(controls) and np.searchsorted(controls, a) < np.searchsorted(controls, b):
                    text = self._by_runs(numbers[a:b])
                else:
                    text = raw.decode()
            except UnicodeDecodeError:
                text = self._by_runs(numbers[a:b])
            if self._prefix and text.startswith(" "):
                # Control pieces are empty; a space from a byte or an unknown piece stays.
                first = next(i for i in numbers[a:b].tolist() if self._kinds[i] != _CONTROL)
                if self._kinds[first] == _NORMAL:
                    text = text[1:]
            texts.append(text)
        return texts


def encode_pieces(spark: SparkSession, text: Column | str, model: str) -> Column:
    """Ids of *text* by the SentencePiece file *model*, an array of ints; NULL and empty texts have none.

    Nothing is cut and nothing is sampled; a text's words are known or worked out, however long. The file, whose size does
    not grow with the data, goes to each executor once.
    """
    shared = shared_file(spark, model)

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        coder = loaded(shared.value, PieceBpe)
        coded = [coder.encode(t.as_py() or "") for t in texts]
        offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int64)
        values = pa.array(np.frombuffer(b"".join(coded), np.int32), pa.int32())
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)

    # Repeatable, but marked so that the optimizer does not encode again for each use of the result.
    return run.asNondeterministic()(text)


def decode_pieces(spark: SparkSession, ids: Column | str, model: str) -> Column:
    """The text of *ids*, an array of ints without NULL elements; NULL and empty arrays give an empty text."""
    shared = shared_file(spark, model)

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        coder = loaded(shared.value, PieceBpe)
        lists = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
        return pa.array(coder.decode_all(lists), pa.string())

    return run(F.coalesce(ids if isinstance(ids, Column) else F.col(ids), F.array().cast("array<int>")))
