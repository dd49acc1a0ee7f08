"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a word there is exactly one token that its encoding can end with. Candidates are the vocabulary
entries that end there, found by an automaton over suffix links; a candidate fits if it and the last token of the prefix
before it can stand side by side, that is if no merge would have crossed the edge between them. Following the
back-pointers from the end of the word gives the exact ids, in time linear in its length.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the byte-level format: the word pattern, white space, and bytes that stand for themselves.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACES = frozenset("\t\n\v\f\r \x85\xa0     　") | {chr(c) for c in range(0x2000, 0x200B)}
_SIGNS = "!#$%&*+,-./:;?@^_|~"
_PLAIN = frozenset([*range(33, 127), *range(161, 173), *range(174, 256)])

#: Words kept with their ids in one worker, and the longest word kept. Both bound memory, not results.
_CACHED_WORDS = 150_000
_CACHED_LENGTH = 64


def _byte_letters() -> list[str]:
    """The letter that stands for each byte."""
    others = iter(range(256, 512))
    return [chr(b) if b in _PLAIN else chr(next(others)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one tokenizer file (JSON, byte-level BPE without normalizer)."""

    def __init__(self, content: bytes) -> None:
        import ahocorasick
        import regex

        spec = json.loads(content)
        model, words = spec["model"], spec["pre_tokenizer"]
        plain = not model.get("ignore_merges") and not model.get("byte_fallback") and not model.get("dropout")
        if model["type"] != "BPE" or words["type"] != "ByteLevel" or spec["normalizer"] is not None or not plain:
            raise ValueError("Only byte-level BPE files without normalizer are supported")
        if words["add_prefix_space"] or not words.get("use_regex", True):
            raise ValueError("Only byte-level files with the usual word pattern are supported")
        vocab = model["vocab"]
        self._letters = dict(enumerate(_byte_letters()))
        to_byte = {letter: b for b, letter in self._letters.items()}
        self._rank: dict[int, int] = {}
        self._halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self._rank[pair[0] << 32 | pair[1]] = rank
            self._halves.setdefault(whole, (*pair, rank))
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._length: dict[int, int] = {}
        for token, number in vocab.items():
            if number in self._halves or len(token) == 1:
                self._automaton.add_word(token, number)
                self._length[number] = len(token)
        self._automaton.make_automaton()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("Added tokens that take in their surroundings are not supported")
        names = sorted(added, key=len, reverse=True)
        self._added = {name: np.array([number], "<u4").tobytes() for name, number in added.items()}
        self._split_added = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self._pieces = regex.compile(_WORDS).findall
        self._bytes = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, number in vocab.items():
            known = all(c in to_byte for c in token)
            self._bytes[number] = bytes(to_byte[c] for c in token) if known else token.encode()
        for name, number in added.items():
            self._bytes[number] = name.encode()
        self._edges: tuple[dict, dict] = ({}, {})
        self._fits: dict[int, bool] = {}
        self._signs: dict[str, bytes] = {}
        self._four = [np.array([i], "<u4").tobytes() for i in range(len(self._bytes))]
        self._spaced: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of *token* while it is built, each with the rank of the merge that ends it."""
        known = self._edges[side].get(token)
        if known is None:
            known, part, ended = [], token, float("inf")
            while part in self._halves:
                known.append((part, ended))
                halves = self._halves[part]
                part, ended = halves[side], halves[2]
            known.append((part, ended))
            self._edges[side][token] = known
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Whether no merge crosses the edge between the two tokens."""
        rank = self._rank.get
        for x, x_ended in self._edge(left, 1):
            for y, y_ended in self._edge(right, 0):
                merged = rank(x << 32 | y)
                # Where both ends have the same rank the left pair goes first.
                if merged is not None and merged < x_ended and merged <= y_ended:
                    return False
        return True

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word as the pattern cuts them."""
        line = word.encode().decode("latin-1").translate(self._letters)
        last, fits = [-1] * (len(line) + 1), self._fits
        last[0] = -2
        size = self._length
        for end, token in self._automaton.iter(line):
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
                elif before == -2:
                    last[end] = token
        if len(fits) > _CACHED_WORDS:
            fits.clear()
        ids, at = [], len(line)
        while at:
            token = last[at]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        return ids

    def _packed(self, word: str) -> bytes:
        four = self._four
        return b"".join([four[i] for i in self.word_ids(word)])

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self._packed(word) for word in self._pieces(chunk)])

    def _after_space(self, part: str) -> bytes:
        """Ids of a space and *part*."""
        ids = self._spaced.get(part) or self._older.get(part)
        if ids is None:
            # Letters are one word, and signs after them another; only the rest needs the pattern.
            letters = part if part.isalpha() else part.rstrip(_SIGNS)
            if letters == part and part.isalpha():
                ids = self._packed(" " + part)
            elif letters.isalpha():
                signs = part[len(letters) :]
                tail = self._signs.get(signs)
                if tail is None:
                    tail = self._packed(signs)
                    if len(self._signs) < 1000:
                        self._signs[signs] = tail
                ids = self._after_space(letters) + tail
            else:
                ids = self._chunk(" " + part)
        if len(part) <= _CACHED_LENGTH:
            if len(self._spaced) >= _CACHED_WORDS:
                self._older, self._spaced = self._spaced, {}
            self._spaced[part] = ids
        return ids

    def _encode_plain(self, text: str) -> bytes:
        # A word always starts at a space before something else than white space, so a text may be cut there.
        first, *parts = text.split(" ")
        ids = list(map(self._spaced.get, parts))
        unknown = [i for i, known in enumerate(ids) if known is None]
        if all(parts[i] and parts[i][0] not in _SPACES for i in unknown):
            for i in unknown:
                ids[i] = self._after_space(parts[i])
            return self._chunk(first) + b"".join(ids)
        starts = [i for i, p in enumerate(parts) if p and p[0] not in _SPACES]
        chunks = [" ".join(parts[a:b]) for a, b in zip(starts, [*starts[1:], len(parts)])]
        head = " ".join([first, *parts[: starts[0] if starts else None]])
        return self._chunk(head) + b"".join([self._after_space(c) for c in chunks])

    def encode(self, text: str) -> bytes:
        """Ids of *text* as little-endian unsigned 32-bit integers; added tokens in the text keep their own id."""
        if self._split_added is None:
            return self._encode_plain(text)
        pieces = self._split_added(text)
        if len(pieces) == 1:
            return self._encode_plain(text)
        return b"".join(self._added.get(p) or self._encode_plain(p) for p in pieces if p)

    def decode(self, ids: bytes) -> str:
        """The text of ids given as :meth:`encode` returns them; bytes that are no UTF-8 become U+FFFD."""
        content = self._bytes
        return b"".join([content[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


#: Runs that the library cannot work on, or only in quadratic time, and the length from which a text can hold one.
_LONG = 100_000
_LONG_RUN = re.compile(rf"\s{{{_LONG}}}|\S{{{_LONG}}}")


class LibraryBpe:
    """The same ids from the tiktoken library, for callers that need ids and not the method.

    The library's word pattern ends with an error on a very long run of blanks; a text with one goes to :class:`Bpe`.
    """

    def __init__(self, content: bytes) -> None:
        import tiktoken

        own = self._own = Bpe(content)
        spec = json.loads(content)
        vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {own._bytes[i]: i for token, i in vocab.items() if token not in added}
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("The ids of this file are not in the order of its merges")
        self._coder = tiktoken.Encoding("own", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> bytes:
        if len(text) >= _LONG and _LONG_RUN.search(text):
            return self._own.encode(text)
        return np.array(self._coder.encode(text, allowed_special="all"), "<u4").tobytes()


_loaded: dict[tuple[type, int], object] = {}


def shared_file(spark: SparkSession, path: str):
    """The tokenizer file for all executors. Its size is that of a vocabulary, whatever the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def loaded(content: bytes, kind: type = Bpe):
    """The coder of one tokenizer file, built once in a worker."""
    key = (kind, hash(content))
    if key not in _loaded:
        _loaded[key] = kind(content)
    return _loaded[key]


def encode(spark: SparkSession, text: Column | str, tokenizer: str) -> Column:
    """Ids of *text* by the file *tokenizer*, packed as little-endian unsigned 32-bit integers (binary); NULL is empty."""
    shared = shared_file(spark, tokenizer)

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        coder = loaded(shared.value)
        return pa.array([coder.encode(t.as_py() or "") for t in texts], pa.binary())

    # Repeatable, but marked so that the optimizer does not encode again for each use of the result.
    return run.asNondeterministic()(text)


def decode(spark: SparkSession, ids: Column | str, tokenizer: str) -> Column:
    """The text of packed *ids*, with added tokens written out; NULL is empty."""
    shared = shared_file(spark, tokenizer)

    @F.arrow_udf("string")
    def run(packed: pa.Array) -> pa.Array:
        coder = loaded(shared.value)
        return pa.array([coder.decode(i.as_py() or b"") for i in packed], pa.string())

    return run(ids)
