"""Byte-pair encoding by backtracking, and decoding from an offset table.

The encoder never replays merges.  An Aho-Corasick automaton over the vocabulary gives the
longest token that starts at each place; tokens are taken from left to right, and a token
may follow another only if no merge across their border would have come first.  If none
fits, the last token is taken back and a shorter one is tried.  Each place of a piece is
given up at most once, so the time is linear in its length.

Defined results: a NULL or empty text has no tokens; the end marker inside a text is its own
token; rows are neither dropped nor merged, so repeated rows give repeated results; columns
other pass through; one that has the name given for the result is replaced.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, int_lists

VOCABULARY = "byte_bpe_50k.json"
# White space as Unicode defines it; Python's own classes count four control characters more.
SPACE = "\t-\r \x85\xa0  -     　"
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Where a blank is followed by white space or the end, cutting at blanks could split a piece.
UNSAFE = regex.compile(rf" (?:[{SPACE}]|\Z)")
CACHED = 150_000  # entries of a worker's cache before its older half goes; only speed depends on it


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


def _halve(cache: dict) -> None:
    """Drop the older half of a cache."""
    for key in list(islice(cache, len(cache) // 2)):
        del cache[key]


class _AfterBlank(dict):
    """Packed ids of words that follow a blank, found once each; bounded."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = self.encode(" " + word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                _halve(self)
            self[word] = found
        return found


class Vocabulary:
    """Tokens, merges and decoding table of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.letters = {b: c for b, c in enumerate(letters)}
        size = max(*ids.values(), *self.special.values()) + 1
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        last = len(letters) - 1
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            token = ids[left + right]
            if token <= last:
                raise ValueError("token ids must follow the order of the merges")
            last = token
            self.parts[token] = (ids[left], ids[right])
            self.merged[ids[left], ids[right]] = token
        self.ids = ids
        if not all(c in ids for c in letters):
            raise ValueError("the vocabulary must hold every single byte")
        self.automaton = ahocorasick.Automaton()
        self.length = [0] * size
        for text, token in ids.items():
            self.automaton.add_word(text, (token, len(text)))
            self.length[token] = len(text)
        self.automaton.make_automaton()
        self.shorter = [-1] * size  # the longest token that is a proper prefix of a token
        for text, token in ids.items():
            for n in range(len(text) - 1, 0, -1):
                if text[:n] in ids:
                    self.shorter[token] = ids[text[:n]]
                    break
        self.apart: list[dict[int, bool]] = [{} for _ in range(size)]  # known answers by left token
        self.known = 0
        self.spelled = [b""] * size
        back = {c: b for b, c in enumerate(letters)}
        for text, token in ids.items():
            self.spelled[token] = bytes(back[c] for c in text)
        for text, token in self.special.items():
            self.spelled[token] = text.encode()
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(s) for s in self.spelled], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.end = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        self.pieces: dict[str, bytes] = {}
        self.after_blank = _AfterBlank(self._word)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging would leave ``left`` and ``right`` as neighbours."""
        known = self.apart[left].get(right)
        if known is None:
            if self.known >= CACHED:
                self.known = 0
                for answers in self.apart:
                    answers.clear()
            self.known += 1
            known = self.apart[left][right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the later of the two tokens step by step; no earlier merge may span the border."""
        before = len(self.parts)
        while True:
            token = self.merged.get((left, right))
            if token is not None and token < before:
                return False
            if left > right:
                if self.parts[left] is None:
                    return True
                before, left = left, self.parts[left][1]
            else:
                if self.parts[right] is None:
                    return True
                before, right = right + 1, self.parts[right][0]

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one piece of text between the cuts of the splitting rule."""
        text = piece.encode().decode("latin-1").translate(self.letters)
        whole = self.ids.get(text)
        if whole is not None:
            return [whole]
        n, longest_from = len(text), self.automaton.iter_long
        longest = [-1] * n
        for end, (token, size) in longest_from(text):  # one after the other, from the start
            longest[end + 1 - size] = token
        length, shorter, apart = self.length, self.shorter, self.apart
        closed: set[int] = set()  # places that were given up
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            fits = True
            if last >= 0:
                fits = apart[last].get(token)
                if fits is None:
                    fits = self.stay_apart(last, token)
            if fits and at + length[token] not in closed:
                out.append(token)
                at += length[token]
                if at == n:
                    return out
                last, token = token, longest[at]
                if token < 0:  # off the way of longest matches
                    token = longest[at] = next(longest_from(text, at))[1][0]
                continue
            token = shorter[token]
            while token < 0:
                closed.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
            last = out[-1] if out else -1

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = array("i", self.encode_piece(piece)).tobytes()
            if len(piece) <= 64:
                if len(self.pieces) >= CACHED:
                    _halve(self.pieces)
                self.pieces[piece] = found
        return found

    def _word(self, word: str) -> bytes:
        """A word with or without the blank before it."""
        if word[1:].isalpha() and (word[0] == " " or word[0].isalpha()):
            return array("i", self.encode_piece(word)).tobytes()
        if word[1:-1].isalpha() and word[0] == " " and word[-1] in ".,":
            return self.after_blank[word[1:-1]] + self._piece(word[-1])
        return b"".join(map(self._piece, PIECES.findall(word)))

    def _plain(self, text: str) -> bytes:
        if UNSAFE.search(text):
            return b"".join(map(self._piece, PIECES.findall(text)))
        first, *rest = text.split(" ")
        return self._word(first) + b"".join(map(self.after_blank.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Token ids of ``text`` as 32-bit integers in machine order."""
        if not text:
            return b""
        if self.end is None or not self.end.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.end.finditer(text):
            out += [self._plain(text[at : m.start()]) if m.start() > at else b"", np.int32(self.special[m.group()]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:]) if at < len(text) else b""])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, gathered through the offset table."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids.astype(np.int64) + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.blob[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _added(batch: pa.RecordBatch, name: str, array: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, array], names=[*batch.schema.names, name])


def _schema(df: DataFrame, name: str, kind: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{name}` {kind}"])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with a column of token ids; a NULL text gives an empty list."""
    path, docs = path or public_tokenizers.path(VOCABULARY), docs.drop(ids)

    def make():
        words = vocabulary(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [words.encode(t) for t in batch.column(text).to_pylist()]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(b) // 4 for b in found], out=offsets[1:])
            return _added(batch, ids, int_lists(np.frombuffer(b"".join(found), np.int32), offsets))

        return step

    return arrow_map(docs, make, _schema(docs, ids, "array<int>"))


def decode(tokens: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """``tokens`` with the text its ids stand for; broken UTF-8 is replaced as usual."""
    path, tokens = path or public_tokenizers.path(VOCABULARY), tokens.drop(text)

    def make():
        words = vocabulary(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(ids)
            values = column.values.to_numpy(zero_copy_only=False)
            cuts = column.offsets.to_numpy()
            out = [words.decode(values[a:b]).decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
            return _added(batch, text, pa.array(out, pa.string()))

        return step

    return arrow_map(tokens, make, _schema(tokens, text, "string"))


def round_trip(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text and the text that they decode to, in one pass.

    The ids are decoded where they were made, so only one worker a task holds the vocabulary.
    """
    path, docs = path or public_tokenizers.path(VOCABULARY), docs.drop(ids, decoded)

    def make():
        words = vocabulary(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [words.encode(t) for t in batch.column(text).to_pylist()]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(b) // 4 for b in found], out=offsets[1:])
            back = [words.decode(np.frombuffer(b, np.int32)).decode("utf-8", "replace") for b in found]
            with_ids = _added(batch, ids, int_lists(np.frombuffer(b"".join(found), np.int32), offsets))
            return _added(with_ids, decoded, pa.array(back, pa.string()))

        return step

    return arrow_map(docs, make, f"{_schema(docs, ids, 'array<int>')}, `{decoded}` string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the decoded text."""
    done = round_trip(docs.select("doc_id", "text"), path=path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
