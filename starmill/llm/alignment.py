"""Which tokens of two tokenizers cover the same text, by pointer jumping.

A text is encoded by a byte-level vocabulary (A, which gets the text after a blank) and by a
sentencepiece model (B, which adds the blank itself).  Both cover the same bytes, so where
tokens of both end, the text is cut into groups.  To label them, every token points to the
farthest-right token of the other side that it overlaps, the one that holds its last byte; a
B token that ends where an A token ends points to itself, and such an A token to it.  Doubling
all successors at once reaches the last token of each group after a number of rounds that is
the logarithm of the longest chain, whatever the number of texts in the batch.

All A-B pairs of occurrences in a group are links.  Over the corpus, an id pair counts in how
many documents it is linked.  ``scores`` sums those counts over each document's links, and
counts the links whose pair no other pair of the same A id outnumbers.  Documents are aligned
once and stored with their distinct pairs.  The most frequent pairs, ``HOT`` of them at most,
are broadcast as a table of that size and looked up in place; rarer pairs, which by then no
single one can be frequent, are joined.

Defined results: a text that is NULL or empty, or whose joined bytes on one side differ from
blank and text (as B's do where the text holds U+2581), has no tokens: zeros, and '' for the
digest.  Strings of special tokens are ordinary text.  Each row is a document of its own, also
if it repeats another or has no id; columns other than ``doc_id`` and ``text`` are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.bytetokens import byte_tokens
from starmill.llm.common import arrow_map, stored

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
LINKS = 2_000_000  # links or distinct pairs that are spread out at once
HELD = 4_000_000  # pairs that a worker counts before it passes them on
HOT = 500_000  # pairs that are broadcast


class Piece:
    """A sentencepiece model with the bytes of each of its pieces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.spelled = []
        for i in range(self.size):
            text = self.model.id_to_piece(i)
            self.spelled.append(bytes([int(text[3:5], 16)]) if self.model.is_byte(i) else text.replace("▁", " ").encode())


@lru_cache(maxsize=2)
def piece_model(path: str) -> Piece:
    return Piece(path)


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered from 0, from where the tokens end.

    Both cover the same bytes, so the last ends are equal.
    """
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size, length = len(ends_a), int(ends_a[-1])
    before_a, before_b = np.zeros(length + 1, np.int32), np.zeros(length + 1, np.int32)
    before_a[ends_a] = 1
    before_b[ends_b] = 1
    closed = before_a[ends_b] == 1  # B tokens that end a group
    np.cumsum(before_a, out=before_a)
    np.cumsum(before_b, out=before_b)
    # The token that holds the byte before place x is the number of tokens that end before x.
    jump = np.concatenate([size + before_b[ends_a - 1], np.where(closed, np.arange(len(ends_b)) + size, before_a[ends_b - 1])])
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    label = np.cumsum(closed) - 1
    return label[jump[:size] - size], label[jump[size:] - size]


def _starts(groups: np.ndarray, number: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=number))])


def _spread(a: np.ndarray, ga: np.ndarray, b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of an A and a B token of one group; ``first`` says where a group's B tokens start."""
    many = first[ga + 1] - first[ga]
    left = np.repeat(np.arange(len(a)), many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[ga], many)
    return left, right


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_tokens(path_a), piece_model(path_b)
        self.len_a = np.array([len(s) for s in self.a.spelled], np.int64)
        self.len_b = np.array([len(s) for s in self.b.spelled], np.int64)
        # An id as it is written: before a comma, at the end of its side, at the end of all.
        self.written = [f"{i}{end}".encode() for i in range(self.a.size) for end in (",", "|", "")]
        self.written += [f"{i}{end}".encode() for i in range(self.b.size) for end in (",", ";", "")]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        none = np.zeros(0, np.int64)
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        for i, ids in zip(full, self.b.model.encode([texts[i] for i in full], num_threads=1), strict=True):
            text = " " + texts[i]
            raw = text.encode()
            if b"".join(map(self.b.spelled.__getitem__, ids)) != raw:
                continue
            a = self.a.encode_plain(text).astype(np.int64)
            if int(self.len_a[a].sum()) == len(raw) and b"".join(map(self.a.spelled.__getitem__, a.tolist())) == raw:
                out_a[i], out_b[i] = a, np.array(ids, np.int64)
        return out_a, out_b

    def align(self, texts: list[str | None]) -> list[dict]:
        """Per text: counts, digest, and slices of ``(pairs, times)`` that no pair is in twice."""
        out_a, out_b = self.tokens(texts)
        n_a, n_b = np.array([len(x) for x in out_a], np.int64), np.array([len(x) for x in out_b], np.int64)
        a, b = np.concatenate(out_a) if out_a else np.zeros(0, np.int64), np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
        # Both sides of each text have the same bytes, so running totals agree where texts meet.
        ga, gb = group_labels(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        number = int(gb[-1]) + 1 if len(gb) else 0
        first_a, first_b = _starts(ga, number), _starts(gb, number)
        at_a, at_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
        last_group = np.r_[gb[at_b[1:] - 1] + 1 if number else np.zeros(len(texts), np.int64)]
        group_at = np.zeros(len(texts) + 1, np.int64)
        group_at[1:] = np.where(n_b > 0, last_group, 0)
        np.maximum.accumulate(group_at, out=group_at)
        links = np.r_[0, np.cumsum(np.diff(first_a) * np.diff(first_b))]
        n_links = links[group_at[1:]] - links[group_at[:-1]]
        digests = self._digests(a, b, ga, gb, first_a, first_b, at_a, at_b)
        out = [
            {"n_a": int(n_a[i]), "n_b": int(n_b[i]), "n_groups": int(group_at[i + 1] - group_at[i]), "n_links": int(n_links[i]), "groups_sha256": digests[i], "slices": []}
            for i in range(len(texts))
        ]
        i = 0
        while i < len(texts):
            j, total = i + 1, int(n_links[i])
            while j < len(texts) and total + n_links[j] <= LINKS:
                total += int(n_links[j])
                j += 1
            own = (a[at_a[i] : at_a[j]], ga[at_a[i] : at_a[j]] - group_at[i], b[at_b[i] : at_b[j]], gb[at_b[i] : at_b[j]] - group_at[i])
            if total > LINKS:  # one text with very many
                out[i]["slices"] = list(self._sliced(*own))
            elif total:
                doc = np.repeat(np.arange(j - i), n_a[i:j])
                for k, part in enumerate(self._distinct(doc, *own, j - i)):
                    out[i + k]["slices"] = [part] if len(part[0]) else []
            i = j
        return out

    def _distinct(self, doc, a, ga, b, gb, docs):
        left, right = _spread(a, ga, b, _starts(gb, int(gb[-1]) + 1))
        space = self.a.size * self.b.size
        key = doc[left] * space + a[left] * self.b.size + b[right]
        key.sort()
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times = np.diff(np.r_[new, len(key)])
        key = key[new]
        borders = np.searchsorted(key, np.arange(docs + 1) * space)
        for k, (x, y) in enumerate(zip(borders, borders[1:], strict=False)):
            yield key[x:y] - k * space, times[x:y]

    def _sliced(self, a, ga, b, gb):
        """Equal ids of a group count once, and A ids are dealt into as many slices as memory asks for."""
        number = int(gb[-1]) + 1
        ka, ca = np.unique(ga * self.a.size + a, return_counts=True)
        kb, cb = np.unique(gb * self.b.size + b, return_counts=True)
        ga, a, gb, b = ka // self.a.size, ka % self.a.size, kb // self.b.size, kb % self.b.size
        first = _starts(gb, number)
        slices = -(-int((first[ga + 1] - first[ga]).sum()) // LINKS)
        for r in range(slices):
            own = np.flatnonzero(a % slices == r)
            left, right = _spread(a[own], ga[own], b, first)
            key, times = a[own][left] * self.b.size + b[right], ca[own][left] * cb[right]
            if not len(key):
                continue
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield key[new], np.add.reduceat(times, new)

    def _digests(self, a, b, ga, gb, first_a, first_b, at_a, at_b) -> list[str]:
        code_a, code_b = 3 * a, 3 * (b + self.a.size)
        if len(a):
            code_a[first_a[1:] - 1] += 1
            code_b[first_b[1:] - 1] += 1
            code_b[at_b[1:][np.diff(at_b) > 0] - 1] += 1
        merged = np.empty(len(a) + len(b), np.int64)
        merged[np.arange(len(a)) + first_b[ga]] = code_a
        merged[np.arange(len(b)) + first_a[gb + 1]] = code_b
        at = at_a + at_b
        written = self.written.__getitem__
        return [hashlib.sha256(b"".join(map(written, merged[x:y].tolist()))).hexdigest() if y > x else "" for x, y in zip(at, at[1:], strict=False)]


_ALIGNED = (
    "part int, nth long, slice int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Stored rows, one or more for a document: its counts and digest, and a slice of its distinct pairs.

    ``part`` and ``nth`` name a document.  A pair is the A id times the size of B's vocabulary plus
    the B id, in 8 bytes, ``times`` how often it is linked, in 4.
    """
    path_a, path_b = path_a or public_tokenizers.path(BYTES), path_b or public_tokenizers.path(PIECES)
    stats = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        aligner, part, nth = Aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                rows, ids = [], batch.column("doc_id").to_pylist()
                for doc_id, found in zip(ids, aligner.align(batch.column("text").to_pylist()), strict=True):
                    for i, (pairs, times) in enumerate(found["slices"] or [(np.zeros(0, np.int64), np.zeros(0, np.int64))]):
                        rows.append((part, nth, i, doc_id, *(found[s] for s in stats), pairs.astype("<i8").tobytes(), times.astype("<u4").tobytes()))
                        if sum(len(r[-2]) for r in rows[-4:]) > 8 * LINKS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)
                            rows = []
                    nth += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)

    return stored(docs.select("doc_id", "text").mapInArrow(run, _ALIGNED), "alignment-documents")


_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in _ALIGNED.split(", ")]


def _lists(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and borders of a column of packed numbers."""
    data = batch.column(name).to_pylist()
    values = np.frombuffer(b"".join(data), kind)
    return values, np.r_[0, np.cumsum([len(d) for d in data])] // values.itemsize


def counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Stored ``(pair, n, best)``: documents that hold an id pair linked, and whether no pair of its A id has more."""

    def run(batches):
        keys, times = [], []

        def merged():
            key, n = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            return key[new], np.add.reduceat(n, new) if len(new) else n

        def rows(key, n):
            for x in range(0, len(key), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[x : x + 100_000]), pa.array(n[x : x + 100_000])], names=["pair", "n"])

        held = 0
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                values, _ = _lists(whole.slice(first, 1000), "pairs", "<i8")
                key, n = np.unique(values, return_counts=True)
                keys.append(key)
                times.append(n.astype(np.int64))
                held += len(key)
                if held >= HELD:
                    key, n = merged()
                    if len(key) > HELD // 2:
                        yield from rows(key, n)
                        keys, times, held = [], [], 0
                    else:
                        keys, times, held = [key], [n], len(key)
        if held:
            yield from rows(*merged())

    pairs = aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stored(pairs, "alignment-pairs").withColumn("a", F.expr(f"pair div {size_b}"))
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))  # at most one row per id of A's vocabulary
    best = pairs.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return stored(best, "alignment-counts")


def _threshold(known: DataFrame, hot: int) -> int:
    """The lowest power of two from which on there are at most ``hot`` pairs."""
    classes = known.groupBy(F.floor(F.log2("n")).cast("int").alias("c")).count().collect()  # 63 rows at most
    left = hot
    for c, n in sorted(((r["c"], r["count"]) for r in classes), reverse=True):
        left -= n
        if left < 0:
            return 1 << (c + 1)
    return 0


def scores(aligned: DataFrame, known: DataFrame, hot: int = HOT) -> DataFrame:
    """Per document the stored counts and digest, ``n_best`` and ``count_sum``."""
    least = _threshold(known, hot)
    top = known.where(F.col("n") >= least).orderBy("pair").toArrow()  # at most ``hot`` rows
    shared = aligned.sparkSession.sparkContext.broadcast(
        (top["pair"].to_numpy(), top["n"].to_numpy(), np.asarray(top["best"].to_numpy(zero_copy_only=False), np.int64))
    )
    stats = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    keep = ["part", "nth", *stats]

    def find(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = shared.value[0]
        at = np.minimum(np.searchsorted(pair, values), max(0, len(pair) - 1))
        return at, pair[at] == values if len(pair) else np.zeros(len(values), bool)

    def make_hot():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, cuts = _lists(batch, "pairs", "<i8")
            times = _lists(batch, "times", "<u4")[0].astype(np.int64)
            at, hit = find(values)
            _, n, best = shared.value
            sums = []
            for worth in (best, n):
                each = np.where(hit, times * worth[at], 0) if len(n) else np.zeros(len(values), np.int64)
                total = np.r_[0, np.cumsum(each)]
                sums.append(pa.array(total[cuts[1:]] - total[cuts[:-1]], pa.int64()))
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *sums], names=[*keep, "n_best", "count_sum"])

        return step

    kinds = "part int, nth long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    done = arrow_map(aligned.select(*keep, "pairs", "times"), make_hot, f"{kinds}, n_best long, count_sum long")
    if least:

        def make_cold():
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                values, cuts = _lists(batch, "pairs", "<i8")
                times = _lists(batch, "times", "<u4")[0].astype(np.int64)
                rest = np.flatnonzero(~find(values)[1])
                row = np.searchsorted(cuts, rest, "right") - 1
                return pa.RecordBatch.from_arrays(
                    [batch.column("part").take(pa.array(row)), batch.column("nth").take(pa.array(row)), pa.array(values[rest]), pa.array(times[rest])],
                    names=["part", "nth", "pair", "times"],
                )

            return step

        cold = arrow_map(aligned.select("part", "nth", "pairs", "times"), make_cold, "part int, nth long, pair long, times long")
        rare = cold.join(known.where(F.col("n") < least), "pair").select(
            "part", "nth", *[F.lit(None).cast(done.schema[c].dataType).alias(c) for c in stats],
            (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"),
        )
        done = done.unionByName(rare)
    whole = done.groupBy("part", "nth").agg(*[F.max(c).alias(c) for c in stats], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, hot: int = HOT) -> DataFrame:
    """Per document: tokens of both sides, groups, links, best links, sum of counts, digest of the groups."""
    path_b = path_b or public_tokenizers.path(PIECES)
    aligned = align(docs, path_a, path_b)
    return scores(aligned, counts(aligned, piece_model(path_b).size), hot)
