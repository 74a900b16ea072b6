"""Best-fit packing of documents into sequences of fixed size, by exact complements.

``pieces`` turns whole texts into token ids, closes each document with an end id, and cuts only
documents longer than a sequence.  How pieces combine depends on their lengths alone, and there
are no more lengths than tokens in a sequence, so the plan is made from that one histogram.

``patterns`` opens a sequence with the longest length left.  Its gap is looked up in an index of
the sums of one, two and three lengths that are left; a combination that fills the gap exactly is
taken if there are enough pieces of each.  Without one, the longest length that fits goes in and
the smaller gap is looked up again.  A pattern is repeated as often as pieces allow, so each takes
at least one length out of further use and the number of patterns does not grow with the corpus.

``places`` numbers the pieces of each length, first inside each stored part and then over the
parts by running totals, and reads each piece's sequence and offset from the plan: no length,
however frequent, meets in one task.

Defined results: a NULL or empty text is one piece of the end id; an empty table gives no pieces;
rows are never merged, so repeated rows or NULL ids give pieces of their own; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.bytetokens import byte_tokens
from starmill.llm.common import arrow_map, stored

VOCABULARY = "byte_bpe_50k.json"
SIZE = 2048
END = 0

_PIECES = (
    "part int, nth long, rank long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
)


def cuts(n: int, size: int) -> np.ndarray:
    """Borders of the pieces of ``n`` ids: all pieces are full but the first, which may be shorter."""
    first = n % size or size
    return np.r_[0, np.arange(first, n + 1, size)] if n > size else np.array([0, n])


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ids of a piece; they are stored in two bytes each where the vocabulary allows it."""
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None, end: int = END) -> DataFrame:
    """Stored pieces of all documents.

    ``part`` and ``nth`` name a piece; ``rank`` numbers the pieces of one length in a part.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        tokens = byte_tokens(path)
        kind = "<u2" if tokens.size <= 1 << 16 else "<u4"
        part, seen, done = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64), 0

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal done
            doc, number, start, length, crc, data = [], [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(tokens.encode(text) if text else np.zeros(0, np.uint32), np.uint32(end)).astype("<u4")
                small, at = ids.astype(kind), cuts(len(ids), size).tolist()
                for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    doc.append(doc_id)
                    number.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b]))
                    data.append(small[a:b].tobytes())
            sizes = np.array(length, np.int64)
            order = np.argsort(sizes, kind="stable")
            times = np.bincount(sizes, minlength=size + 1)
            rank = np.empty(len(sizes), np.int64)
            rank[order] = np.arange(len(sizes)) - np.repeat(np.cumsum(times) - times, times) + seen[sizes[order]]
            np.add(seen, times, out=seen)
            nth = np.arange(done, done + len(sizes))
            done += len(sizes)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), part), pa.int32()), pa.array(nth, pa.int64()), pa.array(rank, pa.int64()),
                    pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(data, pa.binary()),
                ],
                names=["part", "nth", "rank", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

        return step

    return stored(arrow_map(docs.select("doc_id", "text"), make, _PIECES), "packing-pieces")


class Complements:
    """Which lengths are left, and the sums that one, two or three of them make.

    The index counts sums over distinct lengths.  It may name a sum whose lengths are no longer
    there often enough, so every hit is checked against what is available.
    """

    def __init__(self, counts: np.ndarray):
        self.size = len(counts) - 1
        self.left = counts.astype(np.int64).copy()
        self.one = (self.left > 0).astype(np.int64)
        self.one[0] = 0
        self.two = np.convolve(self.one, self.one)[: self.size + 1]
        self.three = np.convolve(self.two, self.one)[: self.size + 1]
        self.taken: Counter[int] = Counter()  # by the pattern that is being made

    def use_up(self, length: int) -> None:
        """Take a length out of the index."""
        self.one[length] = 0
        self.two[length:] -= 2 * self.one[: self.size + 1 - length]
        if 2 * length <= self.size:
            self.two[2 * length] -= 1
        self.three[length:] -= 3 * self.two[: self.size + 1 - length]
        if 2 * length <= self.size:
            self.three[2 * length :] -= 3 * self.one[: self.size + 1 - 2 * length]
        if 3 * length <= self.size:
            self.three[3 * length] -= 1

    def free(self, length: int) -> int:
        return int(self.left[length]) - self.taken[length]

    def longest(self, gap: int) -> int:
        """The longest length up to ``gap`` of which a piece is free, or 0."""
        for length in np.flatnonzero(self.one[: gap + 1])[::-1].tolist():
            if self.free(length) > 0:
                return length
        return 0

    def _pair(self, gap: int) -> tuple[int, ...]:
        if gap < 2 or not self.two[gap]:
            return ()
        low = np.arange(1, gap // 2 + 1)
        for a in low[(self.one[low] & self.one[gap - low]) > 0][::-1].tolist():
            if self.free(a) > (a == gap - a) and self.free(gap - a) > 0:
                return gap - a, a
        return ()

    def exact(self, gap: int) -> tuple[int, ...]:
        """One, two or three free lengths that add up to ``gap``, or nothing."""
        if self.one[gap] and self.free(gap) > 0:
            return (gap,)
        if found := self._pair(gap):
            return found
        if gap < 3 or not self.three[gap]:
            return ()
        third = np.arange(1, gap - 1)
        for c in third[(self.one[third] > 0) & (self.two[gap - third] > 0)][::-1].tolist():
            if self.free(c) > 0:
                self.taken[c] += 1
                found = self._pair(gap - c)
                self.taken[c] -= 1
                if found:
                    return c, *found
        return ()


def patterns(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(times, [(length, how many), ...])`` for the counts of lengths 0 to the size of a sequence."""
    index = Complements(counts)
    out = []
    while first := index.longest(index.size):
        index.taken = Counter({first: 1})
        gap = index.size - first
        while gap:
            if found := index.exact(gap):
                index.taken.update(found)
                break
            fitting = index.longest(gap)
            if not fitting:
                break
            index.taken[fitting] += 1
            gap -= fitting
        pattern = sorted((+index.taken).items(), reverse=True)
        times = min(int(index.left[length]) // m for length, m in pattern)
        out.append((times, pattern))
        index.taken = Counter()
        for length, m in pattern:
            index.left[length] -= times * m
            if not index.left[length]:
                index.use_up(length)
    return out


def _intervals(made: list[tuple[int, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
    """Runs of ranks of one length: ``(length, first rank, pieces a sequence, first sequence, offset)`` by length and rank."""
    rows, used, sequence = [], Counter(), 0
    for times, pattern in made:
        offset = 0
        for length, m in pattern:
            rows.append((length, used[length], m, sequence, offset))
            used[length] += times * m
            offset += length * m
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(np.ascontiguousarray(c) for c in table.T)


_RANKS = 44  # bits of a rank beside the length in a key


def places(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Each piece with ``sequence_id`` and ``offset``; the columns are those of ``pieces`` but ids and ranks."""
    here = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(here.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-firsts")
    counts = np.zeros(size + 1, np.int64)
    for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        counts[r["length"]] = r["n"]
    shared = found.sparkSession.sparkContext.broadcast(_intervals(patterns(counts)))

    names = ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = found.drop("ids").join(firsts.drop("n").hint("merge"), ["length", "part"]).select(*names, (F.col("first") + F.col("rank")).alias("rank"))

    def make():
        length, lowest, many, sequence, offset = shared.value
        keys = (length << _RANKS) | lowest

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (own << _RANKS) | rank, "right") - 1
            turn, slot = np.divmod(rank - lowest[at], many[at])
            columns = [batch.column(c) for c in names]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[at] + turn), pa.array(offset[at] + slot * own)], names=[*names, "sequence_id", "offset"]
            )

        return step

    return arrow_map(
        ranked, make, "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def sequences(found: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids``, and the ``doc_ids`` and ``offsets`` of their pieces.

    A sequence holds no more pieces than tokens, so its rows may meet in one task.
    """
    rows = placed.select("part", "nth", "doc_id", "length", "sequence_id", "offset").join(found.select("part", "nth", "ids"), ["part", "nth"])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.concatenate([unpacked(d, n) for d, n in zip(table["ids"].to_pylist(), table["length"].to_pylist(), strict=True)])
        return pa.table({
            "sequence_id": table["sequence_id"][:1],
            "ids": pa.array([ids.astype(np.int32)], pa.list_(pa.int32())),
            "doc_ids": pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
            "offsets": pa.array([table["offset"].to_pylist()], pa.list_(pa.int64())),
        })

    return rows.groupBy("sequence_id").applyInArrow(run, "sequence_id long, ids array<int>, doc_ids array<long>, offsets array<long>")


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, end: int = END) -> DataFrame:
    """Per piece of each document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    return places(pieces(docs, size, path, end), size).drop("part", "nth")
