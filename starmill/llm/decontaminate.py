"""Benchmark passages in training text, found by spaced seeds.

A seed looks at fixed places of a window of words and skips the others, so a replaced word at a
skipped place does not hide the window.  Seed hashes of all windows of the benchmark and of the
training texts are joined; around each hit the texts are compared word by word on that
alignment, with replaced words tolerated, and the best overlap decides.

An overlap counts when it has ``MATCHED`` equal words or ``WHOLE`` of the item's words, whichever
is less.  A single equal word at either end, cut off by a replaced one, is not part of an overlap.
Items of fewer than ``LEAST`` words occur by chance in any text; they match a text that consists
of just their words.

How it scales: a Bloom filter of bounded size over the benchmark's hashes is all that is
broadcast.  Only documents with a window that passes it are kept with their words; the exact
joins then run over those, by distinct hash, so that repeated windows do not multiply.  Places are
compared in one task per document and item: all alignments at once, in time linear in the length
of the document, and word by word only those with enough equal words.  Equal items and equal texts
are compared once.

Defined results: NULL or empty texts match nothing; an item or document with a NULL id takes
part like any other; repeated rows are judged alike; equal items are reported under the smallest
id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, bloom, free_name, passing, stored

# Places that count.  Long seeds serve items of at least 13 words, short ones those of 6 to 9 and
# tiny ones those below; short and tiny ones allow for one replaced word anywhere.
LONG = ("1110110010111", "1101011101101", "1011101110011")
SHORT = ("111011", "110111", "101111", "111101", "11111")
TINY = ("1111", "10111", "11011", "11101")
# Five places each, for items of 10 words or more: chosen so that every overlap of up to 24 words
# that counts holds one of them, wherever its replaced words are.
DENSE = (
    "110100010001", "1100101001", "110001001001", "1100010101", "11010010001", "1101000011", "10010100011",
    "101000100101", "110100100001", "110010011", "1110010001", "1111001", "1101000101",
)
SEEDS = LONG + DENSE + SHORT + TINY
MATCHED, WHOLE = 12, 0.8
LEAST = 4
DROP = 4  # an overlap ends where mismatches outweigh matches by so much
_WORDS = re.compile(r"\w+")
_FACTORS = np.random.default_rng(2).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GROUP = 100_000  # words hashed together


def words_of(text: str | None) -> list[int]:
    """Hashes of the words of a text, whatever their case and punctuation."""
    digest = xxhash.xxh3_64_intdigest
    return [digest(w) for w in _WORDS.findall((text or "").lower())]


def seeded(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed's hash at every window start."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, number + 1, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out += words[i : i + n] * _FACTORS[i]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


_CELLS = 1 << 22  # words compared at once


def whole_hash(words: np.ndarray) -> np.uint64:
    """The hash of a short sequence as a whole."""
    return np.uint64(xxhash.xxh3_64_intdigest(b"whole" + words.tobytes()))


def masks_of(n: int) -> list[tuple[int, str]]:
    """Number and places of every seed that looks up an item of ``n`` words."""
    if n < LEAST:
        return []
    of_size = TINY if n < 6 else SHORT if n < 10 else DENSE if n < len(LONG[0]) else LONG + DENSE
    return [(i, m) for i, m in enumerate(SEEDS) if m in of_size]


def counts(equal: int, n: int) -> bool:
    """Whether so many equal words of an item of ``n`` words make a leak."""
    return n >= LEAST and equal >= min(MATCHED, WHOLE * n)


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items: ``item_id`` and their words."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.array(words_of(t), np.uint64).tobytes() for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.binary())], names=["item_id", "item"])

        return step

    rows = arrow_map(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), make, "item_id long, item binary")
    return rows.where(F.length("item") > 0).groupBy("item").agg(F.min("item_id").alias("item_id"))


def _seeds(items: DataFrame) -> DataFrame:
    """Seed hashes of all items: ``hash``, the item, and the place of the window."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, owner, place = [], [], []
            column = batch.column("item").to_pylist()
            for i, data in enumerate(column):
                words = np.frombuffer(data, np.uint64)
                if len(words) < LEAST:
                    hashes.append(whole_hash(words)[None])
                    owner.append(np.full(1, i))
                    place.append(np.zeros(1, np.int32))
                for number, mask in masks_of(len(words)):
                    h = seeded(words, mask, number)
                    hashes.append(h)
                    owner.append(np.full(len(h), i))
                    place.append(np.arange(len(h), dtype=np.int32))
            if not hashes:
                return None
            which = pa.array(np.concatenate(owner), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes).view(np.int64)), batch.column("item").take(which), batch.column("item_id").take(which), pa.array(np.concatenate(place), pa.int32())],
                names=["hash", "item", "item_id", "at"],
            )

        return step

    return arrow_map(items, make, "hash long, item binary, item_id long, at int")


def _hits(docs: DataFrame, filter_bytes: np.ndarray, masks: list[tuple[int, str]]) -> DataFrame:
    """Documents with windows that pass the filter: ``mark``, ``doc_id``, words, hits."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_bytes)

    def make():
        bits = shared.value

        def scan(texts: list[list[int]]) -> list[tuple[list[int], list[int]]]:
            sizes = np.array([len(t) for t in texts])
            ends = np.cumsum(sizes)
            words = np.array([w for t in texts for w in t], np.uint64)
            owner = np.repeat(np.arange(len(texts)), sizes)
            found: list[tuple[list[int], list[int]]] = [([], []) for _ in texts]
            short = np.flatnonzero((sizes > 0) & (sizes < LEAST))
            if len(short):
                h = np.array([whole_hash(words[ends[k] - sizes[k] : ends[k]]) for k in short], np.uint64)
                for i in passing(bits, h):
                    found[short[i]][0].append(int(h[i].view(np.int64)))
                    found[short[i]][1].append(0)
            for number, mask in masks:
                h = seeded(words, mask, number)
                for i in passing(bits, h):
                    k = owner[i]
                    if i + len(mask) <= ends[k]:  # not across two texts
                        found[k][0].append(int(h[i].view(np.int64)))
                        found[k][1].append(int(i - (ends[k] - sizes[k])))
            return found

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: list[tuple[int, bytes, list[int], list[int]]] = []
            group, first, size = [], 0, 0
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                group.append(words_of(text))
                size += len(group[-1])
                if size >= _GROUP or i == len(texts) - 1:
                    for k, (h, at) in enumerate(scan(group) if size else []):
                        if h:
                            rows.append((first + k, np.array(group[k], np.uint64).tobytes(), h, at))
                    group, first, size = [], i + 1, 0
            if not rows:
                return None
            which = pa.array([r[0] for r in rows], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("mark").take(which), batch.column("doc_id").take(which), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                names=["mark", "doc_id", "doc", "hashes", "places"],
            )

        return step

    marked = docs.select(row_mark().alias("mark"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(marked, make, "mark long, doc_id long, doc binary, hashes array<long>, places array<int>")


def row_mark():
    """One number for id and text, which also tells rows without an id apart."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Best overlap with the item laid at word ``shift``: equal words, first word, words."""
    a, b = max(0, shift), min(len(doc), shift + len(item))
    same = doc[a:b] == item[a - shift : b - shift]
    best, gain, equal, first = (0, a, 0), 0, 0, a
    top = 0
    for i, s in enumerate(same.tolist()):
        if gain == 0 and not s:
            continue
        if gain == 0:
            first, equal, top = a + i, 0, 0
        gain += 1 if s else -1
        equal += s
        if gain >= top and s:
            top = gain
            if equal > best[0]:
                best = (equal, first, a + i + 1 - first)
        if gain <= 0 or top - gain >= DROP:
            gain = 0
    return best


def alignments(hashes: np.ndarray, places: np.ndarray, item: np.ndarray, size: int) -> np.ndarray:
    """Distinct shifts at which a window of the item and one of the document have the same seed hash."""
    order = np.argsort(hashes, kind="stable")
    hashes, places = hashes[order], places[order]
    hit = np.zeros(size + len(item), bool)
    for number, mask in masks_of(len(item)):
        own = seeded(item, mask, number).view(np.int64)
        for at, (a, b) in enumerate(zip(np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right"), strict=True)):
            hit[places[a:b] - at + len(item)] = True
    return np.flatnonzero(hit) - len(item)


def best_overlap(doc: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int]:
    """The best overlap over several shifts; those with too few equal words are passed over."""
    n, best = len(item), (0, 0, 0)
    padded = np.concatenate([np.full(n, ~item[0], np.uint64), doc, np.full(n, ~item[0], np.uint64)])
    step = max(1, _CELLS // n)
    for i in range(0, len(shifts), step):
        part = shifts[i : i + step]
        equal = (np.lib.stride_tricks.sliding_window_view(padded, n)[part + n] == item).sum(axis=1)
        for shift, most in zip(part[equal >= min(MATCHED, WHOLE * n)].tolist(), equal[equal >= min(MATCHED, WHOLE * n)].tolist(), strict=True):
            if most >= best[0]:
                best = max(best, overlap(doc, item, shift))
    return best


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per contaminated row and item: ``mark``, ``doc_id``, ``item_id``, the best overlap and its share of the item."""
    items = stored(_items(benchmark), "leak-items")
    seeds = stored(_seeds(items), "leak-seeds")
    longest = len(LONG[0])  # longer items have the same seeds
    sizes = items.select(F.least(F.length("item") / 8, F.lit(longest)).cast("int").alias("n")).distinct().collect()
    masks = sorted({m for r in sizes for m in masks_of(r["n"])})
    hits = stored(_hits(docs, bloom(seeds), masks), "leak-hits").dropDuplicates(["mark"])
    pairs = (
        hits.select("mark", F.explode(F.array_distinct("hashes")).alias("hash"))
        .join(seeds.select("hash", "item", "item_id").distinct(), "hash")
        .groupBy("mark", "item")
        .agg(F.min("item_id").alias("item_id"))
    )
    texts = pairs.join(hits, "mark")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for r in batch.to_pylist():
                doc, item = np.frombuffer(r["doc"], np.uint64), np.frombuffer(r["item"], np.uint64)
                if len(item) < LEAST:
                    if r["doc"] == r["item"]:
                        rows.append((r["mark"], r["doc_id"], r["item_id"], len(item), 0, len(item), 1.0))
                    continue
                shifts = alignments(np.array(r["hashes"], np.int64), np.array(r["places"], np.int64), item, len(doc))
                equal, first, size = best_overlap(doc, item, shifts)
                if counts(equal, len(item)):
                    rows.append((r["mark"], r["doc_id"], r["item_id"], equal, first, size, equal / len(item)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["mark", "doc_id", "item_id", "matched", "first_word", "n_words", "item_share"])

        return step

    return arrow_map(texts, make, "mark long, doc_id long, item_id long, matched int, first_word int, n_words int, item_share double")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage."""
    mark = free_name(docs, "row_mark")
    gone = leaks(docs, benchmark).select(F.col("mark").alias(mark)).distinct()
    return docs.withColumn(mark, row_mark()).join(gone, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
