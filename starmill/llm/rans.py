"""Token ids in entropy-coded files: static range asymmetric numeral systems.

``write`` turns whole texts into token ids, orders the documents by id, and stores runs of
documents ("segments") as binary records of a Spark table, so any store Spark writes to will
do.  All segments share one frequency table, taken over all ids and kept beside them.

A segment holds independent blocks.  In a block, symbol ``i`` belongs to lane ``i % lanes``;
the lanes are interleaved in one stream of 32-bit words.  At fixed steps the block keeps the
state of every lane and the place in the stream, so its stretches are decoded side by side;
a checksum over the ids closes the block.

Block layout, little-endian: ids ``u32``, lanes ``u32``, stretches ``u32``, words ``u32``,
crc32 ``u32``; then first word of each stretch ``u32[stretches]``, states
``u64[stretches, lanes]``, and the words.

Defined results: a NULL or empty text has the end id only; rows with a NULL document id come
first; documents with equal ids are ordered by their text and none is lost; an empty table
gives no segments; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmill.llm.bpe import byte_letters
from starmill.llm.common import arrow_map, int_lists
from starmill.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 2
SCALE = 20  # bits of the shared table: frequencies add up to 2**SCALE
LOW = np.uint64(1 << 31)  # lower end of a lane's state
LANES, STEPS = 4096, 128  # lanes of a block; steps of a stretch between two kept states
BLOCK = LANES * STEPS * 2
SEGMENT = BLOCK  # ids after which a segment is closed, at the end of a document
WORDS = 400_000  # entries of a worker's cache beyond which its older half goes
LETTERS = 8 << 20  # bytes of text that are encoded together
# Control characters that Python takes for white space and Unicode does not, and the one that closes a piece here.
ODD = r"[\x00\x1c-\x1f]"
BEYOND = re.compile("[^\x00-\u024f]")
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordTokens(dict):
    """Ids of a text as the tokenizers library gives them, with each distinct word encoded once.

    The vocabulary's rules drop white space and never join across it, so the ids of a text are
    those of its words in turn.  This maps words to packed ids.  New words of a batch are
    normalized and cut into pieces, and all new pieces go through the vocabulary's merges at once:
    a piece is closed by a NUL, whose merges with the byte before it come first and stand for the
    vocabulary's word ends.  Up to U+024F no two characters combine, so normalizing only
    lower-cases; words with others pass the library's normalizer.  Words with a special token, and texts
    with odd control characters, go through the library whole.  The cache is bounded.
    """

    def __init__(self, path: str):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.marks = {s[0] for s in self.special}
        back = {c: b for b, c in enumerate(byte_letters())}
        suffix = json.loads(self.library.to_str())["model"]["end_of_word_suffix"]
        ranks, self.closes = {}, np.zeros(self.library.get_vocab_size(with_added_tokens=True), bool)
        for text, token in self.library.get_vocab(with_added_tokens=False).items():
            closed = text.endswith(suffix)
            ranks[bytes(map(back.__getitem__, text.removesuffix(suffix) if closed else text)) + (b"\0" if closed else b"")] = token
            self.closes[token] = closed
        self.merges = tiktoken.Encoding("pieces", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _lowered(self, words: list[str]) -> list[str]:
        """Words after normalizing; white space parts them, so that they are lower-cased together."""
        together = "\n".join(words)
        if not BEYOND.search(together):
            return together.lower().split("\n")
        return [self.library.normalizer.normalize_str(w) if BEYOND.search(w) else w.lower() for w in words]

    def _learn(self, words: list[str]) -> pa.LargeBinaryArray:
        """Packed ids of new words, which hold no odd character."""
        together = "\n".join(words)
        special = [i for i, w in enumerate(words) if any(s in w for s in self.special)] if any(m in together for m in self.marks) else []
        plain = [w for w in words if not any(s in w for s in self.special)] if special else words
        counts, pieces = [], []
        for text in self._lowered(plain) if plain else []:
            if text.isalpha():  # one piece, by the first letter rule
                pieces.append(text)
                counts.append(1)
            elif text[-1] in ".," and text[:-1].isalpha():
                pieces += (text[:-1], text[-1])
                counts.append(2)
            else:
                own = PIECES.findall(text)
                pieces += own
                counts.append(len(own))
        ids = self.merges.encode_to_numpy("\0".join(pieces) + "\0", disallowed_special=()) if pieces else np.zeros(0, np.uint32)
        ends = np.r_[0, np.flatnonzero(self.closes[ids]) + 1] * 4
        cuts = ends[np.r_[0, np.cumsum(counts, dtype=np.int64)]]
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(plain), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype(np.uint32))])
        if special:
            place = np.argsort(np.r_[np.setdiff1d(np.arange(len(words)), special), special], kind="stable")
            out = pa.concat_arrays([out, pa.array([self._whole(words[i]) for i in special], pa.large_binary())]).take(pa.array(place))
        return out

    def encode_all(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of many texts as 32-bit integers.

        Arrow splits the texts and numbers their distinct words, so that each word of a batch is
        looked up once; the packed ids are then laid out by those numbers.  Words that a batch
        holds more than once stay in the cache.
        """
        if len(self) > WORDS:  # the older half goes
            for word in list(islice(self, len(self) // 2)):
                del self[word]
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = pc.match_substring_regex(texts, ODD).fill_null(False)
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts.fill_null("")))
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [b"" if not w else self.get(w) for w in words]
        missing = np.array([i for i, ids in enumerate(known) if ids is None], np.int64)
        new = [words[i] for i in missing.tolist()]
        learnt = self._learn(new)
        # Words that were known keep their numbers; NULL stands at the numbers of new ones.
        place = np.arange(len(words))
        place[missing] = len(words) + np.arange(len(new))
        at = numbered.indices.to_numpy()
        packed = pa.concat_arrays([pa.array(known, pa.large_binary()), learnt]).take(pa.array(place[at]))
        ends = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1) if len(packed) else np.zeros(1, np.int64)
        cuts, ids = ends[split.offsets.to_numpy()].tolist(), packed.buffers()[2]
        out = [ids[a:b].to_pybytes() if b > a else b"" for a, b in zip(cuts, cuts[1:], strict=False)]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._whole(texts[i].as_py())
        often = np.flatnonzero(np.bincount(at, minlength=len(words))[missing] > 1)
        self.update((w, b) for w, b in zip([new[i] for i in often.tolist()], learnt.take(pa.array(often)).to_numpy(zero_copy_only=False).tolist(), strict=True) if len(w) <= 64)
        return out


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


class Coder:
    """Encoder and decoder for one frequency table."""

    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.first = np.zeros(len(frequencies), np.uint64)
        self.first[1:] = np.cumsum(self.frequency)[:-1]
        self.limit = self.frequency << np.uint64(63 - SCALE)
        self._symbol: np.ndarray | None = None
        self.filler = int(np.argmax(frequencies)) if len(frequencies) else 0

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))
        return self._symbol

    def encode_block(self, ids: np.ndarray) -> bytes:
        lanes = LANES
        while lanes > 1 and lanes * 64 > len(ids):
            lanes //= 2
        steps = -(-len(ids) // lanes)
        padded = np.full(steps * lanes, self.filler, np.int64)
        padded[: len(ids)] = ids
        rows = padded.reshape(steps, lanes)
        freq, first, limit = self.frequency[rows], self.first[rows], self.limit[rows]
        stretches = -(-steps // STEPS)
        states = np.zeros((stretches, lanes), np.uint64)
        words: list[np.ndarray] = []
        counts = np.zeros(steps, np.int64)
        x = np.full(lanes, LOW, np.uint64)
        whole, half = np.uint64(1 << SCALE), np.uint64(32)
        for s in range(steps - 1, -1, -1):
            f = freq[s]
            full = np.flatnonzero(x >= limit[s])
            out = x[full]
            words.append(out.astype(np.uint32))
            counts[s] = len(out)
            x[full] = out >> half
            q = x // f
            # The quotient moves up by the scale, the remainder stays: x + q * (2**SCALE - f).
            x += q * (whole - f)
            x += first[s]
            if s % STEPS == 0:
                states[s // STEPS] = x
        stream = np.concatenate(words[::-1])
        before = np.concatenate([[0], np.cumsum(counts)])[: steps : STEPS].astype("<u4")
        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
        head = struct.pack("<5I", len(ids), lanes, stretches, len(stream), crc)
        return head + before.tobytes() + states.astype("<u8").tobytes() + stream.astype("<u4").tobytes()

    def decode_block(self, data: memoryview) -> tuple[np.ndarray, int]:
        """The ids of the block at the start of ``data``, and its size in bytes."""
        n, lanes, stretches, size, crc = struct.unpack_from("<5I", data)
        at = 20
        places = np.frombuffer(data, "<u4", stretches, at).astype(np.int64)
        at += 4 * stretches
        x = np.frombuffer(data, "<u8", stretches * lanes, at).reshape(stretches, lanes).copy()
        at += 8 * stretches * lanes
        stream = np.append(np.frombuffer(data, "<u4", size, at), np.uint32(0)).astype(np.uint64)
        at += 4 * size
        steps = -(-n // lanes)
        out = np.empty((stretches, min(STEPS, steps), lanes), np.uint32)
        mask, scale, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
        borders = np.arange(stretches + 1) * lanes
        for s in range(out.shape[1]):
            # The last stretch may be shorter; it then runs on over words that are not its own.
            slot = x & mask
            got = self.symbol[slot]
            out[:, s] = got
            x >>= scale
            x *= self.frequency[got]
            x += slot
            x -= self.first[got]
            low = np.flatnonzero(x.reshape(-1) < LOW)  # by stretch, then by lane
            taken = np.diff(np.searchsorted(low, borders))
            word = np.arange(len(low)) + np.repeat(places - (np.cumsum(taken) - taken), taken)
            x.reshape(-1)[low] = (x.reshape(-1)[low] << half) | stream[np.minimum(word, size)]
            places += taken
        ids = out.reshape(-1)[:n] if stretches == 1 else out.reshape(stretches * out.shape[1] * lanes)[:n]
        if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != crc:
            raise ValueError("checksum of a block does not fit its ids")
        return ids, at

    def encode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.encode_block(ids[a : a + BLOCK]) for a in range(0, len(ids), BLOCK))

    def decode(self, data: bytes) -> np.ndarray:
        view, out = memoryview(data), []
        while len(view):
            ids, size = self.decode_block(view)
            out.append(ids)
            view = view[size:]
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


def shared_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to ``2**SCALE``; every symbol that occurs keeps a place."""
    total, goal = int(counts.sum()), 1 << SCALE
    if not total:
        return np.zeros(len(counts), np.int64)
    if int((counts > 0).sum()) > goal:
        raise ValueError("more symbols than places in the table")
    out = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * goal // total), 0).astype(np.int64)
    order = np.lexsort((np.arange(len(out)), -out))
    left = goal - int(out.sum())
    if left > 0:
        out[order[0]] += left
    for i in order:
        if left >= 0:
            break
        cut = min(-left, int(out[i]) - 1)
        out[i] -= cut
        left += cut
    return out


_SEGMENTS = "part int, seg int, before long, doc_ids array<bigint>, lengths array<int>, ids binary, seen binary"
_FILES = "part int, seg int, start long, doc_ids array<bigint>, lengths array<int>, data binary"


def _longs(rows: list[list[int | None]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int64()))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``LETTERS`` bytes of text each; a longer text is a run with its neighbours at most."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // LETTERS)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def _segments(docs: DataFrame, path: str, end: int, symbols: int) -> DataFrame:
    """Texts, already in order, as runs of ids; each partition numbers its own.

    The last run of a partition also tells how often each id occurs in all of them.
    """

    def run(batches):
        tokens, seen, stop = word_tokens(path), np.zeros(symbols, np.int64), np.uint32(end).tobytes()
        part, seg, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, parts, size, last = [], [], [], 0, None

        def close():
            ids = np.frombuffer(b"".join(parts), np.uint32)
            np.add(seen, np.bincount(ids, minlength=symbols), out=seen)
            packed = ids.astype("<u2" if symbols <= 1 << 16 else "<u4").tobytes()
            return [part, seg, before, doc_ids, lengths, packed, None]

        def row(x):
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            names = ["part", "seg", "before", "doc_ids", "lengths", "ids", "seen"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(x, kinds, strict=True)], names=names)

        for whole in batches:
            for batch in _slices(whole):
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode_all(batch.column("text")), strict=True):
                    doc_ids.append(doc_id)
                    parts += [ids, stop]
                    lengths.append(len(ids) // 4 + 1)
                    size += lengths[-1]
                    if size >= SEGMENT:
                        if last:
                            yield row(last)
                        last = close()
                        seg, before = seg + 1, before + size
                        doc_ids, lengths, parts, size = [], [], [], 0
        if doc_ids:
            if last:
                yield row(last)
            last = close()
        if last:
            used = np.flatnonzero(seen)
            last[-1] = np.stack([used, seen[used]]).astype("<i8").tobytes()
            yield row(last)

    return docs.mapInArrow(run, _SEGMENTS)


def _ids(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def _counts(segments: DataFrame, symbols: int) -> np.ndarray:
    """How often each id occurs; at most one row per symbol reaches the driver."""

    def run(batches):
        total = np.zeros(symbols, np.int64)
        for batch in batches:
            for data in batch.column("seen").drop_null().to_pylist():
                used, n = np.frombuffer(data, "<i8").reshape(2, -1)
                total[used] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["symbol", "n"])

    rows = segments.select("seen").mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(symbols, np.int64)
    for r in rows:
        out[r["symbol"]] = r["n"]
    return out


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> str:
    """Store the ids of ``docs`` (``doc_id``, ``text``) in ascending order of ``doc_id``."""
    spark, path = docs.sparkSession, path or public_tokenizers.path(VOCABULARY)
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    )
    symbols = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    _segments(ordered, path, end, symbols).write.option("compression", "zstd").parquet(f"{folder}/ids")
    segments = spark.read.schema(_SEGMENTS).parquet(f"{folder}/ids")
    frequencies = shared_frequencies(_counts(segments, symbols))
    totals = segments.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")).collect()
    sizes = sorted((r["part"], r["n"]) for r in totals)  # one row per partition
    base = dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0), strict=False))
    shared = spark.sparkContext.broadcast((frequencies, base))

    def make():
        table, first = shared.value
        coder = Coder(table)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = batch.select(["part", "before", "ids", "lengths"]).to_pylist()
            data = [coder.encode(_ids(r["ids"], sum(r["lengths"])).astype(np.uint32)) for r in rows]
            start = [first[r["part"]] + r["before"] for r in rows]
            return pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("seg"), pa.array(start, pa.int64()), batch.column("doc_ids"), batch.column("lengths"), pa.array(data, pa.binary())],
                names=["part", "seg", "start", "doc_ids", "lengths", "data"],
            )

        return step

    arrow_map(segments.drop("seen"), make, _FILES).write.option("compression", "none").parquet(f"{folder}/blocks")
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(frequencies) if n], "symbol int, frequency int").coalesce(1).write.parquet(f"{folder}/table")
    return folder


def _decoded(spark: SparkSession, folder: str, give: Callable[[list, np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``give(doc_ids, starts, ids of each)`` for every segment of a folder, decoded where it is read."""
    rows = spark.read.schema("symbol int, frequency int").parquet(f"{folder}/table").collect()
    table = np.zeros(max((r["symbol"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        table[r["symbol"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        coder = Coder(shared.value)
        for batch in batches:
            for row in batch.select(["start", "doc_ids", "lengths", "data"]).to_pylist():
                ids = coder.decode(row["data"])
                cuts = np.zeros(len(row["lengths"]) + 1, np.int64)
                np.cumsum(row["lengths"], out=cuts[1:])
                if cuts[-1] != len(ids):
                    raise ValueError("a segment's index does not fit its ids")
                yield give(row["doc_ids"], row["start"] + cuts, ids)

    return spark.read.schema(_FILES).parquet(f"{folder}/blocks").mapInArrow(run, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start`` and ``ids``."""

    def give(doc_ids, starts, ids):
        lists = int_lists(ids.astype(np.int32), (starts - starts[0]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts[:-1], pa.int64()), lists], names=["doc_id", "start", "ids"])

    return _decoded(spark, folder, give, "doc_id long, start long, ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's place, number of ids and their checksum, from the ids that were read back."""

    def give(doc_ids, starts, ids):
        plain, at = np.ascontiguousarray(ids, "<u4"), (starts - starts[0]).tolist()
        crc = [zlib.crc32(plain[a:b]) for a, b in zip(at, at[1:], strict=False)]
        columns = [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1], pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _decoded(spark, folder, give, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write, read back, and give each document's place, size and checksum."""
    spark = docs.sparkSession
    return read_digests(spark, write(docs, scratch_path(spark, "token-files"), path))
