"""Packing: pieces against the library, sequences without gaps, few of them, and exact fills."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmill.llm import packing
from starmill.llm.bytetokens import WIDE, byte_tokens
from starmill.llm.queries import QUERIES

PATH = public_tokenizers.path(packing.VOCABULARY)
LETTERS = [*"aab e'stREL \n\t\r\x1c\x85 　é中١1½<|>!.́ſΣ😀\x00", "<|endoftext|>", "  ", "'ll", "\n\n", " the", "ing", "    "]


def library(plain=False):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    tokenizer.encode_special_tokens = plain
    return tokenizer


def expected(rows, size):
    """Rows of (doc_id, text) to the pieces that they must give."""
    tokens, out = library(), []
    for doc_id, text in rows:
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= size else len(ids) % size or size
        starts = [0, *range(first, len(ids), size)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4"))))
    return out


def check(rows, got, size):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(expected(rows, size))
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(filled)


def test_ids_equal_the_librarys():
    tokens, draw = byte_tokens(PATH), random.Random(5)
    for plain in (False, True):
        own, theirs = tokens.encode_plain if plain else tokens.encode, library(plain)
        texts = ["".join(draw.choices(LETTERS, k=draw.randint(0, 16))) for _ in range(2000)] + [" " * WIDE + "x<|endoftext|>", "a" * 10**6]
        for text in texts:
            assert own(text).tolist() == theirs.encode(text, add_special_tokens=False).ids, text[:40]
    assert len(tokens.encode(" " * 2_000_000 + "x")) == 2_000_000  # too wide for tiktoken's pattern


@pytest.mark.parametrize("size", [1, 7, 64, 2048])
def test_edges(docs_of, edges, size):
    got = packing.pack(docs_of(edges), size).collect()
    assert check([(i, t) for i, t in edges], got, size) == -(-sum(r.length for r in got) // size)
    assert packing.pack(docs_of([]), size).collect() == []


def test_sequences_hold_the_ids(docs_of, edges):
    found = packing.pieces(docs_of(edges).repartition(4), 64)
    placed = packing.places(found, 64).cache()
    whole = {r.sequence_id: r for r in packing.sequences(found, placed).collect()}
    assert all(len(r.ids) <= 64 and r.offsets == sorted(r.offsets) for r in whole.values())
    for r in placed.collect():
        part = whole[r.sequence_id].ids[r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4")) == r.ids_crc32
        assert whole[r.sequence_id].doc_ids[whole[r.sequence_id].offsets.index(r.offset)] == r.doc_id


def needed(counts):
    """The fewest sequences, by trying all: counts of lengths 1 to n."""
    size = len(counts) - 1

    @lru_cache(maxsize=None)
    def solve(left):
        if not any(left):
            return 0
        best = 99

        def fill(rest, gap, below):
            nonlocal best
            best = min(best, 1 + solve(tuple(rest)))
            for length in range(min(gap, below), 0, -1):
                if rest[length]:
                    rest[length] -= 1
                    fill(rest, gap - length, length)
                    rest[length] += 1

        longest = max(i for i, n in enumerate(left) if n)
        rest = list(left)
        rest[longest] -= 1
        fill(rest, size - longest, longest)
        return best

    return solve(tuple(counts))


def total(made):
    return sum(times for times, _ in made)


def test_patterns_use_every_piece_and_come_near_the_fewest():
    draw, more = random.Random(4), 0
    for _ in range(120):
        counts = [0] * 11
        for _ in range(draw.randint(1, 9)):
            counts[draw.randint(1, 10)] += 1
        made = packing.patterns(np.array(counts))
        used = Counter()
        for times, pattern in made:
            assert sum(length * m for length, m in pattern) <= 10 and times > 0
            used.update({length: times * m for length, m in pattern})
        assert used == Counter({i: n for i, n in enumerate(counts) if n})
        more += total(made) - needed(counts)
    assert more <= 3  # of some 300 sequences


def test_exact_fills_need_pairs_and_triples():
    counts = np.zeros(2049, np.int64)
    counts[[1000, 1048]] = 5  # pairs
    counts[[1500, 500, 30, 18]] = 7  # triples beside the longest
    assert packing.patterns(counts) == [(7, [(1500, 1), (500, 1), (30, 1), (18, 1)]), (5, [(1048, 1), (1000, 1)])]
    index = packing.Complements(counts)
    assert index.exact(548) == (500, 30, 18) and index.exact(549) == ()
    for length in np.flatnonzero(counts)[::-1].tolist():
        index.left[length] = 0
        index.use_up(length)
    assert not index.one.any() and not index.two.any() and not index.three.any()


def test_many_pieces_of_one_length_make_few_patterns():
    counts = np.random.default_rng(1).integers(0, 50, 2049)
    counts[0], counts[300], counts[1] = 0, 10**12, 10**9
    made = packing.patterns(counts)
    assert len(made) < 4 * 2048
    assert total(made) <= 10**12 / 6 * 1.0001  # six of the frequent length, and no more, fit


def test_query_equals_brute_force(spark, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    got = QUERIES["op12_complement_packing"](spark, "/root/testdata/sf0.001").collect()
    assert check(rows, got, 2048) <= -(-sum(r.length for r in got) // 2048) + 1
