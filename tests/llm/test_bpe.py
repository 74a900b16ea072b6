"""Backtracking encoder against the tokenizers library, and the round trip."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from starmill.llm import bpe
from starmill.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.VOCABULARY)
LETTERS = [*"aab e'stREL \n\t\r\x1c\x85 　é中١1½<|>!.́ſΣ😀", "<|endoftext|>", "  ", "'ll", "\n\n", " the", "ing", "    "]


def _library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_ids_equal_the_librarys_on_random_texts():
    draw, words, library = random.Random(1), bpe.vocabulary(PATH), _library()
    for _ in range(3000):
        text = "".join(draw.choices(LETTERS, k=draw.randint(0, 16)))
        ids = np.frombuffer(words.encode(text), np.int32).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert words.decode(np.array(ids, np.int32)).decode() == text


def test_long_pieces_take_linear_time():
    words, library = bpe.vocabulary(PATH), _library()
    for text in ("a" * 100_000, " " * 50_000 + "x", "abcdefghij" * 10_000, "ab" * 50_000):
        assert np.frombuffer(words.encode(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_bytes_decode_like_the_library():
    words, library, draw = bpe.vocabulary(PATH), _library(), random.Random(3)
    for _ in range(300):
        ids = [draw.randrange(50257) for _ in range(draw.randint(0, 6))]
        assert words.decode(np.array(ids, np.int32)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_edges(docs_of, edges):
    rows = bpe.digests(docs_of(edges)).collect()
    assert len(rows) == len(edges) and sum(r["n_tokens"] == 0 for r in rows) == 3
    named = bpe.decode(bpe.encode(docs_of(edges))).collect()  # a column ids is replaced
    assert all(r["decoded"] == (r["text"] or "") and r["key"] == b"x" for r in named)
    at_once = bpe.round_trip(docs_of(edges)).collect()
    assert sorted(map(str, at_once)) == sorted(map(str, named))
    assert bpe.digests(docs_of([])).collect() == []


def test_query_equals_brute_force(spark, table):
    import hashlib

    library = _library()
    got = {r["doc_id"]: r for r in QUERIES["op9_backtracking_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for r in table("documents").collect():
        text = r["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert tuple(got[r["doc_id"]])[1:] == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
        )
