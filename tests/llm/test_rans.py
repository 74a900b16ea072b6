"""Token files: exact round trips, order, and detection of damage."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmill.llm import rans
from starmill.llm.queries import QUERIES

PATH = public_tokenizers.path(rans.VOCABULARY)


def _library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_words_in_turn_equal_the_library_on_whole_texts():
    draw, library = random.Random(2), _library()
    letters = [*"aaBé É'st \n\t\r\x1c\x85 　中١1½<|>!.́ſΣσK😀Ǻİ", "<|endoftext|>", "<|startoftext|>", "'ll", "가", "ᄀ", "ᅡ", "word ", "Word, "]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 16))) for _ in range(3000)]
    tokens = rans.WordTokens(PATH)
    for text, ids in zip(texts, tokens.encode_all(texts), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert tokens.encode_all([None, "", "  "]) == [b""] * 3


def test_merges_equal_the_library_on_every_token_and_on_random_words():
    draw, library, tokens = random.Random(7), _library(), rans.WordTokens(PATH)
    words = {library.id_to_token(i).removesuffix("</w>") for i in range(512, 49_406)}
    words |= {"".join(draw.choices(draw.choice(["etaoinshrdlu", "abcdefghijklmnopqrstuvwxyz", "éèüßñaeiou", "анпроет", "日本語"]), k=draw.randint(1, 24))) for _ in range(60_000)}
    words = sorted(w for w in words if w.strip())
    for word, ids in zip(words, tokens.encode_all(words), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(rans, "WORDS", 3)
    draw, library, tokens = random.Random(3), _library(), rans.WordTokens(PATH)
    for _ in range(50):
        text = " ".join(draw.choices(["a", "bc", "Bc,", "d.", "'s", "x1y", "é", "l" * 70], k=12))
        (ids,) = tokens.encode_all([text])
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(tokens) <= 3 + 8 and "l" * 70 not in tokens


def test_runs_of_rows_hold_every_row_once_and_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(rans, "LETTERS", 40)
    draw, library = random.Random(5), _library()
    words = ["a", "Bc,", "<|endoftext|>", "x<|startoftext|>y", "\x1c", "\x00b", "é", "Σς", " ", "l" * 70]
    texts = [draw.choice([None, "", " ".join(draw.choices(words, k=draw.randint(1, 30)))]) for _ in range(200)]
    tokens, seen, runs = rans.WordTokens(PATH), [], 0
    for run in rans._slices(pa.RecordBatch.from_pydict({"text": pa.array(["out", *texts], pa.string())}).slice(1)):
        runs += 1
        for text, ids in zip(run.column("text").to_pylist(), tokens.encode_all(run.column("text")), strict=True):
            seen.append(text)
            assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert seen == texts and runs > 50
    assert not list(rans._slices(pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 2047, 2048, 2049, 300_000, rans.BLOCK, rans.BLOCK + 1])
def test_blocks_come_back(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(max=49_407).astype(np.uint32)
    coder = rans.Coder(rans.shared_frequencies(np.bincount(ids, minlength=49_408)))
    assert (coder.decode(coder.encode(ids)) == ids).all()


def test_one_symbol_and_all_symbols():
    for counts in (np.array([0, 5, 0]), np.ones(60_000, np.int64), np.r_[10**12, np.ones(60_000, np.int64)]):
        table = rans.shared_frequencies(counts)
        assert table.sum() == 1 << rans.SCALE and ((table > 0) == (counts > 0)).all()
        ids = np.flatnonzero(counts).astype(np.uint32)
        assert (rans.Coder(table).decode(rans.Coder(table).encode(ids)) == ids).all()


def test_a_damaged_block_is_refused():
    ids = np.arange(5000, dtype=np.uint32) % 50
    coder = rans.Coder(rans.shared_frequencies(np.bincount(ids)))
    data = bytearray(coder.encode(ids))
    data[-9] ^= 4
    with pytest.raises(ValueError):
        coder.decode(bytes(data))


def test_edges(docs_of, edges, spark, tmp_path):
    folder = rans.write(docs_of(edges), f"{tmp_path}/files")
    rows = sorted(rans.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 7]
    at = 0
    for r in rows:
        assert r["start"] == at and r["ids"][-1] == rans.END
        at += len(r["ids"])
    assert sum(len(r["ids"]) == 1 for r in rows) == 4
    assert rans.round_trip(docs_of([])).collect() == []


def test_query_equals_brute_force(spark, table):
    library, start = _library(), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_rans_token_files"](spark, "/root/testdata/sf0.001").collect()}
    for r in sorted(table("documents").collect(), key=lambda r: r["doc_id"]):
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        assert got.pop(r["doc_id"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    assert not got
