"""Token alignment: against plain Python on whole texts, and each part on random input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starmill.llm import alignment
from starmill.llm.queries import QUERIES

A = Tokenizer.from_file(public_tokenizers.path(alignment.BYTES))
A.no_padding()
A.no_truncation()
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spelled(text):
    """Ids and end bytes of both sides, or nothing."""
    if not text:
        return None
    from starmill.llm.bpe import byte_letters

    back = {c: b for b, c in enumerate(byte_letters())}
    raw, a = (" " + text).encode(), A.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(back[c] for c in A.id_to_token(i)) for i in a]
    b = B.encode(text)
    bytes_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    return a, np.cumsum([len(x) for x in bytes_a]).tolist(), b, np.cumsum([len(x) for x in bytes_b]).tolist()


def groups(text):
    """The groups of a text as lists of ids of both sides."""
    found = spelled(text)
    if not found:
        return []
    a, ends_a, b, ends_b = found
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def brute(rows):
    made = [(doc_id, groups(text)) for doc_id, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in made]
    held = Counter(pair for c in links for pair in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, g), c in zip(made, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return Counter(out)


def got(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def made(n):
    draw = random.Random(n)
    letters = [*"aab e'stREL \n\t\r\x1c\x85 　é中١1½<|>!.́ſΣ😀\x00İ👩‍🚀", "<|endoftext|>", "  ", "'ll", "\n\n", " the", "ing", "</s>", "日本語"]
    return [(i, "".join(draw.choices(letters, k=draw.randint(0, 25)))) for i in range(n)] + [(n, "x▁y"), (n, "x▁y")]


@pytest.mark.parametrize("hot", [500_000, 40, 0])
def test_equals_plain_python(docs_of, edges, hot):
    rows = made(150) + [(i, t if t is None or len(t) < 1000 else t[:3000]) for i, t in edges]
    assert got(alignment.report(docs_of(rows).repartition(5), hot=hot)) == brute(rows)


def test_many_links_in_one_text(docs_of, monkeypatch):
    rows = made(40) + [(99, "the same words again and again " * 40)]
    want = brute(rows)
    monkeypatch.setattr(alignment, "LINKS", 30)
    monkeypatch.setattr(alignment, "HELD", 50)
    aligner = alignment.Aligner(public_tokenizers.path(alignment.BYTES), public_tokenizers.path(alignment.PIECES))
    for i, found in zip(range(len(rows)), aligner.align([t for _, t in rows]), strict=True):
        whole = np.concatenate([p for p, _ in found["slices"]]) if found["slices"] else np.zeros(0)
        assert len(set(whole.tolist())) == len(whole)
        c = Counter((x, y) for a, b in groups(rows[i][1]) for x in a for y in b)
        assert {k: n for p, t in found["slices"] for k, n in zip(p.tolist(), t.tolist(), strict=True)} == {x * B.vocab_size() + y: n for (x, y), n in c.items()}
    aligned = alignment.align(docs_of(rows))
    assert got(alignment.scores(aligned, alignment.counts(aligned, B.vocab_size()), 20)) == want


def test_labels_by_pointer_jumping():
    for seed in range(300):
        draw = np.random.default_rng(seed)
        length = int(draw.integers(1, 60))
        a, b = (np.unique(np.r_[draw.integers(1, length + 1, int(draw.integers(1, 40))), length]) for _ in range(2))
        both = np.intersect1d(a, b)
        ga, gb = alignment.group_labels(a, b)
        assert ga.tolist() == np.searchsorted(both, a).tolist() and gb.tolist() == np.searchsorted(both, b).tolist()
    # One chain through all tokens: no common end but the last.
    ga, gb = alignment.group_labels(np.r_[np.arange(2, 100_001, 2), 100_002], np.r_[np.arange(1, 100_002, 2), 100_002])
    assert not ga.any() and not gb.any()


def test_long_and_empty(docs_of, edges):
    rows = alignment.report(docs_of(edges)).collect()
    assert len(rows) == len(edges)
    long = [r for r in rows if r.doc_id == 5]
    assert len(long) == 2 and long[0] == long[1] and long[0].n_a > 60_000
    assert alignment.report(docs_of([])).collect() == []


def test_query_equals_brute_force(spark, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert got(QUERIES["op11_token_alignment"](spark, "/root/testdata/sf0.001")) == brute(rows)
