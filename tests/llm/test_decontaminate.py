"""Spaced seeds: planted passages with replaced words, against brute force."""

import random
import time

import numpy as np

from starmill.llm import decontaminate
from starmill.llm.queries import QUERIES

DRAW = random.Random(7)
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def _words(n):
    return [DRAW.choice(VOCABULARY) for _ in range(n)]


def _items(spark, items):
    return spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, hash string")


def _found(spark, docs_of, docs, items):
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_of(docs), _items(spark, items)).collect()}


def test_planted_passages_are_found_and_clean_texts_are_not(spark, docs_of):
    items = [(i, " ".join(_words(30))) for i in range(20)]
    docs, planted = [], set()
    for i in range(40):
        words = _words(200)
        if i < 20:
            passage = items[i][1].split()
            for k in range(3, 30, 9):  # every ninth word replaced
                passage[k] = "other"
            words[50:50] = [w.upper() + "," for w in passage]
            planted.add((i, i))
        docs.append((i, " ".join(words)))
    assert _found(spark, docs_of, docs, items) == planted


def test_every_window_with_a_replaced_word_is_hit_by_a_seed():
    """Any one word of a 13-word window may differ, and any two but for few pairs."""
    for k in range(13):
        assert any(mask[k] == "0" for mask in decontaminate.LONG) or k in (0, 12)


def _seed_hits(doc, item, shift):
    """Whether a seed looks the item up at this place of the text."""
    for number, mask in decontaminate.masks_of(len(item)):
        of_item, of_doc = decontaminate.seeded(item, mask, number), decontaminate.seeded(doc, mask, number)
        if (of_item == of_doc[shift : shift + len(of_item)]).any():
            return True
    return False


def test_seeds_find_every_overlap_that_counts():
    """Against brute force: 10-24 words with up to five replaced, at the edges too; exact runs of longer items."""
    draw, counted = random.Random(3), 0
    around = np.arange(500, 540, dtype=np.uint64)
    for n in range(10, 25):
        item = np.arange(100, 100 + n, dtype=np.uint64)
        patterns = [(k,) for k in range(n)] + [(0, k) for k in range(1, n)] + [(k, n - 1) for k in range(n - 1)]
        patterns += [tuple(draw.sample(range(n), draw.randint(2, 5))) for _ in range(150)]
        patterns += [(*range(a), *range(a + 12, n)) for a in range(n - 11)]
        for replaced in patterns:
            copy = item.copy()
            copy[list(replaced)] = 7
            doc = np.r_[around[:20], copy, around[20:]]
            equal = decontaminate.overlap(doc, item, 20)[0]
            if equal >= decontaminate.MATCHED or n <= decontaminate.MATCHED and equal >= decontaminate.WHOLE * n:
                counted += 1
                assert _seed_hits(doc, item, 20), (n, replaced)
    assert counted > 1000


def test_a_run_of_twelve_and_replaced_edges_count(spark, docs_of):
    item, other = _words(30), _words(14)
    items = [(1, " ".join(item)), (2, " ".join(other))]
    docs = [(1, " ".join([*_words(40), *item[9:21], *_words(40)])), (2, " ".join([*_words(9), "edge", *other[1:13], "edge", *_words(9)]))]
    assert _found(spark, docs_of, docs, items) == {(1, 1), (2, 2)}


def test_short_items(spark, docs_of):
    items = [(1, "seven words make up this short item"), (2, "too few words"), (3, None), (4, ""), (5, "seven words make up this short item")]
    docs = [(1, "x seven words make up this short item y"), (2, "seven words make up that short item"), (3, "too few words"), (4, None)]
    assert _found(spark, docs_of, docs, items) == {(1, 1), (2, 1), (3, 2)}


def test_items_of_one_to_three_words_match_whole_texts_only(spark, docs_of):
    items = [(1, "Yes"), (2, "forty two"), (3, "just three words"), (4, "yes")]
    docs = [(1, "yes."), (2, "Yes, yes"), (3, "FORTY two!"), (4, "forty two words"), (5, " just, three words"), (6, "not just three words"), (7, ""), (8, "no")]
    assert _found(spark, docs_of, docs, items) == {(1, 1), (3, 2), (5, 3)}


def test_random_texts_equal_a_comparison_of_all_alignments(spark, docs_of):
    """Brute force: every item laid at every word of every text, the best run kept."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 25)))) for i in range(25)]
    docs = []
    for i in range(60):
        text = draw.choices(words, k=draw.randint(0, 40))
        for _ in range(draw.randint(0, 2)):
            copy = draw.choice(items)[1].split()
            for k in draw.sample(range(len(copy)), len(copy) // 8):
                copy[k] = "new"
            at = draw.randint(0, len(text))
            text[at:at] = copy
        docs.append((i, " ".join(text)))
    docs += [(100 + i, t) for i, t in items[:10]]
    want = set()
    for d, text in docs:
        doc = np.array(decontaminate.words_of(text), np.uint64)
        for i, item_text in items:
            item = np.array(decontaminate.words_of(item_text), np.uint64)
            if len(item) < decontaminate.LEAST:
                if np.array_equal(doc, item):
                    want.add((d, min(j for j, t in items if t == item_text)))
            elif any(decontaminate.counts(decontaminate.overlap(doc, item, s)[0], len(item)) for s in range(1 - len(item), len(doc))):
                want.add((d, min(j for j, t in items if t == item_text)))
    assert want and _found(spark, docs_of, docs, items) == want


def test_repetitive_texts_take_linear_time(spark, docs_of):
    item = " ".join(["spam", "eggs"] * 20)
    docs = [(1, "spam eggs " * 20_000), (2, "spam ham " * 20_000), (3, "eggs " * 40_000)]
    start = time.perf_counter()
    rows = decontaminate.leaks(docs_of(docs), _items(spark, [(1, item)])).collect()
    assert [(r["doc_id"], r["matched"]) for r in rows] == [(1, 40)]
    assert time.perf_counter() - start < 60
    doc, words = (np.array(decontaminate.words_of(t), np.uint64) for t in ("spam eggs " * 20_000, item))
    start = time.perf_counter()
    assert decontaminate.best_overlap(doc, words, np.arange(-39, len(doc)))[0] == 40
    assert time.perf_counter() - start < 10


def test_one_share_decides_for_every_length(spark, docs_of):
    """Four fifths of an item count up to the length where twelve words do."""
    items, docs, expected = [], [], set()
    for n, replaced in ((4, []), (4, [2]), (5, []), (5, [2]), (6, [0]), (6, [5]), (7, [5]), (8, [4]), (13, [0, 6]), (14, [3, 8]), (13, [0, 6, 12]), (20, [3, 9, 15])):
        words = [f"{w}{len(items)}" for w in _words(n)]
        items.append((len(items), " ".join(words)))
        copy = [f"new{k}" if k in replaced else w for k, w in enumerate(words)]
        docs.append((len(docs), " ".join([*_words(9), *copy, *_words(9)])))
        if n - len(replaced) >= min(12, 0.8 * n):
            expected.add((len(docs) - 1, len(docs) - 1))
    assert len(expected) == 10
    assert _found(spark, docs_of, docs, items) == expected


def test_seeds_find_every_short_item():
    for n in range(decontaminate.LEAST, 10):
        item = np.arange(100, 100 + n, dtype=np.uint64)
        for replaced in [[], *([k] for k in range(n))]:
            copy = item.copy()
            copy[replaced] = 7
            if decontaminate.counts(decontaminate.overlap(copy, item, 0)[0], n):
                assert _seed_hits(np.r_[np.full(3, 9, np.uint64), copy], item, 3), (n, replaced)


def test_overlap_is_the_best_run():
    item = np.arange(20, dtype=np.uint64)
    doc = np.r_[np.full(5, 99, np.uint64), item[:10], np.uint64(77), item[11:], np.full(5, 99, np.uint64)].astype(np.uint64)
    assert decontaminate.overlap(doc, item, 5) == (19, 5, 20)
    assert decontaminate.overlap(doc[8:], item, -3)[0] == 16
    assert decontaminate.overlap(item[:0], item, 0)[0] == 0


def test_edges(spark, docs_of, edges):
    passage = " ".join(_words(40))
    docs = [*edges, (20, f"a {passage} b"), (20, f"a {passage} b"), (None, passage)]
    items = _items(spark, [(None, passage), (8, passage)])
    rows = decontaminate.leaks(docs_of(docs), items).collect()
    assert {(r["doc_id"], r["item_id"], r["matched"]) for r in rows} == {(20, 8, 40), (None, 8, 40)}
    left = decontaminate.clean(docs_of(docs), items)
    assert left.columns == docs_of([]).columns and left.count() == len(edges)
    assert decontaminate.leaks(docs_of([]), items).collect() == []
    assert decontaminate.clean(docs_of(edges), items.where("false")).count() == len(edges)


def test_query_finds_every_whole_passage(spark, table):
    items = [r["text"].lower() for r in table("benchmark").collect()]
    expected = {r["doc_id"] for r in table("documents").collect() if any(t in (r["text"] or "").lower() for t in items)}
    rows = QUERIES["op2_spaced_seed_leaks"](spark, "/root/testdata/sf0.001").collect()
    assert expected == {r["doc_id"] for r in rows}
