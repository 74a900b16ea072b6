"""Near-duplicate groups against all pairs, and the cases that tiles and classes must survive."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import minmax
from starmill.llm.queries import QUERIES
from starmill.operators.lookups import BroadcastBudget


def _brute(rows, size, num, den):
    sets, parent = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
        parent[i] = i

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def _copies(seed, words=60, groups=6, size=9):
    """Groups of near copies at all distances, some linked only through others."""
    draw, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{draw.randrange(500)}" for _ in range(words)]
        for k in range(size):
            text = list(base)
            for _ in range(draw.randrange(5)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(text)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [1024, 4])
def test_equals_all_pairs(docs_of, monkeypatch, chunk):
    monkeypatch.setattr(minmax, "CHUNK_SETS", chunk)  # 4: every bucket is cut into tiles
    rows = _copies(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in minmax.groups(docs_of(rows)).collect()}
    assert got == _brute(rows, 3, 85, 100)


def test_exact_threshold_links():
    left = np.arange(100, dtype=np.uint64)
    right = np.r_[np.arange(85, dtype=np.uint64)]
    assert minmax._linked([left, right], None, 85, 100)[0, 1]
    assert not minmax._linked([left, right[:-1]], None, 85, 100)[0, 1]


def test_a_chain_is_one_component(spark):
    edges = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("x", "x")], "u string, v string")
    roots = minmax.connected(edges, "chain").collect()
    assert len(roots) == 60 and {r["root"] for r in roots} == {"000"}


def test_edges(docs_of, edges):
    rows = minmax.groups(docs_of(edges)).collect()
    assert len(rows) == len(edges)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert by[1] == by[2] == by[3][:1] or by[3] == [(0, 3, True)]
    assert by[1] == [(0, 1, True)] and by[4] == [(1, 4, True)]
    assert sorted(by[None]) == sorted([(0, None, False), (3, None, False)])
    assert by[5] == [(3, 5, True)] * 2
    assert minmax.groups(docs_of([])).collect() == []


def test_one_of_each_group_stays(docs_of, edges):
    rows = [*edges, (9, edges[4][1]), (10, edges[4][1].upper())]
    left = minmax.deduplicate(docs_of(rows))
    assert left.columns == docs_of([]).columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4, 5, 7]
    plain = [(i, t) for i, t in _copies(8) if t]
    kept = {r["doc_id"] for r in minmax.deduplicate(docs_of(plain)).collect()}
    assert kept == {i for i, (_, _, k) in _brute(plain, 5, 80, 100).items() if k}


def test_query_equals_all_pairs(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_min_max_groups"](spark, "/root/testdata/sf0.001").collect()}
    assert got == _brute(rows, 3, 85, 100)


@pytest.mark.parametrize("budget", [minmax.BROADCAST, BroadcastBudget(rows=0)])
def test_a_hub_with_very_many_neighbours(spark, monkeypatch, budget):
    """A star of 100,000 edges and a few chains; one node's neighbours need not meet in one task."""
    monkeypatch.setattr(minmax, "BROADCAST", budget)
    star = spark.range(100_000).selectExpr("id + 1000 AS u", "999L AS v")
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(5, 1500)], "u long, v long")
    got = {(r.root, r.n) for r in minmax.connected(star.unionByName(chain), "hub").groupBy("root").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, 100_000 + 1 + 19), (20, 19), (40, 19)}
