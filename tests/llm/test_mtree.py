"""Exact top-k against brute force, with ties, copies and odd vectors."""

import numpy as np
import pytest

from starmill.llm import mtree
from starmill.llm.queries import QUERIES


def _brute(rows, every, k, real=np.float32):
    points = {}
    for i, x in rows:
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x):
            points.setdefault(i, tuple(int(np.floor(64.0 * np.float64(real(c)))) for c in x))
    out = set()
    for q, v in points.items():
        if q % every == 0:
            clip = lambda s: max(-(2**63), min(2**63 - 1, s))
            scores = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=False))), i) for i, w in points.items() if i != q)[:k]
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)}
    return out


def _frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, x, 0, b"", 1.0) for i, x in rows], f"vec_id long, embedding array<{kind}>, label int, v binary, score double")


@pytest.mark.parametrize("node,page", [(2048, 64), (40, 5)])
def test_equals_brute_force(spark, monkeypatch, node, page):
    monkeypatch.setattr(mtree, "NODE", node)
    monkeypatch.setattr(mtree, "PAGE", page)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8))
    rows = [(int(i), [float(c) for c in (centres[i % 6] + 0.1 * draw.normal(size=8))]) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # a third of all: one vector
    got = {tuple(r) for r in mtree.nearest(_frame(spark, rows), 20, 20).collect()}
    assert got == _brute(rows, 20, 20)


def test_bounds_never_cut_a_result():
    draw = np.random.default_rng(1)
    for _ in range(20):
        v = np.floor(64 * draw.normal(size=(300, 6)) * draw.choice([0.01, 1, 30]))
        space = mtree.Space(float((v * v).sum(axis=1).max()))
        node = mtree.unpacked(mtree.packed(mtree.build(np.arange(300), v, v[0], space)))
        q = v[:40]
        rows, ids, scores = mtree.search(node, np.arange(40), q, np.full(40, -np.inf), space.of_queries(q, v[:1])[:, 0], space, 5)
        for i in range(40):
            want = sorted((-int(s), j) for j, s in enumerate(v @ q[i]) if j != i)[:5]
            assert sorted(zip(-scores[rows == i], ids[rows == i], strict=True)) == want


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [-0.001, 0.5]), (40, []), (60, None), (80, [None, 1.0]), (100, [float("nan"), 1.0]),
            (120, [float("inf"), 0.0]), (None, [1.0, 1.0]), (-20, [3.0, -1.0]), (7, [0.0, 0.0]), (9, [1.0])]
    got = {tuple(r) for r in mtree.nearest(_frame(spark, rows), 20, 20).collect()}
    assert got == _brute(rows, 20, 20) and {q for q, *_ in got} == {0, 20, -20}
    assert mtree.nearest(_frame(spark, []), 20, 20).collect() == []
    assert mtree.nearest(_frame(spark, [(20, [1.0])]), 20, 20).collect() == []


@pytest.mark.parametrize("kind,large", [("float", 1e10), ("float", 3e38), ("double", 1e150), ("double", 1e300)])
def test_large_finite_vectors(spark, kind, large):
    """Products far beyond 64 bits, next to small ones, with both signs."""
    draw = np.random.default_rng(5)
    rows = [(i, [float(c) for c in draw.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, [float(c) for c in draw.choice([-1.0, 1.0, 2.0, 0.0], 4) * large / 2]) for i in range(40)]
    got = {tuple(r) for r in mtree.nearest(_frame(spark, rows, kind), 20, 20).collect()}
    want = _brute(rows, 20, 20, np.float32 if kind == "float" else np.float64)
    assert got == want and any(s == 2**63 - 1 for *_, s in want)


def _computed(vectors, queries, k=20):
    """Share of all products that a search of one node computes."""
    space = mtree.Space(float((vectors * vectors).sum(axis=1).max()))
    node = mtree.build(np.arange(len(vectors)), vectors, vectors[0], space)
    done, products = [0], mtree._products
    mtree._products = lambda a, b: (done.__setitem__(0, done[0] + len(a) * len(b)), products(a, b))[1]
    try:
        for i in queries:
            q = vectors[i : i + 1]
            mtree.search(node, np.array([i]), q, np.full(1, -np.inf), space.of_queries(q, vectors[:1])[:, 0], space, k)
    finally:
        mtree._products = products
    return done[0] / len(vectors) / len(queries)


def test_bounds_spare_products_where_vectors_cluster(table):
    """On clusters most products are never computed; the test table is spread too evenly for that."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 8))
    clustered = np.floor(64 * (centres[draw.integers(0, 40, 2000)] + 0.02 * draw.normal(size=(2000, 8))))
    assert _computed(clustered, range(0, 2000, 50)) < 0.1
    rows = [r["embedding"] for r in table("embeddings").collect() if r["embedding"]]
    share = _computed(np.floor(64 * np.array(rows, np.float64)), range(0, len(rows), 20))
    print(f"computed share on the test table: {share:.3f}")
    assert share <= 1


def test_query_equals_brute_force(spark, table):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings").collect()]
    got = {tuple(r) for r in QUERIES["op10_m_tree_top_k"](spark, "/root/testdata/sf0.001").collect()}
    assert got == _brute(rows, 20, 20)


def test_blocks_of_queries_and_nodes_are_never_broadcast(spark, monkeypatch):
    """Blocks are many times as large as the file they are made from, so a broadcast of them fills the driver."""
    plans, stored = [], mtree.stored
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(mtree, "stored", lambda df, label: (note(df), stored(df, label))[1])
    draw = np.random.default_rng(7)
    note(mtree.nearest(_frame(spark, [(i, draw.normal(size=8).tolist()) for i in range(300)]), 20, 5))
    joins = [line for plan in plans for line in plan.splitlines() if "Join [route" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)
