"""Source divergence: against Python integers, and the skyband against a full count."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmill.llm import divergence
from starmill.llm.queries import ORACLES, QUERIES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, k=200):
    """Rows of (text, lang, source) to the expected rows, in plain Python."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: counts[g, s] for g, s in counts if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept))

        shares = {s: {t: p(c, t) for t in kept} for s, c in groups.items()}
        lang_share = {t: p(whole, t) for t in kept}
        for s, c in groups.items():
            items = [(-sum((shares[s][t] - shares[o][t]) ** 2 // shares[o][t] for t in kept), o.encode()) for o in groups if o != s]
            out |= {(lang, s, "pair", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(items), 1)}
            items = [(-((shares[s][t] - lang_share[t]) ** 2 // lang_share[t]), t.encode()) for t in kept if c[t] and shares[s][t] > lang_share[t]]
            out |= {(lang, s, "term", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(items)[:k], 1)}
    return out


def got(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(draw, n, sources):
    words = ["The", "the", "É", "été", "x", "İ", "ß", "日本", "zeta", "Ωmega", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", "1", "_", "\x00", "-", "\x7f"]) for _ in range(draw.randint(0, 30)))
        rows.append((text, draw.choice(["en", "fr", None]), draw.choice(sources)))
    return rows


@pytest.mark.parametrize("tile, bucket, k", [(128, 200_000, 200), (2, 5, 3), (3, 20, 1)])
def test_equals_python_integers(spark, monkeypatch, tile, bucket, k):
    rows = made(random.Random(tile), 120, ["a", "b", "c", "Z", "é", None, "", "d", "e"])
    rows += [(None, "de", "only"), ("", "xx", "p"), ("1 2", "xx", "q"), ("lone words here", "xx", "r")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, n long, term int").repartition(5)
    assert got(divergence.audit(docs, k=k, tile=tile, bucket=bucket)) == brute(rows, k=k)


def test_long_texts_repeated_rows_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", 16)
    monkeypatch.setattr(divergence, "HELD", 7)
    rows = made(random.Random(9), 30, ["a", "b"]) * 2 + [("word other " * 5_000 + "x" * 100_000, "en", "a")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(docs)) == brute(rows)
    pieces = [t for part in divergence._spelled(("ab " * 50 + "c" * 99).encode()) for t in part]
    assert pieces == [b"ab"] * 50 + [b"c" * 99]


def test_no_documents(spark):
    assert divergence.audit(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []


def test_skyband_keeps_what_fewer_than_k_dominate():
    for seed in range(30):
        draw = np.random.default_rng(seed)
        n, k = int(draw.integers(1, 900)), int(draw.integers(1, 40))
        a, b, place = draw.integers(0, 12, n), draw.integers(0, 12, n), draw.permutation(n)
        over = (a[None, :] >= a[:, None]) & (b[None, :] <= b[:, None]) & (place[None, :] < place[:, None])
        assert sorted(divergence.skyband(a, b, place, k)) == np.flatnonzero(over.sum(axis=1) < k).tolist()


def test_shares_are_exact_for_large_counts(spark):
    rows = [(1, 1), (2**52, 2**53 - 1), (3, 7), (8 * 10**14, 9 * 10**15), (10**9, 10**9 + 1)]
    df = spark.createDataFrame(rows, "n long, total long").select("n", "total", divergence.share("n", "total").alias("p"))
    assert all(r.p == 1 + 10**9 * r.n // r.total for r in df.collect())
    n, total = np.array(rows).T
    assert divergence._share(n, total).tolist() == [1 + 10**9 * a // b for a, b in rows]


def test_query_equals_sql_and_brute_force(spark):
    import duckdb

    path = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    result = got(QUERIES["op13_source_divergence"](spark, path))
    assert result == set(db.execute(ORACLES["op13_source_divergence"]).fetchall())
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert result == brute(rows)
