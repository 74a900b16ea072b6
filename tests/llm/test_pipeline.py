"""The corpus pipeline: columns, empty and odd tables, and stage by stage against brute force."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from starmill.llm import bpe, decontaminate, minmax, quality, secrets

TABLES = "/root/testdata/sf0.001"


def test_everything_is_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in driver.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "decontamination", "secret_scan", "bpe_tokens"]


def test_run_equals_brute_force(spark, table):
    docs = table("documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.train(docs, quality.graded(table("labels")))
    kept = {i: t for i, t in rows.items() if model.tails(model.score(quality.features(t)))[-1] >= quality.KEEP}
    sets = {i: minmax.shingle_set(t, 5) for i, t in kept.items()}
    parent = {i: i for i in kept}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(kept)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    kept = {i: t for i, t in kept.items() if top(i) == i}
    passages = [" ".join(decontaminate._WORDS.findall(r["text"].lower())) for r in table("benchmark").collect()]
    kept = {i: t for i, t in kept.items() if not any(p in " ".join(decontaminate._WORDS.findall((t or "").lower())) for p in passages)}
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, TABLES).collect()}
    assert got.keys() == kept.keys() and all(r["restored"] for r in got.values())
    for r in secrets.scan(docs).collect():
        if r["doc_id"] in kept:
            text = kept[r["doc_id"]]
            for s in reversed(r["spans"]):
                text = text[: s["start"]] + secrets.MASK + text[s["end"] :]
            if all(a["end"] <= b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False)):
                assert got[r["doc_id"]]["ids"] == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("empty", [False, True])
def test_stages_survive_odd_rows(spark, docs_of, edges, empty):
    docs = docs_of([] if empty else edges)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, TABLES)
        if name != "bpe_tokens":
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert out.count() == docs.count() and (not empty or out.count() == 0)
