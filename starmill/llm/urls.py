"""URL verdicts: rules first, then naive Bayes over words found in host and path.

Hosts glue words together.  A unigram model splits each host label into the words that are most
probable together (Viterbi); a multinomial naive Bayes model then scores the words of host and
path.  It learns from the URLs that a rule decides.  The labels and path parts that rules are
made of are left out, in learning and in scoring: they would only teach the rules once more.

How it scales: the word model is counted over all page texts, but never gathered: the pieces of
the distinct host labels are joined with the word counts, so each label gets the counts it needs.
Words of more than ``LONGEST`` letters are not in the word model, so a label has pieces in
proportion to its length; labels themselves are read whole.  Naive Bayes counts go to ``BUCKETS``
hashed buckets, a fixed bound for what is broadcast.  Rules are joined by host suffix, and the
longest fitting one wins; they are what is broadcast, up to a measured size.  What belongs to a
host or a place is looked up by joins that spread frequent keys.

Defined results: a NULL URL or one without ``://`` has empty host and path; ties between classes
go to ``allow``; a class without examples never wins; repeated rows get equal verdicts; among
rules equally long, the one with the longer host, then the smaller text wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, stored
from starmill.operators.lookups import BroadcastBudget, left_lookup

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
LONGEST = 20  # letters of a word of the word model
BUCKETS = 1 << 16
BROADCAST = BroadcastBudget(rows=20_000, bytes=2 << 20)  # the largest lookup that is sent to every executor
_WORDS = re.compile(r"[a-z]+|[0-9]+")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def located(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``."""
    host, path = split_url(F.col("url"))
    return pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))


def ruled(urls: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``urls`` with the longest fitting ``rule`` and its ``ruling``; NULL where none fits."""
    kinds = "rule string, ruling string, rule_host string, rule_path string"
    table = urls.sparkSession.createDataFrame(sorted({(r, v, r.split("/", 1)[0], "/" + r.split("/", 1)[1]) for v, r in rules}), kinds)
    if BROADCAST.admits(table):
        table = F.broadcast(table)
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    places = urls.select("host", "path").distinct()
    fits = (
        places.withColumn("rule_host", F.explode(suffixes))
        .join(table, "rule_host")
        .where(F.expr("startswith(path, rule_path)"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule"), F.length("rule_host"), "rule", "ruling")).alias("best"))
        .select("host", "path", "best.rule", "best.ruling")
    )
    return left_lookup(urls, fits, {"host": F.col("host"), "path": F.col("path")}, BROADCAST)


def parts_of(rules: Sequence[tuple[str, str]]) -> tuple[list[str], list[str]]:
    """The host labels and the path words that rules are made of."""
    hosts, paths = zip(*(r.split("/", 1) for _, r in rules), strict=True) if rules else ((), ())
    return sorted({x for h in hosts for x in h.split(".")}), sorted({w for p in paths for w in _WORDS.findall(p.lower())})


def word_counts(pages: DataFrame) -> DataFrame:
    """How often each word of letters occurs in the text of all pages: ``word``, ``n``."""

    def make():
        tags, words = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I), re.compile(r"[a-z]+")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, int] = {}
            for page in batch.column("html").to_pylist():
                for w in words.findall(tags.sub(" ", page or "").lower()):
                    if len(w) <= LONGEST:
                        counts[w] = counts.get(w, 0) + 1
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        return step

    return arrow_map(pages.select("html"), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_word(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a host label (Viterbi); fewer words win ties.

    A piece that was never counted costs more the longer it is.
    """
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(label) + 1):
        found = None
        for start in range(max(0, end - LONGEST), end):
            piece = label[start:end]
            n = counts.get(piece)
            cost = math.log(total / n) if n else math.log(total) + 2.5 * (end - start)
            here = (best[start][0] + cost, best[start][1] + 1, start)
            if found is None or here < found:
                found = here
        best.append(found)
    out, end = [], len(label)
    while end:
        out.append(label[best[end][2] : end])
        end = best[end][2]
    return out[::-1]


def segmented(hosts: DataFrame, counts: DataFrame, ruled_labels: Sequence[str] = ()) -> DataFrame:
    """``host``, its ``words`` in order, and ``own``, those of labels that no rule is made of.

    The last label, which names no site, stays whole.
    """
    labels = hosts.select("host").distinct().select("host", F.posexplode(F.split("host", r"\.")).alias("i", "name"), F.size(F.split("host", r"\.")).alias("labels"))
    names = labels.select("name").distinct().where("name RLIKE '[a-z]'")
    letters = F.char_length("name")
    pieces = (
        names.withColumn("start", F.explode(F.sequence(F.lit(1), letters)))
        .withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), letters - F.col("start") + 1))))
        .select("name", F.expr("substring(name, start, size)").alias("word"))
        .distinct()
    )
    known = pieces.join(counts, "word", "left").groupBy("name").agg(F.map_from_entries(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", "n")))).alias("counts"))
    total = max(1, counts.agg(F.sum("n")).first()[0] or 1)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for name, pairs in zip(batch.column("name").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                have = dict(pairs or [])
                # Digits and hyphens part words by themselves.
                found.append([w for piece in _WORDS.findall(name) for w in (split_word(piece, have, total) if piece[0].isalpha() else [piece])])
            return pa.RecordBatch.from_arrays([batch.column("name"), pa.array(found, pa.list_(pa.string()))], names=["name", "split"])

        return step

    split = arrow_map(known, make, "name string, split array<string>")
    whole = F.when((F.col("i") == F.col("labels") - 1) | F.col("split").isNull(), F.array("name")).otherwise(F.col("split"))
    rows = left_lookup(labels, split, {"name": F.col("name")}, BROADCAST).select("host", F.struct("i", whole.alias("split"), (~F.col("name").isin(list(ruled_labels))).alias("own")).alias("label"))
    by_host = rows.groupBy("host").agg(F.array_sort(F.collect_list("label")).alias("all"))
    words = lambda labels: F.flatten(F.transform(labels, lambda x: x["split"]))
    return by_host.select("host", words(F.col("all")).alias("words"), words(F.filter("all", lambda x: x["own"])).alias("own"))


def marks(words: list[str] | None, path: str, ruled_words: frozenset[str] = frozenset()) -> list[int]:
    """Buckets of the words of a host and a path; numbers count by their length only."""
    out = [f"h {w}" for w in words or [] if w]
    out += [f"p {w}" if w[0].isalpha() else f"p #{len(w)}" for w in _WORDS.findall(path.lower()) if w not in ruled_words]
    return [xxhash.xxh3_64_intdigest(w) % BUCKETS for w in out]


def _with_marks(rows: DataFrame, ruled_words: frozenset[str]) -> DataFrame:
    """Columns ``own``, ``path`` and what else is there, with ``marks``."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [marks(w, p, ruled_words) for w, p in zip(batch.column("own").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, "marks"])

        return step

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "marks array<int>"])
    return arrow_map(rows, make, schema)


def train(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Log-odds of "block" per bucket, and of the classes; ``rows`` has ``marks`` and ``ruling``."""
    taught = rows.where("ruling IS NOT NULL")
    counts = np.ones((2, BUCKETS))  # one of each, so nothing is impossible
    for r in taught.select("ruling", F.explode("marks").alias("mark")).groupBy("ruling", "mark").count().collect():  # 2 * BUCKETS rows at most
        counts[int(r["ruling"] == "block"), r["mark"]] += r["count"]
    seen = {r["ruling"]: r["count"] for r in taught.groupBy("ruling").count().collect()}
    odds = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    allow, block = seen.get("allow", 0), seen.get("block", 0)
    prior = -math.inf if not block else math.inf if not allow else math.log(block / allow)
    return odds, prior


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``words``, ``block_odds``."""
    urls = located(pages)
    places = stored(ruled(urls.select("host", "path").distinct(), rules), "url-places")
    counts = stored(word_counts(pages), "url-words")
    ruled_labels, ruled_words = parts_of(rules)
    words = stored(segmented(places, counts, ruled_labels), "url-hosts")
    looked_up = left_lookup(urls.drop("url"), places, {"host": F.col("host"), "path": F.col("path")}, BROADCAST)
    looked_up = left_lookup(looked_up, words, {"host": F.col("host")}, BROADCAST).select("page_id", "host", "path", "rule", "ruling", "words", "own")
    marked = stored(_with_marks(looked_up, frozenset(ruled_words)), "url-marks")
    odds, prior = train(marked)
    shared = pages.sparkSession.sparkContext.broadcast((odds, prior))

    def make():
        table, start = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column("marks")
            values, cuts = column.values.to_numpy(), column.offsets.to_numpy()
            sums = np.concatenate([[0.0], np.cumsum(table[values])])
            score = start + sums[cuts[1:]] - sums[cuts[:-1]]
            verdict = [r or ("block" if s > 0 else "allow") for r, s in zip(batch.column("ruling").to_pylist(), score, strict=True)]
            keep = batch.select(["page_id", "host", "path", "rule"])
            return pa.RecordBatch.from_arrays([*keep.columns, pa.array(verdict, pa.string()), batch.column("words"), pa.array(score, pa.float64())], names=[*keep.schema.names, "verdict", "words", "block_odds"])

        return step

    kind = pages.schema["page_id"].dataType.simpleString()
    return arrow_map(marked, make, f"page_id {kind}, host string, path string, rule string, verdict string, words array<string>, block_odds double")
