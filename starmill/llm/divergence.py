"""How sources of one language differ in their words, by exact integer arithmetic.

Terms are runs of ASCII letters and of characters outside ASCII, with A-Z lower-cased.  A
language keeps the terms found in at least ``LEAST`` of its documents.  A group is a language
and a source.  With count ``c`` of a term, ``N`` the sum of counts over kept terms and ``V`` kept
terms, ``p = 1 + floor(10^9 (c + 1) / (N + V))``; ``q`` is the same for what a group is compared
with, and a term adds ``floor((p - q)^2 / q)``.

``pairs`` compares every source with every other of its language, over all kept terms.  Terms
that neither has all add the same, so only the others are visited: terms are dealt into buckets
and sources into tiles, a task sums one bucket for one pair of tiles, and what leaves it is one
row per pair of sources, never per term.

``terms`` ranks the terms that a group uses more than its language does.  A value grows with the
group's count and falls with the language's, and of equal values the earlier term in UTF-8 comes
first.  So a term that ``k`` others dominate (count not lower, language's count not higher,
earlier in UTF-8) is not among the first ``k``: each partition keeps its ``k``-skyband, the
skybands are merged in steps of ``FAN`` partitions, and what is left is ranked exactly.

Defined results: a NULL text, language or source reads as ''; an empty text, or one without
letters, still makes its group occur; each row is a document of its own, also if it repeats
another; other columns are ignored; without documents there are no rows.  A language without
kept terms gives pairs of value 0 and no terms.  Sums of counts must stay below 2^53.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import stored
from starmill.operators.lookups import left_lookup, shuffle_partitions

LEAST = 3  # documents of a language that a kept term is found in
TOP = 200
UNIT = 1_000_000_000
TILE = 128  # sources of a tile
BUCKET = 200_000  # counts of a bucket
FAN = 4, 16, 16  # partitions whose skybands are merged at once, and merged ones in turn
HELD = 800_000  # counts or terms that a worker holds before it passes them on
STEP = 512  # points that are compared with a skyband at once
CHUNK = 1 << 20  # bytes of a text read at once; pairs of counts compared at once

# Any ASCII character but a letter separates terms; capital letters become small ones.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _spelled(raw: bytes):
    """Terms of a text in UTF-8, as lists of bounded size."""
    text, at = raw.translate(_LETTERS), 0
    while len(text) - at > CHUNK:
        end = text.find(b" ", at + CHUNK)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def _partial_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts and document counts by group and term, added up inside each task as far as memory allows.

    A row holds the terms of one group that fall into one bucket, separated by blanks, and their
    numbers in 8 bytes each.  Each group also gets the empty term, so that it occurs even without terms.
    """

    def rows(groups):
        for (lang, source), (times, found) in groups.items():
            dealt = defaultdict(list)
            for term in times:
                dealt[zlib.crc32(term) % buckets].append(term)
            dealt[0].append(b"")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(dealt), pa.binary()).cast(pa.string()),
                    pa.array([source] * len(dealt), pa.binary()).cast(pa.string()),
                    pa.array(list(dealt), pa.int32()),
                    pa.array([b" ".join(terms) for terms in dealt.values()], pa.binary()).cast(pa.string()),
                    *(
                        pa.array([np.fromiter((counts[t] for t in terms), "<i8", len(terms)).tobytes() for terms in dealt.values()], pa.binary())
                        for counts in (times, found)
                    ),
                ],
                names=["lang", "source", "bucket", "terms", "n", "docs"],
            )

    def run(batches):
        groups, held = {}, 0
        for batch in batches:
            columns = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "source", "text")]
            for lang, source, raw in zip(*columns, strict=True):
                times, found = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(times), set()
                for terms in _spelled(raw):
                    times.update(terms)
                    own.update(terms)
                found.update(own)
                held += len(times) - before + 1
                if held >= HELD:
                    yield from rows(groups)
                    groups, held = {}, 0
        yield from rows(groups)

    whole = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return whole.mapInArrow(run, "lang string, source string, bucket int, terms string, n binary, docs binary")


_KEPT = "lang string, source string, term string, n long, lang_n long, first boolean"


def _kept(table: pa.Table, least: int) -> pa.Table:
    """One language's terms of one bucket, summed by source and over the language."""
    terms = pc.split_pattern(table["terms"], " ")
    many = pc.list_value_length(terms).to_numpy()
    term = pc.list_flatten(terms).combine_chunks().dictionary_encode()
    source = table["source"].combine_chunks().dictionary_encode()
    n, docs = (np.frombuffer(b"".join(table[c].to_pylist()), "<i8") for c in ("n", "docs"))
    code, size = term.indices.to_numpy().astype(np.int64), len(source.dictionary)
    everywhere, found = (np.bincount(code, x, len(term.dictionary)).astype(np.int64) for x in (n, docs))
    keep = (found >= least) | pc.equal(term.dictionary, "").to_numpy(zero_copy_only=False)
    held = keep[code]
    key = code[held] * size + np.repeat(source.indices.to_numpy(), many)[held]
    key, at = np.unique(key, return_inverse=True)
    total = np.bincount(at, n[held], len(key)).astype(np.int64)
    code = key // size
    return pa.table({
        "lang": pa.repeat(table["lang"][0], len(key)), "source": source.dictionary.take(pa.array(key % size)),
        "term": term.dictionary.take(pa.array(code)), "n": total, "lang_n": everywhere[code],
        "first": np.r_[np.ones(min(1, len(key)), bool), code[1:] != code[:-1]],
    })


def kept_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Stored rows (lang, source, term, n, lang_n, first): kept terms by group, and '' for every group.

    ``lang_n`` is the term's count in its language; ``first`` marks one row of each term.
    """
    partial = _partial_counts(docs, max(64, shuffle_partitions(docs.sparkSession)))
    kept = partial.groupBy("lang", "bucket").applyInArrow(lambda table: _kept(table, least), _KEPT)
    return stored(kept, "divergence-counts")


def sizes(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(lang, source, n)`` of every group, and ``(lang, lang_n, v, sources, counts)`` of every language."""
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    real = F.col("term") != ""
    langs = counts.groupBy("lang").agg(
        F.sum("n").alias("lang_n"),
        F.sum((F.col("first") & real).cast("long")).alias("v"),
        F.sum((~real).cast("long")).alias("sources"),
        F.sum(real.cast("long")).alias("counts"),
    )
    return stored(groups, "divergence-groups"), stored(langs, "divergence-langs")


def share(n: Column | str, total: Column | str) -> Column:
    """``1 + floor(10^9 n / total)`` for ``0 < n <= total < 2^53``, three digits at a time."""
    n, total = (F.col(c) if isinstance(c, str) else c for c in (n, total))
    out, rest = F.lit(0).cast("long"), n
    for _ in range(3):
        rest = rest * F.lit(1000)
        out = out * F.lit(1000) + F.call_function("div", rest, total)
        rest = rest % total
    return out + F.lit(1)


def _share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    out, rest = np.zeros(len(n), np.int64), n.astype(np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _gap(p, q):
    return (p - q) * (p - q) // q


_PAIRS = "lang string, source string, item string, value long, seen long, n long, item_n long, v long"


def _block(block: pa.Table) -> pa.Table:
    """Sums over one bucket of terms for the pairs of sources of two tiles.

    Rows without a term name the sources.  ``seen`` counts the terms that at least one of a pair has.
    """
    term = block["term"].combine_chunks().dictionary_encode()
    named = pc.is_null(block["term"]).to_numpy(zero_copy_only=False)
    source = block["source"].combine_chunks().dictionary_encode()
    names, at = source.dictionary.to_pylist(), source.indices.to_numpy()
    size = len(names)
    n, tile = np.zeros(size, np.int64), np.zeros(size, np.int64)
    n[at[named]] = block["n"].to_numpy()[named]
    tile[at[named]] = block["own"].to_numpy()[named]
    low, high = block["low"][0].as_py(), block["high"][0].as_py()
    v = block["v"][0].as_py()
    wanted = (tile[:, None] == low) & (tile[None, :] == high)
    wanted = (wanted | wanted.T) & ~np.eye(size, dtype=bool)

    s, c = at[~named], block["n"].to_numpy()[~named]
    code = np.asarray(term.indices.to_numpy(zero_copy_only=False)[~named], np.int64)
    value, seen = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)
    if len(s):
        total = n + v
        none = _share(np.ones(size, np.int64), total)  # p of a term that a source lacks
        seen += (held := np.bincount(s, minlength=size))[:, None] + held[None, :]
        # Against zero: the counts of a source, each distinct one once.
        pair, times = np.unique(np.stack([s.astype(np.int64), c]), axis=1, return_counts=True)
        for a in range(0, len(times), max(1, CHUNK // size)):
            part = slice(a, a + max(1, CHUNK // size))
            p = _share(pair[1, part] + 1, total[pair[0, part]])
            np.add.at(value, pair[0, part], _gap(p[:, None], none[None, :]) * times[part, None])
            np.add.at(value.T, pair[0, part], _gap(none[None, :], p[:, None]) * times[part, None])
        # Terms that both have: take back what stands against zero, add the true value.
        order = np.argsort(code, kind="stable")
        s, c, code = s[order], c[order], code[order]
        p = _share(c + 1, total[s])
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        length = np.diff(np.r_[starts, len(code)])
        width = np.repeat(length, length)
        begin = np.repeat(starts, length)
        ends = np.cumsum(width)
        a = 0
        while a < len(code):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, "right")))
            left = np.repeat(np.arange(a, b), width[a:b])
            right = np.arange(len(left)) - np.repeat(np.cumsum(width[a:b]) - width[a:b], width[a:b]) + begin[left]
            good = wanted[s[left], s[right]]
            left, right = left[good], right[good]
            g, h = s[left], s[right]
            more = _gap(p[left], p[right]) - _gap(p[left], none[h]) - _gap(none[g], p[right])
            # Sums of 30 bits each stay exact in floating point.
            flat, space = g * size + h, size * size
            high, low_bits = (np.bincount(flat, part, space) for part in (more >> 30, more & ((1 << 30) - 1)))
            value += ((high.astype(np.int64) << 30) + low_bits.astype(np.int64)).reshape(size, size)
            seen -= np.bincount(flat, minlength=space).reshape(size, size)
            a = b
    g, h = np.nonzero(wanted)
    label = pa.array(names, pa.string())
    return pa.table({
        "lang": pa.repeat(block["lang"][0], len(g)), "source": label.take(pa.array(g)), "item": label.take(pa.array(h)),
        "value": value[g, h], "seen": seen[g, h], "n": n[g], "item_n": n[h], "v": pa.repeat(pa.scalar(v, pa.int64()), len(g)),
    })


def pairs(counts: DataFrame, groups: DataFrame, langs: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """``(lang, source, item, value)`` for all ordered pairs of sources of a language."""
    plan = langs.select(
        "lang", "v",
        F.ceil(F.col("sources") / F.lit(tile)).cast("int").alias("tiles"),
        F.greatest(F.lit(1), F.ceil(F.col("counts") / F.lit(bucket))).cast("int").alias("buckets"),
    )

    def dealt(df: DataFrame, term: Column, buckets: Column) -> DataFrame:
        own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
        placed = left_lookup(df, plan, {"lang": F.col("lang")}).withColumn("own", own)
        return placed.select(
            "lang", "source", term.alias("term"), "n", "v", "own", "tiles", buckets.alias("bucket")
        ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))

    real = counts.where(F.col("term") != "")
    rows = dealt(real, F.col("term"), F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int"))
    heads = dealt(groups, F.lit(None).cast("string"), F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    keyed = rows.unionByName(heads).select(
        "lang", "source", "term", "n", "v", "own", "bucket",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    parts = keyed.groupBy("lang", "bucket", "low", "high").applyInArrow(_block, _PAIRS)
    summed = parts.groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), *[F.max(c).alias(c) for c in ("n", "item_n", "v")]
    )
    p, q = (share(F.lit(1).cast("long"), F.greatest(F.lit(1), F.col(n) + F.col("v"))) for n in ("n", "item_n"))
    with_shares = summed.withColumn("p", p).withColumn("q", q)
    both_lack = (F.col("v") - F.col("seen")) * F.expr("(p - q) * (p - q) div q")
    return with_shares.select("lang", "source", "item", (F.col("value") + both_lack).alias("value"))


def skyband(group_n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of the points that fewer than ``k`` others dominate.

    A point is dominated by one whose ``group_n`` is not lower, whose ``lang_n`` is not higher
    and whose ``place`` is earlier.  It is enough to count dominators inside the skyband: of the
    dominators of a point the first ``k`` in order have fewer than ``k`` themselves.
    """
    order = np.lexsort((place, lang_n, -group_n))
    # Of equal counts only the first k places can stay.
    same = (group_n[order][1:] == group_n[order][:-1]) & (lang_n[order][1:] == lang_n[order][:-1])
    starts = np.flatnonzero(np.r_[True, ~same])
    order = order[np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)])) < k]
    kept = np.zeros(0, np.int64)
    for a in range(0, len(order), STEP):
        new = order[a : a + STEP]
        count = np.zeros(len(new), np.int64)
        if len(kept) >= k:
            # The k-th place among those up to some language counts: what comes later is dominated.
            by_lang = kept[np.argsort(lang_n[kept], kind="stable")]
            ends = np.unique(np.linspace(k, len(by_lang), 16).astype(np.int64))
            limit = np.array([np.partition(place[by_lang[:end]], k - 1)[k - 1] for end in ends])
            at = np.searchsorted(lang_n[by_lang[ends - 1]], lang_n[new], "right") - 1
            new = new[(at < 0) | (place[new] < limit[np.maximum(at, 0)])]
        if len(kept):
            above = (lang_n[kept][None, :] <= lang_n[new][:, None]) & (place[kept][None, :] < place[new][:, None])
            count = above.sum(axis=1)
            new, count = new[count < k], count[count < k]
        inside = (
            (group_n[new][None, :] >= group_n[new][:, None]) & (lang_n[new][None, :] <= lang_n[new][:, None]) & (place[new][None, :] < place[new][:, None])
        )
        kept = np.concatenate([kept, new[count + inside.sum(axis=1) < k]])
    return kept


_BAND = "lang string, source string, slot int, term string, n long, lang_n long"


def _thinned(table: pa.Table, k: int) -> pa.Table:
    if table.num_rows <= k:
        return table
    term = table["term"].combine_chunks()
    place = np.empty(len(term), np.int64)
    place[pc.sort_indices(term.cast(pa.binary())).to_numpy()] = np.arange(len(term))
    kept = skyband(table["n"].to_numpy(), table["lang_n"].to_numpy(), place, k)
    return table.take(pa.array(np.sort(kept)))


def bands(counts: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k``-skyband of each group's terms: ``(lang, source, term, n, lang_n)``."""
    names = ["lang", "source", "slot", "term", "n", "lang_n"]

    def local(batches):
        slot = TaskContext.get().partitionId() // FAN[0]
        held, rows = [], 0

        def passed():
            whole = pa.concat_tables(held).sort_by([("lang", "ascending"), ("source", "ascending")])
            keys = [whole[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
            cuts = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
                part = _thinned(whole.slice(a, b - a), k)
                yield from part.append_column("slot", pa.repeat(pa.scalar(slot, pa.int32()), part.num_rows)).select(names).to_batches()

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= HELD:
                yield from passed()
                held, rows = [], 0
        if rows:
            yield from passed()

    out = counts.where(F.col("term") != "").select("lang", "source", "term", "n", "lang_n").mapInArrow(local, _BAND)
    for more in FAN[1:]:
        out = out.groupBy("lang", "source", "slot").applyInArrow(lambda table: _thinned(table, k), _BAND)
        out = out.withColumn("slot", F.expr(f"slot div {more}").cast("int"))
    return out.groupBy("lang", "source").applyInArrow(lambda table: _thinned(table, k), _BAND).drop("slot")


def terms(counts: DataFrame, groups: DataFrame, langs: DataFrame, k: int = TOP) -> DataFrame:
    """``(lang, source, item, value, rank)``: the first ``k`` terms that a group uses more than its language."""
    band = left_lookup(bands(counts, k), groups.withColumnRenamed("n", "group_all"), {"lang": F.col("lang"), "source": F.col("source")})
    band = left_lookup(band, langs.select("lang", F.col("lang_n").alias("lang_all"), "v"), {"lang": F.col("lang")})
    known = band.withColumn("p", share(F.col("n") + 1, F.col("group_all") + F.col("v"))).withColumn(
        "q", share(F.col("lang_n") + 1, F.col("lang_all") + F.col("v"))
    )
    more = known.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    return _ranked(more).where(F.col("rank") <= k)


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return df.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = LEAST, k: int = TOP, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` with the parts ``pair`` and ``term``."""
    counts = kept_counts(docs, least)
    groups, langs = sizes(counts)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    by_pair = _ranked(pairs(counts, groups, langs, tile, bucket)).withColumn("part", F.lit("pair")).select(columns)
    by_term = terms(counts, groups, langs, k).withColumn("part", F.lit("term")).select(columns)
    return by_pair.unionByName(by_term)


AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT id, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT d.lang, d.source, coalesce(max(s.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) d
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL
), l AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
