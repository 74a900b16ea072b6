"""Secrets in text, with weak candidates confirmed by the parts that belong with them.

Everything here is DataFrame expressions.  Three kinds are secrets by themselves: assigned
values, access ids and long hexadecimal runs.  Weaker parts (identifiers, secrets, endpoints) are
common in harmless text; they are linked by an interval join and reported only where what
completes them starts within ``SCOPE`` code points: a secret with an identifier or an endpoint,
an identifier with a secret, an endpoint with both.

How it scales: a text is scanned where it lies; only lengths of gaps and matches move.  The
interval join runs over buckets of ``SCOPE`` code points: a bucket is reduced to the first and
last start of each role before it is joined, so a bucket with many parts makes no pairs.

Defined results: a NULL or empty text has no spans; spans of one kind never overlap, spans of
different kinds may; positions are code points, ends exclusive; repeated rows get equal results;
rows with a NULL id are told apart by their text; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import free_name, stored

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# kind, role, pattern, group whose length counts, least length.  The order breaks ties.
BASE = (
    ("assign", "secret", _ASSIGN, 2, 12),
    ("access", "id", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "", r"[0-9a-f]{16,}", 0, 16),
)
WEAK = (
    ("id", "id", r"""(?i:access_?key_?id|client_?id|account|user_?name|login|user)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}""", 0, 0),
    ("key", "secret", r"(?<![A-Za-z0-9+/=_-])(?=[A-Z0-9+/]*[a-z])(?=[a-z0-9+/]*[A-Z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", 0, 0),
    ("value", "secret", r"""(?i:password|passwd|pwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,11}(?![A-Za-z0-9+/_.=-])""", 0, 0),
    ("endpoint", "endpoint", r"(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9][^\s\"'<>]*", 0, 0),
)
KINDS = BASE + WEAK
SCOPE = 300
MASK = "[secret]"


def row_mark() -> Column:
    return F.xxhash64("doc_id", "text")


def _at_least(numbers: Column, least: int) -> Column:
    return F.transform(numbers, lambda n: n >= least)


def _found(docs: DataFrame) -> DataFrame:
    """Per row: for every kind the matches in order, as (gap before, length, whether it counts)."""
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_mark().alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    step = step.select("*", *[F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(f"m{i}") for i, (_, _, pattern, _, _) in enumerate(KINDS)])
    columns = []
    for i, (_, _, pattern, group, least) in enumerate(KINDS):
        matches = F.col(f"m{i}")
        sizes = F.transform(matches, lambda m: F.char_length(m))
        counted = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), lambda m: F.char_length(m)) if group else sizes
        gaps = F.slice(F.transform(F.split("text", pattern, -1), lambda m: F.char_length(m)), F.lit(1), F.size(matches))
        parts = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), _at_least(counted, least).alias("ok"))
        columns.append(F.when(F.size(matches) > 0, parts).alias(f"k{i}"))
    return step.select("doc_id", "mark", *columns)


def _spans(found: DataFrame) -> DataFrame:
    """One row per match that counts: ``doc_id``, ``mark``, ``kind`` (number), ``start``, ``end``."""
    some = found.where(F.coalesce(*[F.col(f"k{i}") for i in range(len(KINDS))]).isNotNull()).dropDuplicates(["doc_id", "mark"])
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"k{i}").alias("parts")) for i in range(len(KINDS))])
    rows = (
        some.select("doc_id", "mark", F.explode(kinds).alias("k"))
        .select("doc_id", "mark", "k.kind", F.posexplode("k.parts").alias("i", "p"))
        .select("doc_id", "mark", "kind", "i", "p.gap", "p.size", "p.ok")
    )
    order = Window.partitionBy("doc_id", "mark", "kind").orderBy("i")
    ends = F.sum(F.col("gap") + F.col("size")).over(order)
    return rows.withColumn("end", ends).where("ok").select("doc_id", "mark", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _linked(spans: DataFrame) -> DataFrame:
    """The weak spans whose complement starts within ``SCOPE`` of their own start."""
    role = F.element_at(F.array(*[F.lit(r) for _, r, _, _, _ in KINDS]), F.col("kind") + 1)
    parts = spans.withColumn("role", role).withColumn("bucket", F.floor(F.col("start") / SCOPE)).where("role <> ''")
    ends = [f(F.when(F.col("role") == r, F.col("start"))).alias(f"{n}_{r}") for r in ("id", "secret", "endpoint") for n, f in (("first", F.min), ("last", F.max))]
    buckets = parts.groupBy("doc_id", "mark", "bucket").agg(*ends).select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.col("bucket").alias("b"), *[e for e in ("first_id", "last_id", "first_secret", "last_secret", "first_endpoint", "last_endpoint")])
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn("near", F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])))
    joined = weak.join(buckets, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("near") == F.col("b")))

    def close(r: str) -> Column:
        inside = F.col("near") == F.col("bucket")
        before = (F.col("near") < F.col("bucket")) & (F.col(f"last_{r}") >= F.col("start") - SCOPE)
        after = (F.col("near") > F.col("bucket")) & (F.col(f"first_{r}") <= F.col("start") + SCOPE)
        return F.max(F.coalesce(F.col(f"first_{r}").isNotNull() & (inside | before | after), F.lit(False)))

    met = joined.groupBy("doc_id", "mark", "kind", "start", "end", "role").agg(*[close(r).alias(r) for r in ("id", "secret", "endpoint")])
    return met.where(
        (F.col("role") == "secret") & (F.col("id") | F.col("endpoint")) | (F.col("role") == "id") & F.col("secret") | (F.col("role") == "endpoint") & F.col("id") & F.col("secret")
    ).select("doc_id", "mark", "kind", "start", "end")


def _collected(found: DataFrame) -> DataFrame:
    """Per distinct row with spans: all its spans in order of start, then kind."""
    spans = stored(_spans(found), "secret-spans")
    every = spans.where(F.col("kind") < len(BASE)).unionByName(_linked(spans))
    return every.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``mark``, and ``spans`` (start, kind number, end); empty if none."""
    found = stored(_found(docs), "secret-found")
    right = _collected(found).select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "spans")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    left = found.select("doc_id", "mark")
    return left.join(right, left["doc_id"].eqNullSafe(right["d"]) & (left["mark"] == right["m"]), "left").select("doc_id", "mark", F.coalesce("spans", none).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k, _, _, _, _ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row: counts of the three kinds, digest of their spans, and all spans as text."""
    spans = F.col("spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return scan(docs).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.filter(spans, lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``MASK``; a column ``n_chars`` follows the new text."""
    mark = free_name(docs, "row_mark")
    hits = _collected(stored(_found(docs), "secret-found")).select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.col("spans").alias("s"))
    marked = docs.withColumn(mark, row_mark())
    joined = marked.join(hits, marked["doc_id"].cast("long").eqNullSafe(hits["d"]) & (marked[mark] == hits["m"]), "left")
    text, empty = marked["text"], F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def take(a: Column, s: Column) -> Column:
        gap = text.substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["out"], gap, F.lit(MASK))).otherwise(a["out"]).alias("out"))

    new = F.when(hits["s"].isNull(), text).otherwise(F.aggregate(hits["s"], empty, take, lambda a: F.concat(a["out"], text.substr((a["at"] + 1).cast("int"), F.lit(2**31 - 1)))))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(new.alias("text"))
        elif c == "n_chars":
            columns.append(F.when(hits["s"].isNull(), marked["n_chars"]).otherwise(F.char_length(new)).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(marked[f"`{c}`"])
    return joined.select(*columns)
