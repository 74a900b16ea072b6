"""Near-duplicate groups by min-max hashing.

Each document is the set of its word shingles.  Under every permutation both the smallest and
the largest value are kept, so ``PERMUTATIONS`` hash evaluations give twice as many signature
values; runs of ``ROWS`` values form bands.  Documents that agree on a band share a bucket, and
every pair inside a bucket is compared on the full sets.

With 40 permutations and 20 bands of 4 values, a pair at similarity 0.85 shares no bucket with
probability ``(1 - 0.85**4)**20`` = 4e-7, one at 0.8 with 3e-5.

How it scales: equal sets become one class before anything is compared.  Buckets with the
same members are compared once.  A bucket is cut into chunks of bounded size, each pair of
chunks ("tile") is one group, and a tile returns a spanning forest of its links, never all
pairs.  Only texts of documents in some bucket are read again.

Defined results: a text without words (NULL, empty, white space only) has an empty set, is
linked with nothing and is its own component; a text with fewer words than a shingle is one
shingle; a row with a NULL ``doc_id`` is linked with nothing and its ``component_id`` is NULL;
repeated rows each get their own result row; an empty table gives no rows; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, bloom, free_name, passing, stored
from starmill.operators.lookups import BroadcastBudget, left_lookup

PERMUTATIONS, ROWS = 40, 4
CHUNK_SETS, CHUNK_SHINGLES = 1024, 400_000  # average bounds of a chunk of a bucket
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(1, 2**63, (2 * PERMUTATIONS // ROWS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 18  # hash values computed at a time


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of ``text``; words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    n = min(size, len(hashes))
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * _WORD[i]
    return np.unique(_mixed(total))


def signature(values: np.ndarray) -> np.ndarray:
    """Minima and maxima of a set under every permutation, two after two."""
    low = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    step = max(1, _BLOCK // PERMUTATIONS)
    for a in range(0, len(values), step):
        block = _FACTORS[:, None] * values[None, a : a + step]
        np.minimum(low, block.min(axis=1), out=low)
        np.maximum(high, block.max(axis=1), out=high)
    return np.stack([low, high], axis=1).reshape(-1)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """Per document: size and digest of its set, and its band values."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingle_set(text, size)
                sizes.append(len(values))
                keys.append(xxhash.xxh3_128_digest(values.tobytes()))
                if len(values):
                    rows = signature(values).reshape(-1, ROWS)
                    bands.append(_mixed((rows * _BAND).sum(axis=1, dtype=np.uint64)).view(np.int64))
                else:
                    bands.append(np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "key", "bands"],
            )

        return step

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n_shingles long, key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Digest and set of the documents that ``wanted`` (``doc``) names, and of few others.

    A Bloom filter of the ids, of bounded size, picks them, so the texts need no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted.select(F.xxhash64("doc").alias("hash"))))

    def make():
        bits = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text")
            sets = [shingle_set(texts[int(i)].as_py(), size) for i in passing(bits, batch.column("hash").to_numpy().view(np.uint64))]
            return pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["key", "hashes"],
            )

        return step

    rows = docs.where("doc_id IS NOT NULL").select(F.xxhash64(F.col("doc_id").cast("long")).alias("hash"), "text")
    return arrow_map(rows, make, "key binary, hashes binary")


def _members(classes: DataFrame) -> DataFrame:
    """Members of the buckets to compare: bucket, class, and the tiles the class takes part in."""
    spread = classes.where("n_shingles > 0").select("key", "doc", "n_shingles", F.posexplode("bands").alias("band", "value"))
    mark = F.xxhash64("key")
    buckets = (
        spread.groupBy("band", "value")
        .agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s"))
        .where("sets > 1")
        .groupBy("sets", "shingles", "x", "s")
        .agg(F.min(F.struct("band", "value")).alias("first"))
        .select(
            F.col("first.band").alias("band"),
            F.col("first.value").alias("value"),
            F.greatest(F.ceil(F.col("sets") / CHUNK_SETS), F.ceil(F.col("shingles") / CHUNK_SHINGLES), F.lit(1)).cast("int").alias("chunks"),
        )
    )
    return (
        spread.join(buckets, ["band", "value"])
        .withColumn("chunk", F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks")).cast("int"))
        .select("band", "value", "chunks", "chunk", "key", "doc")
    )


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> np.ndarray:
    """Which sets reach the similarity ``num / den``; within ``left`` if there is no ``right``."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    count = np.bincount(column)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n, total, width = len(left), int(column[-1]) + 1 if len(column) else 0, 4096
    both = np.zeros((n, len(right) if right else n), np.float64)
    for a in range(0, total, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[lo:hi], column[lo:hi] - a] = 1
        both += block[:n] @ (block[n:] if right else block).T
    inter = both.astype(np.int64)
    union = sizes[:n, None] + (sizes[n:] if right else sizes)[None, :] - inter
    return den * inter >= num * union


def _forest(keys: list[bytes], pairs: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links from each key to the smallest key it reaches through ``pairs``."""
    parent = list(range(len(keys)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = top(int(a)), top(int(b))
        if a != b:
            a, b = (a, b) if keys[a] < keys[b] else (b, a)
            parent[b] = a
    return [(keys[i], keys[top(i)]) for i in range(len(keys)) if top(i) != i]


def _links(members: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """A spanning forest of the verified links of every tile."""
    tiles = (
        members.join(_sets(docs, members.select("doc"), size), "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("band", "value", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", "key", "hashes")
    )

    def compare(table: pa.Table) -> pa.Table:
        rows = {}  # repeated documents come more than once
        for chunk, key, data in zip(table["chunk"].to_pylist(), table["key"].to_pylist(), table["hashes"].to_pylist(), strict=True):
            rows[key] = (chunk, data)
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        order = sorted(rows, key=lambda k: (rows[k][0], k))
        left = [np.frombuffer(rows[k][1], np.uint64) for k in order if rows[k][0] == a]
        right = None if a == b else [np.frombuffer(rows[k][1], np.uint64) for k in order if rows[k][0] == b]
        links = []
        if left and (right is None and len(left) > 1 or right):
            close = _linked(left, right, num, den)
            pairs = np.argwhere(close if right else np.triu(close, 1))
            if right:
                pairs[:, 1] += len(left)
            links = _forest(order, pairs)
        return pa.table({"u": pa.array([u for u, _ in links], pa.binary()), "v": pa.array([v for _, v in links], pa.binary())})

    return tiles.groupBy("band", "value", "a", "b").applyInArrow(compare, "u binary, v binary")


BROADCAST = BroadcastBudget(rows=100_000, bytes=4 << 20)  # the largest lookup that is sent to every executor


def connected(edges: DataFrame, label: str) -> DataFrame:
    """Columns ``node`` and ``root``: the smallest node of each linked node's component.

    ``edges`` has ``u`` and ``v`` of one orderable type.  Two kinds of step alternate until
    nothing changes: neighbours above a node, then those below it, are hung to the smallest.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.shiftright(F.xxhash64("v", "u"), 24)).alias("s")).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The lookups spread a node with very many neighbours.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m")), label)
        up = left_lookup(both.where("v > u"), least, {"at": F.col("u")}, BROADCAST).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        up = stored(up, label)
        low = stored(up.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m"), label)
        down = left_lookup(up, low, {"at": F.col("u")}, BROADCAST).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(down.select("e.*").where("u <> v").distinct(), label)


def components(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``key`` (digest of its set), ``n_shingles``, ``component_id``."""
    signed = stored(_signed(docs, shingle), "minmax-signed")
    classes = signed.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = stored(classes, "minmax-classes")
    members = stored(_members(classes), "minmax-members")
    links = connected(_links(members, docs, shingle, num, den), "minmax-links")
    rooted = classes.select("key", "doc").join(links.select(F.col("node").alias("key"), "root"), "key", "left").select("key", "doc", F.coalesce("root", "key").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select("key", "component_id"), "minmax-named")
    return (
        signed.select("doc_id", "key", "n_shingles")
        .join(named, "key", "left")
        .select(
            "doc_id",
            "key",
            "n_shingles",
            F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def groups(docs: DataFrame, shingle: int = 3, num: int = 85, den: int = 100) -> DataFrame:
    """Per row: set size, smallest linked ``doc_id``, and whether it is that document."""
    found = components(docs, shingle, num, den)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def deduplicate(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of every group, that with the smallest ``doc_id``; rows without id stay.

    Of rows that share both id and set, one stays.
    """
    found = stored(components(docs, shingle, num, den).where("doc_id IS NOT NULL").select("doc_id", "key", "component_id"), "minmax-found")
    gone = found.where("doc_id <> component_id").select("doc_id", "key").distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(*columns)
    # An id stands for several rows: tell them apart by their sets.
    key = free_name(docs, "set_key")
    left = _with_keys(docs, shingle, key).join(gone.withColumnRenamed("key", key), ["doc_id", key], "left_anti")
    one = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", key])
    return one.unionByName(left.where("doc_id IS NULL")).select(*columns)


def _with_keys(docs: DataFrame, size: int, name: str) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = [xxhash.xxh3_128_digest(shingle_set(t, size).tobytes()) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, name])

        return step

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{name}` binary"])
    return arrow_map(docs, make, schema)
