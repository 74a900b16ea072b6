"""Exact top-k by inner product: an M-tree of paged metric nodes, searched best first.

Vectors become whole numbers, ``floor(64 x)``.  An inner product turns into a distance by one
more coordinate, ``sqrt(M - |x|**2)`` with ``M`` the largest square norm: then the nearest
vectors have the highest products.  The tree has three levels: routing objects, pages with a
covering radius, and entries with their distance to the page's centre.  What is stored lets
whole nodes, pages and entries be passed over without a computation, by the triangle inequality;
what remains is compared exactly, on whole numbers.

How it scales: there are at most ``ROUTES`` routing objects, so only they are broadcast.  The
vectors of one are cut into nodes of about ``NODE`` vectors, so a very common vector fills many
nodes.  Queries travel in blocks.  A first look at one node per query gives a threshold; then a
query goes only to routing objects that can beat it, and a node returns only what reaches it.
Blocks and nodes meet in a shuffle: a query goes to many nodes, so its blocks are many times as
large as the file they come from, by which Spark would choose to broadcast them.

Defined results: vectors that are NULL, empty or hold NULL or non-finite components take no
part, nor do rows with a NULL id; shorter vectors count as filled up with zeros; equal rows
count once; a query is not its own candidate, nor is another row of its id; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, stored

SCALE = 64
ROUTES, NODE, PAGE, BLOCK = 64, 2048, 32, 256
_EXACT = float(2**53)


def whole(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``, the whole-number vector as packed 64-bit floats; valid rows, each once."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, out = [], []
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                if i is None or not x or any(c is None for c in x):
                    continue
                v = np.floor(SCALE * np.array(x, np.float64))
                if np.isfinite(v).all():
                    ids.append(i)
                    out.append((v + 0.0).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

        return step

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return arrow_map(rows, make, "vec_id long, v binary").dropDuplicates(["vec_id", "v"])


def _matrix(column: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, data in enumerate(column):
        v = np.frombuffer(data)
        out[i, : len(v)] = v
    return out


_LOW, _HIGH = -(2**63), 2**63 - 1


def _integers(a: np.ndarray) -> np.ndarray:
    out = np.empty(a.shape, object)
    out[...] = [[int(x) for x in row] for row in a]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exact: in floats while they fit, else in Python's integers."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64)
    return np.clip(_integers(a) @ _integers(b).T, _LOW, _HIGH).astype(np.int64)


class Space:
    """Distances between stored vectors, and from queries to them."""

    def __init__(self, top: float):
        self.top = top  # largest square norm
        self.slack = 1e-6 * (1 + top) ** 0.5
        self.bounded = bool(top < 1e300)  # else all distances are taken as 0 and every product as possible

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not self.bounded:
            return np.zeros((len(a), len(b)))
        na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        last = np.sqrt(np.maximum(self.top - na, 0))[:, None] - np.sqrt(np.maximum(self.top - nb, 0))[None, :]
        return np.sqrt(np.maximum(na[:, None] + nb[None, :] - 2 * (a @ b.T), 0) + last * last)

    def of_queries(self, q: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not self.bounded:
            return np.zeros((len(q), len(b)))
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + self.top - 2 * (q @ b.T), 0))

    def best(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Highest product of a query with anything at least ``bound`` away, a little too high."""
        if not self.bounded:
            return np.where(np.isposinf(bound), -np.inf, np.inf)
        near = np.maximum(bound - 2 * self.slack, 0)
        square = (q * q).sum(axis=1).reshape(-1, *([1] * (near.ndim - 1)))
        high = (square + self.top - near * near) / 2
        return high + 1e-9 * (square + self.top) + 1e-3


def promoted(vectors: np.ndarray, pages: int, space: Space) -> np.ndarray:
    """Page centres far from each other: each is the candidate farthest from those before it."""
    chosen, away = [0], space.between(vectors, vectors[:1])[:, 0]
    while len(chosen) < pages and away.max() > space.slack:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, space.between(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def build(ids: np.ndarray, vectors: np.ndarray, route: np.ndarray, space: Space) -> dict[str, np.ndarray]:
    """A node: pages around centres, entries in order of their distance to the centre."""
    pages = max(1, len(ids) // PAGE)
    order = np.array(sorted(range(len(ids)), key=lambda i: (xxhash.xxh3_64_intdigest(ids[i].tobytes()), i)))
    centres = promoted(vectors[order[: 4 * pages]], pages, space)
    distance = space.between(vectors, centres)
    page = distance.argmin(axis=1)
    own = distance[np.arange(len(ids)), page]
    order = np.lexsort((own, page))
    starts = np.searchsorted(page[order], np.arange(len(centres) + 1))
    used = np.flatnonzero(np.diff(starts))
    radius = np.array([own[order[starts[p + 1] - 1]] for p in used])
    return {
        "ids": ids[order],
        "vectors": vectors[order],
        "parent": own[order],
        "starts": np.append(starts[used], len(ids)),
        "centres": centres[used],
        "radius": radius,
        "route": space.between(route[None, :], centres[used])[0],
    }


_PARTS = (("ids", np.int64), ("vectors", np.float32), ("parent", np.float64), ("starts", np.int64), ("centres", np.float32), ("radius", np.float64), ("route", np.float64))


def packed(node: dict[str, np.ndarray]) -> bytes:
    small = max((np.abs(node[k]).max() for k in ("vectors", "centres") if node[k].size), default=0) < 2**24
    head = np.array([len(node["ids"]), len(node["radius"]), node["vectors"].shape[1], small], np.int64).tobytes()
    return head + b"".join(node[k].astype(t if t is not np.float32 or small else np.float64).tobytes() for k, t in _PARTS)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    n, pages, width, small = np.frombuffer(data, np.int64, 4).tolist()
    shapes = {"ids": (n,), "vectors": (n, width), "parent": (n,), "starts": (pages + 1,), "centres": (pages, width), "radius": (pages,), "route": (pages,)}
    out, at = {}, 32
    for k, t in _PARTS:
        t = np.dtype(t if t is not np.float32 or small else np.float64)
        size = int(np.prod(shapes[k]))
        out[k] = np.frombuffer(data, t, size, at).reshape(shapes[k])
        at += size * t.itemsize
    out["vectors"], out["centres"] = out["vectors"].astype(np.float64), out["centres"].astype(np.float64)
    return out


def search(node: dict[str, np.ndarray], own: np.ndarray, q: np.ndarray, least: np.ndarray, to_route: np.ndarray, space: Space, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries for each query among those that reach ``least``: query, id, product.

    Pages are visited best first.  A page is passed over by its distance to the routing object,
    then by that to its centre; an entry by the stored distance to the centre.
    """
    far = np.abs(to_route[:, None] - node["route"][None, :]) - node["radius"]
    least = least.copy()
    alive = space.best(q, far) >= least[:, None]
    pages = np.flatnonzero(alive.any(axis=0))
    if not len(pages):
        none = np.zeros(0, np.int64)
        return none, none, none
    to_centre = space.of_queries(q, node["centres"][pages])
    high = np.where(alive[:, pages], space.best(q, to_centre - node["radius"][pages]), -np.inf)
    kept = np.full((len(q), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for p in np.argsort(-high.max(axis=0), kind="stable"):
        rows = np.flatnonzero(high[:, p] >= least)
        if not len(rows):
            continue
        a, b = node["starts"][pages[p]], node["starts"][pages[p] + 1]
        bound = space.best(q[rows], np.abs(to_centre[rows, p, None] - node["parent"][a:b]))
        wanted = bound >= least[rows, None]
        entries = np.flatnonzero(wanted.any(axis=0)) + a
        if not len(entries):
            continue
        score = _products(q[rows], node["vectors"][entries])
        ok = (score >= least[rows, None]) & (node["ids"][entries][None, :] != own[rows, None])
        r, c = np.nonzero(ok)
        if len(r):
            found.append((rows[r], node["ids"][entries[c]], score[r, c]))
            kept[rows] = -np.partition(-np.concatenate([kept[rows], np.where(ok, score, -np.inf).astype(np.float64)], axis=1), k - 1, axis=1)[:, :k]
            least[rows] = np.maximum(least[rows], kept[rows].min(axis=1))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    row, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
    some = score >= least[row]
    row, ids, score = row[some], ids[some], score[some]
    order = np.lexsort((ids, ~score, row))  # ~ turns the order around without leaving 64 bits
    row, ids, score = row[order], ids[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], ids[rank < k], score[rank < k]


def _blocks(rows: Iterator[pa.RecordBatch], route_of, names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows gathered by destination into blocks of at most ``BLOCK`` queries."""
    open_blocks: dict[tuple[int, int], list[tuple]] = {}

    def close(to: tuple[int, int]) -> pa.RecordBatch:
        columns = list(zip(*open_blocks.pop(to), strict=True))
        return pa.RecordBatch.from_arrays([pa.array([to[0]], pa.int32()), pa.array([to[1]], pa.int32()), *(pa.array([list(c)], pa.list_(k)) for c, k in zip(columns, kinds, strict=True))], names=["route", "slot", *names])

    for batch in rows:
        for to, row in route_of(batch):
            block = open_blocks.setdefault(to, [])
            block.append(row)
            if len(block) == BLOCK:
                yield close(to)
    for to in list(open_blocks):
        yield close(to)


_QUERY = ["uid", "vec_id", "v", "least", "distance"]
_QUERY_KINDS = [pa.binary(), pa.int64(), pa.binary(), pa.float64(), pa.float64()]
_BLOCK_SCHEMA = "route int, slot int, uid array<binary>, vec_id array<bigint>, v array<binary>, least array<double>, distance array<double>"


def meet(blocks: DataFrame, nodes: DataFrame, place: str) -> DataFrame:
    """Each block of queries with the nodes of its place, in a sorted merge: a task holds the nodes of
    one place at a time and neither side whole, and nothing passes through the driver."""
    return blocks.join(nodes.hint("merge"), ["route", place])


def nearest(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """For every row whose id is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    points = stored(whole(vectors), "mtree-points")

    def norms():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.frombuffer(v) for v in batch.column("v").to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64()), pa.array([max(map(len, found))], pa.int32()), pa.array([max(float(v @ v) for v in found)], pa.float64())], names=["n", "width", "top"])

        return step

    facts = arrow_map(points, norms, "n long, width int, top double").agg(F.sum("n").alias("n"), F.max("width").alias("width"), F.max("top").alias("top")).first()
    answer = "query_id long, rank int, vec_id long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], answer)
    width, space = int(facts["width"]), Space(float(facts["top"]))
    # Routing objects: a bounded sample by hash of the id; every vector is indexed under one.
    few = points.orderBy(F.xxhash64("vec_id"), "v").limit(int(min(ROUTES, -(-facts["n"] // (NODE // 2))))).collect()
    routes = np.unique(_matrix([bytes(r["v"]) for r in few], width), axis=0)
    known = spark.sparkContext.broadcast((routes, space, width))

    def assign():
        routes, space, width = known.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            to = space.between(_matrix(batch.column("v").to_pylist(), width), routes)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(to.argmin(axis=1), pa.int32()), pa.array(to.min(axis=1), pa.float64())], names=[*batch.schema.names, "route", "away"])

        return step

    assigned = stored(arrow_map(points, assign, "vec_id long, v binary, route int, away double"), "mtree-assigned")
    sizes = {r["route"]: (r["n"], r["radius"]) for r in assigned.groupBy("route").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}  # ROUTES rows at most
    nodes_of = {r: -(-n // NODE) for r, (n, _) in sizes.items()}
    slots_of = {r: -(-n // 8) for r, n in nodes_of.items()}  # places to spread a large routing object's nodes over
    chunks = F.create_map(*[F.lit(x) for r in sorted(nodes_of) for x in (r, nodes_of[r])])
    slots = F.create_map(*[F.lit(x) for r in sorted(slots_of) for x in (r, slots_of[r])])

    def grow(table: pa.Table) -> pa.Table:
        routes, space, width = known.value
        route = table["route"][0].as_py()
        ids, v = table["vec_id"].to_numpy(), _matrix(table["v"].to_pylist(), width)
        order = np.lexsort((*v.T, ids))
        node = packed(build(ids[order], v[order], routes[route], space))
        return pa.table({"route": pa.array([route], pa.int32()), "chunk": pa.array([table["chunk"][0].as_py()], pa.int32()), "node": pa.array([node], pa.binary())})

    spread = assigned.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(5)), chunks[F.col("route")]).cast("int"))
    nodes = stored(spread.groupBy("route", "chunk").applyInArrow(grow, "route int, chunk int, node binary"), "mtree-nodes")

    def visit(joined: DataFrame, limit: int) -> DataFrame:
        def run():
            _, space, width = known.value

            def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
                out: list[tuple[list[bytes], np.ndarray, np.ndarray]] = []
                for i in range(batch.num_rows):
                    get = lambda c, i=i: batch.column(c)[i].as_py()
                    uid = get("uid")
                    row, ids, score = search(unpacked(get("node")), np.array(get("vec_id"), np.int64), _matrix(get("v"), width), np.array(get("least")), np.array(get("distance")), space, limit)
                    out.append(([uid[r] for r in row], ids, score))
                if not any(len(s) for _, _, s in out):
                    return None
                return pa.RecordBatch.from_arrays(
                    [pa.array([u for x, _, _ in out for u in x], pa.binary()), pa.array(np.concatenate([x for _, x, _ in out]).astype(np.int64)), pa.array(np.concatenate([x for _, _, x in out]).astype(np.int64))],
                    names=["uid", "vec_id", "score"],
                )

            return step

        return arrow_map(joined, run, "uid binary, vec_id long, score long")

    queries = assigned.where(F.col("vec_id") % every == 0).select(F.unhex(F.md5(F.concat(F.col("vec_id").cast("string").cast("binary"), F.col("v")))).alias("uid"), "vec_id", "v")

    def first_place(batches):
        routes, space, width = known.value

        def places(batch: pa.RecordBatch):
            rows = batch.to_pylist()
            to = space.of_queries(_matrix([r["v"] for r in rows], width), routes)
            for r, d in zip(rows, to, strict=True):
                # Only routing objects that have vectors; ties go to the first.
                route = min(nodes_of, key=lambda x: (d[x], x))
                chunk = xxhash.xxh3_64_intdigest(r["uid"]) % nodes_of[route]
                yield (route, chunk), (r["uid"], r["vec_id"], r["v"], -np.inf, float(d[route]))

        return _blocks(batches, places, _QUERY, _QUERY_KINDS)

    looked = meet(queries.mapInArrow(first_place, _BLOCK_SCHEMA).withColumnRenamed("slot", "chunk"), nodes, "chunk")
    reached = visit(looked, k).groupBy("uid").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    bounded = queries.join(reached, "uid", "left").select("uid", "vec_id", "v", F.when(F.col("n") >= k, F.col("low").cast("double")).otherwise(F.lit(float("-inf"))).alias("least"))
    bounded = stored(bounded, "mtree-bounds")

    def all_places(batches):
        routes, space, width = known.value
        radius = np.array([sizes[r][1] if r in sizes else -np.inf for r in range(len(routes))])

        def places(batch: pa.RecordBatch):
            rows = batch.to_pylist()
            q = _matrix([r["v"] for r in rows], width)
            to = space.of_queries(q, routes)
            open_to = space.best(q, np.where(np.isinf(radius), np.inf, to - radius)) >= np.array([r["least"] for r in rows])[:, None]
            for i, route in zip(*np.nonzero(open_to & ~np.isinf(radius)[None, :]), strict=True):
                r = rows[i]
                for slot in range(slots_of[int(route)]):
                    yield (int(route), slot), (r["uid"], r["vec_id"], r["v"], r["least"], float(to[i, route]))

        return _blocks(batches, places, _QUERY, _QUERY_KINDS)

    slotted = nodes.withColumn("slot", F.pmod(F.col("chunk"), slots[F.col("route")]).cast("int"))
    every_hit = visit(meet(bounded.mapInArrow(all_places, _BLOCK_SCHEMA), slotted, "slot"), k)
    # The rank limit works inside each task before the exchange, so no list grows with the table.
    order = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = every_hit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    owners = bounded.select("uid", F.col("vec_id").alias("query_id"))
    return best.join(owners, "uid").select("query_id", "rank", "vec_id", "score")
