"""Helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starmill.session import written


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is a checkout and not installed."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, environment.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back."""
    return written(df.sparkSession, df, label)


ROWS_AT_ONCE = 1000


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """Apply ``make()``, called once per task, to a thousand rows of an Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                # Rebuilt, so that offsets of lists and texts start at the slice.
                out = step(pa.concat_batches([batch.slice(first, ROWS_AT_ONCE)]) if batch.num_rows > ROWS_AT_ONCE else batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def int_lists(values, offsets) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


LEAST_BITS, MOST_BITS = 26, 30  # a filter has 8 to 128 MB, by the number of values
_PART = 1 << 16  # bits of a part of the filter
_PLACES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _place(hashes: np.ndarray, i: int, bits: int) -> np.ndarray:
    return ((hashes * _PLACES[i]) >> np.uint64(64 - bits)).astype(np.int64)


def bloom(hashes: DataFrame, most: int = MOST_BITS) -> np.ndarray:
    """Bloom filter over a column ``hash`` of well-mixed 64-bit values, as packed bits.

    It is gathered in parts and may be broadcast: it has 12 bits for every value, but never more
    than ``2**most``.  It lets some other values through, so an exact join must follow; with more
    values than it is made for it lets more through, and loses none.
    """
    bits = min(most, max(LEAST_BITS, (12 * hashes.count()).bit_length()))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column("hash").to_numpy().view(np.uint64)
            places = np.unique(np.concatenate([_place(values, i, bits) for i in range(3)]))
            return pa.RecordBatch.from_arrays([pa.array(places // _PART, pa.int64()), pa.array(places % _PART, pa.int32())], names=["part", "bit"])

        return step

    def join(table: pa.Table) -> pa.Table:
        own = np.zeros(_PART, np.uint8)
        own[table["bit"].to_numpy()] = 1
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int64()), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    parts = arrow_map(hashes.select("hash"), make, "part long, bit int").distinct().groupBy("part").applyInArrow(join, "part long, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.collect():  # 2**bits / _PART rows at most
        out[r["part"] * (_PART // 8) : (r["part"] + 1) * (_PART // 8)] = np.frombuffer(r["bits"], np.uint8)
    return out


def passing(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Indices of the values that a Bloom filter lets through."""
    left, bits = np.arange(len(hashes)), (8 * len(filled)).bit_length() - 1
    for i in range(3):
        at = _place(hashes[left], i, bits)
        left = left[(filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return left
