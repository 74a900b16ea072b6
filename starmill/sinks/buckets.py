"""A stored table of one row per key, into which batches are merged bucket by bucket.

Rows lie in folders by a hash of their key.  A merge reads, compares and rewrites only the buckets
that the batch touches; a record then names the folder that counts for each bucket, so readers see
the table before or after a merge.  Merging a batch again changes nothing.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmill.operators.lookups import shuffle_partitions
from starmill.session import STORED, shuffles_dropped
from starmill.sinks.records import Records, remove

BUCKET, _SHARE = "__bucket", "__share"


@dataclass(frozen=True)
class Merge:
    """What a merge rewrote."""

    touched: int
    buckets: int


@dataclass(frozen=True)
class BucketedTable:
    """``latest(rows, keys)`` keeps one row per key: from a batch, and from a batch and what is stored.

    It must not depend on the order of rows, and its result must not depend on whether earlier
    batches were reduced before; a total order over all columns gives both.
    """

    root: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int
    latest: Callable[[DataFrame, Sequence[str]], DataFrame]

    def merge(self, batch: DataFrame) -> Merge:
        """Take in a batch.

        A key that fills the batch is reduced inside the map tasks first.  The stored rows of the
        touched buckets and the batch then meet by bucket, in the one exchange that also lays out
        the files: the bucket is part of the key, so keep-latest needs no other.  A bucket is divided
        among tasks by another part of the hash, so that tasks stay small however few the buckets.
        What only the merge itself reads, its exchanges and the reduced batch, goes with it.
        """
        with shuffles_dropped(batch.sparkSession):
            return self._merge(batch)

    def _merge(self, batch: DataFrame) -> Merge:
        spark, records = batch.sparkSession, self._records(batch.sparkSession)
        last = records.latest() or {"number": -1, "folders": {}}
        place = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = self.latest(batch.select(*self.schema.names), self.keys).withColumn(BUCKET, place)
        folder = f"{self.root}/rows/{uuid.uuid4().hex}"
        new.write.options(**STORED).parquet(f"{folder}-batch")
        new = spark.read.schema(new.schema).parquet(f"{folder}-batch")
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # ``buckets`` rows at most
        if not touched:
            remove(spark, f"{folder}-batch")
            return Merge(0, self.buckets)
        stored = self._read(spark, [last["folders"][str(b)] for b in touched if str(b) in last["folders"]])
        shares = math.ceil(shuffle_partitions(spark) / len(touched))
        share = F.pmod(F.shiftright(F.xxhash64(*self.keys), 32), F.lit(shares)).cast("int")
        both = new.unionByName(stored.withColumn(BUCKET, place)).withColumn(_SHARE, share)
        spread = both.repartition(len(touched) * shares, BUCKET, _SHARE)
        self.latest(spread, [BUCKET, _SHARE, *self.keys]).drop(_SHARE).write.options(**STORED).partitionBy(BUCKET).parquet(folder)
        records.add(last["number"] + 1, {"folders": {**last["folders"], **{str(b): f"{folder}/{BUCKET}={b}" for b in touched}}})
        remove(spark, f"{folder}-batch")
        return Merge(len(touched), self.buckets)

    def read(self, spark: SparkSession) -> DataFrame:
        last = self._records(spark).latest()
        return self._read(spark, sorted(last["folders"].values()) if last else [])

    def drop_superseded(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete folders that neither the last record nor the ``keep`` before it name; returns their number."""
        records = self._records(spark)
        numbers = records.numbers()
        named: set[str] = set()
        for n in numbers[-1 - keep :]:
            named |= set(records.get(n)["folders"].values())
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        at = path(f"{self.root}/rows")
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone = 0
        for run in files.listStatus(at) if files.exists(at) else []:
            name = run.getPath().getName()
            inside = [s.getPath().getName() for s in files.listStatus(run.getPath()) if s.isDirectory()]
            unused = [b for b in inside if f"{self.root}/rows/{name}/{b}" not in named]
            if len(unused) == len(inside):
                files.delete(run.getPath(), True)
            else:
                for b in unused:
                    files.delete(path(f"{self.root}/rows/{name}/{b}"), True)
            gone += max(len(unused), not inside)
        return gone

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def _records(self, spark: SparkSession) -> Records:
        return Records(spark, f"{self.root}/records")
