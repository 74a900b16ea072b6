"""Incremental landing: each new file is read once, and each of its rows counts once.

A streaming file source with a checkpoint finds the new files.  Every micro-batch is written to
a folder of its own attempt, and a record then names the attempt that counts.  A run that dies
before the record leaves rows that nobody reads; one that dies between the record and the
checkpoint repeats the batch, finds the record and does nothing.  One run of a landing at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmill.session import STORED
from starmill.sinks.records import Records, remove, subfolders
from starmill.sources.files import ARRIVED_AT, INGESTED_AT, SOURCE_FILE, stream_csv, with_arrival

_BATCH, _ATTEMPT = "__batch", "__attempt"


@dataclass(frozen=True)
class Landing:
    """Rows, records and checkpoint of one landed relation, below a shared folder."""

    root: str
    schema: T.StructType

    @property
    def stored(self) -> T.StructType:
        lineage = {SOURCE_FILE: "string", INGESTED_AT: "timestamp", ARRIVED_AT: "timestamp"}
        whole = T.StructType(list(self.schema.fields))
        for name, kind in {**lineage, _BATCH: "long", _ATTEMPT: "string"}.items():
            whole = whole.add(name, kind)
        return whole

    def records(self, spark: SparkSession) -> Records:
        return Records(spark, f"{self.root}/records")

    def publish(self, batch: DataFrame, batch_id: int) -> None:
        """Make the rows of a micro-batch count, unless an earlier attempt has done so."""
        records = self.records(batch.sparkSession)
        if records.holds(batch_id):
            return
        attempt = uuid.uuid4().hex
        batch.write.options(**STORED).parquet(f"{self.root}/rows/{_BATCH}={batch_id}/{_ATTEMPT}={attempt}")
        try:
            records.add(batch_id, {_ATTEMPT: attempt})
        except FileExistsError:
            pass  # another attempt was first; this one's rows are never read

    def read(self, spark: SparkSession) -> DataFrame:
        """Every landed row, with its file, the time it was read and the time its file arrived.

        The records prune the folders of attempts that do not count.
        """
        counted = self.records(spark).frame(f"number long, {_ATTEMPT} string").withColumnRenamed("number", _BATCH)
        if not self.records(spark).numbers():
            return spark.createDataFrame([], self.stored).drop(_BATCH, _ATTEMPT)
        rows = spark.read.schema(self.stored).parquet(f"{self.root}/rows")
        return rows.join(counted, [_BATCH, _ATTEMPT], "left_semi").drop(_BATCH, _ATTEMPT)

    def drop_superseded(self, spark: SparkSession) -> int:
        """Delete the rows of attempts that will never count; returns the number of attempts.

        A batch without a record keeps its attempts: its run may be about to record one.
        """
        records, rows, gone = self.records(spark), f"{self.root}/rows", 0
        for batch in subfolders(spark, rows):
            number, attempts = int(batch.removeprefix(f"{_BATCH}=")), subfolders(spark, f"{rows}/{batch}")
            if len(attempts) > 1 and records.holds(number):
                counts = f"{_ATTEMPT}={records.get(number)[_ATTEMPT]}"
                for attempt in [a for a in attempts if a != counts]:
                    remove(spark, f"{rows}/{batch}/{attempt}")
                    gone += 1
        return gone


def land_new_files(
    spark: SparkSession,
    path: str,
    landing: Landing,
    publish: Callable[[DataFrame, int], None] | None = None,
    files_at_once: int | None = None,
) -> None:
    """Land the files under ``path`` that no earlier run has landed, then return.

    ``publish`` receives each micro-batch and its number; by default the landing's own.
    """
    stream = with_arrival(stream_csv(spark, path, landing.schema, files_at_once=files_at_once))
    started = (
        stream.writeStream.foreachBatch(publish or landing.publish)
        .option("checkpointLocation", f"{landing.root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
