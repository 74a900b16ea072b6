"""A stored dimension history, advanced by one snapshot at a time.

Current versions are one folder that each snapshot writes anew; versions that ended stay where
the snapshot that ended them put them.  A record names the folders that belong together, so a
reader sees the history before or after a snapshot, and a snapshot applied again after a crash
replaces its own earlier outcome.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmill.operators.history import advance, history_schema, interval_report, opened
from starmill.operators.quality import enforce, key_report
from starmill.operators.schema import require_schema
from starmill.session import STORED
from starmill.sinks.records import Records, remove, subfolders


@dataclass(frozen=True)
class HistoryTable:
    """The history of a dimension: its name, the columns of a snapshot and their key."""

    root: str
    name: str
    snapshot: T.StructType
    key: str

    def apply(self, snapshot: DataFrame, since: date) -> list:
        """Take in a snapshot that holds from ``since`` on; returns the report lines of its checks.

        Days must ascend; the same day again replaces what that day's snapshot did.
        """
        spark = snapshot.sparkSession
        rows = require_schema(snapshot, self.name, self.snapshot)
        lines = enforce(key_report(rows, self.name, [self.key]))
        records = Records(spark, f"{self.root}/records")
        last = records.latest()
        number = last["number"] + 1 if last else 0
        if last and last["since"] > since.isoformat():
            raise ValueError(f"{self.name} already holds a snapshot of {last['since']}")
        if last and last["since"] == since.isoformat():
            last = records.get(last["before"]) if last["before"] is not None else None

        mark = uuid.uuid4().hex
        folders = {"current": f"{self.root}/current/{since}-{mark}", "ended": f"{self.root}/ended/{since}-{mark}"}
        if last is None:
            opened(rows, self.key, since).write.options(**STORED).parquet(folders["current"])
            past = []
        else:
            ended, current = advance(self._read(spark, [last["current"]]), rows, self.key, since)
            ended.write.options(**STORED).parquet(folders["ended"])
            current.write.options(**STORED).parquet(folders["current"])
            past = [*last["ended"], folders["ended"]]
        lines += enforce(interval_report(self._read(spark, [folders["current"], *past]), self.name, self.key))
        records.add(
            number,
            {"since": since.isoformat(), "before": last["number"] if last else None, "current": folders["current"], "ended": past},
        )
        return lines

    def read(self, spark: SparkSession) -> DataFrame:
        """All versions; none before the first snapshot."""
        last = Records(spark, f"{self.root}/records").latest()
        if last is None:
            return spark.createDataFrame([], history_schema(self.snapshot))
        return self._read(spark, [last["current"], *last["ended"]])

    def current(self, spark: SparkSession) -> DataFrame:
        """The members that hold now, without reading what has ended."""
        last = Records(spark, f"{self.root}/records").latest()
        frame = self._read(spark, [last["current"]]) if last else self.read(spark)
        return frame.select(*[F.col(c) for c in self.snapshot.names])

    def drop_superseded(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete folders that neither the last record nor the ``keep`` before it name; returns their number.

        What the last day started from stays, so that its snapshot can be applied again.  Not to be
        called while a snapshot is applied.
        """
        records = Records(spark, f"{self.root}/records")
        kept = [records.get(n) for n in records.numbers()[-1 - keep :]]
        if kept and kept[-1]["before"] is not None:
            kept.append(records.get(kept[-1]["before"]))
        # A snapshot's two folders share their name; its ended rows count longer than its current ones.
        named = {"current": [r["current"] for r in kept], "ended": [f for r in kept for f in r["ended"]]}
        gone = 0
        for part, folders in named.items():
            names = {f.rsplit("/", 1)[-1] for f in folders}
            for name in subfolders(spark, f"{self.root}/{part}"):
                if name not in names:
                    remove(spark, f"{self.root}/{part}/{name}")
                    gone += 1
        return gone

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        return spark.read.schema(history_schema(self.snapshot)).parquet(*folders)
