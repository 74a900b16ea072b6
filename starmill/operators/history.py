"""Dimension history: what held for a member, and from when until when.

Each version of a member has the day it began and the day it ended (exclusive, NULL while it
holds).  Intervals of a member never overlap.  A member that is missing from a snapshot ends; one
that comes back begins anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget, left_lookup
from starmill.operators.quality import report_line, report_rows

BEGAN, ENDED, IS_CURRENT, MARK = "effective_from", "effective_to", "is_current", "row_mark"


def row_mark(names: Sequence[str]) -> Column:
    """A digest of the columns, in which NULL differs from every text."""
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)


def opened(snapshot: DataFrame, key: str, since: date) -> DataFrame:
    """A snapshot's members as versions that begin on ``since``."""
    tracked = [c for c in snapshot.columns if c != key]
    return snapshot.select(
        *snapshot.columns,
        F.lit(since).cast("date").alias(BEGAN),
        F.lit(None).cast("date").alias(ENDED),
        F.lit(True).alias(IS_CURRENT),
        row_mark(tracked).alias(MARK),
    )


def advance(current: DataFrame, snapshot: DataFrame, key: str, since: date) -> tuple[DataFrame, DataFrame]:
    """``(ended, current)`` after a snapshot taken on ``since``.

    Both inputs hold each key once and no NULL key.  One join by key decides everything: equal
    marks keep the stored version with its beginning, other marks end it and begin another.
    Versions that ended earlier take no part and need not be read.
    """
    columns = current.columns
    new = opened(snapshot, key, since).select(*columns)
    old, fresh = F.struct(*[F.col(f"o.{c}").alias(c) for c in columns]), F.struct(*[F.col(f"n.{c}").alias(c) for c in columns])
    both = current.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    both = both.select(
        F.when(F.col(f"o.{key}").isNotNull(), old).alias("old"), F.when(F.col(f"n.{key}").isNotNull(), fresh).alias("new")
    )
    same = F.coalesce(F.col(f"old.{MARK}") == F.col(f"new.{MARK}"), F.lit(False))
    ended = (
        both.where(F.col("old").isNotNull() & ~same)
        .select("old.*")
        .withColumns({ENDED: F.lit(since).cast("date"), IS_CURRENT: F.lit(False)})
        # A version that began on this very day never held.
        .where(F.col(BEGAN) < F.col(ENDED))
    )
    held = both.where(F.col("new").isNotNull()).select(F.when(same, F.col("old")).otherwise(F.col("new")).alias("v")).select("v.*")
    return ended, held


def version_at(
    fact: DataFrame,
    history: DataFrame,
    on: Mapping[str, Column],
    at: Column,
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """LEFT JOIN each fact row to the version of its member that held at ``at``.

    The interval is a further condition of the equality join, so no fact row is repeated.
    """
    day = at.cast("date")
    held = (F.col(BEGAN) <= day) & (F.col(ENDED).isNull() | (day < F.col(ENDED)))
    return left_lookup(fact, history.drop(IS_CURRENT, MARK), on, budget, held).drop(BEGAN, ENDED)


def interval_report(history: DataFrame, subject: str, key: str) -> DataFrame:
    """Versions that are empty, that run into the next one of their member, or whose flag is wrong."""
    order = Window.partitionBy(key).orderBy(BEGAN)
    ends, late = F.col(ENDED), F.lead(BEGAN).over(order)
    seen = history.select(
        (ends <= F.col(BEGAN)).alias("empty"),
        (late.isNotNull() & (ends.isNull() | (late < ends))).alias("overlap"),
        (F.col(IS_CURRENT) != ends.isNull()).alias("flag"),
    )
    totals = seen.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(c) for c in ("empty", "overlap", "flag")])
    return report_rows(totals, *[report_line(subject, f"intervals({c})", F.col("rows"), F.col(c)) for c in ("empty", "overlap", "flag")])


def history_schema(snapshot: T.StructType) -> T.StructType:
    return T.StructType(
        [*snapshot.fields, *[T.StructField(n, k) for n, k in ((BEGAN, T.DateType()), (ENDED, T.DateType()), (IS_CURRENT, T.BooleanType()), (MARK, T.StringType()))]]
    )
