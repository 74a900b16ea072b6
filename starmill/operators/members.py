"""Unknown dimension members and the fact rows that point at them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget, broadcast_lookup, spread_lookup
from starmill.session import written

_FLAG = "__flag"


def with_unknown_member(dimension: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Append one row holding ``values``; every other column of it is NULL.

    The row is shaped by the dimension's own schema, so it fits any dimension; call
    this after the final projection.
    """
    cells = [
        F.lit(values.get(field.name)).cast(field.dataType).alias(field.name)
        for field in dimension.schema.fields
    ]
    spark = dimension.sparkSession
    return dimension.unionByName(spark.range(0, 1, 1, 1).select(*cells))


def remap_orphans(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    orphan_key: str,
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """Point fact rows whose key is NULL or not in the dimension at the unknown member.

    No row is lost or repeated.  The fact stays in place whenever either the dimension's
    keys or the orphaned keys are few enough to broadcast: for a large dimension the
    fact's distinct keys are compared with it first, and only that one column is
    shuffled.  When both are large the fact is joined by shuffle, spread against skew.
    """
    on = {key: F.col(key)}
    listed = dimension.select(key).where(F.col(key).isNotNull())
    members = listed.distinct().withColumn(_FLAG, F.lit(True))
    if budget.admits(listed):
        return _resolved(broadcast_lookup(fact, members, on), key, F.col(_FLAG).isNull(), orphan_key)

    used = fact.select(key).where(F.col(key).isNotNull()).distinct()
    strays = written(fact.sparkSession, used.join(members, key, "left_anti"), "strays")
    if budget.admits(strays):
        flagged = broadcast_lookup(fact, strays.withColumn(_FLAG, F.lit(True)), on)
        return _resolved(flagged, key, F.col(_FLAG) | F.col(key).isNull(), orphan_key)

    return _resolved(spread_lookup(fact, members, on), key, F.col(_FLAG).isNull(), orphan_key)


def _resolved(flagged: DataFrame, key: str, orphaned: Column, orphan_key: str) -> DataFrame:
    return flagged.withColumn(key, F.when(orphaned, F.lit(orphan_key)).otherwise(F.col(key))).drop(_FLAG)
