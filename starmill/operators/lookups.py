"""Left lookup joins that hold at any size of the lookup and any skew of the fact.

A lookup whose measured size fits a budget is broadcast and the fact does not move.
A larger one is joined by shuffle; fact rows of very frequent keys, and rows whose
key is NULL, are then spread over many partitions while the few lookup rows of the
frequent keys are repeated for each of them.  Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_SALT, _HASH, _FAN = "__salt", "__hash", "__fan"


@dataclass(frozen=True)
class BroadcastBudget:
    """The largest lookup sent to every executor."""

    rows: int = 1_000_000
    bytes: int = 64 << 20

    def admits(self, lookup: DataFrame) -> bool:
        """Measure rows and bytes in one distributed aggregate; one row comes back.

        A lookup stated in code is measured without a job: its rows are part of the plan.
        """
        plan = lookup._jdf.queryExecution().optimizedPlan()
        if plan.nodeName() == "LocalRelation":
            return plan.data().size() <= self.rows and int(plan.stats().sizeInBytes()) <= self.bytes
        width = sum(
            (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in lookup.columns),
            F.lit(0),
        )
        seen = lookup.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")).first()
        return seen["rows"] <= self.rows and (seen["bytes"] or 0) <= self.bytes


DEFAULT_BUDGET = BroadcastBudget()


def frequent_keys(
    df: DataFrame, key: list[Column], tracked: int = 16384, listed: int = 2048, merges: int = 256
) -> list[tuple[int, float]]:
    """``(hash of the key, share of the rows)`` of the keys that hold the most rows.

    One pass with a frequent-items sketch of bounded size per task.  The sketches are
    merged in two steps, first in ``merges`` groups of tasks and then those, so that no
    task takes in all of them; at most ``listed`` pairs reach the driver, among them
    each key holding more than 1/``listed`` of the rows.  The list only steers where
    rows go; a key missing from it, or a hash collision, cannot change a join's result.
    """
    sketch = F.expr(f"approx_top_k_accumulate({_HASH}, {tracked})")
    per_group = (
        df.where(_all_present(key))
        .select(F.xxhash64(*key).alias(_HASH))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(merges)).alias("task_group"))
        .agg(sketch.alias("sketch"), F.count(F.lit(1)).alias("rows"))
    )
    seen = (
        per_group.groupBy(F.lit(True).alias("all_groups"))  # grouped: no rows give no line
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
        .select(F.expr(f"approx_top_k_estimate(sketch, {listed})").alias("top"), "rows")
        .first()
    )
    return [(item["item"], item["count"] / seen["rows"]) for item in seen["top"]] if seen else []


def _all_present(key: list[Column]) -> Column:
    whole = F.lit(True)
    for part in key:
        whole = whole & part.isNotNull()
    return whole


def left_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column],
    budget: BroadcastBudget = DEFAULT_BUDGET,
    also: Column | None = None,
) -> DataFrame:
    """LEFT JOIN ``fact`` to ``lookup`` and append the lookup's other columns.

    ``on`` maps each key column of the lookup to the fact expression it must equal.
    The lookup's key columns are not kept.  A NULL key matches nothing.  ``also`` is a further
    condition over columns of both sides.
    """
    join = broadcast_lookup if budget.admits(lookup) else spread_lookup
    return join(fact, lookup, on, also)


def broadcast_lookup(
    fact: DataFrame, lookup: DataFrame, on: Mapping[str, Column], also: Column | None = None
) -> DataFrame:
    """``left_lookup`` for a lookup already measured as small: the fact stays in place."""
    return _joined(fact, F.broadcast(_keyed(lookup, on)), on, also)


def spread_lookup(
    fact: DataFrame, lookup: DataFrame, on: Mapping[str, Column], also: Column | None = None
) -> DataFrame:
    """``left_lookup`` by shuffle, in which no key is bound to a single partition.

    A frequent key gets a number of places in proportion to its share of the rows: its
    fact rows are divided among them and its lookup rows repeated in each.  The copies
    add up to about twice the number of partitions, whatever the data.
    """
    keyed = _keyed(lookup, on)
    spark = fact.sparkSession
    partitions = shuffle_partitions(spark)
    # Keys are hashed as the type that the join compares them in.
    common = fact.select(*[part.alias(f"__on_{c}") for c, part in on.items()]).unionByName(
        keyed.select(*[f"__on_{c}" for c in on])
    )
    types = dict(common.dtypes)
    fact_key = [part.try_cast(types[f"__on_{c}"]) for c, part in on.items()]
    listed = min(max(2048, 2 * partitions), 100_000)
    fans = [
        (key_hash, math.ceil(2 * share * partitions))
        for key_hash, share in frequent_keys(fact, fact_key, tracked=8 * listed, listed=listed)
        if share * partitions > 0.5
    ]
    heavy = F.broadcast(spark.createDataFrame(fans, f"{_HASH} long, {_FAN} int"))

    # The partition number separates exact copies of a row.  It is fixed per task, so a
    # retried task repeats its placement.
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{f.name}`") for f in fact.schema.fields if _hashable(f.dataType)])
    whole = _all_present(fact_key)
    places = F.when(whole, F.coalesce(F.col(_FAN), F.lit(1))).otherwise(F.lit(2 * partitions))
    salted_fact = (
        fact.join(heavy, F.when(whole, F.xxhash64(*fact_key)) == F.col(_HASH), "left")
        .withColumn(_SALT, F.pmod(row_hash, places).cast("int"))
        .drop(_HASH, _FAN)
    )
    lookup_key = [F.col(f"__on_{c}").try_cast(types[f"__on_{c}"]) for c in on]
    last_place = F.coalesce(F.col(_FAN), F.lit(1)) - 1
    salted_lookup = (
        keyed.join(heavy, F.xxhash64(*lookup_key) == F.col(_HASH), "left")
        .withColumn(f"__on_{_SALT}", F.explode(F.sequence(F.lit(0), last_place)))
        .drop(_HASH, _FAN)
    )
    return _joined(salted_fact, salted_lookup, {**on, _SALT: F.col(_SALT)}, also).drop(_SALT)


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions a shuffle starts with."""
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.shuffle.partitions")
    numbers = [int(v) for v in (spark.conf.get(n, None) for n in names) if (v or "").isdigit()]
    return max(numbers, default=200)  # some platforms allow "auto"


def _hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def _keyed(lookup: DataFrame, on: Mapping[str, Column]) -> DataFrame:
    """The lookup with its key columns renamed, so that they cannot clash with the fact's."""
    return lookup.select(
        *[F.col(c).alias(f"__on_{c}") for c in on],
        *[F.col(c) for c in lookup.columns if c not in on],
    )


def _joined(fact: DataFrame, keyed: DataFrame, on: Mapping[str, Column], also: Column | None = None) -> DataFrame:
    condition = F.lit(True) if also is None else also
    for name, part in on.items():
        condition = condition & (part == F.col(f"__on_{name}"))
    return fact.join(keyed, condition, "left").drop(*[f"__on_{name}" for name in on])
