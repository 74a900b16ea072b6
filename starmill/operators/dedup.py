"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[Column],
    undecided_by: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row of each key under ``prefer``; NULL keys form one group.

    Ties are settled by all remaining columns ascending (NULLs last), so the survivor
    does not depend on partitioning.  Columns in ``undecided_by`` (run stamps, equal
    throughout a run) take no part in that.

    The rank filter lets Spark cut every task's rows to one per key before the
    exchange (``WindowGroupLimit``): a key holding a third of the table reaches its
    reducer as one row per map task.
    """
    settled = {*keys, *undecided_by}
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in settled]
    order = Window.partitionBy(*keys).orderBy(*prefer, *ties)
    return df.withColumn(_RANK, F.row_number().over(order)).where(F.col(_RANK) == 1).drop(_RANK)
