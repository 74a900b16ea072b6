"""Lookup relations stated in code.

They are built from SQL VALUES: Spark sees a local relation of known, constant size
rather than an opaque list scan, and can fold and broadcast it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def region_lookup(spark: SparkSession, regions: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``country, state, region``: one row per entry of the nested mapping."""
    rows = ", ".join(
        f"({_quoted(country)}, {_quoted(state)}, {_quoted(region)})"
        for country, states in regions.items()
        for state, region in states.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lookup(country, state, region)")


def rate_lookup(spark: SparkSession, rates: Mapping[str, str | float]) -> DataFrame:
    """``currency, inr_rate`` with exact decimal rates."""
    rows = ", ".join(f"({_quoted(code)}, CAST('{rate}' AS DECIMAL(12,6)))" for code, rate in rates.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lookup(currency, inr_rate)")
