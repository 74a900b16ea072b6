"""Lookups kept as files that people edit: read whole, checked, and refused when they are wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starmill.operators.quality import combined, enforce, held_report, key_report
from starmill.plans.contracts import columns
from starmill.session import written
from starmill.sources.files import REJECTED, scan_csv

REGIONS = columns(country="string", state="string", region="string")
RATES = columns(currency="string", inr_rate="decimal(12,6)")
RATE_HISTORY = columns(currency="string", valid_from="date", inr_rate="decimal(12,6)")


def read_seed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], name: str) -> DataFrame:
    """A lookup from CSV files: every line fits, every key occurs once and whole, no cell is empty.

    Raises ``QualityError`` otherwise.  The rows are stored once, so what was checked is what is used.
    """
    rows = written(spark, scan_csv(spark, path, schema, rejects=True), f"seed-{name}")
    filled: Column = F.lit(True)
    for field in schema.fields:
        filled = filled & F.col(field.name).isNotNull() & (F.trim(F.col(field.name).cast("string")) != "")
    enforce(
        combined(
            held_report(rows, name, F.col(REJECTED).isNull(), "lines"),
            held_report(rows, name, filled | F.col(REJECTED).isNotNull(), "cells"),
            key_report(rows.where(F.col(REJECTED).isNull()), name, keys),
        )
    )
    return rows.drop(REJECTED)


def region_seed(spark: SparkSession, path: str) -> DataFrame:
    """``country, state, region``, as ``full_refresh(regions=...)`` takes it."""
    return read_seed(spark, path, REGIONS, ["country", "state"], "regions")


def rate_seed(spark: SparkSession, path: str, dated: bool = False) -> DataFrame:
    """``currency, inr_rate``, or a history of rates with ``valid_from``, as ``full_refresh(rates=...)`` takes it."""
    if dated:
        return read_seed(spark, path, RATE_HISTORY, ["currency", "valid_from"], "rates")
    return read_seed(spark, path, RATES, ["currency"], "rates")
