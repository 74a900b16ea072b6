"""Checks count injected defects exactly, whether references are probed or counted."""

from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from starmill.operators.lookups import BroadcastBudget
from starmill.operators.quality import (
    QualityError,
    Reference,
    combined,
    enforce,
    exact_report,
    key_report,
    parse_report,
    reconciliation,
    reconciliation_report,
    reference_report,
)
from starmill.operators.schema import SchemaDrift, require_schema, schema_differences, schema_report
from starmill.plans import silver
from starmill.plans.contracts import DIM_CUSTOMERS


def _lines(report):
    return {r["check_name"]: (r["row_count"], r["violations"]) for r in report.collect()}


def test_key_report_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert _lines(key_report(df, "t", ["k"])) == {"unique(k)": (6, 3), "not_null(k)": (6, 2)}


def test_composite_key_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", None), (None, None)], "k string, n int")
    assert _lines(key_report(df, "t", ["k", "n"])) == {"unique(k,n)": (5, 1), "not_null(k,n)": (5, 2)}


def test_empty_tables_pass(spark):
    df = spark.createDataFrame([], "k string")
    assert _lines(key_report(df, "t", ["k"])) == {"unique(k)": (0, 0), "not_null(k)": (0, 0)}
    for budget in (BroadcastBudget(), BroadcastBudget(rows=-1)):
        assert _lines(reference_report(df, "t", [Reference("k", df, "k")], budget)) == {"references(k)": (0, 0)}


@pytest.mark.parametrize("row_limit", [100, 3, 0])
def test_orphans_of_all_references(spark, row_limit):
    """All probed, one probed and one counted, all counted: the same numbers."""
    fact = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise("gone").alias("c"),
        (F.col("id") % 6).cast("int").alias("d"),
    )
    names = spark.createDataFrame([("hot",), ("hot",), ("idle",)], "name string")
    days = spark.createDataFrame([(n,) for n in range(5)], "day int")
    report = reference_report(
        fact, "fact", [Reference("c", names, "name"), Reference("d", days, "day")], BroadcastBudget(rows=row_limit)
    )
    assert _lines(report) == {"references(c)": (900, 600), "references(d)": (900, 150)}


def test_unparsed_values_are_counted_and_blanks_are_not(spark):
    df = spark.createDataFrame([("Two",), ("Four",), ("  ",), (None,), ("x",)], "quantity string")
    parsers = {"quantity": silver.item_parsers()["quantity"]}
    assert _lines(parse_report(df, "t", parsers)) == {"parses(quantity)": (5, 2)}


def test_rounded_values_are_counted(spark):
    rows = [("$1.5", "2.123456789%", "Tax 3"), ("98765432109950.120625", "2.12345678", "-4.25"), (None, "x", "n.a.")]
    df = spark.createDataFrame(rows, "unit_price string, discount_pct string, tax_amount string")
    expected = {"unit_price": (3, 1), "discount_pct": (3, 1), "tax_amount": (3, 0)}
    found = _lines(exact_report(df, "t", silver.item_exactness()))
    assert found == {f"parses_exactly({name})": counts for name, counts in expected.items()}
    assert {v for _, v in _lines(exact_report(df.limit(0), "t", silver.item_exactness())).values()} == {0}


def test_reconciliation(spark):
    before = spark.createDataFrame([(1.10,), (2.20,), (None,)], "amount double")
    assert reconciliation(before, before, "amount").collect() == [(3, Decimal("3.30"), 1, 3, Decimal("3.30"), 1)]
    lost = before.where("amount IS NULL OR amount < 2")
    assert _lines(reconciliation_report(before, lost, "t", "amount")) == {
        "keeps(rows)": (2, 1), "keeps(amount)": (2, 1),
    }


def test_no_loss_is_too_small_or_too_large_to_see(spark):
    """A thousandth per row, one unit at 10**17, and an amount that became NULL."""
    for was, now in ((1.004, 1.0), (1e17, 5e17), (4e17, None)):
        one = spark.createDataFrame([(was,)], "amount double")
        other = spark.createDataFrame([(now,)], "amount double")
        lines = _lines(reconciliation_report(one, other, "t", "amount"))
        assert lines["keeps(amount)"][1] >= 1 and lines["keeps(rows)"] == (1, 0)
    exact = spark.sql("SELECT CAST('12345678901234567890.12' AS DECIMAL(24,2)) AS amount")
    less = exact.selectExpr("CAST(amount - 0.01 AS DECIMAL(24,2)) AS amount")
    assert _lines(reconciliation_report(exact, less, "t", "amount"))["keeps(amount)"] == (1, 1)


def test_enforce_names_every_failure(spark):
    good = spark.createDataFrame([("a",)], "k string")
    bad = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert len(enforce(key_report(good, "good", ["k"]))) == 2
    with pytest.raises(QualityError, match=r"bad: unique\(k\) has 1 violations; bad: not_null\(k\) has 1"):
        enforce(combined(key_report(good, "good", ["k"]), key_report(bad, "bad", ["k"])))


def test_schema_drift(spark):
    agreed = spark.createDataFrame([], "a int, b string").schema
    drifted = spark.createDataFrame([(1, 2.0), (2, 3.0)], "a long, c double")
    assert schema_differences(drifted.schema, agreed) == [
        ("a", "int", "bigint"), ("b", "string", "absent"), ("c", "absent", "double"),
    ]
    assert _lines(schema_report(drifted, "t", agreed))["schema(a: int, got bigint)"] == (2, 2)
    with pytest.raises(SchemaDrift, match="b: agreed string, got absent"):
        require_schema(drifted, "t", agreed)


def test_schema_order_is_restored_and_nullability_ignored(spark):
    df = spark.sql("SELECT " + ", ".join(f"'x' AS {c}" for c in reversed(DIM_CUSTOMERS.columns)))
    assert require_schema(df, "t", DIM_CUSTOMERS.schema).columns == DIM_CUSTOMERS.columns
