"""Revenue arithmetic, reporting currency, keys and flags."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starmill import fixed_values as fixed
from starmill.functions import numbers
from starmill.functions.numbers import PRICE, exactly, held, with_revenue
from starmill.plans import gold
from starmill.sources.literals import rate_lookup

ITEM = "quantity long, unit_price double, discount_pct double, tax_amount double"
AMOUNTS = ("gross_amount", "discount_amount", "net_amount", "total_amount")


def _measures(spark, *items):
    return [tuple(float(v) if v is not None else None for v in r) for r in
            with_revenue(spark.createDataFrame(items, ITEM)).select(*AMOUNTS).collect()]


def test_measures(spark):
    assert _measures(spark, (3, 7.25, 12.0, 0.4)) == [(21.75, 2.61, 19.14, 19.54)]


def test_net_excludes_tax(spark):
    assert _measures(spark, (4, 0.5, 0.0, 0.19)) == [(2.0, 0.0, 2.0, 2.19)]


def test_null_inputs_pass_on(spark):
    assert _measures(spark, (None, 1.0, 1.0, 1.0), (1, 5.0, None, 1.0), (1, 5.0, 0.0, None)) == [
        (None, None, None, None), (5.0, None, None, None), (5.0, 0.0, 5.0, None),
    ]


def test_large_amounts_are_exact_or_reported(spark):
    big = (2_000_000_000, 99_999_999_999.0, 0.0, 0.0)
    assert _measures(spark, big)[0] == (1.99999999998e20, 0.0, 1.99999999998e20, 1.99999999998e20)
    names = ("quantity", "unit_price", "discount_pct", "tax_amount")
    rows = with_revenue(spark.createDataFrame([big, (2, 1e18, 0.0, 0.0), (None, 1e18, 0.0, 0.0)], ITEM))
    assert sorted(r[0] for r in rows.select(held(*names, "total_amount")).collect()) == [False, True, True]


def _exactly(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "place int, written string")
    return [r[0] for r in df.orderBy("place").select(exactly(F.col("written"), PRICE)).collect()]


def test_rounded_amounts_are_told_apart(spark):
    kept = ["0", "12.5", "-7.0000000001", "99999999999999999", "1e3", "0.10000000000000000000"]
    rounded = ["7.00000000001", "98765432109950.120625", "123456789012345.678", "1e18", "12345678.1234567890123"]
    neither = [None, "", "x", "NaN", "1e999"]
    assert _exactly(spark, kept) == [True] * 3 + [False] + [True] * 2  # a double has no 17 nines
    assert _exactly(spark, rounded) == [False] * 5
    assert _exactly(spark, neither) == [None] * 5


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**16, 10**16), st.integers(0, 16)), min_size=1, max_size=60))
def test_rounding_equals_exact_decimal_arithmetic(spark, numbers):
    texts = [str(Decimal(digits).scaleb(-places)) for digits, places in numbers]
    used = [Decimal(repr(float(t))).quantize(Decimal("1e-10"), ROUND_HALF_UP) for t in texts]
    assert _exactly(spark, texts) == [u == Decimal(t) for u, t in zip(used, texts, strict=True)]


def test_half_cents_round_up_exactly(spark):
    # As doubles, 1.005 * 1 rounds down and 0.145 * 100 is inexact.
    assert _measures(spark, (1, 1.005, 0.0, 0.0))[0][0] == 1.01
    assert _measures(spark, (1, 0.29, 50.0, 0.0))[0][1] == 0.15


_cents = st.integers(0, 10**9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 500), _cents, st.integers(0, 10_000), _cents), min_size=1, max_size=60))
def test_measures_equal_exact_decimal_arithmetic(spark, items):
    cent = Decimal("0.01")

    def half_up(value):
        return value.quantize(cent, ROUND_HALF_UP)

    expected = []
    for quantity, price, percent, tax in items:
        gross = half_up(quantity * Decimal(price) / 100)
        discount = half_up(gross * Decimal(percent) / 10_000)
        net = gross - discount
        expected.append((gross, discount, net, net + Decimal(tax) / 100))
    given_rows = [(q, p / 100, d / 100, t / 100) for q, p, d, t in items]
    got = with_revenue(spark.createDataFrame(given_rows, ITEM).coalesce(1)).select(*AMOUNTS).collect()
    assert [tuple(r) for r in got] == expected


def test_coupon_flag(spark, rows):
    df = spark.createDataFrame([("g", " "), ("h", "x"), ("i", None), ("j", "")], "order_id string, coupon_code string")
    assert rows(gold.with_coupon_flag(df), "order_id", "coupon_flag") == [("g", 1), ("h", 1), ("i", 0), ("j", 0)]


def test_date_key(spark, rows):
    df = spark.sql("SELECT explode(array(DATE'2025-08-01', DATE'1999-12-31', CAST(NULL AS DATE))) AS dt")
    keyed = gold.with_date_key(df)
    assert dict(keyed.dtypes)["date_id"] == "int"
    assert rows(keyed, "date_id") == [(None,), (19991231,), (20250801,)]


def test_reporting_currency(spark, rows):
    df = spark.createDataFrame(
        [("A", " usd ", 10.0), ("B", "INR", 10.0), ("C", "XXX", 10.0), ("D", None, 10.0), ("E", "gbp", None)],
        "order_id string, unit_price_currency string, total_amount double",
    ).selectExpr("order_id", "unit_price_currency", "CAST(total_amount AS DECIMAL(18,2)) AS total_amount")
    converted = gold.with_reporting_amount(df, rate_lookup(spark, fixed.INR_PER_UNIT))
    assert rows(converted, "order_id", "total_amount_inr") == [
        ("A", Decimal("882.90")), ("B", Decimal("10.00")), ("C", None), ("D", None), ("E", None),
    ]
    assert "currency" not in converted.columns


def test_short_numbers_are_exact_as_the_decimals_say(spark):
    texts = ["0", "-0.00", "12345", "99999.99999999", "-12345.12345678", "1.5", "00012.50", "123456.5", "1.123456789", "1e3", " 1.5 ", "1.", ".5", "12a", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in (numbers.PRICE, numbers.PERCENT):
        number = numbers.to_amount(F.col("t"))
        plain = number.try_cast(kind).try_cast(numbers.WRITTEN).eqNullSafe(F.col("t").try_cast(numbers.WRITTEN))
        got = rows.select("t", numbers.exactly(F.col("t"), kind), F.when(number.isNotNull(), plain)).collect()
        assert [r[1] for r in got] == [r[2] for r in got]
    short = [r["t"] for r in rows.where(F.col("t").rlike(numbers.SHORT)).collect()]
    assert short == texts[:7]
