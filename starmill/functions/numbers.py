"""Number parsing that yields NULL on bad text, and exact money arithmetic.

Parsed values stay doubles, as they are stored.  Amounts are computed as decimals, wide enough
that no product loses a digit: ten digits of quantity times ``PRICE``, and ``AMOUNT`` times
``PERCENT``, both fit 38.  Every step is rounded half-up to cents.  What does not fit becomes
NULL; ``held`` tells such a row apart, and the refresh reports it as a violation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PRICE = "decimal(27,10)"
PERCENT = "decimal(13,8)"
AMOUNT = "decimal(24,2)"
WRITTEN = "decimal(38,18)"  # digits of a text that ``exactly`` compares
# Numbers that a double and every kind above hold as they are written: 13 digits, of which 8 are places.
SHORT = r"^-?[0-9]{1,5}(\.[0-9]{1,8})?$"


def to_whole(text: Column) -> Column:
    return text.try_cast("int")


def to_real(text: Column) -> Column:
    return text.try_cast("float")


def to_amount(text: Column) -> Column:
    """A finite double; text such as ``NaN`` is no amount.

    A product, both sides of which are always evaluated, shares the parsed number; a branch
    would clean and parse the text once more.
    """
    number = text.try_cast("double")
    return number * F.when(F.abs(number) < F.lit(float("inf")), F.lit(1.0))


def exactly(text: Column, kind: str) -> Column:
    """Whether the decimal that amounts are computed with is the number that the text has.

    A double has about 16 digits and the decimal ``kind`` a fixed number of places; longer numbers
    are rounded.  NULL for text without a number; digits past the 18th place do not count.
    """
    number = to_amount(text)
    compared = number.try_cast(kind).try_cast(WRITTEN).eqNullSafe(text.try_cast(WRITTEN))
    return F.when(text.rlike(SHORT), F.lit(True)).when(number.isNotNull(), compared)


def size_or_zero(number: Column) -> Column:
    """Absolute value, NULL as 0."""
    return F.coalesce(F.abs(number), F.lit(0))


def in_cents(amount: Column) -> Column:
    return F.round(amount, 2).try_cast(AMOUNT)


def percent_of(amount: Column, percent: Column) -> Column:
    """``percent`` per cent of a cent amount.

    The product is rounded at whole hundredths *before* the division by 100, which
    keeps it exact: dividing first would round twice.
    """
    return (F.round(amount * percent, 0) * F.lit("0.01").cast("decimal(2,2)")).try_cast(AMOUNT)


def with_revenue(df: DataFrame) -> DataFrame:
    """Gross, discount, net (before tax) and total (with tax) amounts.

    Reads ``quantity, unit_price, discount_pct, tax_amount``.  A NULL input makes
    every amount that depends on it NULL.
    """
    price, tax = F.col("unit_price").try_cast(PRICE), F.col("tax_amount").try_cast(PRICE)
    percent = F.col("discount_pct").try_cast(PERCENT)
    # Separate projections: each amount is computed once and then reused.
    return (
        df.withColumn("gross_amount", in_cents(F.col("quantity").try_cast("int") * price))
        .withColumn("discount_amount", percent_of(F.col("gross_amount"), percent))
        .withColumn("net_amount", in_cents(F.col("gross_amount") - F.col("discount_amount")))
        .withColumn("total_amount", in_cents(F.col("net_amount") + tax))
    )


def held(quantity: str, price: str, percent: str, tax: str, total: str) -> Column:
    """FALSE where every input is there and the total is not: the amounts did not fit."""
    inputs = [F.col(c).isNotNull() for c in (quantity, price, percent, tax)]
    return F.col(total).isNotNull() | ~(inputs[0] & inputs[1] & inputs[2] & inputs[3])
