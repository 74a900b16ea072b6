"""Silver: each raw table cleansed on its own.  No joins, no business rules.

Every step is one projection; only the keep-latest steps move rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starmill import fixed_values as fixed
from starmill.functions import dates, numbers, text
from starmill.operators.dedup import latest_per_key
from starmill.sources.files import ARRIVED_AT, INGESTED_AT, SOURCE_FILE

PROCESSED_AT = "_processed_at"


# Brands ---------------------------------------------------------------------


def clean_brands(df: DataFrame) -> DataFrame:
    """Unpadded names; codes of letters and digits only."""
    code = text.without_pattern(F.col("brand_code"), fixed.NOT_ALPHANUMERIC)
    return df.withColumns({"brand_code": code, "brand_name": F.trim("brand_name")})


def recode_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("category_code", text.recode(F.col("category_code"), fixed.CATEGORY_CODE_FIXES))


def brands(bronze: DataFrame) -> DataFrame:
    return bronze.transform(clean_brands).transform(recode_categories)


# Category -------------------------------------------------------------------


def category(bronze: DataFrame) -> DataFrame:
    """One row per upper-cased code; of several names the first in order stays."""
    upper = bronze.withColumn("category_code", F.upper("category_code"))
    return latest_per_key(
        upper, ["category_code"], [F.col("category_name").asc_nulls_last()], undecided_by=[INGESTED_AT]
    )


# Products -------------------------------------------------------------------


def parse_sizes(df: DataFrame) -> DataFrame:
    """``450g`` to 450 and ``12,5`` to 12.5; text that is no number becomes NULL."""
    weight = text.without_characters(F.col("weight_grams"), fixed.WEIGHT_UNIT)
    length = F.translate("length_cm", fixed.DECIMAL_COMMA, fixed.DECIMAL_POINT)
    return df.withColumns({"weight_grams": numbers.to_whole(weight), "length_cm": numbers.to_real(length)})


def upper_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({code: F.upper(code) for code in ("brand_code", "category_code")})


def correct_materials(df: DataFrame) -> DataFrame:
    return df.withColumn("material", text.recode(F.col("material"), fixed.MATERIAL_FIXES))


def clean_ratings(df: DataFrame) -> DataFrame:
    return df.withColumn("rating_count", numbers.size_or_zero(F.col("rating_count")))


def products(bronze: DataFrame) -> DataFrame:
    return (
        bronze.transform(parse_sizes).transform(upper_codes).transform(correct_materials).transform(clean_ratings)
    )


# Customers ------------------------------------------------------------------


def known_customers(df: DataFrame) -> DataFrame:
    """Only rows that can be referred to."""
    return df.where(F.col("customer_id").isNotNull())


def filled_phones(df: DataFrame, missing: str = fixed.UNKNOWN_VALUE) -> DataFrame:
    return df.fillna(missing, subset=["phone"])


def customers(bronze: DataFrame) -> DataFrame:
    return bronze.transform(known_customers).transform(filled_phones)


# Calendar -------------------------------------------------------------------


def parse_days(df: DataFrame) -> DataFrame:
    return df.withColumn("date", dates.to_day(F.col("date"), fixed.CALENDAR_DATE_LAYOUT))


def one_row_per_day(df: DataFrame) -> DataFrame:
    """Of contradictory rows the one that agrees best with its own date stays."""
    fit = dates.agreement(F.col("date"), F.col("day_name"), F.col("quarter"), F.col("week_of_year"))
    prefer = [fit.desc(), *[F.col(c).asc_nulls_last() for c in ("day_name", "quarter", "week_of_year")]]
    return latest_per_key(df, ["date"], prefer, undecided_by=[INGESTED_AT])


def capitalized_days(df: DataFrame) -> DataFrame:
    return df.withColumn("day_name", F.initcap("day_name"))


def with_period_labels(df: DataFrame) -> DataFrame:
    """Positive weeks, plus display labels next to the sortable numbers."""
    week = F.abs("week_of_year")
    return df.withColumns(
        {
            "week_of_year": week,
            "quarter_label": dates.period_label("Q", F.col("quarter"), F.col("year")),
            "week_label": dates.period_label("Week", week, F.col("year")),
        }
    )


def calendar(bronze: DataFrame) -> DataFrame:
    return (
        bronze.transform(parse_days)
        .transform(one_row_per_day)
        .transform(capitalized_days)
        .transform(with_period_labels)
    )


# Order items ----------------------------------------------------------------


LINE = ("order_id", "item_seq")


def latest_items(df: DataFrame) -> DataFrame:
    """One row per order line: the one from the last batch file, whose name holds its date."""
    return latest_per_key(df, LINE, [F.col(SOURCE_FILE).desc_nulls_last()], undecided_by=[INGESTED_AT])


def latest_arrivals(df: DataFrame, keys: Sequence[str] = LINE) -> DataFrame:
    """One row per order line: the one from the file that arrived last, of equal times the last by name."""
    order = [F.col(c).desc_nulls_last() for c in (ARRIVED_AT, SOURCE_FILE)]
    return latest_per_key(df, keys, order, undecided_by=[INGESTED_AT])


def amount_texts() -> dict:
    """Raw order-item amounts without symbols, and the decimal that each is computed with."""
    return {
        "unit_price": (text.without_characters(F.col("unit_price"), fixed.PRICE_SYMBOL), numbers.PRICE),
        "discount_pct": (text.without_characters(F.col("discount_pct"), fixed.PERCENT_SYMBOL), numbers.PERCENT),
        "tax_amount": (text.without_pattern(F.col("tax_amount"), fixed.NOT_AMOUNT), numbers.PRICE),
    }


def item_parsers() -> dict:
    """Raw order-item column to its parsed expression; also what the parse check tests."""
    amounts = {name: numbers.to_amount(written) for name, (written, _) in amount_texts().items()}
    return {
        "quantity": numbers.to_whole(text.recode(F.col("quantity"), fixed.QUANTITY_WORDS)),
        **amounts,
        "dt": dates.to_day(F.col("dt"), fixed.ORDER_DATE_LAYOUT),
        "order_ts": dates.to_moment(F.col("order_ts"), *fixed.ORDER_TIME_LAYOUTS),
        "item_seq": numbers.to_whole(F.col("item_seq")),
    }


def item_exactness() -> dict:
    """Raw order-item amount to whether it enters the amounts with every digit it was written with."""
    return {name: numbers.exactly(written, kind) for name, (written, kind) in amount_texts().items()}


def _parsed(df: DataFrame, *names: str) -> DataFrame:
    parsers = item_parsers()
    return df.withColumns({name: parsers[name] for name in names})


def parse_quantities(df: DataFrame) -> DataFrame:
    """Quantities as integers; words outside the fixed list are NULL and counted by the parse check."""
    return _parsed(df, "quantity")


def parse_amounts(df: DataFrame) -> DataFrame:
    """Prices, rates and taxes without their symbols, as doubles (the stored type)."""
    return _parsed(df, "unit_price", "discount_pct", "tax_amount")


def standard_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "coupon_code": text.folded(F.col("coupon_code")),
            "channel": text.recode(F.col("channel"), fixed.CHANNEL_LABELS),
        }
    )


def parse_times(df: DataFrame) -> DataFrame:
    return _parsed(df, "dt", "order_ts", "item_seq")


def order_items(bronze: DataFrame) -> DataFrame:
    return (
        bronze.transform(latest_items)
        .transform(parse_quantities)
        .transform(parse_amounts)
        .transform(standard_labels)
        .transform(parse_times)
        .withColumn(PROCESSED_AT, F.current_timestamp())
    )


PLANS = {
    "brands": brands,
    "category": category,
    "products": products,
    "customers": customers,
    "calendar": calendar,
    "order_items": order_items,
}
