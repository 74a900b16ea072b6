"""Gold: the published star schema.  Each plan ends in its contract's column list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmill import fixed_values as fixed
from starmill.functions import dates, numbers, text
from starmill.operators.asof import as_of_lookup
from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget, left_lookup
from starmill.operators.members import remap_orphans, with_unknown_member
from starmill.plans.contracts import DIM_CALENDAR, DIM_CUSTOMERS, DIM_PRODUCTS, FACT, FACT_NAMES

VALID_FROM = "valid_from"


def dim_products(
    products: DataFrame,
    category: DataFrame,
    brands: DataFrame,
    missing: str = fixed.UNKNOWN_VALUE,
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """Products with the names of their own category and brand.

    Product codes are upper case, so lookup codes are compared in upper case too.
    """
    categories = category.select(F.upper("category_code").alias("code"), "category_name")
    brand_names = brands.select(F.upper("brand_code").alias("code"), "brand_name")
    named = left_lookup(products, categories, {"code": F.col("category_code")}, budget)
    named = left_lookup(named, brand_names, {"code": F.col("brand_code")}, budget)
    return named.fillna(missing, subset=["category_name", "brand_name"]).select(*DIM_PRODUCTS.columns)


def with_region(
    customers: DataFrame,
    regions: DataFrame,
    missing: str = fixed.UNKNOWN_REGION,
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """Sales region by country and state; pairs not listed, or incomplete, get ``missing``."""
    placed = left_lookup(
        customers, regions, {"country": F.col("country"), "state": F.col("state")}, budget
    )
    return placed.fillna(missing, subset=["region"])


def dim_customers(
    customers: DataFrame, regions: DataFrame, budget: BroadcastBudget = DEFAULT_BUDGET
) -> DataFrame:
    """Customers with region, plus the unknown member that orphaned fact rows point at."""
    published = with_region(customers, regions, budget=budget).select(*DIM_CUSTOMERS.columns)
    return with_unknown_member(
        published, {"customer_id": fixed.UNKNOWN_KEY, "region": fixed.UNKNOWN_VALUE}
    )


def dim_calendar(calendar: DataFrame) -> DataFrame:
    day = F.col("date")
    return calendar.withColumns(
        {
            "date_id": dates.date_key(day),
            "month_name": dates.month_name(day),
            "is_weekend": dates.weekend_flag(F.col("day_name")),
        }
    ).select(*DIM_CALENDAR.columns)


def with_date_key(items: DataFrame) -> DataFrame:
    return items.withColumn("date_id", dates.date_key(F.col("dt")))


def with_coupon_flag(items: DataFrame) -> DataFrame:
    """1 for a usable coupon: neither NULL nor blank."""
    return items.withColumn("coupon_flag", text.is_present(F.col("coupon_code")))


def with_reporting_amount(
    items: DataFrame, rates: DataFrame, budget: BroadcastBudget = DEFAULT_BUDGET
) -> DataFrame:
    """Total in rupees; an unknown or missing currency gives NULL.

    Rates with a column ``valid_from`` are a history: each line gets the rate in effect on its
    day, and NULL before the first one.
    """
    on = {"currency": F.upper(F.trim("unit_price_currency"))}
    if VALID_FROM in rates.columns:
        rated = as_of_lookup(items, rates, on, F.col("dt"), VALID_FROM, budget=budget)
    else:
        rated = left_lookup(items, rates, on, budget)
    return rated.withColumn("total_amount_inr", numbers.in_cents(F.col("total_amount") * F.col("inr_rate")))


def published_fact(items: DataFrame) -> DataFrame:
    """The fact's column list under its published names, amounts as doubles."""
    silver_name = {published: silver for silver, published in FACT_NAMES.items()}
    return items.select(
        *[
            F.col(silver_name.get(field.name, field.name)).cast(field.dataType).alias(field.name)
            for field in FACT.schema.fields
        ]
    )


def fact_order_items(
    items: DataFrame,
    rates: DataFrame,
    customers: DataFrame,
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """Every order line with measures, keys and a customer that exists.

    All steps but the two lookups are projections, and the lookups leave the fact in
    place while the customer keys fit the broadcast budget.
    """
    return (
        items.transform(numbers.with_revenue)
        .transform(with_date_key)
        .transform(with_coupon_flag)
        .transform(with_reporting_amount, rates, budget)
        .transform(remap_orphans, customers, "customer_id", fixed.UNKNOWN_KEY, budget)
        .transform(published_fact)
    )
