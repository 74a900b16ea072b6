"""Lookups against the fixed relations, the unknown member, and orphaned fact rows."""

import pytest

from starmill import fixed_values as fixed
from starmill.operators.lookups import BroadcastBudget
from starmill.operators.members import remap_orphans, with_unknown_member
from starmill.plans import gold
from starmill.plans.contracts import DIM_CALENDAR
from starmill.sources.literals import rate_lookup, region_lookup

CUSTOMER = "customer_id string, phone string, country_code string, country string, state string"


def test_fixed_lookups_hold_every_entry(spark):
    assert region_lookup(spark, fixed.REGION_BY_COUNTRY_STATE).count() == 35
    assert rate_lookup(spark, fixed.INR_PER_UNIT).count() == 7


def test_lookup_text_is_quoted(spark, rows):
    odd = {"Cote d'Ivoire": {"A\\B": "West"}}
    assert rows(region_lookup(spark, odd)) == [("Cote d'Ivoire", "A\\B", "West")]


def test_region_needs_country_and_state(spark, rows):
    regions = region_lookup(spark, {"Norway": {"TR": "North", "OS": "East"}, "Chile": {"AP": "North"}})
    df = spark.createDataFrame(
        [("n1", None, "NO", "Norway", "TR"), ("n2", None, "NO", "Norway", "AP"), ("n3", None, "NO", "Norway", None),
         ("n4", None, "CL", "Chile", "AP"), ("n5", None, "PE", "Peru", "OS")], CUSTOMER,
    )
    assert rows(gold.with_region(df, regions), "customer_id", "region") == [
        ("n1", "North"), ("n2", "Other"), ("n3", "Other"), ("n4", "North"), ("n5", "Other"),
    ]


def test_customer_dimension_ends_with_the_unknown_member(spark, rows):
    df = spark.createDataFrame([("q", "12", "CA", "Canada", "QC")], CUSTOMER)
    dim = gold.dim_customers(df, region_lookup(spark, fixed.REGION_BY_COUNTRY_STATE))
    assert rows(dim) == [
        ("-1", None, None, None, None, "Not Available"), ("q", "12", "CA", "Canada", "QC", "East"),
    ]


def test_unknown_member_fits_any_schema(spark, rows):
    df = spark.createDataFrame([(1, 2.5, "x")], "id long, weight double, name string")
    assert rows(with_unknown_member(df, {"id": "-1", "name": "none"})) == [(-1, None, "none"), (1, 2.5, "x")]


# 10: the members are broadcast; 3: the two orphaned keys are; 0: the fact is shuffled.
@pytest.mark.parametrize("row_limit", [10, 3, 0])
def test_orphans_move_and_revenue_stays(spark, rows, row_limit):
    fact = spark.createDataFrame(
        [("ada", 11.5), ("ada", 2.25), ("nobody", 30.75), ("closed", 4.0), (None, 8.5)],
        "customer_id string, total_amount double",
    )
    # A repeated or NULL member must not repeat fact rows.
    dim = spark.createDataFrame([("ada",), ("ada",), ("bo",), ("cy",), ("di",), (None,)], "customer_id string")
    resolved = remap_orphans(fact, dim, "customer_id", fixed.UNKNOWN_KEY, BroadcastBudget(rows=row_limit))
    assert rows(resolved, "customer_id", "total_amount") == [
        ("-1", 30.75), ("-1", 4.0), ("-1", 8.5), ("ada", 11.5), ("ada", 2.25),
    ]


def test_product_dimension_names_and_fan_out(spark, rows):
    product = (
        "product_id string, sku string, category_code string, brand_code string, color string, size string,"
        " material string, weight_grams int, length_cm float, width_cm float, height_cm float, rating_count int"
    )
    products = spark.createDataFrame(
        [(p, None, c, b, None, None, None, 1, None, None, None, 0) for p, c, b in
         [("P1", "CE", "ACME"), ("P2", "XX", "NONE"), ("P3", None, None)]], product,
    )
    category = spark.createDataFrame([("CE", "Electronics")], "category_code string, category_name string")
    brands = spark.createDataFrame([("Acme", "Acme Corp")], "brand_code string, brand_name string")
    named = ("product_id", "category_name", "brand_name")
    missing = fixed.UNKNOWN_VALUE
    assert rows(gold.dim_products(products, category, brands), *named) == [
        ("P1", "Electronics", "Acme Corp"), ("P2", missing, missing), ("P3", missing, missing),
    ]
    doubled = brands.unionByName(brands)
    assert gold.dim_products(products, category, doubled).where("product_id = 'P1'").count() == 2


def test_calendar_dimension(spark, rows):
    silver_rows = spark.sql(
        "SELECT DATE'2025-08-02' AS date, 2025 AS year, 'Saturday' AS day_name, 3 AS quarter, 31 AS week_of_year,"
        " 'Q3-2025' AS quarter_label, 'Week31-2025' AS week_label"
        " UNION ALL SELECT DATE'2025-08-03', 2025, CAST(NULL AS STRING), 3, 31, 'Q3-2025', 'Week31-2025'"
    )
    dim = gold.dim_calendar(silver_rows)
    assert dim.columns == DIM_CALENDAR.columns
    # The flag follows the published name, so the unnamed Sunday is not flagged.
    assert rows(dim, "date_id", "month_name", "is_weekend") == [(20250802, "August", 1), (20250803, "August", 0)]
