"""What each table holds: columns in order, grain, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    member: str


@dataclass(frozen=True)
class Contract:
    """A published table.  Keys are verified on the data before publication."""

    name: str
    schema: T.StructType
    grain: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def columns(**kinds: str) -> T.StructType:
    """A schema: columns in order with their Spark SQL types."""
    schema = T.StructType()
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return schema


# FIXED VALUES: column names, order and types equal those of the source system's files and tables.
AUDIT = {"_source_file": "string", "_ingested_at": "timestamp"}

# Raw files, in file order.  Order items land as text so that no value is lost on read.
RAW = {
    "brands": columns(
        brand_code="string", brand_name="string", category_code="string",
    ),
    "category": columns(
        category_code="string", category_name="string",
    ),
    "products": columns(
        product_id="string", sku="string", category_code="string", brand_code="string",
        color="string", size="string", material="string", weight_grams="string", length_cm="string",
        width_cm="float", height_cm="float", rating_count="integer",
    ),
    "customers": columns(
        customer_id="string", phone="string", country_code="string", country="string",
        state="string",
    ),
    "calendar": columns(
        date="string", year="integer", day_name="string", quarter="integer", week_of_year="integer",
    ),
    "order_items": columns(
        dt="string", order_ts="string", customer_id="string", order_id="string", item_seq="string",
        product_id="string", quantity="string", unit_price_currency="string", unit_price="string",
        discount_pct="string", tax_amount="string", channel="string", coupon_code="string",
    ),
}


def _landed(entity: str) -> Contract:
    return Contract(f"brz_{entity}", T.StructType(RAW[entity].fields + columns(**AUDIT).fields))


BRONZE = {entity: _landed(entity) for entity in RAW}

SILVER = {
    "brands": Contract(
        "slv_brands",
        columns(
            brand_code="string", brand_name="string", category_code="string", **AUDIT
        ),
    ),
    "category": Contract(
        "slv_category",
        columns(
            category_code="string", category_name="string", **AUDIT
        ),
        ("category_code",),
    ),
    "products": Contract(
        "slv_products",
        columns(
            product_id="string", sku="string", category_code="string", brand_code="string",
            color="string", size="string", material="string", weight_grams="integer", length_cm="float",
            width_cm="float", height_cm="float", rating_count="integer", **AUDIT
        ),
    ),
    "customers": Contract(
        "slv_customers",
        columns(
            customer_id="string", phone="string", country_code="string", country="string",
            state="string", **AUDIT
        ),
    ),
    "calendar": Contract(
        "slv_calendar",
        columns(
            date="date", year="integer", day_name="string", quarter="integer", week_of_year="integer", **AUDIT, quarter_label="string", week_label="string"
        ),
        ("date",),
    ),
    "order_items": Contract(
        "slv_order_items",
        columns(
            dt="date", order_ts="timestamp", customer_id="string", order_id="string", item_seq="integer",
            product_id="string", quantity="integer", unit_price_currency="string", unit_price="double",
            discount_pct="double", tax_amount="double", channel="string", coupon_code="string", **AUDIT, _processed_at="timestamp"
        ),
    ),
}

DIM_PRODUCTS = Contract(
    "gld_dim_products",
    columns(
        product_id="string", sku="string", category_code="string", category_name="string",
        brand_code="string", brand_name="string", color="string", size="string", material="string",
        weight_grams="integer", length_cm="float", width_cm="float", height_cm="float",
        rating_count="integer",
    ),
    ("product_id",),
)
DIM_CUSTOMERS = Contract(
    "gld_dim_customers",
    columns(
        customer_id="string", phone="string", country_code="string", country="string",
        state="string", region="string",
    ),
    ("customer_id",),
)
DIM_CALENDAR = Contract(
    "gld_dim_calendar",
    columns(
        date_id="integer", date="date", year="integer", month_name="string", day_name="string",
        is_weekend="integer", quarter="integer", quarter_label="string", week_of_year="integer",
        week_label="string",
    ),
    ("date_id",),
)
FACT = Contract(
    "gld_fact_order_items",
    columns(
        date_id="integer", transaction_date="date", transaction_ts="timestamp",
        transaction_id="string", seq_no="integer", customer_id="string", product_id="string",
        channel="string", coupon_code="string", coupon_flag="integer", unit_price_currency="string",
        quantity="integer", unit_price="double", gross_amount="double", discount_percent="double",
        discount_amount="double", net_amount="double", tax_amount="double", total_amount="double",
        total_amount_inr="double",
    ),
    ("transaction_id", "seq_no"),
    (
        ForeignKey("product_id", DIM_PRODUCTS.name, "product_id"),
        ForeignKey("customer_id", DIM_CUSTOMERS.name, "customer_id"),
        ForeignKey("date_id", DIM_CALENDAR.name, "date_id"),
    ),
)

# Published name of each fact column that silver calls differently.
FACT_NAMES = {
    "dt": "transaction_date",
    "order_ts": "transaction_ts",
    "order_id": "transaction_id",
    "item_seq": "seq_no",
    "discount_pct": "discount_percent",
}
