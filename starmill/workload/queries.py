"""One query per operator and per plan, each over whole test tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starmill import fixed_values as fixed
from starmill.functions import numbers
from starmill.operators import members
from starmill.operators.history import BEGAN, ENDED, MARK, version_at
from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget, left_lookup
from starmill.operators.quality import (
    QualityError,
    Reference,
    combined,
    exact_report,
    held_report,
    key_report,
    reconciliation_report,
    reference_report,
)
from starmill.operators.schema import schema_report
from starmill.plans import gold, silver
from starmill.plans.contracts import (
    BRONZE,
    DIM_CALENDAR,
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    FACT,
    RAW,
    SILVER,
    Contract,
)
from starmill.plans.refresh import Layers, advisory_report, amounts_held, full_refresh, publish_gold, stage_dimensions
from starmill.session import scratch_path, shuffles_dropped, written
from starmill.sinks.buckets import BucketedTable
from starmill.sinks.history import HistoryTable
from starmill.sinks.tables import publish, published
from starmill.sources.files import ARRIVED_AT, INGESTED_AT, REJECTED, SOURCE_FILE, scan_csv, with_audit
from starmill.sources.literals import rate_lookup, region_lookup
from starmill.sources.seeds import rate_seed, region_seed
from starmill.streaming.landing import Landing, land_new_files
from starmill.workload import raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE = ("order_id", "item_seq")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Building blocks ------------------------------------------------------------


def regions(spark: SparkSession) -> DataFrame:
    return region_lookup(spark, fixed.REGION_BY_COUNTRY_STATE)


def rates(spark: SparkSession) -> DataFrame:
    return rate_lookup(spark, fixed.INR_PER_UNIT)


def clean(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.PLANS[entity](raw.bronze(spark, sf_dir, entity))


def customers_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customers(clean(spark, sf_dir, "customers"), regions(spark))


def products_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_products(*[clean(spark, sf_dir, e) for e in ("products", "category", "brands")])


def calendar_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_calendar(clean(spark, sf_dir, "calendar"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customers_dimension(spark, sf_dir)
    return gold.fact_order_items(clean(spark, sf_dir, "order_items"), rates(spark), customers)


def measured_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir, "order_items").transform(numbers.with_revenue)


def zoneless(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as plain date and time, the form the SQL side has."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n, t in df.dtypes if t.startswith("decimal")})


def new_database(spark: SparkSession, label: str) -> str:
    """A database of its own in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


# Scans, writes, literal relations -------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """Product files under a typed schema; bad numbers read as NULL."""
    scan = with_audit(scan_csv(spark, raw.landing(spark, sf_dir, "products"), RAW["products"]))
    return scan.withColumns(
        {
            "has_source_file": F.col(SOURCE_FILE).endswith(".csv"),
            "has_ingest_time": F.col(INGESTED_AT).isNotNull(),
        }
    ).drop(SOURCE_FILE, INGESTED_AT)


@query
def all_string_landing(spark, sf_dir):
    """Order items exactly as their files hold them."""
    return scan_csv(spark, raw.landing(spark, sf_dir, "order_items"), RAW["order_items"])


@query
def multi_file_scan(spark, sf_dir):
    """Many batch files as one relation; lineage tells the batches apart."""
    scan = with_audit(scan_csv(spark, raw.landing(spark, sf_dir, "order_items"), RAW["order_items"]))
    batch = F.regexp_extract(SOURCE_FILE, r"/batch=(\d{4}-\d{2})/[^/]+\.csv\.gz$", 1)
    return scan.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("order_id", "item_seq").alias("line_count"),
        F.count("customer_id").alias("with_customer"),
        F.max("unit_price").alias("max_unit_price_text"),
    )


@query
def table_roundtrip(spark, sf_dir):
    """Customers published twice under one name, then read by name."""
    database = new_database(spark, "roundtrip")
    rows = clean(spark, sf_dir, "customers").withColumns(
        {SOURCE_FILE: F.lit("customers.csv"), INGESTED_AT: F.current_timestamp()}
    )
    for _ in range(2):
        publish(rows, database, SILVER["customers"])
    return spark.table(f"{database}.{SILVER['customers'].name}").drop(INGESTED_AT)


@query
def region_mapping_table(spark, sf_dir):
    """The literal region lookup, with the number of customers each entry serves."""
    served = (
        raw.bronze(spark, sf_dir, "customers").groupBy("country", "state").agg(F.count(F.lit(1)).alias("customers"))
    )
    return regions(spark).join(served, ["country", "state"], "left").fillna(0, subset=["customers"])


# Silver dimensions ----------------------------------------------------------


@query
def drop_null_keys(spark, sf_dir):
    return silver.known_customers(raw.bronze(spark, sf_dir, "customers"))


@query
def fill_sentinel(spark, sf_dir):
    return silver.filled_phones(raw.bronze(spark, sf_dir, "customers"))


@query
def silver_customers(spark, sf_dir):
    return clean(spark, sf_dir, "customers")


@query
def brand_clean(spark, sf_dir):
    return silver.clean_brands(raw.bronze(spark, sf_dir, "brands"))


@query
def map_category_codes(spark, sf_dir):
    return silver.recode_categories(raw.bronze(spark, sf_dir, "brands"))


@query
def silver_brands(spark, sf_dir):
    return clean(spark, sf_dir, "brands")


@query
def dedup_category(spark, sf_dir):
    return clean(spark, sf_dir, "category")


@query
def product_clean(spark, sf_dir):
    return clean(spark, sf_dir, "products")


@query
def map_materials(spark, sf_dir):
    return silver.correct_materials(raw.bronze(spark, sf_dir, "products")).select("product_id", "material")


@query
def rating_clean(spark, sf_dir):
    return silver.clean_ratings(raw.bronze(spark, sf_dir, "products")).select("product_id", "rating_count")


@query
def dedup_calendar(spark, sf_dir):
    return raw.bronze(spark, sf_dir, "calendar").transform(silver.parse_days).transform(silver.one_row_per_day)


@query
def period_labels(spark, sf_dir):
    return silver.with_period_labels(raw.bronze(spark, sf_dir, "calendar"))


@query
def silver_calendar(spark, sf_dir):
    return clean(spark, sf_dir, "calendar")


# Silver order items ---------------------------------------------------------


@query
def parse_quantity(spark, sf_dir):
    return silver.parse_quantities(raw.bronze(spark, sf_dir, "order_items")).select(*LINE, "product_id", "quantity")


@query
def clean_monetary(spark, sf_dir):
    parsed = silver.parse_amounts(raw.bronze(spark, sf_dir, "order_items"))
    return parsed.select(*LINE, "product_id", "unit_price", "discount_pct", "tax_amount")


@query
def parse_temporal(spark, sf_dir):
    parsed = silver.parse_times(raw.bronze(spark, sf_dir, "order_items"))
    return zoneless(parsed.select(*LINE, "product_id", "dt", "order_ts"))


@query
def standardize_categoricals(spark, sf_dir):
    labelled = silver.standard_labels(raw.bronze(spark, sf_dir, "order_items"))
    return labelled.select(*LINE, "product_id", "channel", "coupon_code")


@query
def dedup_latest(spark, sf_dir):
    return silver.latest_items(raw.bronze(spark, sf_dir, "order_items"))


@query
def silver_order_items(spark, sf_dir):
    stamped = clean(spark, sf_dir, "order_items")
    flagged = stamped.withColumn("has_processing_time", F.col(silver.PROCESSED_AT).isNotNull())
    return zoneless(flagged.drop(silver.PROCESSED_AT))


# Measures and keys ----------------------------------------------------------


@query
def revenue_measures(spark, sf_dir):
    amounts = ("gross_amount", "discount_amount", "net_amount", "total_amount")
    return as_doubles(measured_items(spark, sf_dir).select(*LINE, "quantity", "unit_price", *amounts))


@query
def date_key(spark, sf_dir):
    return gold.with_date_key(clean(spark, sf_dir, "order_items")).select(*LINE, "dt", "date_id")


@query
def coupon_flag(spark, sf_dir):
    return gold.with_coupon_flag(clean(spark, sf_dir, "order_items")).select(*LINE, "coupon_code", "coupon_flag")


@query
def fx_convert(spark, sf_dir):
    converted = gold.with_reporting_amount(measured_items(spark, sf_dir), rates(spark))
    return as_doubles(converted.select(*LINE, "unit_price_currency", "total_amount", "total_amount_inr"))


@query
def remap_orphans(spark, sf_dir):
    items = clean(spark, sf_dir, "order_items").select(*LINE, "customer_id", "product_id")
    return members.remap_orphans(items, customers_dimension(spark, sf_dir), "customer_id", fixed.UNKNOWN_KEY)


def _stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, clean(spark, sf_dir, "order_items").select(*LINE, "customer_id", "product_id"), "lines")


@query
def remap_orphans_shuffled(spark, sf_dir):
    """The same when neither the members nor the orphaned keys may be broadcast."""
    dimension = customers_dimension(spark, sf_dir)
    return members.remap_orphans(
        _stored_items(spark, sf_dir), dimension, "customer_id", fixed.UNKNOWN_KEY, BroadcastBudget(rows=0)
    )


@query
def remap_orphans_few_strays(spark, sf_dir):
    """The same when the members are too many to broadcast and the orphaned keys are few."""
    dimension = customers_dimension(spark, sf_dir)
    budget = BroadcastBudget(rows=dimension.count() - 1)
    return members.remap_orphans(_stored_items(spark, sf_dir), dimension, "customer_id", fixed.UNKNOWN_KEY, budget)


@query
def left_lookup_shuffled(spark, sf_dir):
    """Names of the products of all order lines, joined by a spread shuffle."""
    names = products_dimension(spark, sf_dir).select(F.col("product_id").alias("code"), "category_name", "brand_name")
    lines = _stored_items(spark, sf_dir).drop("customer_id")
    return left_lookup(lines, names, {"code": F.col("product_id")}, BroadcastBudget(rows=0))


@query
def reconcile_revenue(spark, sf_dir):
    """Rows and revenue before, and of known and unknown customers after orphans have moved."""
    before = written(spark, measured_items(spark, sf_dir).select("customer_id", "total_amount"), "revenue")
    after = members.remap_orphans(before, customers_dimension(spark, sf_dir), "customer_id", fixed.UNKNOWN_KEY)
    unknown = F.col("customer_id") == fixed.UNKNOWN_KEY
    sides = before.select(F.lit("before").alias("side"), "total_amount").unionByName(
        after.select(F.when(unknown, "unknown").otherwise("known").alias("side"), "total_amount")
    )
    totals = []
    for side in ("before", "known", "unknown"):
        mine = F.col("side") == side
        totals.append(F.count(F.when(mine, 1)).alias(f"rows_{side}"))
        totals.append(F.sum(F.when(mine, F.col("total_amount"))).alias(f"total_amount_{side}"))
    kept = "coalesce(total_amount_known, 0) + coalesce(total_amount_unknown, 0) = coalesce(total_amount_before, 0)"
    agrees = f"rows_known + rows_unknown = rows_before AND {kept}"
    return as_doubles(sides.agg(*totals).withColumn("agrees", F.expr(agrees)))


# Star schema ----------------------------------------------------------------


@query
def customer_region(spark, sf_dir):
    placed = gold.with_region(clean(spark, sf_dir, "customers"), regions(spark))
    return placed.select("customer_id", "country", "state", "region")


@query
def dim_customers(spark, sf_dir):
    return customers_dimension(spark, sf_dir)


@query
def dim_products(spark, sf_dir):
    return products_dimension(spark, sf_dir)


@query
def dim_calendar(spark, sf_dir):
    return calendar_dimension(spark, sf_dir)


@query
def fact_order_items(spark, sf_dir):
    return zoneless(fact(spark, sf_dir))


# Data checks ----------------------------------------------------------------


def _dimensions(spark: SparkSession, sf_dir: str) -> dict:
    """The three dimensions, stored once so that every check reads files."""
    plans = {
        DIM_PRODUCTS: products_dimension(spark, sf_dir),
        DIM_CUSTOMERS: customers_dimension(spark, sf_dir),
        DIM_CALENDAR: calendar_dimension(spark, sf_dir),
    }
    return {contract: written(spark, df, contract.name) for contract, df in plans.items()}


def _key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions, which pass, and the raw customers and calendar, which do not."""
    reports = [
        key_report(products_dimension(spark, sf_dir), DIM_PRODUCTS.name, DIM_PRODUCTS.grain),
        key_report(customers_dimension(spark, sf_dir), DIM_CUSTOMERS.name, DIM_CUSTOMERS.grain),
        key_report(calendar_dimension(spark, sf_dir), DIM_CALENDAR.name, DIM_CALENDAR.grain),
    ]
    reports.append(key_report(raw.bronze(spark, sf_dir, "customers"), "raw_customers", ["customer_id"]))
    reports.append(key_report(raw.bronze(spark, sf_dir, "calendar"), "raw_calendar", ["date"]))
    return combined(*reports)


@query
def check_grain(spark, sf_dir):
    return _key_checks(spark, sf_dir).where(F.col("check_name").startswith("unique"))


@query
def check_not_null(spark, sf_dir):
    return _key_checks(spark, sf_dir).where(F.col("check_name").startswith("not_null"))


@query
def check_grain_composite(spark, sf_dir):
    """Order lines before and after keep-latest."""
    return combined(
        key_report(raw.bronze(spark, sf_dir, "order_items"), "raw_order_items", LINE),
        key_report(clean(spark, sf_dir, "order_items"), SILVER["order_items"].name, LINE),
    )


@query
def check_referential(spark, sf_dir):
    """References of the raw order lines, with orphans, and of the published fact, without."""
    return _references(spark, sf_dir, DEFAULT_BUDGET)


@query
def check_referential_counted(spark, sf_dir):
    """The same when no dimension may be broadcast."""
    return _references(spark, sf_dir, BroadcastBudget(rows=0))


def _references(spark: SparkSession, sf_dir: str, budget: BroadcastBudget) -> DataFrame:
    dimensions = _dimensions(spark, sf_dir)
    references = _fact_references(dimensions)
    lines = raw.bronze(spark, sf_dir, "order_items").transform(silver.parse_times).transform(gold.with_date_key)
    items = clean(spark, sf_dir, "order_items")
    return combined(
        reference_report(lines, "raw_order_items", references, budget),
        reference_report(
            gold.fact_order_items(items, rates(spark), dimensions[DIM_CUSTOMERS]), FACT.name, references, budget
        ),
    )


def _fact_references(dimensions: dict) -> list[Reference]:
    by_name = {contract.name: df for contract, df in dimensions.items()}
    return [Reference(k.column, by_name[k.table], k.member) for k in FACT.foreign_keys]


@query
def dq_report(spark, sf_dir):
    """Every check of a refresh as one report over stored tables."""
    items = written(spark, clean(spark, sf_dir, "order_items"), "items")
    dimensions = _dimensions(spark, sf_dir)
    published = written(
        spark, gold.fact_order_items(items, rates(spark), dimensions[DIM_CUSTOMERS]), FACT.name
    )
    return combined(
        *[key_report(df, c.name, c.grain) for c, df in dimensions.items()],
        key_report(published, FACT.name, FACT.grain),
        reference_report(published, FACT.name, _fact_references(dimensions)),
        reconciliation_report(items, published, FACT.name, "tax_amount"),
        held_report(published, FACT.name, amounts_held(), "amounts"),
        advisory_report(
            raw.bronze(spark, sf_dir, "order_items"),
            clean(spark, sf_dir, "category"),
            clean(spark, sf_dir, "brands"),
        ),
    )


@query
def exact_amounts(spark, sf_dir):
    """Amounts of order items that are rounded before anything is computed with them."""
    return exact_report(raw.bronze(spark, sf_dir, "order_items"), BRONZE["order_items"].name, silver.item_exactness())


@query
def schema_contract(spark, sf_dir):
    """The customer dimension against its contract, then a drifted copy of it."""
    good = customers_dimension(spark, sf_dir)
    drifted = good.withColumnsRenamed({"phone": "telephone"}).withColumn("state", F.length("state"))
    return combined(
        schema_report(good, DIM_CUSTOMERS.name, DIM_CUSTOMERS.schema),
        key_report(good, DIM_CUSTOMERS.name, DIM_CUSTOMERS.grain),
        schema_report(drifted, "drifted_customers", DIM_CUSTOMERS.schema),
    )


# Full refresh ---------------------------------------------------------------

# Columns that differ from run to run, or hold a path.
NOT_COMPARED = {SOURCE_FILE, INGESTED_AT, silver.PROCESSED_AT}


def _text(field: T.StructField) -> Column:
    """A cell as text that both engines write alike."""
    cell, kind = F.col(field.name), field.dataType.simpleString()
    if kind in ("int", "float", "double"):
        # The text of a double is not the same everywhere, its arithmetic is: billions, and millionths of the
        # rest where a double still holds them.
        number = cell.cast("double")
        billions = F.floor(number / 1e9)
        rest = F.floor((number - billions.cast("double") * 1e9) * 1e6 + 0.5)
        rest = F.when(F.abs(number) < 1e12, rest).otherwise(F.lit(0))
        cell = F.concat(billions.cast("string"), F.lit(":"), rest.cast("string"))
    elif kind == "timestamp":
        cell = F.date_format(cell, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(cell.cast("string"), F.lit("~"))


def content(contract) -> Column:
    """A digest of all rows of a table: the sum of eight hexadecimal digits of each row's MD5."""
    row = F.concat_ws("|", *[_text(f) for f in contract.schema.fields if f.name not in NOT_COMPARED])
    digits = F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10)
    return F.coalesce(F.sum(digits.cast("long")), F.lit(0)).alias("content")


@query
def full_refresh_rerun(spark, sf_dir):
    """All layers built twice from files; the second run must reproduce the first."""
    files = {entity: raw.landing(spark, sf_dir, entity) for entity in RAW}
    layers = Layers(*[new_database(spark, layer) for layer in ("bronze", "silver", "gold")])
    tables = (
        [("bronze", layers.bronze, c) for c in BRONZE.values()]
        + [("silver", layers.silver, c) for c in SILVER.values()]
        + [("gold", layers.gold, c) for c in (DIM_PRODUCTS, DIM_CUSTOMERS, DIM_CALENDAR, FACT)]
    )
    stamps = {INGESTED_AT, silver.PROCESSED_AT}
    runs = []
    for number in (1, 2):
        full_refresh(spark, files, layers)
        counts = combined(
            *[
                spark.table(f"{database}.{c.name}").agg(
                    F.lit(layer).alias("layer"),
                    F.lit(c.name).alias("table_name"),
                    F.count(F.lit(1)).alias("row_count"),
                    content(c),
                    F.sum(F.xxhash64(*[n for n in c.columns if n not in stamps]).cast("decimal(20,0)")).alias("mark"),
                )
                for layer, database, c in tables
            ]
        )
        runs.append(written(spark, counts.withColumn("run", F.lit(number)), f"counts-{number}"))
    first = F.broadcast(runs[0].select("table_name", F.col("mark").alias("first_mark")))
    return (
        runs[0].unionByName(runs[1])
        .join(first, "table_name")
        .select("run", "layer", "table_name", "row_count", "content", (F.col("mark") == F.col("first_mark")).alias("same_rows"))
    )


# Incremental runs -----------------------------------------------------------


class _Died(RuntimeError):
    """Stands for a lost driver."""


def _dying(publish, before: bool):
    """A batch function that dies before the batch's record is written, or right after it."""

    def run(batch: DataFrame, number: int) -> None:
        if before:
            batch.count()
        else:
            publish(batch, number)
        raise _Died

    return run


def _drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the number of the drop that brings them, by the month that names their file."""
    number = (F.substring("batch", 6, 2).cast("int") % 3 + 1).alias("drop_number")
    with shuffles_dropped(spark):
        return written(spark, raw.order_lines(spark, sf_dir).select("*", number), "drops")


@query
def incremental_landing(spark, sf_dir):
    """Three drops landed as they arrive, with two runs that die on the way: each line's last arrival.

    Drops do not follow the months that name their files.
    """
    inbox, landing = scratch_path(spark, "inbox"), Landing(scratch_path(spark, "landed"), RAW["order_items"])
    lines = _drops(spark, sf_dir)
    files = f"{inbox}/*/*/*.csv"
    for drop in (1, 2, 3):
        raw.drop_files(lines.where(F.col("drop_number") == drop), f"{inbox}/{drop}", minute=drop)
        if drop > 1:
            with contextlib.suppress(StreamingQueryException):
                land_new_files(spark, files, landing, _dying(landing.publish, before=drop == 2))
        land_new_files(spark, files, landing)
    arrived = F.regexp_extract(SOURCE_FILE, r"/(\d)/batch=[^/]+/[^/]+\.csv$", 1).cast("int").alias("drop_number")
    return silver.latest_arrivals(landing.read(spark)).select(*RAW["order_items"].names, arrived)


@query
def merged_lines(spark, sf_dir):
    """The last arrival of each line again, by merging the drops into a stored table; one comes twice."""
    kinds = T.StructType([*RAW["order_items"].fields, *[T.StructField(n, T.StringType()) for n in (SOURCE_FILE, INGESTED_AT)], T.StructField(ARRIVED_AT, T.IntegerType())])
    table = BucketedTable(scratch_path(spark, "lines"), kinds, LINE, 16, silver.latest_arrivals)
    rows = raw.item_texts(_drops(spark, sf_dir), "drop_number").withColumnsRenamed({"batch": SOURCE_FILE, "drop_number": ARRIVED_AT}).withColumn(INGESTED_AT, F.lit("now"))
    for drop in (1, 2, 2, 3):
        table.merge(rows.where(F.col(ARRIVED_AT) == drop))
        table.drop_superseded(spark, keep=0)  # nobody reads an earlier state
    return table.read(spark).select(*RAW["order_items"].names, F.col(ARRIVED_AT).alias("drop_number"))


@query
def check_grain_bucketed(spark, sf_dir):
    """Grain and key nullity of a fact that is stored by line: the keys stay where they are."""
    database = new_database(spark, "buckets")
    publish(fact(spark, sf_dir), database, FACT, buckets=(8, FACT.grain))
    return key_report(spark.table(f"{database}.{FACT.name}"), FACT.name, FACT.grain)


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that change on some days of each month, moved up and down by the day."""
    day = F.col("o_orderdate").cast("date").alias("valid_from")
    days = raw.table(spark, sf_dir, "orders").select(day).distinct().where(F.day("valid_from").isin(1, 11, 21))
    percent = F.expr("CAST(80 + (dayofyear(valid_from) * 7 + ascii(currency)) % 41 AS DECIMAL(3,0))")
    moved = (F.col("inr_rate") * percent * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(12,6)")
    each = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(r).cast("decimal(12,6)").alias("inr_rate")) for c, r in fixed.INR_PER_UNIT.items()])
    changing = days.select("valid_from", F.inline(each)).withColumn("inr_rate", moved)
    return changing.where("currency <> 'SGD' OR valid_from >= DATE'1995-01-01'").select("currency", "valid_from", "inr_rate")


def _converted_then(
    spark: SparkSession, sf_dir: str, history: DataFrame, budget: BroadcastBudget = DEFAULT_BUDGET
) -> DataFrame:
    # Read for the days, for frequent keys and for the lookup: stored, so that keep-latest runs once.
    needed = measured_items(spark, sf_dir).select(*LINE, "unit_price_currency", "dt", "total_amount")
    converted = gold.with_reporting_amount(written(spark, needed, "measured"), history, budget)
    return as_doubles(converted.select(*LINE, "unit_price_currency", "total_amount", "total_amount_inr"))


@query
def fx_as_of(spark, sf_dir):
    """Rupee amounts at the rate in effect on the order's day."""
    return _converted_then(spark, sf_dir, rate_history(spark, sf_dir))


@query
def fx_as_of_shuffled(spark, sf_dir):
    """The same when the resolved days may not be broadcast."""
    return _converted_then(spark, sf_dir, rate_history(spark, sf_dir), BroadcastBudget(rows=0))


def customer_snapshots(spark: SparkSession, sf_dir: str) -> list[tuple[date, DataFrame]]:
    """Three states of the customer dimension: some come late, some vanish and return, some move."""
    everyone = gold.with_region(clean(spark, sf_dir, "customers"), regions(spark)).select(*DIM_CUSTOMERS.columns)
    numbered = everyone.withColumn("k", F.substring("customer_id", 2, 20).cast("long"))

    def moved(df: DataFrame, who: str, country: str, state: str) -> DataFrame:
        to = {"country": country, "state": state, "region": fixed.REGION_BY_COUNTRY_STATE[country][state]}
        return df.withColumns({c: F.when(F.expr(who), F.lit(v)).otherwise(F.col(c)) for c, v in to.items()})

    second = moved(numbered, "k % 4 = 1", "India", "MH")
    third = moved(second, "k % 6 = 2", "Canada", "BC").withColumn(
        "phone", F.when(F.expr("k % 50 = 7"), F.lit(fixed.UNKNOWN_VALUE)).otherwise(F.col("phone"))
    )
    return [
        (date(1994, 1, 1), numbered.where("k % 10 <> 3").drop("k")),
        (date(1996, 1, 1), second.where("k % 29 <> 5").drop("k")),
        (date(1997, 6, 1), third.drop("k")),
    ]


def customer_versions(spark: SparkSession, sf_dir: str) -> HistoryTable:
    """The history of the three snapshots; the second one is applied twice."""
    schema = T.StructType([f for f in DIM_CUSTOMERS.schema.fields])
    table = HistoryTable(scratch_path(spark, "history"), "hst_customers", schema, "customer_id")
    first, second, third = customer_snapshots(spark, sf_dir)
    for day, rows in (first, second, second, third):
        table.apply(rows, day)
    return table


@query
def customer_history(spark, sf_dir):
    """Every version of every customer, with the days it held as text."""
    days = {c: F.col(c).cast("string") for c in (BEGAN, ENDED)}
    return customer_versions(spark, sf_dir).read(spark).withColumns(days).drop(MARK)


@query
def region_at_order_time(spark, sf_dir):
    """Each order line with its customer's region on the order's day, and the region of today."""
    table = customer_versions(spark, sf_dir)
    # Too large a history is looked up by shuffle, which reads the lines more than once.
    lines = written(spark, clean(spark, sf_dir, "order_items").select(*LINE, "customer_id", "dt"), "dated")
    on = {"customer_id": F.col("customer_id")}
    then = version_at(lines, table.read(spark).select("customer_id", F.col("region").alias("region_then"), BEGAN, ENDED), on, F.col("dt"))
    now = table.current(spark).select("customer_id", F.col("region").alias("region_now"))
    return left_lookup(then, now, on).drop("dt")


# Landing and publication ----------------------------------------------------


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a customer file, some of them with a field missing, too many, or of another type."""
    return raw.table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 50 = 7 THEN concat('C', c_custkey, ',', c_mktsegment)"
        " WHEN c_custkey % 77 = 3 THEN concat('C', c_custkey, ',', c_mktsegment, ',', c_nationkey, ',more')"
        " WHEN c_custkey % 91 = 5 THEN concat('C', c_custkey, ',', c_mktsegment, ',n', c_nationkey)"
        " ELSE concat('C', c_custkey, ',', c_mktsegment, ',', c_nationkey) END AS line"
    )


@query
def quarantined_lines(spark, sf_dir):
    """Lines that do not fit their schema, kept whole, and how many rows of each kind landed."""
    folder = scratch_path(spark, "lines")
    customer_lines(spark, sf_dir).select(F.col("line").alias("value")).write.option("compression", "none").text(folder)
    schema = T.StructType().add("id", "string").add("segment", "string").add("nation", "integer")
    contract = Contract("brz_lines", T.StructType([*schema.fields, *BRONZE["brands"].schema.fields[-2:]]))
    database = new_database(spark, "landing")
    scan = with_audit(scan_csv(spark, f"{folder}/*.txt", schema, rejects=True, header=False))
    publish(scan, database, contract, hidden=(REJECTED,))
    landed, rejects = spark.table(f"{database}.brz_lines"), spark.table(f"{database}.brz_lines_rejects")
    kept = landed.agg(F.count(F.lit(1)).alias("row_count"), F.count("nation").alias("with_nation"))
    each = {"row_count": F.lit(1).cast("long"), "with_nation": F.lit(0).cast("long")}
    return rejects.select(F.col(REJECTED).alias("line")).withColumns(each).unionByName(kept.withColumn("line", F.lit("all")))


@query
def one_switch(spark, sf_dir):
    """What readers see of dimensions and fact after a refresh, and after one whose fact fails.

    The second refresh has no customers; its fact repeats a line, so nothing of it may show.
    """
    layers = Layers(*[new_database(spark, layer) for layer in ("bronze", "silver", "gold")])
    stamps = {SOURCE_FILE: F.lit("file"), INGESTED_AT: F.current_timestamp()}
    for entity in RAW:
        rows = clean(spark, sf_dir, entity).drop(SOURCE_FILE).withColumns(stamps)
        publish(rows.select(*SILVER[entity].columns), layers.silver, SILVER[entity])
    publish_gold(spark, layers, stage_dimensions(spark, layers))
    seen = [_visible(spark, layers, 1)]

    table = lambda entity: spark.table(f"{layers.silver}.{SILVER[entity].name}")
    publish(table("customers").where("false"), layers.silver, SILVER["customers"])
    publish(table("order_items").unionByName(table("order_items").limit(1)), layers.silver, SILVER["order_items"])
    with contextlib.suppress(QualityError):
        publish_gold(spark, layers, stage_dimensions(spark, layers))
    seen.append(_visible(spark, layers, 2))
    return combined(*seen)


def _visible(spark: SparkSession, layers: Layers, refresh: int) -> DataFrame:
    """Rows of each gold table by its own name, and as the one record of the switch names it."""
    lines = []
    for name, together in published(spark, layers.gold).items():
        sides = spark.table(f"{layers.gold}.{name}").select(F.lit(0).alias("side")).unionByName(together.select(F.lit(1).alias("side")))
        lines.append(
            sides.agg(F.count_if(F.col("side") == 0).alias("row_count"), F.count_if(F.col("side") == 1).alias("rows_together"))
            .select(F.lit(refresh).alias("refresh"), F.lit(name).alias("table_name"), "row_count", "rows_together")
        )
    return written(spark, combined(*lines), f"visible-{refresh}")


@query
def dim_customers_seeded(spark, sf_dir):
    """The customer dimension with regions from a seed file instead of code."""
    folder = scratch_path(spark, "seeds")
    regions(spark).coalesce(1).write.option("header", True).csv(folder)
    return gold.dim_customers(clean(spark, sf_dir, "customers"), region_seed(spark, f"{folder}/*.csv"))


@query
def fx_as_of_seeded(spark, sf_dir):
    """Rupee amounts by a history of rates that is kept as files."""
    folder = scratch_path(spark, "seeds")
    rate_history(spark, sf_dir).write.option("header", True).csv(folder)
    return _converted_then(spark, sf_dir, rate_seed(spark, f"{folder}/*.csv", dated=True))
