"""From hand-written files with every kind of defect to the checked star schema, twice."""

import datetime as dt

import pytest
from pyspark.sql import Observation

from starmill.operators.lookups import BroadcastBudget
from starmill.operators.quality import QualityError
from starmill.plans.contracts import BRONZE, FACT
from starmill.plans.refresh import (
    GOLD_DIMENSIONS,
    Layers,
    full_refresh,
    landing_report,
    refresh_bronze,
    refresh_fact,
    refresh_items,
)
from starmill.sinks.tables import published
from starmill.sources.files import scan_csv, with_audit
from starmill.plans.contracts import RAW

FILES = {
    "brands/b.csv": "brand_code,brand_name,category_code\nAC-ME!,  Acme Corp ,GROCERY\nZNTH,Zenith,CE\n",
    "category/c.csv": "category_code,category_name\nce,Electronics\ngrcy,Grocery\nGRCY,Grocery\n",
    "products/p.csv": (
        "product_id,sku,category_code,brand_code,color,size,material,weight_grams,length_cm,width_cm,height_cm,"
        "rating_count\n"
        'P1,S1,grcy,acme,red,M,Coton,450g,"12,5",1.5,2.5,-3\n'
        "P2,S2,zz,none,red,M,Steel,10,2.5,wide,2.5,\n"
    ),
    "customers/c.csv": (
        "customer_id,phone,country_code,country,state\nC1,,IN,India,MH\nC2,555,CA,Canada,ZZ\n,556,IN,India,KA\n"
    ),
    "calendar/c.csv": (
        "date,year,day_name,quarter,week_of_year\n01-08-2025,2025,friday,3,-31\n02-08-2025,2025,SUNDAY,3,-31\n"
        "02-08-2025,2025,SATURDAY,3,-31\n"
    ),
    "order_items/landing/order_items_2025-08-01.csv": (
        "dt,order_ts,customer_id,order_id,item_seq,product_id,quantity,unit_price_currency,unit_price,discount_pct,"
        "tax_amount,channel,coupon_code\n"
        "2025-08-01,2025-08-01 10:00:00,C1,O1,1,P1,One,usd,$10.00,10%,1.00,web, SAVE10 \n"
        "2025-08-01,01-08-2025 11:30,,O1,2,P2,2,INR,$49.99,21%,4.50,app,\n"
    ),
    "order_items/landing/order_items_2025-08-02.csv": (
        "dt,order_ts,customer_id,order_id,item_seq,product_id,quantity,unit_price_currency,unit_price,discount_pct,"
        "tax_amount,channel,coupon_code\n"
        "2025-08-02,2025-08-02 10:00:00,C1,O1,1,P1,Three, USD ,$10.00,10%,Rs 1.00,web, SAVE10 \n"
        "2025-08-02,never,C9,O2,1,P1,Four,XXX,5,0,0,store,   \n"
    ),
}


@pytest.fixture
def files(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    root = f"{tmp_path}/raw"
    return {e: f"{root}/{e}/*.csv" for e in RAW if e != "order_items"} | {
        "order_items": f"{root}/order_items/landing/*.csv"
    }


@pytest.fixture
def layers(spark, tmp_path):
    names = [f"{layer}_{abs(hash(str(tmp_path)))}" for layer in ("bronze", "silver", "gold")]
    for name in names:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    return Layers(*names)


@pytest.mark.parametrize("budget", [BroadcastBudget(), BroadcastBudget(rows=0)])
def test_files_to_star_schema_twice(spark, rows, files, layers, budget):
    for _ in range(2):
        report = full_refresh(spark, files, layers, budget=budget)
    checks = [line for line in report if not line["check_name"].startswith("parses")]
    assert sum(line["violations"] for line in checks) == 0 and len(checks) == 18
    unread = {line["check_name"]: line["violations"] for line in report if line["violations"]}
    assert unread == {"parses(quantity)": 1, "parses(order_ts)": 1}

    fact = spark.table(f"{layers.gold}.{FACT.name}")
    assert fact.schema.names == FACT.schema.names and fact.dtypes == [
        (f.name, f.dataType.simpleString()) for f in FACT.schema.fields
    ]
    day = dt.date
    assert rows(fact, *FACT.columns) == [
        (20250801, day(2025, 8, 1), dt.datetime(2025, 8, 1, 11, 30), "O1", 2, "-1", "P2", "Mobile", None, 0, "INR",
         2, 49.99, 99.98, 21.0, 21.0, 78.98, 4.5, 83.48, 83.48),
        (20250802, day(2025, 8, 2), None, "O2", 1, "-1", "P1", "store", "", 0, "XXX",
         None, 5.0, None, 0.0, None, None, 0.0, None, None),
        (20250802, day(2025, 8, 2), dt.datetime(2025, 8, 2, 10), "O1", 1, "C1", "P1", "Website", "save10", 1, " USD ",
         3, 10.0, 30.0, 10.0, 3.0, 27.0, 1.0, 28.0, 2472.12),
    ]
    assert rows(spark.table(f"{layers.gold}.gld_dim_products"), "product_id", "category_name", "brand_name",
                "material", "weight_grams", "length_cm", "width_cm", "rating_count") == [
        ("P1", "Grocery", "Acme Corp", "Cotton", 450, 12.5, 1.5, 3),
        ("P2", "Not Available", "Not Available", "Steel", 10, 2.5, None, 0),
    ]
    assert rows(spark.table(f"{layers.gold}.gld_dim_customers"), "customer_id", "phone", "region") == [
        ("-1", None, "Not Available"), ("C1", "Not Available", "West"), ("C2", "555", "Other"),
    ]
    assert rows(spark.table(f"{layers.gold}.gld_dim_calendar"), "date_id", "day_name", "is_weekend") == [
        (20250801, "Friday", 0), (20250802, "Saturday", 1),
    ]
    bronze = spark.table(f"{layers.bronze}.{BRONZE['order_items'].name}")
    assert bronze.count() == 4 and {t for n, t in bronze.dtypes if not n.startswith("_")} == {"string"}


def test_a_duplicate_brand_code_stops_the_refresh(spark, files, layers, tmp_path):
    (tmp_path / "raw/brands/more.csv").write_text("brand_code,brand_name,category_code\nacme,Other Acme,CE\n")
    with pytest.raises(QualityError, match=r"slv_brands: unique\(brand_code\) has 1 violations"):
        full_refresh(spark, files, layers)
    assert not spark.catalog.tableExists(f"{layers.gold}.{FACT.name}")


def test_a_failing_fact_leaves_all_four_tables(spark, files, layers, tmp_path):
    full_refresh(spark, files, layers)
    before = {n: sorted(map(str, df.collect())) for n, df in published(spark, layers.gold).items()}
    assert set(before) == {c.name for c in (*GOLD_DIMENSIONS, FACT)}
    # New customers, and items whose product nobody knows: the fact's references fail.
    (tmp_path / "raw/customers/more.csv").write_text("customer_id,phone,country_code,country,state\nC7,,IN,India,MH\n")
    (tmp_path / "raw/order_items/landing/order_items_2025-08-03.csv").write_text(
        FILES["order_items/landing/order_items_2025-08-01.csv"].replace("P1", "P404")
    )
    with pytest.raises(QualityError, match=r"references\(product_id\)"):
        full_refresh(spark, files, layers)
    assert {n: sorted(map(str, df.collect())) for n, df in published(spark, layers.gold).items()} == before
    assert {n: sorted(map(str, spark.table(f"{layers.gold}.{n}").collect())) for n in before} == before
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {layers.gold}").collect()]
    assert len(tables) == 8  # four views and their versions


def test_lines_that_do_not_fit_are_reported(spark, files, layers, tmp_path):
    (tmp_path / "raw/category/broken.csv").write_text("category_code,category_name\ntoy\nbks,Books,more\n")
    full_refresh(spark, files, layers)
    found = {r.table_name: (r.row_count, r.violations) for r in landing_report(spark, layers).collect()}
    assert found["brz_category"] == (5, 2) and found["brz_products"] == (2, 1) and found["brz_order_items"] == (4, 0)


def test_parses_are_counted_from_the_table_when_tasks_were_repeated(spark, files, layers, monkeypatch):
    refresh_bronze(spark, files, layers, ["order_items"])
    plain = refresh_items(spark, layers)
    get = Observation.get.fget
    monkeypatch.setattr(Observation, "get", property(lambda self: {k: 2 * v for k, v in get(self).items()}))
    key = lambda lines: sorted(map(tuple, lines))
    assert key(refresh_items(spark, layers)) == key(plain) and {r.row_count for r in plain} == {4}


def _items(spark, files, layers):
    refresh_bronze(spark, files, layers, ["order_items"])
    return refresh_items(spark, layers)


def test_a_refresh_counts_rounded_amounts(spark, files, layers):
    found = {line["check_name"]: line["violations"] for line in _items(spark, files, layers)}
    assert {n: v for n, v in found.items() if n.startswith("parses_exactly")} == {
        f"parses_exactly({n})": 0 for n in ("unit_price", "discount_pct", "tax_amount")
    }


def test_the_fact_needs_its_dimensions(spark, layers):
    with pytest.raises(LookupError, match="gld_dim_products"):
        refresh_fact(spark, layers)


def test_columns_bind_by_position_and_lineage_is_kept(spark, tmp_path):
    (tmp_path / "one.csv").write_text("x,y\nA, padded \n,\n")
    (tmp_path / "two.csv").write_text("y,x\nB,1\n")
    scan = with_audit(scan_csv(spark, f"{tmp_path}/*.csv", RAW["category"]))
    got = sorted((r.category_code or "", r.category_name, r._source_file.rsplit("/", 1)[1]) for r in scan.collect())
    assert got == [("", None, "one.csv"), ("A", " padded ", "one.csv"), ("B", "1", "two.csv")]
    assert scan.select("_ingested_at").distinct().count() == 1


def test_a_refresh_leaves_no_shuffle_files(spark, files, layers, shuffles_left):
    full_refresh(spark, files, layers)
    assert not shuffles_left()
