"""Raw retail relations derived from the test tables, defects included.

The test tables are clean.  Each relation rebuilds one raw file from them, with the
defects the plans exist for, decided by key arithmetic so that a SQL statement can
derive the very same rows.  All cells are text, as in a file; ``bronze`` types them
the way the file scan does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from starmill import fixed_values as fixed
from starmill.plans.contracts import RAW
from starmill.session import ROW_GROUPS, scratch_path, shuffles_dropped

COUNTRIES = list(fixed.REGION_BY_COUNTRY_STATE)
STATES = [state for states in fixed.REGION_BY_COUNTRY_STATE.values() for state in states]
CURRENCY_SPELLINGS = ["INR", "aed", " AUD ", "CAD", "gbp", "SGD", "usd ", "XXX"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], position: str) -> str:
    """SQL: the value at a 0-based position, NULL past the end."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"try_element_at(array({listed}), CAST({position} AS INT) + 1)"


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = "CAST(substring(p_brand, 7) AS INT)"
    return (
        table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .selectExpr(
            f"CASE WHEN {n} % 3 = 0 THEN p_brand || '!' ELSE '@' || p_brand END AS brand_code",
            f"CASE WHEN {n} % 2 = 0 THEN '  Maker ' || {n} || '  ' ELSE 'Maker ' || {n} END AS brand_name",
            _pick(["GROCERY", "TOYS", "BOOKS", "GRCY", "toys", "CE"], f"{n} % 6") + " AS category_code",
        )
    )


_CATEGORY_CODE = (
    "CASE p_type WHEN 'STANDARD' THEN 'GRCY' WHEN 'MEDIUM' THEN 'TOY' WHEN 'PROMO' THEN 'BKS'"
    " WHEN 'LARGE' THEN 'CE' WHEN 'ECONOMY' THEN 'APP' ELSE 'MISC' END"
)


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code in two spellings with two names."""
    return (
        table(spark, sf_dir, "part")
        .select("p_type", F.expr("p_partkey % 2").alias("variant"))
        .distinct()
        .selectExpr(
            f"CASE WHEN variant = 0 THEN lower({_CATEGORY_CODE}) ELSE {_CATEGORY_CODE} END AS category_code",
            "CASE WHEN variant = 0 THEN initcap(p_type) ELSE initcap(p_type) || ' goods' END AS category_name",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "'P' || p_partkey AS product_id",
        "'SKU-' || p_partkey AS sku",
        # Some codes are in no file: their products have no category or brand name.
        f"CASE WHEN p_partkey % 23 = 0 THEN 'void' WHEN p_partkey % 3 = 0 THEN lower({_CATEGORY_CODE})"
        f" ELSE {_CATEGORY_CODE} END AS category_code",
        "CASE WHEN p_partkey % 19 = 0 THEN 'ghost' || p_partkey % 7 WHEN p_partkey % 4 = 0 THEN replace(p_brand, '#', '')"
        " ELSE lower(replace(p_brand, '#', '')) END AS brand_code",
        "split_part(p_name, ' ', 1) AS color",
        _pick(["S", "M", "L", "XL"], "p_size % 5") + " AS size",
        _pick(["Coton", "Ruber", "Alumium", "Cotton", "coton", "Steel"], "p_partkey % 7") + " AS material",
        "CASE WHEN p_partkey % 11 = 0 THEN 'heavy' WHEN p_partkey % 13 = 0 THEN NULL"
        " WHEN p_partkey % 3 = 0 THEN CAST(p_size * 10 AS STRING) ELSE p_size * 10 || 'g' END AS weight_grams",
        "CASE WHEN p_partkey % 17 = 0 THEN '1,2,5' WHEN p_partkey % 5 = 0 THEN p_size || '.5'"
        " ELSE p_size || ',' || p_partkey % 10 END AS length_cm",
        "CASE WHEN p_partkey % 23 = 0 THEN 'wide' ELSE p_size || '.' || p_partkey % 4 * 25 END AS width_cm",
        "CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_size + p_partkey % 8 AS STRING) END AS height_cm",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '-' || (p_size + 1)"
        " ELSE CAST(p_partkey % 997 AS STRING) END AS rating_count",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.selectExpr(
        "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'C' || c_custkey END AS customer_id",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END"
        " AS phone",
        "'N' || n_nationkey AS country_code",
        _pick([*COUNTRIES, "Atlantis"], "n_nationkey % 9") + " AS country",
        _pick([*STATES, "ZZ"], f"c_custkey % {len(STATES) + 2}") + " AS state",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order and ship date, some with contradictory copies."""
    ordered = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderdate AS DATE) AS day").distinct()
    shipped = table(spark, sf_dir, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS day").distinct()
    days = ordered.unionByName(shipped).distinct()
    text = "date_format(day, 'dd-MM-yyyy') AS date"
    sound = days.selectExpr(
        text,
        "CAST(year(day) AS STRING) AS year",
        "CASE day(day) % 3 WHEN 0 THEN upper(date_format(day, 'EEEE')) WHEN 1 THEN lower(date_format(day, 'EEEE'))"
        " ELSE date_format(day, 'EEEE') END AS day_name",
        "CAST(quarter(day) AS STRING) AS quarter",
        "CAST(-weekofyear(day) AS STRING) AS week_of_year",
    )
    contradictory = days.where("day(day) % 7 = 0").selectExpr(
        text,
        "CAST(year(day) AS STRING) AS year",
        "'someday' AS day_name",
        "CASE WHEN day(day) % 2 = 0 THEN CAST(quarter(day) AS STRING) ELSE '9' END AS quarter",
        "CAST(-weekofyear(day) AS STRING) AS week_of_year",
    )
    return sound.unionByName(contradictory)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their orders, as numbers and days, plus the ship month that names the batch file.

    Exchanges move these few bytes; ``item_texts`` makes the text of a row where it lands.  The join
    is a shuffle at every size, so its rows lie spread, however few row groups the source has.
    """
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE) AS ordered")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
        "l_discount",
        "CAST(round(l_tax * 100) AS BIGINT) AS tax_percent",
        "l_returnflag",
        "substring(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS batch",
    )
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def item_texts(lines: DataFrame, *others: str) -> DataFrame:
    """``order_lines`` as the text of their files, with the batch and ``others`` of their columns.

    Lines recur across batches (the test table repeats its line keys), numbers carry
    symbols or are spelled out, order times come in two layouts.
    """
    parts = (
        lines.withColumn("dt", F.expr("CAST(ordered AS STRING)"))
        .withColumn("tax_parts", F.expr("cents * tax_percent"))
        .withColumns(
            {
                "turned": F.expr("substring(dt, 9, 2) || '-' || substring(dt, 6, 2) || '-' || substring(dt, 1, 4)"),
                # Some prices are very large, some have more places than a cent has.
                "price": F.expr(
                    "CASE WHEN l_orderkey % 997 = 1 THEN '98765432109' ELSE '' END || (cents DIV 100) || '.' ||"
                    " lpad(CAST(cents % 100 AS STRING), 2, '0') || CASE WHEN l_orderkey % 31 = 5 THEN '0625' ELSE '' END"
                ),
                "tax": F.expr(
                    "(tax_parts DIV 10000) || '.' || lpad(CAST(tax_parts % 10000 AS STRING), 4, '0') ||"
                    " CASE WHEN l_suppkey % 43 = 7 THEN '0004' ELSE '' END"
                ),
                "at": F.expr(
                    "lpad(CAST(l_orderkey % 24 AS STRING), 2, '0') || ':' ||"
                    " lpad(CAST(l_linenumber * 7 AS STRING), 2, '0')"
                ),
            }
        )
    )
    return parts.selectExpr(
        "dt",
        "CASE WHEN l_orderkey % 101 = 0 THEN 'not a time' WHEN l_orderkey % 103 = 0 THEN NULL"
        " WHEN l_orderkey % 2 = 0 THEN dt || ' ' || at || ':' || lpad(CAST(l_partkey % 60 AS STRING), 2, '0')"
        " ELSE turned || ' ' || at END AS order_ts",
        "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE 'C' || o_custkey END AS customer_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(l_linenumber AS STRING) AS item_seq",
        "'P' || l_partkey AS product_id",
        "CASE CAST(l_quantity AS INT) WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three' WHEN 4 THEN 'Four'"
        " ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity",
        _pick(CURRENCY_SPELLINGS, "o_custkey % 9") + " AS unit_price_currency",
        "CASE WHEN l_partkey % 2 = 0 THEN '$' || price ELSE price END AS unit_price",
        "CAST(round(l_discount * 100) AS INT) || CASE WHEN l_suppkey % 37 = 5 THEN '.34567' ELSE '' END ||"
        " CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE '%' END AS discount_pct",
        "CASE WHEN l_suppkey % 41 = 0 THEN 'n.a.' WHEN l_returnflag = 'R' THEN '-' || tax"
        " WHEN l_suppkey % 4 = 0 THEN 'Tax ' || tax ELSE tax END AS tax_amount",
        _pick(["web", "app", "Store"], "l_orderkey % 4") + " AS channel",
        _pick([" SAVE10 ", "   ", "welcome"], "l_orderkey % 5") + " AS coupon_code",
        "batch",
        *others,
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_texts(order_lines(spark, sf_dir))


def typed(df: DataFrame, entity: str) -> DataFrame:
    """Text cells as the file scan would type them; bad fields become NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW[entity].fields])


RELATIONS = {
    "brands": brands,
    "category": category,
    "products": products,
    "customers": customers,
    "calendar": calendar,
    "order_items": order_items,
}

_written: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the test tables' files, so that changed tables are derived anew."""
    jvm, found = spark.sparkContext._jvm, []
    for pattern in (f"{sf_dir}/*.parquet", f"{sf_dir}/*.parquet/*"):
        at = jvm.org.apache.hadoop.fs.Path(pattern)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in files.globStatus(at) or []]
    return tuple(sorted(found))


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """The folder a writer filled, filled on first use per session and state of the tables."""
    wanted = (spark.conf.get("spark.app.id", ""), _state(spark, sf_dir), label)
    if wanted not in _written:
        path = scratch_path(spark, label)
        with shuffles_dropped(spark):
            write(path)
        _written[wanted] = path
    return _written[wanted]


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A raw relation as its bronze table holds it, without the run stamp.

    It is stored like the table it stands for, so that silver plans start from files.
    """
    rows = RELATIONS[entity](spark, sf_dir)
    if entity == "order_items":
        named = F.concat(F.lit("landing/order_items_"), F.col("batch"), F.lit(".csv"))
        rows = rows.withColumn("_source_file", named).drop("batch")
    else:
        rows = typed(rows, entity)
    # Rebalancing evens out files: the source may hold all rows in one row group.  The join of order
    # items has spread theirs.
    spread = rows if entity == "order_items" else rows.hint("rebalance")
    path = _once(spark, sf_dir, f"bronze-{entity}", spread.write.options(**ROW_GROUPS).parquet)
    return spark.read.schema(rows.schema).parquet(path)


KEEP_SPACES = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def by_batch(lines: DataFrame) -> DataFrame:
    """Lines brought together and sorted by batch, before they become text, which is several times as long."""
    return lines.repartition("batch").sortWithinPartitions("batch")


def _batch_files(lines: DataFrame) -> DataFrameWriter:
    """Writes one CSV file per batch of ``order_lines``."""
    return item_texts(by_batch(lines)).write.options(**KEEP_SPACES).partitionBy("batch")


def drop_files(lines: DataFrame, folder: str, minute: int) -> None:
    """Put ``order_lines`` down as one CSV file per batch, all last written in the same minute of one day."""
    spark = lines.sparkSession
    _batch_files(lines).csv(folder)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/*/*.csv")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(at):
        files.setTimes(status.getPath(), 1_700_000_000_000 + minute * 60_000, -1)


def landing(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """The glob of an entity's CSV files.  Order items fall into one file per ship month, whose
    path holds that month, like batch drops; they are packed, as text takes four times the room."""
    batched = entity == "order_items"
    if batched:
        writer = _batch_files(order_lines(spark, sf_dir)).option("compression", "gzip")
    else:
        writer = RELATIONS[entity](spark, sf_dir).write.options(**KEEP_SPACES)
    path = _once(spark, sf_dir, f"landing-{entity}", writer.csv)
    return f"{path}/*/*.csv.gz" if batched else f"{path}/*.csv"
