"""The same results in plain SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from starmill import fixed_values as fixed
from starmill.plans.contracts import BRONZE, DIM_CALENDAR, DIM_CUSTOMERS, DIM_PRODUCTS, FACT, SILVER
from starmill.workload.raw import COUNTRIES, CURRENCY_SPELLINGS, STATES


# Columns that differ from run to run, or hold a path.
NOT_COMPARED = {"_source_file", "_ingested_at", "_processed_at"}


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows) + ")"


_REGIONS = _values(
    (country, state, region)
    for country, states in fixed.REGION_BY_COUNTRY_STATE.items()
    for state, region in states.items()
)
_RATES = _values(fixed.INR_PER_UNIT.items())

_CODE = (
    "CASE p_type WHEN 'STANDARD' THEN 'GRCY' WHEN 'MEDIUM' THEN 'TOY' WHEN 'PROMO' THEN 'BKS'"
    " WHEN 'LARGE' THEN 'CE' WHEN 'ECONOMY' THEN 'APP' ELSE 'MISC' END"
)
_TITLE = "upper(p_type[1]) || lower(p_type[2:])"
_RECODED = (
    "CASE category_code WHEN 'GROCERY' THEN 'GRCY' WHEN 'TOYS' THEN 'TOY' WHEN 'BOOKS' THEN 'BKS'"
    " ELSE category_code END"
)
_MATERIAL = (
    "CASE material WHEN 'Coton' THEN 'Cotton' WHEN 'Ruber' THEN 'Rubber' WHEN 'Alumium' THEN 'Aluminium'"
    " ELSE material END"
)
_QUANTITY = (
    "TRY_CAST(CASE quantity WHEN 'One' THEN '1' WHEN 'Two' THEN '2' WHEN 'Three' THEN '3' ELSE quantity END"
    " AS INTEGER)"
)
_PRICE_TEXT = "replace(unit_price, '$', '')"
_PERCENT_TEXT = "replace(discount_pct, '%', '')"
_TAX_TEXT = r"regexp_replace(tax_amount, '[^0-9.\-]', '', 'g')"
_PRICE, _PERCENT, _TAX = (f"TRY_CAST({written} AS DOUBLE)" for written in (_PRICE_TEXT, _PERCENT_TEXT, _TAX_TEXT))
_ORDER_TIME = (
    "coalesce(try_strptime(order_ts, '%Y-%m-%d %H:%M:%S'), try_strptime(order_ts, '%d-%m-%Y %H:%M'))"
)
_ORDER_DAY = "CAST(try_strptime(dt, '%Y-%m-%d') AS DATE)"
_CHANNEL = "CASE channel WHEN 'web' THEN 'Website' WHEN 'app' THEN 'Mobile' ELSE channel END"


def _decimal(number: str, kind: str) -> str:
    """A double as the decimal that its shortest text stands for."""
    return f"TRY_CAST(CAST({number} AS VARCHAR) AS DECIMAL({kind}))"


def _date_id(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


# Relations that the statements below build on, in dependency order.
_RELATIONS = {
    "raw_brands": """
        SELECT CASE WHEN n % 3 = 0 THEN p_brand || '!' ELSE '@' || p_brand END AS brand_code,
               CASE WHEN n % 2 = 0 THEN '  Maker ' || n || '  ' ELSE 'Maker ' || n END AS brand_name,
               ['GROCERY', 'TOYS', 'BOOKS', 'GRCY', 'toys', 'CE'][CAST(n % 6 AS INTEGER) + 1] AS category_code
        FROM (SELECT DISTINCT p_brand, CAST(p_brand[7:] AS INTEGER) AS n FROM part)""",
    "raw_category": f"""
        SELECT CASE WHEN variant = 0 THEN lower(code) ELSE code END AS category_code,
               CASE WHEN variant = 0 THEN title ELSE title || ' goods' END AS category_name
        FROM (SELECT DISTINCT {_CODE} AS code, {_TITLE} AS title, p_partkey % 2 AS variant
              FROM part)""",
    "text_products": f"""
        SELECT 'P' || p_partkey AS product_id,
               'SKU-' || p_partkey AS sku,
               CASE WHEN p_partkey % 23 = 0 THEN 'void' WHEN p_partkey % 3 = 0 THEN lower({_CODE})
                    ELSE {_CODE} END AS category_code,
               CASE WHEN p_partkey % 19 = 0 THEN 'ghost' || p_partkey % 7 WHEN p_partkey % 4 = 0 THEN replace(p_brand, '#', '')
                    ELSE lower(replace(p_brand, '#', '')) END AS brand_code,
               split_part(p_name, ' ', 1) AS color,
               ['S', 'M', 'L', 'XL'][CAST(p_size % 5 AS INTEGER) + 1] AS size,
               ['Coton', 'Ruber', 'Alumium', 'Cotton', 'coton', 'Steel'][CAST(p_partkey % 7 AS INTEGER) + 1]
                   AS material,
               CASE WHEN p_partkey % 11 = 0 THEN 'heavy' WHEN p_partkey % 13 = 0 THEN NULL
                    WHEN p_partkey % 3 = 0 THEN CAST(p_size * 10 AS VARCHAR) ELSE p_size * 10 || 'g' END
                   AS weight_grams,
               CASE WHEN p_partkey % 17 = 0 THEN '1,2,5' WHEN p_partkey % 5 = 0 THEN p_size || '.5'
                    ELSE p_size || ',' || p_partkey % 10 END AS length_cm,
               CASE WHEN p_partkey % 23 = 0 THEN 'wide' ELSE p_size || '.' || p_partkey % 4 * 25 END AS width_cm,
               CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_size + p_partkey % 8 AS VARCHAR) END AS height_cm,
               CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '-' || (p_size + 1)
                    ELSE CAST(p_partkey % 997 AS VARCHAR) END AS rating_count
        FROM part""",
    "raw_products": """
        SELECT * REPLACE (TRY_CAST(width_cm AS FLOAT) AS width_cm, TRY_CAST(height_cm AS FLOAT) AS height_cm,
                          TRY_CAST(rating_count AS INTEGER) AS rating_count)
        FROM text_products""",
    "raw_customers": f"""
        SELECT CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'C' || c_custkey END AS customer_id,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
               'N' || n_nationkey AS country_code,
               {_list([*COUNTRIES, 'Atlantis'])}[CAST(n_nationkey % 9 AS INTEGER) + 1] AS country,
               {_list([*STATES, 'ZZ'])}[CAST(c_custkey % {len(STATES) + 2} AS INTEGER) + 1] AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "days": """
        SELECT CAST(o_orderdate AS DATE) AS day FROM orders
        UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem""",
    "raw_calendar": """
        SELECT strftime(day, '%d-%m-%Y') AS date, CAST(year(day) AS INTEGER) AS year,
               CASE day(day) % 3 WHEN 0 THEN upper(dayname(day)) WHEN 1 THEN lower(dayname(day))
                    ELSE dayname(day) END AS day_name,
               CAST(quarter(day) AS INTEGER) AS quarter, CAST(-week(day) AS INTEGER) AS week_of_year
        FROM days
        UNION ALL
        SELECT strftime(day, '%d-%m-%Y'), CAST(year(day) AS INTEGER), 'someday',
               CAST(CASE WHEN day(day) % 2 = 0 THEN quarter(day) ELSE 9 END AS INTEGER),
               CAST(-week(day) AS INTEGER)
        FROM days WHERE day(day) % 7 = 0""",
    "dated_items": """
        SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
               CASE WHEN l_orderkey % 997 = 1 THEN '98765432109' ELSE '' END ||
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) ||
               CASE WHEN l_orderkey % 31 = 5 THEN '0625' ELSE '' END AS price_text,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4))
                    AS VARCHAR) || CASE WHEN l_suppkey % 43 = 7 THEN '0004' ELSE '' END AS tax_text,
               lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
               lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0') AS minute_text
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_items": f"""
        SELECT day_text AS dt,
               CASE WHEN l_orderkey % 101 = 0 THEN 'not a time' WHEN l_orderkey % 103 = 0 THEN NULL
                    WHEN l_orderkey % 2 = 0
                    THEN day_text || ' ' || minute_text || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')
                    ELSE strftime(o_orderdate, '%d-%m-%Y') || ' ' || minute_text END AS order_ts,
               CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE 'C' || o_custkey END AS customer_id,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS item_seq,
               'P' || l_partkey AS product_id,
               CASE CAST(l_quantity AS INTEGER) WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three'
                    WHEN 4 THEN 'Four' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
               {_list(CURRENCY_SPELLINGS)}[CAST(o_custkey % 9 AS INTEGER) + 1] AS unit_price_currency,
               CASE WHEN l_partkey % 2 = 0 THEN '$' || price_text ELSE price_text END AS unit_price,
               CAST(l_discount * 100 AS DECIMAL(4,0)) || CASE WHEN l_suppkey % 37 = 5 THEN '.34567' ELSE '' END ||
                    CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE '%' END
                   AS discount_pct,
               CASE WHEN l_suppkey % 41 = 0 THEN 'n.a.' WHEN l_returnflag = 'R' THEN '-' || tax_text
                    WHEN l_suppkey % 4 = 0 THEN 'Tax ' || tax_text ELSE tax_text END AS tax_amount,
               ['web', 'app', 'Store'][CAST(l_orderkey % 4 AS INTEGER) + 1] AS channel,
               [' SAVE10 ', '   ', 'welcome'][CAST(l_orderkey % 5 AS INTEGER) + 1] AS coupon_code,
               'landing/order_items_' || strftime(l_shipdate, '%Y-%m') || '.csv' AS _source_file
        FROM dated_items""",
    "latest_items": """
        SELECT * FROM raw_items
        QUALIFY row_number() OVER (
            PARTITION BY order_id, item_seq
            ORDER BY _source_file DESC NULLS LAST, dt NULLS LAST, order_ts NULLS LAST, customer_id NULLS LAST,
                     product_id NULLS LAST, quantity NULLS LAST, unit_price_currency NULLS LAST,
                     unit_price NULLS LAST, discount_pct NULLS LAST, tax_amount NULLS LAST, channel NULLS LAST,
                     coupon_code NULLS LAST) = 1""",
    "latest_arrivals": """
        SELECT *, CAST(1 + CAST(regexp_extract(_source_file, '-(..).csv', 1) AS INTEGER) % 3 AS INTEGER) AS drop_number
        FROM raw_items
        QUALIFY row_number() OVER (
            PARTITION BY order_id, item_seq
            ORDER BY drop_number DESC, _source_file DESC NULLS LAST, dt NULLS LAST, order_ts NULLS LAST,
                     customer_id NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
                     unit_price_currency NULLS LAST, unit_price NULLS LAST, discount_pct NULLS LAST,
                     tax_amount NULLS LAST, channel NULLS LAST, coupon_code NULLS LAST) = 1""",
    "items": f"""
        SELECT * REPLACE ({_QUANTITY} AS quantity, {_PRICE} AS unit_price,
                          {_PERCENT} AS discount_pct, {_TAX} AS tax_amount,
                          lower(trim(coupon_code)) AS coupon_code, {_CHANNEL} AS channel, {_ORDER_DAY} AS dt,
                          {_ORDER_TIME} AS order_ts, TRY_CAST(item_seq AS INTEGER) AS item_seq)
        FROM latest_items""",
    "gross_items": f"""
        SELECT *, CAST(round(CAST(quantity AS DECIMAL(10,0)) * {_decimal('unit_price', '27,10')}, 2) AS DECIMAL(24,2))
                  AS gross_amount
        FROM items""",
    "discounted_items": f"""
        SELECT *, CAST(CAST(round(gross_amount * {_decimal('discount_pct', '13,8')}, 0) AS DECIMAL(36,0))
                       * CAST('0.01' AS DECIMAL(2,2)) AS DECIMAL(24,2)) AS discount_amount
        FROM gross_items""",
    "measured_items": f"""
        SELECT *, CAST(gross_amount - discount_amount AS DECIMAL(24,2)) AS net_amount,
               CAST(round(gross_amount - discount_amount + {_decimal('tax_amount', '27,10')}, 2) AS DECIMAL(24,2))
                   AS total_amount
        FROM discounted_items""",
    "rated_items": f"""
        SELECT m.*, CAST(round(total_amount * CAST(rate AS DECIMAL(12,6)), 2) AS DECIMAL(24,2)) AS total_amount_inr
        FROM measured_items m LEFT JOIN {_RATES} AS r(currency, rate)
             ON upper(trim(unit_price_currency)) = currency""",
    "rate_days": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE day(o_orderdate) IN (1, 11, 21)""",
    "rate_history": f"""
        SELECT currency, day AS valid_from,
               CAST(CAST(rate AS DECIMAL(12,6)) * CAST(80 + (dayofyear(day) * 7 + ascii(currency)) % 41 AS DECIMAL(3,0))
                    * CAST('0.01' AS DECIMAL(2,2)) AS DECIMAL(12,6)) AS inr_rate
        FROM rate_days CROSS JOIN {_RATES} AS r(currency, rate)
        WHERE currency <> 'SGD' OR day >= DATE '1995-01-01'""",
    "rated_then": """
        SELECT m.*, CAST(round(total_amount * inr_rate, 2) AS DECIMAL(24,2)) AS total_amount_inr
        FROM measured_items m ASOF LEFT JOIN rate_history h
             ON upper(trim(m.unit_price_currency)) = h.currency AND m.dt >= h.valid_from""",
    "clean_brands": f"""
        SELECT regexp_replace(brand_code, '[^a-zA-Z0-9]', '', 'g') AS brand_code, trim(brand_name) AS brand_name,
               {_RECODED} AS category_code
        FROM raw_brands""",
    "clean_category": """
        SELECT upper(category_code) AS category_code, min(category_name) AS category_name
        FROM raw_category GROUP BY 1""",
    "clean_products": f"""
        SELECT * REPLACE (TRY_CAST(replace(weight_grams, 'g', '') AS INTEGER) AS weight_grams,
                          TRY_CAST(replace(length_cm, ',', '.') AS FLOAT) AS length_cm,
                          upper(brand_code) AS brand_code, upper(category_code) AS category_code,
                          {_MATERIAL} AS material, CAST(coalesce(abs(rating_count), 0) AS INTEGER) AS rating_count)
        FROM raw_products""",
    "clean_customers": """
        SELECT * REPLACE (coalesce(phone, 'Not Available') AS phone)
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "dated_calendar": """
        SELECT * REPLACE (CAST(strptime(date, '%d-%m-%Y') AS DATE) AS date) FROM raw_calendar""",
    "one_per_day": """
        SELECT * FROM dated_calendar
        QUALIFY row_number() OVER (
            PARTITION BY date
            ORDER BY CAST(lower(day_name) = lower(dayname(date)) AS INTEGER) + CAST(quarter = quarter(date) AS INTEGER)
                     + CAST(abs(week_of_year) = week(date) AS INTEGER) DESC,
                     day_name NULLS LAST, quarter NULLS LAST, week_of_year NULLS LAST) = 1""",
    "clean_calendar": """
        SELECT * REPLACE (upper(day_name[1]) || lower(day_name[2:]) AS day_name,
                          CAST(abs(week_of_year) AS INTEGER) AS week_of_year),
               'Q' || quarter || '-' || year AS quarter_label,
               'Week' || abs(week_of_year) || '-' || year AS week_label
        FROM one_per_day""",
    "placed_customers": f"""
        SELECT c.*, coalesce(r.region, 'Other') AS region
        FROM clean_customers c LEFT JOIN {_REGIONS} AS r(country, state, region)
             ON c.country = r.country AND c.state = r.state""",
    "customers_dim": """
        SELECT customer_id, phone, country_code, country, state, region FROM placed_customers
        UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, 'Not Available'""",
    "snapshots": """
        SELECT 1 AS nth, DATE '1994-01-01' AS day, * FROM (
            SELECT *, CAST(customer_id[2:] AS BIGINT) AS k FROM placed_customers) WHERE k % 10 <> 3
        UNION ALL
        SELECT 2, DATE '1996-01-01', * REPLACE (
            CASE WHEN k % 4 = 1 THEN 'India' ELSE country END AS country,
            CASE WHEN k % 4 = 1 THEN 'MH' ELSE state END AS state,
            CASE WHEN k % 4 = 1 THEN 'West' ELSE region END AS region)
        FROM (SELECT *, CAST(customer_id[2:] AS BIGINT) AS k FROM placed_customers) WHERE k % 29 <> 5
        UNION ALL
        SELECT 3, DATE '1997-06-01', * REPLACE (
            CASE WHEN k % 6 = 2 THEN 'Canada' WHEN k % 4 = 1 THEN 'India' ELSE country END AS country,
            CASE WHEN k % 6 = 2 THEN 'BC' WHEN k % 4 = 1 THEN 'MH' ELSE state END AS state,
            CASE WHEN k % 6 = 2 THEN 'West' WHEN k % 4 = 1 THEN 'West' ELSE region END AS region,
            CASE WHEN k % 50 = 7 THEN 'Not Available' ELSE phone END AS phone)
        FROM (SELECT *, CAST(customer_id[2:] AS BIGINT) AS k FROM placed_customers)""",
    "versions": """
        SELECT customer_id, phone, country_code, country, state, region, min(day) AS effective_from,
               [DATE '1996-01-01', DATE '1997-06-01', NULL][CAST(max(nth) AS INTEGER)] AS effective_to,
               max(nth) = 3 AS is_current
        FROM (
            SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY customer_id ORDER BY nth) AS island FROM (
                SELECT *, coalesce(lag(nth) OVER w = nth - 1 AND lag(phone) OVER w IS NOT DISTINCT FROM phone
                          AND lag(country) OVER w IS NOT DISTINCT FROM country
                          AND lag(state) OVER w IS NOT DISTINCT FROM state
                          AND lag(region) OVER w IS NOT DISTINCT FROM region, false) AS same
                FROM snapshots WINDOW w AS (PARTITION BY customer_id ORDER BY nth)))
        GROUP BY customer_id, phone, country_code, country, state, region, island""",
    "products_dim": """
        SELECT p.product_id, p.sku, p.category_code, coalesce(c.category_name, 'Not Available') AS category_name,
               p.brand_code, coalesce(b.brand_name, 'Not Available') AS brand_name, p.color, p.size, p.material,
               p.weight_grams, p.length_cm, p.width_cm, p.height_cm, p.rating_count
        FROM clean_products p
        LEFT JOIN clean_category c ON p.category_code = c.category_code
        LEFT JOIN clean_brands b ON p.brand_code = upper(b.brand_code)""",
    "calendar_dim": f"""
        SELECT {_date_id('date')} AS date_id, date, year, monthname(date) AS month_name, day_name,
               CASE WHEN day_name IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend, quarter,
               quarter_label, week_of_year, week_label
        FROM clean_calendar""",
    "resolved_items": """
        SELECT i.* REPLACE (CASE WHEN d.customer_id IS NULL THEN '-1' ELSE i.customer_id END AS customer_id)
        FROM rated_items i LEFT JOIN customers_dim d ON i.customer_id = d.customer_id""",
    "fact": f"""
        SELECT {_date_id('dt')} AS date_id, dt AS transaction_date, order_ts AS transaction_ts,
               order_id AS transaction_id, item_seq AS seq_no, customer_id, product_id, channel, coupon_code,
               CASE WHEN coupon_code <> '' THEN 1 ELSE 0 END AS coupon_flag, unit_price_currency, quantity,
               unit_price, CAST(gross_amount AS DOUBLE) AS gross_amount, discount_pct AS discount_percent,
               CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_amount AS DOUBLE) AS net_amount,
               tax_amount, CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(total_amount_inr AS DOUBLE) AS total_amount_inr
        FROM resolved_items""",
}


def _with_relations(statement: str) -> str:
    """Prefix the relations a statement needs, directly or through others."""
    needed, pending = set(), [statement]
    while pending:
        text = f" {pending.pop()} "
        for name, body in _RELATIONS.items():
            if name not in needed and any(f" {name}{end}" in text for end in (" ", "\n", ")", ",", ";")):
                needed.add(name)
                pending.append(body)
    parts = [f"{name} AS ({body})" for name, body in _RELATIONS.items() if name in needed]
    return f"WITH {', '.join(parts)}\n{statement}" if parts else statement


def _unique(relation: str, table: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return f"""SELECT '{table}' AS table_name, 'unique({",".join(keys)})' AS check_name,
        (SELECT count(*) FROM {relation} ) AS row_count,
        (SELECT count(*) FROM {relation} ) - (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {relation} ))
            AS violations"""


def _not_null(relation: str, table: str, *keys: str) -> str:
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{table}' AS table_name, 'not_null({",".join(keys)})' AS check_name,
        count(*) AS row_count, count(*) FILTER (WHERE {missing}) AS violations FROM {relation} """


def _keys(relation: str, table: str, *keys: str) -> list[str]:
    return [_unique(relation, table, *keys), _not_null(relation, table, *keys)]


def _references(relation: str, table: str, column: str, value: str, dimension: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'references({column})' AS check_name, count(*) AS row_count,
        count(*) FILTER (WHERE NOT EXISTS (
            SELECT 1 FROM {dimension} d WHERE d.{column} = {value})) AS violations
        FROM {relation} f"""


def _parses(column: str, parsed: str) -> str:
    return f"""SELECT 'brz_order_items' AS table_name, 'parses({column})' AS check_name, count(*) AS row_count,
        count(*) FILTER (WHERE trim({column}) <> '' AND {parsed} IS NULL) AS violations FROM raw_items """


def _parses_exactly(column: str, written: str, number: str, kind: str) -> str:
    return f"""SELECT 'brz_order_items' AS table_name, 'parses_exactly({column})' AS check_name, count(*) AS row_count,
        count(*) FILTER (WHERE {number} IS NOT NULL AND TRY_CAST({_decimal(number, kind)} AS DECIMAL(38,18))
                         IS DISTINCT FROM TRY_CAST({written} AS DECIMAL(38,18))) AS violations FROM raw_items """


def _union(*statements: str) -> str:
    return "\nUNION ALL ".join(statements)


_DIMENSION_KEYS = (
    ("products_dim", "gld_dim_products", "product_id"),
    ("customers_dim", "gld_dim_customers", "customer_id"),
    ("calendar_dim", "gld_dim_calendar", "date_id"),
)
_CHECKED_KEYS = (
    *_DIMENSION_KEYS,
    ("raw_customers", "raw_customers", "customer_id"),
    ("raw_calendar", "raw_calendar", "date"),
)
_FACT_REFERENCES = [
    _references("fact", "gld_fact_order_items", column, f"f.{column}", dimension)
    for dimension, _, column in _DIMENSION_KEYS
]
_BATCH = "strftime(l_shipdate, '%Y-%m')"
_RAW_COLUMNS = (
    "dt, order_ts, customer_id, order_id, item_seq, product_id, quantity, unit_price_currency, unit_price,"
    " discount_pct, tax_amount, channel, coupon_code"
)


def _content(contract) -> str:
    """The sum over all rows of eight hexadecimal digits of the MD5 of the row's cells as text."""

    def text(name: str, kind: str) -> str:
        if kind in ("int", "float", "double"):
            billions = f"floor(CAST({name} AS DOUBLE) / 1e9)"
            rest = f"floor((CAST({name} AS DOUBLE) - {billions} * 1e9) * 1e6 + 0.5)"
            rest = f"CASE WHEN abs(CAST({name} AS DOUBLE)) < 1e12 THEN CAST({rest} AS BIGINT) WHEN {name} IS NOT NULL THEN 0 END"
            cell = f"CAST({billions} AS BIGINT) || ':' || {rest}"
        elif kind == "timestamp":
            cell = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
        else:
            cell = name
        return f"coalesce(CAST({cell} AS VARCHAR), '~')"

    cells = [text(f.name, f.dataType.simpleString()) for f in contract.schema.fields if f.name not in NOT_COMPARED]
    return f"coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(cells)})), 1, 8) AS BIGINT)), 0)"


def _layer_counts(run: int) -> list[str]:
    sources = {
        ("bronze", "brz_brands"): "raw_brands", ("bronze", "brz_category"): "raw_category",
        ("bronze", "brz_products"): "raw_products", ("bronze", "brz_customers"): "raw_customers",
        ("bronze", "brz_calendar"): "raw_calendar", ("bronze", "brz_order_items"): "raw_items",
        ("silver", "slv_brands"): "clean_brands", ("silver", "slv_category"): "clean_category",
        ("silver", "slv_products"): "clean_products", ("silver", "slv_customers"): "clean_customers",
        ("silver", "slv_calendar"): "clean_calendar", ("silver", "slv_order_items"): "items",
        ("gold", "gld_dim_products"): "products_dim", ("gold", "gld_dim_customers"): "customers_dim",
        ("gold", "gld_dim_calendar"): "calendar_dim", ("gold", "gld_fact_order_items"): "fact",
    }
    contracts = {c.name: c for c in (*BRONZE.values(), *SILVER.values(), DIM_PRODUCTS, DIM_CUSTOMERS, DIM_CALENDAR, FACT)}
    statements = []
    for (layer, name), relation in sources.items():
        statements.append(
            f"SELECT {run} AS run, '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count,"
            f" CAST({_content(contracts[name])} AS BIGINT) AS content, TRUE AS same_rows FROM {relation} "
        )
    return statements


_STATEMENTS = {
    "csv_scan": "SELECT *, TRUE AS has_source_file, TRUE AS has_ingest_time FROM raw_products ",
    "all_string_landing": f"SELECT {_RAW_COLUMNS} FROM raw_items ",
    "multi_file_scan": f"""
        SELECT {_BATCH} AS batch, count(*) AS row_count,
               count(DISTINCT l_orderkey || '/' || l_linenumber) AS line_count,
               count(*) FILTER (WHERE o_custkey % 50 <> 0) AS with_customer,
               max(CASE WHEN l_partkey % 2 = 0 THEN '$' || price_text ELSE price_text END) AS max_unit_price_text
        FROM dated_items GROUP BY 1""",
    "table_roundtrip": "SELECT *, 'customers.csv' AS _source_file FROM clean_customers ",
    "region_mapping_table": f"""
        SELECT r.country, r.state, r.region, count(c.country) AS customers
        FROM {_REGIONS} AS r(country, state, region)
        LEFT JOIN raw_customers c ON c.country = r.country AND c.state = r.state GROUP BY ALL""",
    "drop_null_keys": "SELECT * FROM raw_customers WHERE customer_id IS NOT NULL",
    "fill_sentinel": "SELECT * REPLACE (coalesce(phone, 'Not Available') AS phone) FROM raw_customers ",
    "silver_customers": "SELECT * FROM clean_customers ",
    "brand_clean": """
        SELECT regexp_replace(brand_code, '[^a-zA-Z0-9]', '', 'g') AS brand_code, trim(brand_name) AS brand_name,
               category_code FROM raw_brands """,
    "map_category_codes": f"SELECT brand_code, brand_name, {_RECODED} AS category_code FROM raw_brands ",
    "silver_brands": "SELECT * FROM clean_brands ",
    "dedup_category": "SELECT * FROM clean_category ",
    "product_clean": "SELECT * FROM clean_products ",
    "map_materials": f"SELECT product_id, {_MATERIAL} AS material FROM raw_products ",
    "rating_clean": """
        SELECT product_id, CAST(coalesce(abs(rating_count), 0) AS INTEGER) AS rating_count FROM raw_products """,
    "dedup_calendar": "SELECT * FROM one_per_day ",
    "period_labels": """
        SELECT * REPLACE (CAST(abs(week_of_year) AS INTEGER) AS week_of_year),
               'Q' || quarter || '-' || year AS quarter_label,
               'Week' || abs(week_of_year) || '-' || year AS week_label
        FROM raw_calendar """,
    "silver_calendar": "SELECT * FROM clean_calendar ",
    "parse_quantity": f"SELECT order_id, item_seq, product_id, {_QUANTITY} AS quantity FROM raw_items ",
    "clean_monetary": f"""
        SELECT order_id, item_seq, product_id, {_PRICE} AS unit_price,
               {_PERCENT} AS discount_pct, {_TAX} AS tax_amount FROM raw_items """,
    "parse_temporal": f"""
        SELECT order_id, TRY_CAST(item_seq AS INTEGER) AS item_seq, product_id, {_ORDER_DAY} AS dt,
               {_ORDER_TIME} AS order_ts FROM raw_items """,
    "standardize_categoricals": f"""
        SELECT order_id, item_seq, product_id, {_CHANNEL} AS channel, lower(trim(coupon_code)) AS coupon_code
        FROM raw_items """,
    "dedup_latest": "SELECT * FROM latest_items ",
    "silver_order_items": "SELECT *, TRUE AS has_processing_time FROM items ",
    "revenue_measures": """
        SELECT order_id, item_seq, quantity, unit_price, CAST(gross_amount AS DOUBLE) AS gross_amount,
               CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_amount AS DOUBLE) AS net_amount,
               CAST(total_amount AS DOUBLE) AS total_amount FROM measured_items """,
    "date_key": f"SELECT order_id, item_seq, dt, {_date_id('dt')} AS date_id FROM items ",
    "coupon_flag": """
        SELECT order_id, item_seq, coupon_code, CASE WHEN coupon_code <> '' THEN 1 ELSE 0 END AS coupon_flag
        FROM items """,
    "fx_convert": """
        SELECT order_id, item_seq, unit_price_currency, CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(total_amount_inr AS DOUBLE) AS total_amount_inr FROM rated_items """,
    "remap_orphans": "SELECT order_id, item_seq, customer_id, product_id FROM resolved_items ",
    "remap_orphans_shuffled": "SELECT order_id, item_seq, customer_id, product_id FROM resolved_items ",
    "remap_orphans_few_strays": "SELECT order_id, item_seq, customer_id, product_id FROM resolved_items ",
    "reconcile_revenue": """
        SELECT (SELECT count(*) FROM measured_items ) AS rows_before,
               (SELECT CAST(sum(total_amount) AS DOUBLE) FROM measured_items ) AS total_amount_before,
               count(*) FILTER (WHERE customer_id <> '-1') AS rows_known,
               CAST(sum(total_amount) FILTER (WHERE customer_id <> '-1') AS DOUBLE) AS total_amount_known,
               count(*) FILTER (WHERE customer_id = '-1') AS rows_unknown,
               CAST(sum(total_amount) FILTER (WHERE customer_id = '-1') AS DOUBLE) AS total_amount_unknown,
               TRUE AS agrees
        FROM resolved_items """,
    "customer_region": "SELECT customer_id, country, state, region FROM placed_customers ",
    "left_lookup_shuffled": """
        SELECT order_id, item_seq, product_id, category_name, brand_name FROM items LEFT JOIN products_dim USING (product_id) """,
    "dim_customers": "SELECT * FROM customers_dim ",
    "dim_products": "SELECT * FROM products_dim ",
    "dim_calendar": "SELECT * FROM calendar_dim ",
    "fact_order_items": "SELECT * FROM fact ",
    "check_grain": _union(*[_unique(*args) for args in _CHECKED_KEYS]),
    "check_not_null": _union(*[_not_null(*args) for args in _CHECKED_KEYS]),
    "check_grain_composite": _union(
        *_keys("raw_items", "raw_order_items", "order_id", "item_seq"),
        *_keys("items", "slv_order_items", "order_id", "item_seq"),
    ),
    "check_referential": _union(
        _references("raw_items", "raw_order_items", "product_id", "f.product_id", "products_dim"),
        _references("raw_items", "raw_order_items", "customer_id", "f.customer_id", "customers_dim"),
        _references("raw_items", "raw_order_items", "date_id", _date_id(_ORDER_DAY), "calendar_dim"),
        *_FACT_REFERENCES,
    ),
    "check_referential_counted": _union(
        _references("raw_items", "raw_order_items", "product_id", "f.product_id", "products_dim"),
        _references("raw_items", "raw_order_items", "customer_id", "f.customer_id", "customers_dim"),
        _references("raw_items", "raw_order_items", "date_id", _date_id(_ORDER_DAY), "calendar_dim"),
        *_FACT_REFERENCES,
    ),
    "dq_report": _union(
        *[line for args in _DIMENSION_KEYS for line in _keys(*args)],
        *_keys("clean_category", "slv_category", "category_code"),
        *_keys("clean_brands", "slv_brands", "brand_code"),
        *_keys("fact", "gld_fact_order_items", "transaction_id", "seq_no"),
        *_FACT_REFERENCES,
        _parses("quantity", _QUANTITY),
        _parses("unit_price", _PRICE),
        _parses("discount_pct", _PERCENT),
        _parses("tax_amount", _TAX),
        _parses("dt", _ORDER_DAY),
        _parses("order_ts", _ORDER_TIME),
        _parses("item_seq", "TRY_CAST(item_seq AS INTEGER)"),
        """SELECT 'gld_fact_order_items', 'keeps(rows)', (SELECT count(*) FROM fact ),
           abs((SELECT count(*) FROM fact ) - (SELECT count(*) FROM items ))""",
        """SELECT 'gld_fact_order_items', 'keeps(tax_amount)', (SELECT count(*) FROM fact ),
           (SELECT CAST(sum(t) IS DISTINCT FROM (SELECT sum(t) FROM (SELECT """ + _decimal("tax_amount", "38,10") + """ AS t FROM items ))
                   AS INTEGER) FROM (SELECT """ + _decimal("tax_amount", "38,10") + """ AS t FROM fact ))""",
        """SELECT 'gld_fact_order_items', 'holds(amounts)', count(*),
           count(*) FILTER (WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND discount_percent IS NOT NULL
                            AND tax_amount IS NOT NULL AND total_amount IS NULL) FROM fact """,
    ),
    "exact_amounts": _union(
        _parses_exactly("unit_price", _PRICE_TEXT, _PRICE, "27,10"),
        _parses_exactly("discount_pct", _PERCENT_TEXT, _PERCENT, "13,8"),
        _parses_exactly("tax_amount", _TAX_TEXT, _TAX, "27,10"),
    ),
    "schema_contract": _union(
        "SELECT 'gld_dim_customers' AS table_name, 'schema' AS check_name, count(*) AS row_count, 0 AS violations"
        " FROM customers_dim ",
        *_keys("customers_dim", "gld_dim_customers", "customer_id"),
        *[
            f"SELECT 'drifted_customers', 'schema({difference})', count(*), count(*) FROM customers_dim "
            for difference in (
                "phone: string, got absent",
                "state: string, got int",
                "telephone: absent, got string",
            )
        ],
    ),
    "incremental_landing": """
        SELECT dt, order_ts, customer_id, order_id, item_seq, product_id, quantity, unit_price_currency, unit_price,
               discount_pct, tax_amount, channel, coupon_code, drop_number FROM latest_arrivals """,
    "merged_lines": """
        SELECT dt, order_ts, customer_id, order_id, item_seq, product_id, quantity, unit_price_currency, unit_price,
               discount_pct, tax_amount, channel, coupon_code, drop_number FROM latest_arrivals """,
    "check_grain_bucketed": _union(*_keys("fact", "gld_fact_order_items", "transaction_id", "seq_no")),
    "fx_as_of": """
        SELECT order_id, item_seq, unit_price_currency, CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(total_amount_inr AS DOUBLE) AS total_amount_inr FROM rated_then """,
    "dim_customers_seeded": "SELECT * FROM customers_dim ",
    "fx_as_of_seeded": """
        SELECT order_id, item_seq, unit_price_currency, CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(total_amount_inr AS DOUBLE) AS total_amount_inr FROM rated_then """,
    "fx_as_of_shuffled": """
        SELECT order_id, item_seq, unit_price_currency, CAST(total_amount AS DOUBLE) AS total_amount,
               CAST(total_amount_inr AS DOUBLE) AS total_amount_inr FROM rated_then """,
    "customer_history": """
        SELECT * REPLACE (CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to)
        FROM versions """,
    "region_at_order_time": """
        SELECT i.order_id, i.item_seq, i.customer_id, v.region AS region_then, n.region AS region_now
        FROM items i
        LEFT JOIN versions v ON i.customer_id = v.customer_id AND i.dt >= v.effective_from
             AND (v.effective_to IS NULL OR i.dt < v.effective_to)
        LEFT JOIN versions n ON i.customer_id = n.customer_id AND n.is_current""",
    "quarantined_lines": """
        WITH lines AS (
            SELECT *, c_custkey % 50 = 7 AS short, c_custkey % 77 = 3 AS long, c_custkey % 91 = 5 AS typed FROM customer)
        SELECT 'C' || c_custkey || ',' || c_mktsegment || CASE WHEN short THEN '' WHEN long THEN ',' || c_nationkey || ',more'
                   ELSE ',n' || c_nationkey END AS line, 1::BIGINT AS row_count, 0::BIGINT AS with_nation
        FROM lines WHERE short OR long OR typed
        UNION ALL
        SELECT 'all', count(*), count(*) FILTER (WHERE NOT short AND (long OR NOT typed)) FROM lines""",
    "one_switch": _union(
        *[
            f"""SELECT CAST({n} AS INTEGER) AS refresh, '{name}' AS table_name, count(*) AS row_count,
                count(*) AS rows_together FROM {relation} """
            for n in (1, 2)
            for name, relation in (("gld_dim_products", "products_dim"), ("gld_dim_customers", "customers_dim"),
                                   ("gld_dim_calendar", "calendar_dim"), ("gld_fact_order_items", "fact"))
        ]
    ),
    "full_refresh_rerun": _union(*_layer_counts(1), *_layer_counts(2)),
}

ORACLES = {name: _with_relations(statement) for name, statement in _STATEMENTS.items()}
