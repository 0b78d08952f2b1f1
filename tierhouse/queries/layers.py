"""The silver and gold builds over source tables derived from the given ones.

Each order is a customer snapshot, each year of a part's shipments a product
version and each line item a sales line, with dirt added by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierhouse.operators.keys import continue_keys, surrogate_key
from tierhouse.plans import gold, silver
from tierhouse.queries.registry import plain, query
from tierhouse.scratch import scratch_path
from tierhouse.sources.warehouse import timestamp_lit, write_by_month

AS_OF = "1998-07-15"
WS = "' ' || chr(9)"

CRM_CUSTOMER = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE c_custkey END AS cst_id,
  'AW' || lpad(CAST(c_custkey AS STRING), 8, '0') AS cst_key,
  '  ' || lower(c_mktsegment) || ' ' AS cst_firstname,
  'o-' || lower(o_orderpriority) || chr(9) AS cst_lastname,
  CASE o_orderkey % 4 WHEN 0 THEN ' s' WHEN 1 THEN 'M' WHEN 2 THEN '' ELSE NULL END AS cst_marital_status,
  CASE o_orderkey % 5 WHEN 0 THEN 'f ' WHEN 1 THEN 'M' WHEN 2 THEN 'x' ELSE NULL END AS cst_gndr,
  CAST(o_orderdate AS DATE) AS cst_create_date
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""

CRM_PRODUCT = """
SELECT CAST(l_partkey * 100 + ship_year - 1990 AS BIGINT) AS prd_id,
  upper(substr(p_type, 1, 2)) || '-' || upper(substr(p_name, 1, 2)) || '-P' || lpad(CAST(l_partkey AS STRING), 8, '0') AS prd_key,
  p_name AS prd_nm,
  CASE WHEN ship_year % 3 = 0 THEN NULL ELSE CAST(round(p_retailprice) AS BIGINT) + ship_year END AS prd_cost,
  CASE p_size % 6 WHEN 0 THEN 'M ' WHEN 1 THEN ' r' WHEN 2 THEN 'S' WHEN 3 THEN 't' WHEN 4 THEN '' ELSE NULL END AS prd_line,
  CAST(first_ship AS TIMESTAMP) AS prd_start_dt, CAST('1990-01-01 00:00:00' AS TIMESTAMP) AS prd_end_dt
FROM (SELECT l_partkey, CAST(year(l_shipdate) AS BIGINT) AS ship_year, min(l_shipdate) AS first_ship
  FROM {lineitem} GROUP BY l_partkey, year(l_shipdate)) v JOIN {part} ON l_partkey = p_partkey"""

CRM_SALES = """
SELECT 'SO' || CAST(l_orderkey AS STRING) AS sls_ord_num,
  CASE WHEN l_orderkey % 19 = 0 THEN 'unknown' ELSE 'P' || lpad(CAST(l_partkey AS STRING), 8, '0') END AS sls_prd_key,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS sls_cust_id,
  CASE WHEN l_orderkey % 31 = 0 THEN CAST(0 AS BIGINT) WHEN l_orderkey % 37 = 0 THEN CAST(199807 AS BIGINT)
       ELSE CAST(replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') AS BIGINT) END AS sls_order_dt,
  CAST(replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '') AS BIGINT) AS sls_ship_dt,
  CASE WHEN l_linenumber = 1 THEN NULL
       ELSE CAST(replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '') AS BIGINT) END AS sls_due_dt,
  CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN CAST(-5 AS BIGINT) WHEN 2 THEN CAST(7 AS BIGINT)
       ELSE CAST(round(l_quantity) AS BIGINT) * CAST(round(l_extendedprice) AS BIGINT) END AS sls_sales,
  CASE WHEN l_orderkey % 13 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(l_quantity) AS BIGINT) END AS sls_quantity,
  CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS BIGINT)
       WHEN 2 THEN -CAST(round(l_extendedprice) AS BIGINT) ELSE CAST(round(l_extendedprice) AS BIGINT) END AS sls_price
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""

ERP_CUSTOMER = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || 'AW' || lpad(CAST(c_custkey AS STRING), 8, '0') AS cid,
  CAST('1930-01-01' AS DATE) + CAST(c_custkey * 37 % 30000 AS INT) AS bdate,
  CASE c_custkey % 6 WHEN 0 THEN 'Female' WHEN 1 THEN ' m' WHEN 2 THEN '' WHEN 3 THEN 'F' WHEN 4 THEN 'MALE ' ELSE NULL END AS gen
FROM {customer}"""

ERP_LOCATION = """
SELECT 'AW-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS cid,
  CASE n_nationkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN ' USA' WHEN 2 THEN 'US' WHEN 3 THEN '' WHEN 4 THEN NULL
       WHEN 5 THEN 'de' ELSE ' ' || n_name || chr(9) END AS cntry
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""

ERP_CATEGORY = """
SELECT DISTINCT upper(substr(p_type, 1, 2)) || '_' || upper(substr(p_name, 1, 2)) AS id, p_type AS cat,
  upper(substr(p_name, 1, 2)) AS subcat, CASE WHEN p_type = 'LARGE' THEN 'Yes' ELSE 'No' END AS maintenance
FROM {part} WHERE p_type <> 'PROMO'"""


# The SQL each build must agree with, one common table per rule. Codes, labels and output names are fixed values.
_LABELS = """labels(kind, code, label) AS (VALUES
  ('marital', 'S', 'Single'), ('marital', 'M', 'Married'), ('gender', 'F', 'Female'), ('gender', 'M', 'Male'),
  ('gender', 'FEMALE', 'Female'), ('gender', 'MALE', 'Male'), ('line', 'M', 'Mountain'), ('line', 'R', 'Road'),
  ('line', 'S', 'Other Sales'), ('line', 'T', 'Touring'), ('country', 'DE', 'Germany'), ('country', 'US', 'United States'),
  ('country', 'USA', 'United States'))"""


def _label(kind, column, long_codes=True):
    """The label of a code by lookup; `long_codes` also takes codes that are words."""
    short = "" if long_codes else " AND length(code) = 1"
    return f"coalesce((SELECT label FROM labels WHERE kind = '{kind}' AND code = upper(trim({column}, {WS})){short}), 'n/a')"


def _title(column):
    runs = f"regexp_extract_all(lower(trim({column}, {WS})), '([a-z0-9]+|[^a-z0-9]+)')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1:1]) || t[2:]), '')"


def _customer_sql(clean, order):
    return f"""WITH {_LABELS}, raw AS ({plain(CRM_CUSTOMER)}),
one_each AS (SELECT DISTINCT ON (cst_id) * FROM raw WHERE cst_id IS NOT NULL ORDER BY cst_id, {order})
SELECT cst_id, cst_key, {clean('cst_firstname')} AS cst_firstname, {clean('cst_lastname')} AS cst_lastname,
  {_label('marital', 'cst_marital_status')} AS cst_marital_status, {_label('gender', 'cst_gndr', False)} AS cst_gndr,
  cst_create_date
FROM one_each"""


_TEXTS = ("cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")
_REST = ", ".join(f"{c} NULLS FIRST" for c in _TEXTS)
S_CUSTOMER = _customer_sql(lambda c: f"trim({c}, {WS})", f"cst_create_date DESC NULLS LAST, {_REST}")
S_CUSTOMER_SCHEDULED = _customer_sql(_title, f"{_REST}, cst_create_date NULLS FIRST")

S_PRODUCT = f"""WITH {_LABELS}, raw AS ({plain(CRM_PRODUCT)}),
placed AS (SELECT *, row_number() OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST, prd_id) AS place FROM raw),
closing AS (SELECT prd_key AS of_key, place - 1 AS of_place, date_add(CAST(prd_start_dt AS DATE), INTERVAL (-1) DAY) AS last_day
  FROM placed)
SELECT prd_id, string_split(prd_key, '-')[1] || '_' || string_split(prd_key, '-')[2] AS cat_id,
  regexp_replace(prd_key, '^.{{6}}', '') AS prd_key, prd_nm, ifnull(prd_cost, 0) AS prd_cost, {_label('line', 'prd_line')} AS prd_line,
  CAST(prd_start_dt AS DATE) AS prd_start_dt, CAST(last_day AS DATE) AS prd_end_dt
FROM placed LEFT JOIN closing ON of_key = prd_key AND of_place = place"""


def _day(column):
    eight = f"CAST({column} AS VARCHAR)"
    parts = f"make_date({column} // 10000, {column} // 100 % 100, {column} % 100)"
    return f"CASE WHEN {eight} SIMILAR TO '[0-9]{{8}}' THEN {parts} END AS {column}"


S_SALES = f"""WITH raw AS ({plain(CRM_SALES)}),
derived AS (SELECT *, sls_quantity * abs(sls_price) AS expected,
  CASE WHEN sls_quantity <> 0 THEN sls_sales // sls_quantity END AS unit FROM raw)
SELECT sls_ord_num, sls_prd_key, sls_cust_id, {_day('sls_order_dt')}, {_day('sls_ship_dt')}, {_day('sls_due_dt')},
  if(sls_sales > 0 AND (expected IS NULL OR sls_sales = expected), sls_sales, expected) AS sls_sales, sls_quantity,
  if(sls_price > 0, sls_price, unit) AS sls_price
FROM derived"""

S_ERP_CUSTOMER = f"""WITH {_LABELS}, raw AS ({plain(ERP_CUSTOMER)})
SELECT regexp_replace(cid, '^NAS', '') AS cid, if(CAST(bdate AS DATE) <= DATE '{AS_OF}', CAST(bdate AS DATE), NULL) AS bdate,
  {_label('gender', 'gen')} AS gen
FROM raw"""

S_LOCATION = f"""WITH {_LABELS}, raw AS ({plain(ERP_LOCATION)}), trimmed AS (SELECT cid, nullif(trim(cntry, {WS}), '') AS place FROM raw)
SELECT replace(cid, '-', '') AS cid,
  coalesce((SELECT label FROM labels WHERE kind = 'country' AND code = place), place, 'n/a') AS cntry
FROM trimmed"""

S_CATEGORY = plain(ERP_CATEGORY)

G_CUSTOMER = f"""WITH person AS ({S_CUSTOMER}), birth AS ({S_ERP_CUSTOMER}), home AS ({S_LOCATION})
SELECT rank() OVER (ORDER BY cst_id) AS customer_key, cst_id AS customer_id, cst_key AS customer_number,
  cst_firstname AS first_name, cst_lastname AS last_name, home.cntry AS country, cst_marital_status AS marital_status,
  coalesce(nullif(cst_gndr, 'n/a'), birth.gen, 'n/a') AS gender, birth.bdate AS birthdate, cst_create_date AS create_date
FROM person LEFT JOIN birth ON birth.cid = person.cst_key LEFT JOIN home ON home.cid = person.cst_key"""

G_PRODUCT = f"""WITH version AS ({S_PRODUCT}), class AS ({S_CATEGORY}), open_version AS (SELECT * FROM version WHERE prd_end_dt IS NULL)
SELECT rank() OVER (ORDER BY prd_start_dt NULLS FIRST, prd_key) AS product_key, prd_id AS product_id,
  prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, class.cat AS category, class.subcat AS subcategory,
  class.maintenance, prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
FROM open_version LEFT JOIN class ON class.id = open_version.cat_id"""

G_SALES = f"""WITH line AS ({S_SALES}), product_of AS (SELECT product_number, product_key FROM ({G_PRODUCT}) x),
customer_of AS (SELECT customer_id, customer_key FROM ({G_CUSTOMER}) y)
SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
  sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
FROM line LEFT JOIN customer_of ON customer_id = sls_cust_id LEFT JOIN product_of ON product_number = sls_prd_key"""


def _silver_customers(src, options=silver.INTERACTIVE):
    return silver.customers(src.sql(CRM_CUSTOMER), options)


def _silver_products(src):
    return silver.products(src.sql(CRM_PRODUCT))


@query("silver_customers", S_CUSTOMER)
def silver_customers(src):
    return _silver_customers(src)


@query("silver_customers_scheduled", S_CUSTOMER_SCHEDULED)
def silver_customers_scheduled(src):
    return _silver_customers(src, silver.SCHEDULED)


@query("silver_products", S_PRODUCT)
def silver_products(src):
    return _silver_products(src)


@query("silver_sales", S_SALES)
def silver_sales(src):
    return silver.sales(src.sql(CRM_SALES))


@query("silver_erp_customers", S_ERP_CUSTOMER)
def silver_erp_customers(src):
    return silver.erp_customers(src.sql(ERP_CUSTOMER), AS_OF)


@query("silver_locations", S_LOCATION)
def silver_locations(src):
    return silver.locations(src.sql(ERP_LOCATION))


@query("silver_categories", S_CATEGORY)
def silver_categories(src):
    return silver.categories(src.sql(ERP_CATEGORY))


def _gold_customers(src):
    rows = gold.customers(
        _silver_customers(src),
        silver.erp_customers(src.sql(ERP_CUSTOMER), AS_OF),
        silver.locations(src.sql(ERP_LOCATION)),
    )
    return surrogate_key(rows, gold.CUSTOMER_ORDER, "customer_key")


def _gold_products(src):
    rows = gold.products(_silver_products(src), silver.categories(src.sql(ERP_CATEGORY)))
    return surrogate_key(rows, gold.PRODUCT_ORDER, "product_key")


def _gold_sales(src, window):
    lines = gold.fact_slice(silver.sales(src.sql(CRM_SALES)), window, AS_OF)
    return gold.fact_sales(lines, _gold_products(src), _gold_customers(src))


@query("gold_dim_customers", G_CUSTOMER)
def gold_dim_customers(src):
    return _gold_customers(src)


@query("gold_dim_products", G_PRODUCT)
def gold_dim_products(src):
    return _gold_products(src)


@query("gold_fact_sales", G_SALES)
def gold_fact_sales(src):
    return _gold_sales(src, "all")


@query(
    "gold_fact_sales_month",
    f"SELECT * FROM ({G_SALES}) f WHERE date_trunc('month', order_date) = date_trunc('month', DATE '{AS_OF}')",
)
def gold_fact_sales_month(src):
    return _gold_sales(src, "month")


_MONTHS = f"""SELECT order_number, product_key, customer_key, order_date, sales_amount,
  CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM ({G_SALES}) f"""


@query("gold_fact_by_month", _MONTHS)
def gold_fact_by_month(src):
    path = scratch_path(src.spark, "fact-by-month")
    write_by_month(_gold_sales(src, "all"), path, "order_date", ["customer_key", "product_key"])
    columns = ["order_number", "product_key", "customer_key", "order_date", "sales_amount", "order_month"]
    back = "order_number string, product_key bigint, customer_key bigint, order_date date, sales_amount bigint, order_month date"
    return src.spark.read.schema(back).parquet(path).select(columns)


# Customers last seen from 2001 on count as loaded today and are appended once more.
@query(
    "gold_append_customers",
    f"""WITH dim AS ({G_CUSTOMER}), today AS (SELECT DISTINCT customer_id FROM dim WHERE create_date >= DATE '2001-01-01')
SELECT customer_key, customer_id FROM dim
UNION ALL SELECT (SELECT coalesce(max(customer_key), 0) FROM dim) + row_number() OVER (ORDER BY customer_id), customer_id FROM today""",
)
def gold_append_customers(src):
    dim = _gold_customers(src)
    loaded = F.when(F.col("create_date") >= "2001-01-01", timestamp_lit("2026-01-02 03:04:05")).otherwise(
        timestamp_lit("2026-01-01 03:04:05")
    )
    stamped = dim.drop("customer_key").withColumn("dwh_create_date", loaded)
    today = gold.loaded_on(stamped, "2026-01-02").drop("dwh_create_date")
    added = continue_keys(today, dim, gold.CUSTOMER_ORDER, "customer_key")
    return dim.unionByName(added).select("customer_key", "customer_id")
