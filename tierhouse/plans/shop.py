"""The small shop warehouse: two dimensions, a validated fact, checks and a summary.

Text bronze tables, isolated steps: a failing step is logged and the next one
still runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierhouse.functions import dates, numbers, text
from tierhouse.operators.joins import lookup
from tierhouse.operators.keys import surrogate_key
from tierhouse.operators.validation import (
    REASON,
    Rule,
    accepted,
    non_empty_checks,
    rejected,
    row_counts,
    with_reason,
)
from tierhouse.plans.audit import INFO, Audit, Step, load_summary, run_step
from tierhouse.schemas import LOAD_LOGS, SHOP_BRONZE, SHOP_SILVER
from tierhouse.scratch import scratch_scope, written
from tierhouse.sources.warehouse import Warehouse

# The reject messages; the tables' names are filled in first, the raw value for %s.
REJECT_MESSAGES = {
    "unknown_customer": "Customer ID %s does not exist in {customers}",
    "unknown_product": "Product ID %s does not exist in {products}",
    "invalid_quantity": "Invalid quantity value (%s)",
    "invalid_date": "Invalid sale date value (%s)",
}
RAW_SALES = ("raw_cust_id", "raw_prod_id", "raw_qty", "raw_sale_date")


def _loadable(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(text.is_digits(key) & text.is_present(name))


def dim_customer(bronze: DataFrame, pre_trim: bool = False) -> DataFrame:
    """Customers with a numeric id and a name; names are split before trimming unless `pre_trim`."""
    rows = _loadable(bronze, "cust_id", "cust_name").select(
        numbers.hard_long("cust_id").alias("cust_id"),
        text.name_part("cust_name", 0, pre_trim).alias("first_name"),
        text.name_part("cust_name", 1, pre_trim).alias("last_name"),
        text.clean_email("email").alias("email"),
        text.gender("gender").alias("gender"),
        dates.parse_date("created_date").alias("created_date"),
    )
    return surrogate_key(rows, ["cust_id", "email", "first_name", "last_name"], "customer_key")


def dim_products(bronze: DataFrame) -> DataFrame:
    rows = _loadable(bronze, "prod_id", "prod_name").select(
        numbers.hard_long("prod_id").alias("prod_id"),
        text.ws_trim("prod_name").alias("prod_name"),
        text.ws_trim("category").alias("category"),
        numbers.parse_price("price").alias("price"),
    )
    return surrogate_key(rows, ["prod_id", "prod_name", "category", "price"], "product_key")


def staged_sales(bronze: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every sale with its parsed values, looked-up keys and raw texts."""
    parsed = bronze.select(
        numbers.hard_long("sale_id").alias("sale_id"),
        numbers.safe_long("cust_id").alias("_cust"),
        numbers.safe_long("prod_id").alias("_prod"),
        numbers.safe_long("qty").alias("qty"),
        dates.parse_date("sale_date").alias("sale_date"),
        F.col("cust_id").alias("raw_cust_id"),
        F.col("prod_id").alias("raw_prod_id"),
        F.col("qty").alias("raw_qty"),
        F.col("sale_date").alias("raw_sale_date"),
    )
    keyed = lookup(parsed, customers, {"_cust": "cust_id"}, {"customer_key": "customer_key"})
    priced = lookup(keyed, products, {"_prod": "prod_id"}, {"product_key": "product_key", "unit_price": "price"})
    return priced.drop("_cust", "_prod")


def sales_rules(customer_table: str = "silver.dim_customer", product_table: str = "silver.dim_products") -> list[Rule]:
    """Rejection rules in the order in which they are reported."""
    failing = {
        "unknown_customer": (F.col("customer_key").isNull(), "raw_cust_id"),
        "unknown_product": (F.col("product_key").isNull(), "raw_prod_id"),
        "invalid_quantity": (F.col("qty").isNull() | (F.col("qty") <= 0), "raw_qty"),
        "invalid_date": (F.col("sale_date").isNull(), "raw_sale_date"),
    }
    texts = {k: m.format(customers=customer_table, products=product_table) for k, m in REJECT_MESSAGES.items()}
    return [Rule(k, fails, text.template(texts[k], F.col(raw))) for k, (fails, raw) in failing.items()]


def fact_products_sales(flagged: DataFrame) -> DataFrame:
    """Accepted sales with key and exact total price."""
    rows = accepted(flagged).select(
        "sale_id",
        "customer_key",
        "product_key",
        "qty",
        numbers.exact_amount("qty", "unit_price").alias("total_price"),
        "sale_date",
    )
    return surrogate_key(rows, ["sale_id", "customer_key", "product_key", "sale_date", "qty"], "sale_key")


def rejected_sales(flagged: DataFrame) -> DataFrame:
    return rejected(flagged).select("sale_id", *RAW_SALES, REASON)


def load(
    warehouse: Warehouse, run_ts: dt.datetime, audit: Audit | None = None, pre_trim: bool = False
) -> tuple[Audit, DataFrame, DataFrame]:
    """The whole load; returns the audit, the check lines and the summary lines."""
    audit = audit or Audit("silver.load_silver_data")
    warehouse.create(*SHOP_SILVER.values())
    audit.record("START_PIPELINE", INFO, error_message="Pipeline loading sequence initiated.")
    read, silver = warehouse.read, SHOP_SILVER

    def load_customer() -> int:
        return warehouse.overwrite(
            silver["dim_customer"], dim_customer(read(SHOP_BRONZE["customer"]), pre_trim), run_ts
        )

    def load_products() -> int:
        return warehouse.overwrite(silver["dim_products"], dim_products(read(SHOP_BRONZE["products"])), run_ts)

    def load_sales() -> int:
        staged = staged_sales(read(SHOP_BRONZE["sales"]), read(silver["dim_customer"]), read(silver["dim_products"]))
        # Feeds two tables: written once instead of joined twice.
        flagged = written(with_reason(staged, sales_rules()), "staged-sales")
        warehouse.overwrite(silver["rejected_sales"], rejected_sales(flagged), run_ts)
        return warehouse.overwrite(silver["fact_products_sales"], fact_products_sales(flagged), run_ts)

    steps = (
        Step("LOAD_DIM_CUSTOMER", load_customer, warehouse.name(silver["dim_customer"])),
        Step("LOAD_DIM_PRODUCTS", load_products, warehouse.name(silver["dim_products"])),
        Step("LOAD_FACT_SALES", load_sales, warehouse.name(silver["fact_products_sales"])),
    )
    with scratch_scope(warehouse.spark):
        for step in steps:
            run_step(audit, step, isolate=True)

    run_id = audit.run_id
    audit.flush(warehouse)
    return audit, checks(warehouse), load_summary(read(LOAD_LOGS), run_id)


def checks(warehouse: Warehouse) -> DataFrame:
    """Row-count check lines of the three silver tables."""
    names = ("dim_customer", "dim_products", "fact_products_sales")
    return non_empty_checks(row_counts({f"silver.{n}": warehouse.read(SHOP_SILVER[n]) for n in names}))


def inspect(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The tables to look at after a run."""
    logs = warehouse.read(LOAD_LOGS)
    silver = {n: warehouse.read(SHOP_SILVER[n]) for n in ("dim_customer", "dim_products", "fact_products_sales")}
    shown = ("log_id", "step_name", "status", "records_loaded", "error_message", "logged_at")
    return {
        "load_logs": logs.orderBy("logged_at", "seq").select(*shown),
        "dim_customer": silver["dim_customer"].drop("is_active"),
        **{n: silver[n] for n in ("dim_products", "fact_products_sales")},
    }
