"""Silver into the star schema."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierhouse.functions import dates, rules
from tierhouse.operators.history import current_rows
from tierhouse.operators.joins import lookup
from tierhouse.operators.keys import continue_keys, surrogate_key
from tierhouse.operators.skew import same_keys
from tierhouse.plans.audit import Audit, Step, logged, run_independent, run_step
from tierhouse.schemas import GOLD, MONTH, SILVER
from tierhouse.scratch import written
from tierhouse.sources.warehouse import Warehouse

# The leading columns give the documented key order, the others only break ties.
CUSTOMER_ORDER = ("customer_id", "customer_number", "country", "birthdate", "gender")
PRODUCT_ORDER = ("start_date", "product_number", "product_id", "category", "subcategory")


@dataclass(frozen=True)
class GoldOptions:
    """How the layer is loaded.

    `mode`: full (reload tables), create (create table as), append (today's
    silver rows). `fact_window`: month (of `as_of`), all, loaded_today.
    `dedupe_existing` keeps an append from adding business keys again; the
    default appends whatever was stamped today, as often as it is run. With
    `run_id` an append that is repeated, say after a failure, replaces what the
    run has added before.
    """

    mode: str = "full"
    fact_window: str = "month"
    dedupe_existing: bool = False
    run_id: str | None = None


FULL = GoldOptions()
CREATE = GoldOptions(mode="create", fact_window="all")
APPEND = GoldOptions(mode="append", fact_window="loaded_today")


def customers(crm: DataFrame, erp: DataFrame, location: DataFrame) -> DataFrame:
    """Customer rows without key: CRM row, ERP birth date and gender, country."""
    with_erp = lookup(crm, erp, {"cst_key": "cid"}, {"_gen": "gen", "_bdate": "bdate"})
    with_country = lookup(with_erp, location, {"cst_key": "cid"}, {"_cntry": "cntry"})
    return with_country.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("_cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        rules.prefer("cst_gndr", "_gen").alias("gender"),
        F.col("_bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )


def products(crm: DataFrame, category: DataFrame) -> DataFrame:
    """Current product rows without key, with their category where it is known."""
    current = current_rows(crm, "prd_end_dt")
    looked = lookup(
        current, category, {"cat_id": "id"}, {"_cat": "cat", "_subcat": "subcat", "_maintenance": "maintenance"}
    )
    return looked.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("_cat").alias("category"),
        F.col("_subcat").alias("subcategory"),
        F.col("_maintenance").alias("maintenance"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )


def fact_slice(sales: DataFrame, window: str, as_of: dt.date | str | None) -> DataFrame:
    """Sales rows of the fact window; the filter is on plain columns, so it reaches the scan."""
    if window == "all":
        return sales
    if window == "month":
        sliced = sales.where(dates.in_month("sls_order_dt", as_of))
        # The stored table is partitioned by month: one partition is read.
        return sliced.where(F.col(MONTH) == F.trunc(F.lit(as_of).cast("date"), "MM")) if MONTH in sales.columns else sliced
    if window == "loaded_today":
        return sales.where(dates.on_day("dwh_create_date", as_of))
    raise ValueError(f"unknown fact window {window!r}")


def fact_sales(sales: DataFrame, dim_products: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Sales lines with surrogate keys; an unknown product or customer gives a NULL key."""
    with_product = lookup(sales, dim_products, {"sls_prd_key": "product_number"}, {"product_key": "product_key"})
    with_both = lookup(with_product, dim_customers, {"sls_cust_id": "customer_id"}, {"customer_key": "customer_key"})
    return with_both.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )


def loaded_on(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    return df.where(dates.on_day("dwh_create_date", as_of))


def missing_lines(lines: DataFrame, fact: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Of `lines`, as many of each as `fact` lacks; lines have no number of their own.

    Only months (partitions of the fact) and orders that `lines` touches are read
    and compared. The months collected are bounded by the calendar. Orders that
    both have are looked for by their numbers alone; whole lines are compared only
    if there are any. `batch` has the order numbers and dates of `lines`, where
    they can be read with less work.
    """
    batch = lines if batch is None else batch
    months = [r[0] for r in batch.select(F.trunc("order_date", "MM")).distinct().collect()]
    touched = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        touched = touched | F.col(MONTH).isNull()
    known = fact.where(touched).select(*lines.columns)
    numbers = lambda df, old: df.select("order_number", F.lit(old).alias("_old"))
    both = F.bool_or("_old") & F.bool_or(~F.col("_old"))
    seen = numbers(known, True).unionAll(numbers(batch, False)).groupBy("order_number").agg(both.alias("_both"))
    shared = written(seen.where("_both").select("order_number"), "shared-orders")
    if shared.isEmpty():
        return lines
    return lines.exceptAll(known.join(shared, same_keys(known, shared, ["order_number"]), "left_semi"))


def load(
    warehouse: Warehouse,
    run_ts: dt.datetime,
    as_of: dt.date | None = None,
    options: GoldOptions = FULL,
    audit: Audit | None = None,
    at_once: int = 2,
) -> Audit:
    """Both dimensions, then the fact that looks up their keys; fails fast."""
    as_of = as_of or run_ts.date()
    silver = {name: warehouse.read(table) for name, table in SILVER.items()}
    adding = options.mode == "append"
    add = lambda *args: warehouse.append(*args, options.run_id)
    write = {"full": warehouse.overwrite, "create": warehouse.create_as, "append": add}[options.mode]
    if options.mode != "create":
        warehouse.create(*GOLD.values())

    def dimension(name: str, build, order, key: str, business_key: str) -> Step:
        table = GOLD[name]

        def work() -> int:
            rows = build()
            if adding:
                known = [business_key] if options.dedupe_existing else None
                keyed = continue_keys(rows, warehouse.read(table, besides=options.run_id), order, key, known)
            else:
                keyed = surrogate_key(rows, order, key)
            return write(table, keyed, run_ts)

        return Step(f"LOAD_{name.upper()}", work, warehouse.name(table))

    def scoped(name: str) -> DataFrame:
        return warehouse.read_day(SILVER[name], as_of) if adding else silver[name]

    dims = [
        dimension(
            "dim_customers",
            lambda: customers(scoped("crm_cust_info"), silver["erp_cust_az12"], silver["erp_loc_a101"]),
            CUSTOMER_ORDER,
            "customer_key",
            "customer_id",
        ),
        dimension(
            "dim_products",
            lambda: products(scoped("crm_prd_info"), silver["erp_px_cat_g1v2"]),
            PRODUCT_ORDER,
            "product_key",
            "product_number",
        ),
    ]
    def fact() -> int:
        if options.fact_window == "loaded_today":
            lines = warehouse.read_day(SILVER["crm_sales_details"], as_of)
        else:
            lines = fact_slice(silver["crm_sales_details"], options.fact_window, as_of)
        built = fact_sales(lines, warehouse.read(GOLD["dim_products"]), warehouse.read(GOLD["dim_customers"]))
        if adding and options.dedupe_existing:
            # A lookup leaves order and date as they are, so these are taken from the lines before it.
            batch = lines.select(F.col("sls_ord_num").alias("order_number"), F.col("sls_order_dt").alias("order_date"))
            built = missing_lines(built, warehouse.read(GOLD["fact_sales"], besides=options.run_id), batch)
        return write(GOLD["fact_sales"], built, run_ts)

    with logged(warehouse, "gold.load", audit) as log:
        run_independent(log, dims, at_once)
        run_step(log, Step("LOAD_FACT_SALES", fact, warehouse.name(GOLD["fact_sales"])))
    return log
