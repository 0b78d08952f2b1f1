"""Bronze into cleansed silver tables.

The interactive and the scheduled load are the same build with other options.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierhouse.functions import dates, numbers, text
from tierhouse.operators.dedupe import keep_any, keep_latest
from tierhouse.operators.history import validity_end
from tierhouse.operators.skew import HOT_ROWS
from tierhouse.plans.audit import Audit, Step, logged, run_independent
from tierhouse.schemas import BRONZE, SILVER
from tierhouse.sources.warehouse import Warehouse


@dataclass(frozen=True)
class SilverOptions:
    """`name_style`: trim | title. `keep`: latest | any. `strict_dates` fails on impossible days."""

    name_style: str = "trim"
    keep: str = "latest"
    strict_dates: bool = True
    hot_rows: int = HOT_ROWS


INTERACTIVE = SilverOptions()
SCHEDULED = SilverOptions(name_style="title", keep="any")


def customers(bronze: DataFrame, options: SilverOptions = INTERACTIVE) -> DataFrame:
    """One cleansed row per customer id."""
    if options.keep == "latest":
        rows = keep_latest(bronze, ["cst_id"], ["cst_create_date"])
    elif options.keep == "any":
        rows = keep_any(bronze, ["cst_id"])
    else:
        raise ValueError(f"unknown keep {options.keep!r}")
    return rows.select(
        "cst_id",
        "cst_key",
        text.clean_name("cst_firstname", options.name_style).alias("cst_firstname"),
        text.clean_name("cst_lastname", options.name_style).alias("cst_lastname"),
        text.marital_status("cst_marital_status").alias("cst_marital_status"),
        text.gender_code("cst_gndr").alias("cst_gndr"),
        "cst_create_date",
    )


def products(bronze: DataFrame, options: SilverOptions = INTERACTIVE) -> DataFrame:
    """Product versions with validity ranges.

    The range runs over the composed key, so it is built before the key is
    split. Source end dates lie before their start dates and are not read.
    """
    ranged = validity_end(bronze, ["prd_key"], "prd_start_dt", "prd_end_dt", ["prd_id"], options.hot_rows)
    return ranged.select(
        "prd_id",
        text.category_of_key("prd_key").alias("cat_id"),
        text.product_of_key("prd_key").alias("prd_key"),
        "prd_nm",
        numbers.null_to_zero("prd_cost").alias("prd_cost"),
        text.product_line("prd_line").alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        "prd_end_dt",
    )


def sales(bronze: DataFrame, options: SilverOptions = INTERACTIVE) -> DataFrame:
    """Sales lines with dates decoded and measures repaired from the raw values."""
    day = lambda c: dates.date_from_number(c, options.strict_dates).alias(c)
    measures = ("sls_sales", "sls_quantity", "sls_price")
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        day("sls_order_dt"),
        day("sls_ship_dt"),
        day("sls_due_dt"),
        numbers.repair_sales(*measures).alias("sls_sales"),
        "sls_quantity",
        numbers.repair_price(*measures).alias("sls_price"),
    )


def erp_customers(bronze: DataFrame, as_of: dt.date | str) -> DataFrame:
    return bronze.select(
        text.strip_prefix("cid").alias("cid"),
        dates.future_to_null("bdate", as_of).alias("bdate"),
        text.gender("gen").alias("gen"),
    )


def locations(bronze: DataFrame) -> DataFrame:
    return bronze.select(text.strip_separator("cid").alias("cid"), text.country("cntry").alias("cntry"))


def categories(bronze: DataFrame) -> DataFrame:
    return bronze.select("id", "cat", "subcat", "maintenance")


def load(
    warehouse: Warehouse,
    run_ts: dt.datetime,
    as_of: dt.date | None = None,
    options: SilverOptions = INTERACTIVE,
    audit: Audit | None = None,
    at_once: int = 4,
) -> Audit:
    """All six silver tables, each fully reloaded and stamped with `run_ts`; fails fast."""
    as_of = as_of or run_ts.date()
    builds = {
        "crm_cust_info": lambda b: customers(b, options),
        "crm_prd_info": lambda b: products(b, options),
        "crm_sales_details": lambda b: sales(b, options),
        "erp_cust_az12": lambda b: erp_customers(b, as_of),
        "erp_loc_a101": locations,
        "erp_px_cat_g1v2": categories,
    }

    def step(name: str) -> Step:
        table, build = SILVER[name], builds[name]
        warehouse.create(table)
        work = lambda: warehouse.overwrite(table, build(warehouse.read(BRONZE[name])), run_ts)
        return Step(f"LOAD_{name.upper()}", work, warehouse.name(table))

    with logged(warehouse, "silver.load", audit) as log:
        run_independent(log, [step(n) for n in builds], at_once)
    return log
