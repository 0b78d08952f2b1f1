"""Declared tables: schema, defaults and required columns. Loads never infer a schema.

Table and column names are fixed values: files and queries rely on them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

RUN_TS = "run_ts"  # default: the run's timestamp
UUID = "uuid"  # default: a new identifier per row
MONTH = "order_month"  # the partitions of sales tables
LOAD_RUN = "load_run"  # first partition of every table: the load that wrote the rows
LOAD_DAY = "load_day"  # last partition of tables that are read by the day they were loaded

# Column type names of external schema files.
TYPE_NAMES = {
    "STRING": "string",
    "INT64": "bigint",
    "INTEGER": "bigint",
    "FLOAT64": "double",
    "FLOAT": "double",
    "NUMERIC": "decimal(38,9)",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


@dataclass(frozen=True, eq=False)
class Table:
    """A declared table; `defaults` maps a column to RUN_TS, UUID or a literal.

    `month_of` maps a column to the date whose month it is; `cluster_by` orders
    the rows inside the files of a partitioned table. `load_day` names the stamp
    whose day is a further partition, so that a day's rows are found without
    reading the others.
    """

    layer: str
    name: str
    ddl: str
    defaults: Mapping[str, object] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    month_of: Mapping[str, str] = field(default_factory=dict)
    load_day: str | None = None

    @property
    def partitions(self) -> tuple[str, ...]:
        """Partition columns of a load's folder, outermost first."""
        return (*self.partition_by, *((LOAD_DAY,) if self.load_day else ()))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_STAMPED = "dwh_create_date"
_STAMP = {_STAMPED: RUN_TS}
_CUSTOMER = (
    "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, "
    "cst_marital_status string, cst_gndr string, cst_create_date date"
)
_SALES = "sls_sales bigint, sls_quantity bigint, sls_price bigint"
_CATEGORY = "id string, cat string, subcat string, maintenance string"

BRONZE = {
    t.name: t
    for t in (
        Table("bronze", "crm_cust_info", _CUSTOMER),
        Table(
            "bronze",
            "crm_prd_info",
            "prd_id bigint, prd_key string, prd_nm string, prd_cost bigint, prd_line string, "
            "prd_start_dt timestamp, prd_end_dt timestamp",
        ),
        Table(
            "bronze",
            "crm_sales_details",
            "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, "
            f"sls_order_dt bigint, sls_ship_dt bigint, sls_due_dt bigint, {_SALES}",
        ),
        Table("bronze", "erp_loc_a101", "cid string, cntry string"),
        Table("bronze", "erp_cust_az12", "cid string, bdate date, gen string"),
        Table("bronze", "erp_px_cat_g1v2", _CATEGORY),
    )
}

SILVER = {
    t.name: t
    for t in (
        Table("silver", "crm_cust_info", f"{_CUSTOMER}, dwh_create_date timestamp", _STAMP, load_day=_STAMPED),
        Table(
            "silver",
            "crm_prd_info",
            "prd_id bigint, cat_id string, prd_key string, prd_nm string, prd_cost bigint, prd_line string, "
            "prd_start_dt date, prd_end_dt date, dwh_create_date timestamp",
            _STAMP,
            load_day=_STAMPED,
        ),
        Table(
            "silver",
            "crm_sales_details",
            "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, "
            f"sls_order_dt date, sls_ship_dt date, sls_due_dt date, {_SALES}, dwh_create_date timestamp, {MONTH} date",
            _STAMP,
            partition_by=(MONTH,),
            cluster_by=("sls_cust_id", "sls_prd_key"),
            month_of={MONTH: "sls_order_dt"},
            load_day=_STAMPED,
        ),
        Table("silver", "erp_loc_a101", "cid string, cntry string, dwh_create_date timestamp", _STAMP),
        Table("silver", "erp_cust_az12", "cid string, bdate date, gen string, dwh_create_date timestamp", _STAMP),
        Table("silver", "erp_px_cat_g1v2", f"{_CATEGORY}, dwh_create_date timestamp", _STAMP),
    )
}

GOLD = {
    t.name: t
    for t in (
        Table(
            "gold",
            "dim_customers",
            "customer_key bigint, customer_id bigint, customer_number string, first_name string, last_name string, "
            "country string, marital_status string, gender string, birthdate date, create_date date",
        ),
        Table(
            "gold",
            "dim_products",
            "product_key bigint, product_id bigint, product_number string, product_name string, category_id string, "
            "category string, subcategory string, maintenance string, cost bigint, product_line string, "
            "start_date date",
        ),
        Table(
            "gold",
            "fact_sales",
            "order_number string, product_key bigint, customer_key bigint, order_date date, shipping_date date, "
            f"due_date date, sales_amount bigint, quantity bigint, price bigint, {MONTH} date",
            partition_by=(MONTH,),
            cluster_by=("customer_key", "product_key"),
            month_of={MONTH: "order_date"},
        ),
    )
}

SHOP_BRONZE = {
    t.name: t
    for t in (
        Table(
            "bronze",
            "customer",
            "cust_id string, cust_name string, email string, gender string, created_date string",
        ),
        Table("bronze", "products", "prod_id string, prod_name string, category string, price string"),
        Table("bronze", "sales", "sale_id string, cust_id string, prod_id string, qty string, sale_date string"),
    )
}

SHOP_SILVER = {
    t.name: t
    for t in (
        Table(
            "silver",
            "dim_customer",
            "customer_key bigint, cust_id bigint, first_name string, last_name string, email string, gender string, "
            "is_active boolean, created_date date, updated_at timestamp",
            {"is_active": True, "updated_at": RUN_TS},
        ),
        Table(
            "silver",
            "dim_products",
            "product_key bigint, prod_id bigint, prod_name string, category string, price decimal(38,9), "
            "updated_at timestamp",
            {"updated_at": RUN_TS},
            not_null=("prod_name",),
        ),
        Table(
            "silver",
            "fact_products_sales",
            "sale_key bigint, sale_id bigint, customer_key bigint, product_key bigint, qty bigint, "
            "total_price decimal(38,9), sale_date date, loaded_at timestamp",
            {"loaded_at": RUN_TS},
        ),
        Table(
            "silver",
            "rejected_sales",
            "sale_id bigint, raw_cust_id string, raw_prod_id string, raw_qty string, raw_sale_date string, "
            "reject_reason string, loaded_at timestamp",
            {"loaded_at": RUN_TS},
        ),
    )
}

# Step log and load log in one table: the load log's table, start and end are columns here.
LOAD_LOGS = Table(
    "audit",
    "load_logs",
    "log_id string, run_id string, seq bigint, procedure_name string, step_name string, table_name string, "
    "status string, records_loaded bigint, error_message string, error_state string, "
    "start_time timestamp, end_time timestamp, elapsed_seconds bigint, logged_at timestamp",
    {"log_id": UUID, "records_loaded": 0, "logged_at": RUN_TS},
    not_null=("procedure_name", "step_name", "status"),
)

STUDENTS = Table(
    "school",
    "students_table",
    "student_id bigint, student_name string, score decimal(38,9), updated_at timestamp",
    {"updated_at": RUN_TS},
    not_null=("student_name",),
)

STUDENT_LOGS = Table(
    "school",
    "student_logs",
    "log_id string, student_id bigint, action_performed string, old_score decimal(38,9), "
    "new_score decimal(38,9), changed_at timestamp",
    {"log_id": UUID, "changed_at": RUN_TS},
)


def schema_from_file_text(text: str) -> T.StructType:
    """Schema from an external file: a list of {name, type, mode} fields, or Spark's own JSON."""
    parsed = json.loads(text)
    if isinstance(parsed, dict):
        return T.StructType.fromJson(parsed)
    fields = []
    for f in parsed:
        type_name = TYPE_NAMES[f["type"].upper()]
        required = f.get("mode", "NULLABLE").upper() == "REQUIRED"
        column = T.StructType.fromDDL(f"c {type_name}")["c"]
        fields.append(T.StructField(f["name"], column.dataType, not required))
    return T.StructType(fields)
