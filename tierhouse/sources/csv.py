"""CSV landing files with a declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierhouse.schemas import BRONZE, Table

# Columns bind by position and the header line is skipped; a bad value fails
# the load. The odd nullValue keeps an unquoted empty field (NULL) apart from a
# quoted one (empty text).
READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "FAILFAST",
    "quote": '"',
    "escape": '"',
    "nullValue": "\u0000",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class Landing:
    """One manifest entry: files (a path or glob below the landing folder) and their table."""

    path: str
    table: Table


# File of each source table below the landing folder.
MANIFEST = (
    Landing("source_crm/cust_info.csv", BRONZE["crm_cust_info"]),
    Landing("source_crm/prd_info.csv", BRONZE["crm_prd_info"]),
    Landing("source_crm/sales_details.csv", BRONZE["crm_sales_details"]),
    Landing("source_erp/LOC_A101.csv", BRONZE["erp_loc_a101"]),
    Landing("source_erp/CUST_AZ12.csv", BRONZE["erp_cust_az12"]),
    Landing("source_erp/PX_CAT_G1V2.csv", BRONZE["erp_px_cat_g1v2"]),
)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Typed rows of one path, several, or a glob such as `landing/*.csv`."""
    return spark.read.schema(schema).options(**READ_OPTIONS).csv(paths if isinstance(paths, str) else list(paths))


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Files that read_csv() reads back unchanged; text with line breaks is not supported."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def read_landing(
    spark: SparkSession, folder: str, manifest: Iterable[Landing] = MANIFEST
) -> dict[Table, DataFrame]:
    """One DataFrame per manifest entry."""
    root = folder.rstrip("/")
    return {e.table: read_csv(spark, f"{root}/{e.path}", e.table.schema) for e in manifest}
