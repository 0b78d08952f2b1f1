"""The scalar and table functions under their SQL names, for use in spark.sql().

Spark inlines single-expression SQL functions, so they optimise like columns.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tierhouse.functions.dates import DATE_FORMATS, date_shape
from tierhouse.functions.text import WHITESPACE

_TRIM = "btrim({0}, '" + "".join(f"\\u{ord(ch):04x}" for ch in WHITESPACE) + "')"


def _trimmed(name: str) -> str:
    return _TRIM.format(name)


def _parsed(text: str, fmt: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{date_shape(fmt)}' THEN try_to_date({text}, '{fmt}') END"


def _definitions() -> dict[str, str]:
    gender, price, day = _trimmed("p_gender_str"), _trimmed("p_price_str"), _trimmed("p_date_str")
    return {
        "clean_gender(p_gender_str STRING) RETURNS STRING": (
            f"CASE lower({gender}) WHEN 'm' THEN 'Male' WHEN 'male' THEN 'Male' "
            "WHEN 'f' THEN 'Female' WHEN 'female' THEN 'Female' ELSE 'n/a' END"
        ),
        "clean_price(p_price_str STRING) RETURNS DECIMAL(38,9)": (
            f"coalesce(try_cast(replace({price}, '$', '') AS DECIMAL(38,9)), CAST(0 AS DECIMAL(38,9)))"
        ),
        "parse_date_safe(p_date_str STRING) RETURNS DATE": (
            f"coalesce({', '.join(_parsed(day, f) for f in DATE_FORMATS)})"
        ),
        "calculate_final_score(p_theory_score DECIMAL(34,9), p_lab_score DECIMAL(34,9)) RETURNS DECIMAL(38,9)": (
            "CASE WHEN p_theory_score < 0 OR p_lab_score < 0 "
            "THEN CAST(raise_error('Scores cannot be negative') AS DECIMAL(38,9)) "
            "ELSE CAST(p_theory_score * 0.60 + p_lab_score * 0.40 AS DECIMAL(38,9)) END"
        ),
    }


def register(spark: SparkSession) -> list[str]:
    """Create the scalar functions in the session; returns their names."""
    names = []
    for signature, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        names.append(signature.split("(")[0])
    return names


def register_high_performers(spark: SparkSession, students: str, name: str = "get_high_performers") -> None:
    """Create the table function over the table or view `students` (s_id, s_name, s_grade)."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_min_grade DECIMAL(38,9)) "
        "RETURNS TABLE (s_id BIGINT, s_name STRING, s_grade DECIMAL(38,9)) "
        f"RETURN SELECT s_id, s_name, s_grade FROM {students} WHERE s_grade >= p_min_grade"
    )
