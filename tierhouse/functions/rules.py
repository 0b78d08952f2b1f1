"""Business rules on columns: bands, eligibility, precedence, guarded values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierhouse.functions.text import NOT_AVAILABLE, _col, template

# Grade bands and remarks.
GRADE_BANDS = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
GRADE_REMARKS = (
    (("A",), "Excellent Performance!"),
    (("B", "C"), "Good Performance."),
    (("D",), "Needs Improvement."),
)
GRADE_REMARK_DEFAULT = "Fail. Please retake the course."
PASS_SCORE = 50
MIN_ATTENDANCE = 75
MINIMUM_AGE = 18


def band(c: Column | str, lower_bounds: Sequence[tuple[float, str]] = GRADE_BANDS, default: str = "F") -> Column:
    """Label of the first lower bound the value reaches; bounds run from high to low."""
    value, out = _col(c), None
    for bound, label in lower_bounds:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(default)


def label_map(
    c: Column | str,
    branches: Sequence[tuple[Sequence[str], str]] = GRADE_REMARKS,
    default: str | None = GRADE_REMARK_DEFAULT,
) -> Column:
    """Label of the branch that lists the value."""
    value, out = _col(c), None
    for values, label in branches:
        hit = value.isin(*values)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def pass_line(score: Column | str) -> Column:
    s = _col(score)
    return F.when(s >= PASS_SCORE, template("Score: %s. Status: PASSED", s)).otherwise(
        template("Score: %s. Status: FAILED", s)
    )


def eligible(score: Column | str, attendance: Column | str) -> Column:
    """Both thresholds reached; NULL inputs do not qualify."""
    return F.coalesce((_col(score) >= PASS_SCORE) & (_col(attendance) >= MIN_ATTENDANCE), F.lit(False))


def eligibility_reason(score: Column | str, attendance: Column | str) -> Column:
    s, a = _col(score), _col(attendance)
    return (
        F.when(eligible(s, a), template("Eligible for graduation. Attendance: %s%%, Score: %s", a, s))
        .when(s >= PASS_SCORE, template("Not eligible due to low attendance. Attendance: %s%%", a))
        .otherwise(template("Not eligible due to low score. Score: %s", s))
    )


def prefer(first: Column | str, second: Column | str, missing: str = NOT_AVAILABLE) -> Column:
    """`first` unless it is NULL or the `missing` label, else `second`, else the label."""
    a, b = _col(first), _col(second)
    return F.when(a != missing, a).otherwise(F.coalesce(b, F.lit(missing)))


def weighted_score(theory: Column | str, lab: Column | str, strict: bool = True) -> Column:
    """60 % theory and 40 % lab in decimals; a negative score fails the job (or gives NULL)."""
    t, l = _col(theory).cast("decimal(34,9)"), _col(lab).cast("decimal(34,9)")
    score = (t * F.lit("0.60").cast("decimal(2,2)") + l * F.lit("0.40").cast("decimal(2,2)")).cast("decimal(38,9)")
    negative = (t < 0) | (l < 0)
    bad = F.raise_error(F.lit("Scores cannot be negative")).cast("decimal(38,9)") if strict else F.lit(None)
    return F.when(negative, bad).otherwise(score)


def underage_message(age: Column | str, minimum: int = MINIMUM_AGE) -> Column:
    return template(
        "Student is underage for this course. Age provided: %s. "
        f"Minimum required age: {minimum}. Hint: enroll the student in a junior level course instead.",
        _col(age),
    )


def require(value: Column | str, holds: Column, message: Column) -> Column:
    """`value` where the rule holds (or is unknown); elsewhere the job fails with `message`."""
    col = _col(value)
    return F.when(F.coalesce(holds, F.lit(True)), col).otherwise(F.raise_error(message))


def error_class(message: Column | str) -> Column:
    """Class of an error by its text."""
    text = _col(message)
    return (
        F.when(F.contains(text, F.lit("division by zero")), "An error occurred: Cannot divide by zero!")
        .when(text.isNotNull(), "An unexpected error occurred.")
    )
