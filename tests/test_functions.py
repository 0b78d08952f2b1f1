import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierhouse.functions import dates, numbers, rules, sql, text


def one_column(spark, values, type_name, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_name}")
    return [r[0] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_trim_removes_all_whitespace(spark):
    got = one_column(spark, ["  a b\t\n", " x　", "", None, " \r\n"], "string", text.ws_trim)
    assert got == ["a b", "x", "", None, ""]


def test_code_tables(spark):
    assert one_column(spark, [" s", "M", "", None, "x", "m\t"], "string", text.marital_status) == [
        "Single", "Married", "n/a", "n/a", "n/a", "Married",
    ]
    assert one_column(spark, ["f ", "female", "MALE", "m", None, "?"], "string", text.gender) == [
        "Female", "Female", "Male", "Male", "n/a", "n/a",
    ]
    assert one_column(spark, ["f", "Female"], "string", text.gender_code) == ["Female", "n/a"]
    assert one_column(spark, ["R ", "s", "T", "m", "", None], "string", text.product_line) == [
        "Road", "Other Sales", "Touring", "Mountain", "n/a", "n/a",
    ]


def test_country_is_case_sensitive_and_passes_unknown_through(spark):
    values = ["DE", "US", "USA ", "", None, " Canada ", "de", "  "]
    assert one_column(spark, values, "string", text.country) == [
        "Germany", "United States", "United States", "n/a", "n/a", "Canada", "de", "n/a",
    ]


def test_title_case(spark):
    values = ["o-brien mc.donald VAN", "ÉLAN vital", "o'neil", "", None, "-x"]
    assert one_column(spark, values, "string", text.title_case) == [
        "O-Brien Mc.Donald Van", "Élan Vital", "O'neil", "", None, "-X",
    ]


def test_name_part_splits_the_untrimmed_name(spark):
    values = ["  John Doe  ", "Alice Smith", " Bob Johnson ", "Solo", None]
    part = lambda i, **kw: one_column(spark, values, "string", lambda c: text.name_part(c, i, **kw))
    assert part(0) == ["", "Alice", "", "Solo", None]
    assert part(1) == ["", "Smith", "Bob", None, None]
    assert part(0, pre_trim=True) == ["John", "Alice", "Bob", "Solo", None]
    assert part(1, pre_trim=True) == ["Doe", "Smith", "Johnson", None, None]


def test_keys(spark):
    values = ["AC-HE-HL-U509-R", "AC", None]
    assert one_column(spark, values, "string", text.category_of_key) == ["AC_HE", "AC", None]
    assert one_column(spark, values, "string", text.product_of_key) == ["HL-U509-R", "", None]
    assert one_column(spark, ["NASAW1", "AW1", "NAS", None], "string", text.strip_prefix) == ["AW1", "AW1", "", None]
    assert one_column(spark, ["AW-0-1", None], "string", text.strip_separator) == ["AW01", None]


def test_digits_and_presence(spark):
    values = ["12", "12\n", " 12", "1a", "", None]
    assert one_column(spark, values, "string", text.is_digits) == [True, False, False, False, False, None]
    assert one_column(spark, ["a", " \t", "", None], "string", text.is_present) == [True, False, False, False]


def test_safe_and_hard_integers(spark):
    values = [" 2 ", "1.5", "abc", "", None, "-7"]
    assert one_column(spark, values, "string", numbers.safe_long) == [2, None, None, None, None, -7]
    assert one_column(spark, [" 2 ", None], "string", numbers.hard_long) == [2, None]
    with pytest.raises(Exception, match="not an integer: abc"):
        one_column(spark, ["abc"], "string", numbers.hard_long)


def test_price(spark):
    values = ["$1200.50", " free ", "", None, "abc", "15.75", "$$3"]
    got = one_column(spark, values, "string", numbers.parse_price)
    assert got == [Decimal(x) for x in ("1200.5", "0", "0", "0", "0", "15.75", "3")]


def test_measure_repair_truth_table(spark):
    # sales, quantity, price -> repaired sales, repaired price
    table = [
        (10, 2, 5, 10, 5),
        (None, 2, 5, 10, 5),
        (None, 2, None, None, None),
        (10, 2, None, 10, 5),
        (0, 2, None, None, 0),
        (7, 2, -5, 10, 3),
        (10, 0, None, 10, None),
        (-10, 2, 0, 0, -5),
    ]
    df = spark.createDataFrame(table, "s bigint, q bigint, p bigint, want_s bigint, want_p bigint")
    got = df.select(
        numbers.repair_sales("s", "q", "p").alias("s2"), numbers.repair_price("s", "q", "p").alias("p2"), "want_s", "want_p"
    )
    assert got.schema["p2"].dataType.simpleString() == "bigint"
    for r in got.collect():
        assert (r.s2, r.p2) == (r.want_s, r.want_p)


def test_integer_price_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-7, 2, None)], "s bigint, q bigint, p bigint")
    assert df.select(numbers.repair_price("s", "q", "p")).first()[0] == -3


def test_exact_amount_keeps_nine_decimals(spark):
    df = spark.createDataFrame([(2, Decimal("1.123456789"))], "q bigint, p decimal(38,9)")
    got = df.select(numbers.exact_amount("q", "p").alias("x"))
    assert got.schema["x"].dataType.simpleString() == "decimal(38,9)"
    assert got.first()[0] == Decimal("2.246913578")


def test_exact_amount_over_the_whole_range(spark):
    cases = [(1, "1E19"), (10**9, "1E15"), (10**18, "1E9"), (-1, "99999999999999999999999999999.999999999"), (3, "-0.000000001")]
    cases += [(-(2**63), "3.999999999"), (2**63 - 1, "-0.000000009"), (10**10, "9999999999999999999.123456789"), (None, "1"), (10_000_000_000, "1.5"), (9_223_372_036_854_775_807, "123456789.123456789"), (-3, "1234567890123456789.000000001"), (0, "5")]
    df = spark.createDataFrame([(q, Decimal(p)) for q, p in cases], "q bigint, p decimal(38,9)")
    import decimal

    with decimal.localcontext() as wide:
        wide.prec = 60
        assert [r[0] for r in df.select(numbers.exact_amount("q", "p")).collect()] == [None if q is None else q * Decimal(p) for q, p in cases]
    beyond = spark.createDataFrame([(10**10, Decimal("1E19"))], "q bigint, p decimal(38,9)")
    with pytest.raises(Exception):
        beyond.select(numbers.exact_amount("q", "p")).collect()


def test_weighted_score_of_wide_values(spark):
    df = spark.createDataFrame([(Decimal("1234567890123456789012345.000000001"), Decimal(5))], "t decimal(38,9), l decimal(38,9)")
    assert df.select(rules.weighted_score("t", "l")).first()[0] == Decimal("740740734074074073407409.000000001")


def test_fallbacks(spark):
    df = spark.createDataFrame([(10, 0), (9, 2), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(numbers.divide_or("a", "b")).collect()] == [0.0, 4.5, 0.0]
    assert one_column(spark, ["7", "NotANumber", None], "string", lambda c: numbers.cast_or(c, "bigint", -1)) == [7, -1, None]


def test_yyyymmdd(spark):
    values = [20101229, 0, 2010122, None, 201012290]
    assert one_column(spark, values, "bigint", dates.date_from_number) == [dt.date(2010, 12, 29), None, None, None, None]
    with pytest.raises(Exception, match="not a yyyymmdd date: 20101332"):
        one_column(spark, [20101332], "bigint", dates.date_from_number)
    assert one_column(spark, [20101332], "bigint", lambda c: dates.date_from_number(c, strict=False)) == [None]


def test_date_formats(spark):
    values = ["2026-01-15", "12-02-2026", "2026/03/20", " 2026-1-5 ", "invalid_date", "", None, "2026-02-30"]
    want = [dt.date(2026, 1, 15), dt.date(2026, 2, 12), dt.date(2026, 3, 20), dt.date(2026, 1, 5), None, None, None, None]
    assert one_column(spark, values, "string", dates.parse_date) == want
    sql.register(spark)
    assert one_column(spark, values, "string", lambda c: F.call_function("parse_date_safe", c)) == want
    # A short year counts as a year, so the first format wins; nothing else is tried for year 0 or extra text.
    odd = ["05-06-26", "0000-01-01", "2026-01-15x", "2026-01-15 10:00:00", "31/12/2026", "2026-001-05"]
    assert one_column(spark, odd, "string", dates.parse_date) == [dt.date(5, 6, 26), None, None, None, None, None]


def test_dates_agree_with_the_format_driven_parse(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(400):
        y, m, d = rng.randint(1, 3000), rng.randint(0, 14), rng.randint(0, 33)
        pad = rng.choice(["", "02"])
        y, m, d = f"{y}", f"{m:{pad}}", f"{d:{pad}}"
        texts.append(rng.choice([f"{y}-{m}-{d}", f"{d}-{m}-{y}", f"{y}/{m}/{d}"]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.coalesce(*[F.try_to_date("t", f) for f in dates.DATE_FORMATS])
    assert df.where(~dates.parse_date("t").eqNullSafe(slow)).collect() == []


def test_date_windows(spark):
    days = [dt.date(2025, 12, 31), dt.date(2026, 1, 1), dt.date(2026, 1, 31), dt.date(2026, 2, 1), None]
    got = one_column(spark, days, "date", lambda c: dates.in_month(c, "2026-01-15"))
    assert got == [False, True, True, False, None]
    assert one_column(spark, days, "date", lambda c: dates.future_to_null(c, "2026-01-01")) == [
        dt.date(2025, 12, 31), dt.date(2026, 1, 1), None, None, None,
    ]


def test_bands_and_eligibility(spark):
    assert one_column(spark, [95, 85, 70, 60, 12, None], "int", rules.band) == ["A", "B", "C", "D", "F", "F"]
    remark = lambda c: rules.label_map(rules.band(c))
    assert one_column(spark, [95, 85, 65, 1], "int", remark) == [
        "Excellent Performance!", "Good Performance.", "Needs Improvement.", "Fail. Please retake the course.",
    ]
    df = spark.createDataFrame([(85, 92), (85, 10), (10, 92)], "s int, a int")
    got = df.select(rules.eligible("s", "a"), rules.eligibility_reason("s", "a"), rules.pass_line("s")).collect()
    assert [tuple(r) for r in got] == [
        (True, "Eligible for graduation. Attendance: 92%, Score: 85", "Score: 85. Status: PASSED"),
        (False, "Not eligible due to low attendance. Attendance: 10%", "Score: 85. Status: PASSED"),
        (False, "Not eligible due to low score. Score: 10", "Score: 10. Status: FAILED"),
    ]


def test_precedence(spark):
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")], "a string, b string")
    assert [r[0] for r in df.select(rules.prefer("a", "b")).collect()] == ["Male", "Female", "n/a", "Male"]


def test_weighted_score(spark):
    df = spark.createDataFrame([(80, 90)], "t int, l int")
    assert df.select(rules.weighted_score("t", "l")).first()[0] == Decimal(84)
    bad = spark.createDataFrame([(-1, 90)], "t int, l int")
    with pytest.raises(Exception, match="Scores cannot be negative"):
        bad.select(rules.weighted_score("t", "l")).collect()
    assert bad.select(rules.weighted_score("t", "l", strict=False)).first()[0] is None


def test_require_raises_a_full_message(spark):
    df = spark.createDataFrame([(16,)], "age int")
    with pytest.raises(Exception, match="Age provided: 16. Minimum required age: 18"):
        df.select(rules.require("age", F.col("age") >= 18, rules.underage_message("age"))).collect()
    assert one_column(spark, [18, None], "int", lambda c: rules.require(c, c >= 18, rules.underage_message(c))) == [18, None]


def test_error_class(spark):
    values = ["x: division by zero: 10 / 0", "Bad int64 value", None]
    assert one_column(spark, values, "string", rules.error_class) == [
        "An error occurred: Cannot divide by zero!", "An unexpected error occurred.", None,
    ]


def test_template_shows_null(spark):
    assert one_column(spark, ["a", None], "string", lambda c: text.template("(%s)", c)) == ["(a)", "(NULL)"]


def test_sql_functions(spark):
    assert set(sql.register(spark)) == {"clean_gender", "clean_price", "parse_date_safe", "calculate_final_score"}
    row = spark.sql(
        "SELECT clean_gender(' FEMALE\t') g, clean_price('$1,2') bad, clean_price(' $85.00') p, "
        "parse_date_safe('05-05-2026') d, calculate_final_score(80, 90) s"
    ).first()
    assert tuple(row) == ("Female", Decimal(0), Decimal(85), dt.date(2026, 5, 5), Decimal(84))
    spark.createDataFrame([(101, "Alice", Decimal("95.5")), (102, "Bob", Decimal("88")), (103, "Charlie", Decimal("72"))],
                          "s_id bigint, s_name string, s_grade decimal(38,9)").createOrReplaceTempView("students_in")
    sql.register_high_performers(spark, "students_in")
    got = spark.sql("SELECT s_id, s_name FROM get_high_performers(85.0) ORDER BY s_id").collect()
    assert [tuple(r) for r in got] == [(101, "Alice"), (102, "Bob")]


def test_sql_functions_are_inlined(spark):
    sql.register(spark)
    df = spark.sql("SELECT clean_gender(CAST(id AS STRING)) AS g FROM range(5)")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan and "PythonUDF" not in plan and "EvalPython" not in plan
