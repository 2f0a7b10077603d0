"""Column functions on small in-line rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import keys as K, names as N, numbers as U
from auditloom.functions.predicates import same_fiscal_year, structured_filters, target_filter
from auditloom.operators import quality


def apply(spark, expression, values, kind="string"):
    """The expression over ``values``, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_clean_owner_name(spark):
    raw = ["SMITH JOHN  FH 1,234.50 SH 9", "  DOE JANE ", None, "ACME LLC SH 12.00 rest", "FH 12"]
    assert apply(spark, N.clean_owner_name, raw) == ["SMITH JOHN", "DOE JANE", "", "ACME LLC", "FH 12"]


@pytest.mark.parametrize("rules, expected", [
    ("yearly", ["Government", "Religious", "Non-Profit", "LLC", "LLC", "LLC", "Individual", "Corporation",
                "Limited Partnership", "Trust", "Estate", "Financial Institution", "Utility", "HOA/Condo",
                "Utility", "HOA/Condo", "Individual"]),
    ("detailed", ["Government", "Religious", "Non-Profit/Organization", "LLC", "LLC", "LLC", "LLC", "Corporation",
                  "Limited Partnership", "Trust", "Estate", "Financial Institution", "Utility",
                  "HOA/Condo Association", "Utility", "HOA/Condo Association", "Individual"]),
    ("district", ["Government", "Religious", "Non-Profit", "LLC", "LLC", "LLC", "LLC", "Corporation",
                  "Limited Partnership", "Trust", "Estate", "Financial", "Individual", "Individual", "Individual",
                  "Individual", "Individual"]),
])
def test_classify_entity(spark, rules, expected):
    names = ["Town of Middletown", "First Baptist Church", "Rotary Club", "Acme LLC", "Acme L.L.C.", "Acme LC",
             "VALLEY ELEC LC", "Acme Inc", "Acme LP", "SMITH FAMILY TRUST", "HEIRS OF DOE", "FIRST MORTGAGE",
             "POWER PEOPLE", "OAK CONDO", "GASKINS MARY", "HOANG VAN", ""]
    assert apply(spark, lambda c: N.classify_entity(c, rules), names) == expected


def test_word_boundaries_fix_misfires(spark):
    """Plain substrings misfire (ESTATE OF holds STATE OF); whole words do not."""
    rules = N.word_boundary_rules("yearly")
    names = ["GASKINS MARY", "HOANG VAN", "CITY GAS", "OAK HOA", "ESTATE OF DOE"]
    assert apply(spark, N.classify_entity, names) == ["Utility", "HOA/Condo", "Utility", "HOA/Condo", "Government"]
    assert apply(spark, lambda c: N.classify_entity(c, rules), names) == [
        "Individual", "Individual", "Utility", "HOA/Condo", "Estate"]


def test_last_names(spark):
    names = ["SMITH, JOHN", "Smith Jr., Ann", "DOE JANE & JIM", "THE OAKS", "CHER", "", None, "ACME LLC", ", JOHN"]
    assert apply(spark, N.extract_last_name, names) == [
        "SMITH", "SMITH", "DOE", None, None, None, None, None, ""]
    wide = lambda c: N.extract_last_name(c, fixed.LAST_NAME_ENTITY_WORDS_WIDE)
    assert apply(spark, wide, ["ACME LP"]) == [None]


def test_surnames(spark):
    names = ["VAN DYKE PETER    1 MAIN ST", "SMITH JOHN", "X MAN", "ACME PROPERTIES", "   ", None, "MC"]
    assert apply(spark, N.extract_surname, names) == ["VAN DYKE", "SMITH", None, None, None, None, "MC"]


def test_districts(spark):
    texts = ["lot in RED  BUD", "BACKCREEK OPEQUON", "Stephens City", "nowhere", None]
    assert apply(spark, N.canonical_district, texts) == ["Red Bud", "Back Creek", "Stephens City", None, None]


def test_keys(spark):
    assert apply(spark, K.parcel_key, ["80    A     9", " 75B--14-1-7 ", "", None]) == [
        "80--A--9", "75B--14-1-7", "", ""]
    assert apply(spark, K.account_key, [12.0, 0.0, None], "double") == ["12", "", ""]
    assert apply(spark, lambda c: K.account_key(c, zero_is_blank=False), [0.0, None], "double") == ["0", ""]
    assert apply(spark, K.account_key, [1234567.0, 12345678.0, 1.9e7, 12345678.75, -23456789.9, 1e30, float("nan")], "double") == [
        "1234567", "12345678", "19000000", "12345678", "-23456789", "1" + "0" * 30, ""]
    assert apply(spark, K.account_key, ["1.2345678E7", "9999999999999999999", "12.9", "1e", "E7", "x"]) == [
        "12345678", "9999999999999999999", "12", "", "", ""]
    assert apply(spark, lambda c: K.address_key(c, 10), ["  po box 12 main", None]) == ["PO BOX 1", ""]
    assert apply(spark, K.extract_state, ["WINCHESTER VA 22601", "x", None]) == ["VA", None, None]
    assert apply(spark, K.extract_city, ["BUNKER HILL WV 25413", "VA 22601"]) == ["BUNKER HILL", None]


def test_fiscal_years(spark):
    assert apply(spark, K.fiscal_year_key, ["FY2024", "2023-24", "1999-00", "odd"]) == [
        "FY2024", "FY2024", "FY2000", "odd"]
    assert apply(spark, K.school_year, ["FY2024", "FY2000", "2023-24"]) == ["2023-24", "1999-00", "2023-24"]
    assert apply(spark, K.fiscal_year_from_file, ["table15_2023-24.xlsm", "x2021.pdf", "none"]) == [
        "FY2024", "FY2021", "Unknown"]
    assert apply(spark, K.fiscal_year_from_text, ["fy 2022 budget", "years 2022 – 2023", "in 2019", "x"]) == [
        "FY2022", "FY2023", "FY2019", "Unknown"]
    assert apply(spark, K.fiscal_year_strict, ["FY2024_acfr.pdf", "fy2024"]) == ["FY2024", None]
    assert apply(spark, lambda c: same_fiscal_year(c, "2023-24"), ["FY2024", "2022-23"]) == [True, False]


def test_document_types(spark):
    names = ["FY24_Proposed.pdf", "adopted_acfr.pdf", "ACFR.pdf", "Comprehensive report.pdf"]
    assert apply(spark, K.document_type, names) == ["proposed", "adopted", "acfr", "unknown"]
    assert apply(spark, K.report_type, names) == ["budget", "acfr", "acfr", "acfr"]


def test_amounts(spark):
    texts = ["$1,234.50", " (1,234) ", "12%", "", None, "n/a", "1d", "NaN"]
    assert apply(spark, U.clean_amount, texts) == [1234.5, -1234.0, 12.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    texts = ["$1,234.50", "(1,234)", "--", "-", "", "N/A", "x", None, "5%"]
    assert apply(spark, lambda c: U.amount_or_null(c, fixed.NULL_AMOUNT_MARKS), texts) == [
        1234.5, -1234.0, None, None, None, None, None, None, 5.0]
    assert apply(spark, lambda c: U.coded_number(c, fixed.SURVEY_MISSING), ["12", "-1", "M", "", "1.5"]) == [
        12.0, None, None, None, 1.5]


def test_rounding_and_guards(spark):
    assert apply(spark, lambda c: U.round_to(c, 1), [0.25, -0.25, 2.0, None], "double") == [0.3, -0.3, 2.0, None]
    rows = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (0.0, 5.0), (None, 2.0)], "a double, b double")
    out = rows.select(U.ratio("a", "b", digits=2), U.percent("a", "b"), U.growth_pct("a", "b")).collect()
    assert [tuple(r) for r in out] == [(0.33, 33.3, 200.0), (None, 0.0, -100.0), (0.0, 0.0, None), (None, None, None)]


def test_structured_filters(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "ab"), (3, "b")], "n int, s string")
    kept = structured_filters(rows, [("n", "gt", 1), ("s", "contains", "b"), ("n", "in", [2, 3]), ("n", "lt", 3)])
    assert [r.n for r in kept.collect()] == [2]
    with pytest.raises(ValueError):
        structured_filters(rows, [("n", "like", 1)])


def test_target_filter_falls_back_to_names(spark):
    targets = {"069": "Alpha County", "043": "Beta County"}
    coded = spark.createDataFrame([("069",), ("Beta County",), ("x",)], "k string")
    assert [r.k for r in target_filter(coded, "k", targets).collect()] == ["069"]
    named = spark.createDataFrame([("ALPHA COUNTY schools",), ("x",)], "k string")
    assert [r.k for r in target_filter(named, "k", targets).collect()] == ["ALPHA COUNTY schools"]


def test_rounding_and_sums_of_odd_amounts(spark):
    assert apply(spark, lambda c: U.round_to(c, 2), [2e17, -2e17, 1.005, None], "double") == [2e17, -2e17, 1.0, None]
    rows = spark.createDataFrame([(1.25,), (float("nan"),), (1e30,), (2.5,)], "v double")
    assert float(rows.agg(U.money_sum("v").alias("s")).first().s) == 3.75


def test_fixed_digits_round_the_binary_value(spark):
    values = [0.25, 0.75, 2.05, 8.15, 5.65, 1234.5, 1235.5, 9.95, 1e7, 1234567.85, 0.05, -2.25, -0.04, 12.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select(U.fixed_digits("v", 1), U.fixed_digits("v", 0), U.fixed_digits("v", 4)).collect()
    assert [tuple(r) for r in got] == [(f"{v:.1f}", f"{v:.0f}", f"{v:.4f}") for v in values]


def test_history_messages_print_ties_as_the_sql(spark):
    rows = spark.createDataFrame([(8.25, 50.05, 1234.5)], "administration_pct double, instruction_pct double, per_pupil_admin double")
    got = [r.message for r in quality.tiered_flags(rows.withColumn("k", F.lit(1)), ["k"], quality.HISTORY_RULES).collect()]
    assert [m.split(")")[0].split("(")[1] for m in got] == ["8.2%", "50.0%", "$1234"]
