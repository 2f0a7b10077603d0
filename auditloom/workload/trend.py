"""Ratio and trend queries (T*, J5, J6, J10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.numbers import money_sum
from auditloom.operators import joins as J, rollups as R, trends as T
from auditloom.workload.binding import FACTS, LOTS, VREC, Tables, growth, pct, rat, rnd
from auditloom.workload.registry import query

YEARS = tuple(range(1994, 2003))  # one year before and one after the data


@query("T1", f"""
WITH {FACTS}
SELECT district, year, CASE WHEN total > 0 THEN {rat('total', 'adm', 2)} END AS total_per_unit,
  CASE WHEN instruction > 0 THEN {rat('instruction', 'adm', 2)} END AS instruction_per_unit,
  CASE WHEN administration > 0 THEN {rat('administration', 'adm', 2)} END AS administration_per_unit FROM facts""")
def per_unit_ratios(t: Tables) -> DataFrame:
    names = {c: c for c in ("total", "instruction", "administration")}
    out = T.per_unit(t.facts, "adm", names)
    return out.select("district", "year", *[f"{c}_per_unit" for c in names])


@query("T2", f"""
WITH {FACTS}
SELECT district, year, {pct('instruction', 'total', 2, 'NULL')} AS instruction_pct,
  {pct('administration', 'total', 2, 'NULL')} AS administration_pct,
  {pct('technology', 'total', 2, 'NULL')} AS technology_pct FROM facts""")
def spending_shares(t: Tables) -> DataFrame:
    names = ("instruction", "administration", "technology")
    return T.spending_shares(t.facts, "total", names).select("district", "year", *[f"{c}_pct" for c in names])


@query("T3", f"""
WITH {FACTS}
SELECT district, year, CASE WHEN adm > 0 THEN {rat('adm', 'teachers', 1)} END AS teacher_to_student,
  CASE WHEN adm > 0 THEN {rat('adm', 'admins', 1)} END AS admin_to_student,
  CASE WHEN teachers > 0 THEN {rat('teachers', 'admins', 1)} END AS admin_to_teacher FROM facts""")
def guarded_ratios(t: Tables) -> DataFrame:
    out = T.staff_ratios(t.facts, "adm", "teachers", "admins")
    return out.select("district", "year", "teacher_to_student", "admin_to_student", "admin_to_teacher")


@query("T4 J5", f"""
WITH {FACTS}
SELECT district, year, {pct('admins', '(support + teachers)', 2)} AS admin_pct_of_total_staff,
  {rat('admins', 'adm', 2, '0.0::DOUBLE', '*1e3')} AS admin_per_1000_students,
  {rat('admins', 'teachers', 4, '0.0::DOUBLE')} AS admin_to_teacher_ratio,
  {rat('adm', 'admins', 1, '0.0::DOUBLE')} AS students_per_admin
FROM facts WHERE district <> 'ASIA' AND year > 1995""")
def admin_ratios_all_present(t: Tables) -> DataFrame:
    """Entities missing from one of the three tables drop out."""
    g, keys = t.gold_facts, ["district", "year"]
    admin = g.filter("district <> 'ASIA'").select(*keys, F.col("admins").alias("admin_positions"),
                                                  F.col("support").alias("support_total"))
    taught = g.filter("year > 1995").select(*keys, "teachers", F.col("teachers").alias("instructional"))
    out = T.admin_ratios(admin, taught, g.select(*keys, "adm"), keys, [F.col("year")])
    return out.select(*keys, "admin_pct_of_total_staff", "admin_per_1000_students", "admin_to_teacher_ratio",
                      "students_per_admin")


@query("T5", f"""
WITH {FACTS}
SELECT district, year, {rnd('local_amount/nullif(total, 0)*1e2', 1)} AS local_pct,
  {rnd('state_amount/nullif(total, 0)*1e2', 1)} AS state_pct,
  {rnd('federal_amount/nullif(total, 0)*1e2', 1)} AS federal_pct FROM facts""")
def source_shares(t: Tables) -> DataFrame:
    sources = {"local_amount": "local_pct", "state_amount": "state_pct", "federal_amount": "federal_pct"}
    return T.source_shares(t.facts, "total", sources).select("district", "year", *sources.values())


@query("T6", f"""
WITH {FACTS}, f AS (SELECT district, year, nullif(CAST(adm AS DOUBLE), 0) AS u, nullif(total, 0) AS s,
    nullif(instruction, 0) AS i, nullif(administration, 0) + nullif(technology, 0) AS a FROM facts)
SELECT district, year, a AS total_administration, {rnd('s/u', 2)} AS per_pupil_total,
  {rnd('i/u', 2)} AS per_pupil_instruction, {rnd('a/s*1e2', 2)} AS admin_pct, {rnd('a/u', 2)} AS per_pupil_admin,
  {rnd('i/s*1e2', 2)} AS instruction_pct FROM f""")
def survey_metrics(t: Tables) -> DataFrame:
    rows = t.facts.select(
        "district", "year", F.col("adm").alias("enrollment"), F.col("total").alias("total_expenditures"),
        F.col("instruction").alias("instruction_expenditures"),
        F.col("administration").alias("general_administration"),
        F.col("technology").alias("school_administration"))
    return T.survey_metrics(rows).select("district", "year", "total_administration", "per_pupil_total",
                                         "per_pupil_instruction", "admin_pct", "per_pupil_admin", "instruction_pct")


_GAPPED = "f AS (SELECT * FROM facts WHERE NOT (district = 'ASIA' AND year IN (1995, 1998)))"


def _gapped(t: Tables) -> DataFrame:
    """The yearly figures with two years of one district missing."""
    return t.facts.filter("not (district = 'ASIA' and year in (1995, 1998))")


@query("T7 J10", f"""
WITH {FACTS}, {_GAPPED}
SELECT d.district, y.year, y.year - 1994 AS idx, f.adm, f.total
FROM (SELECT DISTINCT district FROM f) d CROSS JOIN (SELECT CAST(unnest(range(1994, 2003)) AS BIGINT) AS year) y
LEFT JOIN f ON f.district = d.district AND f.year = y.year""")
def trend_dense(t: Tables) -> DataFrame:
    rows = _gapped(t).select("district", "year", "adm", "total")
    out = T.dense_trend(rows, ["district"], "year", YEARS, ["adm", "total"])
    return out


@query("T7b", f"""
WITH {FACTS}, f AS (SELECT * FROM facts WHERE NOT (district = 'ASIA' AND year <> 1998)),
k AS (SELECT district FROM f GROUP BY district HAVING count(DISTINCT year) >= 2)
SELECT district, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
  string_agg(CAST(admins AS VARCHAR), ',' ORDER BY year) AS admins
FROM f WHERE district IN (SELECT district FROM k) GROUP BY district""")
def trend_own_years(t: Tables) -> DataFrame:
    """Aligned arrays; a district with a single year has no series."""
    rows = t.gold_facts.filter("not (district = 'ASIA' and year <> 1998)")
    out = T.series(T.own_year_trend(rows, ["district"], "year", ["admins"]), ["district"], "year", ["admins"])
    text = "array<string>"
    return out.select("district", F.array_join(F.col("years").cast(text), ",").alias("years"),
                      F.array_join(F.col("admins_trend").cast(text), ",").alias("admins"))


@query("T8", f"""
WITH {FACTS}, f AS (SELECT district, year, CASE WHEN NOT (district = 'ASIA' AND year IN (1995, 2001))
    THEN total END AS total FROM facts),
e AS (SELECT district, arg_min(total, year) FILTER (WHERE total IS NOT NULL) AS a,
    arg_max(total, year) FILTER (WHERE total IS NOT NULL) AS b,
    max(year) FILTER (WHERE total IS NOT NULL) - min(year) FILTER (WHERE total IS NOT NULL) AS n FROM f GROUP BY district)
SELECT district, a AS start_value, b AS end_value, n AS periods, {growth('a', 'b', 2)} AS total_growth_pct,
  {rnd('(pow(b/a, 1e0/n) - 1e0)*1e2', 2)} AS cagr_pct FROM e WHERE n > 0 AND a > 0""")
def growth_cagr_nonnull(t: Tables) -> DataFrame:
    hole = (F.col("district") == "ASIA") & F.col("year").isin(1995, 2001)
    rows = t.facts.select("district", "year", F.when(~hole, F.col("total")).alias("total"))
    return T.growth_nonnull(rows, ["district"], "year", "total")


@query("T9", f"""
WITH {FACTS}, e AS (SELECT district, count(*) AS n, arg_min(coalesce(total, 0), year) AS a,
    arg_max(coalesce(total, 0), year) AS b FROM facts GROUP BY district)
SELECT district, a AS first_value, b AS last_value, CASE WHEN n >= 2 THEN {growth('a', 'b', 2)} END AS growth_pct
FROM e""")
def growth_first_last(t: Tables) -> DataFrame:
    return T.growth_positions(t.facts, ["district"], "year", "total")


@query("T10", f"""
WITH {FACTS}, f AS (SELECT district, year, CASE WHEN year = 2001 THEN 0.0::DOUBLE ELSE total END AS v FROM facts),
e AS (SELECT district, arg_min(v, year) AS a, coalesce(arg_max(v, year) FILTER (WHERE v <> 0), 0) AS b
  FROM f GROUP BY district)
SELECT district, a AS first_value, b AS last_value, CASE WHEN b > 0 THEN {growth('a', 'b', 2)} END AS growth_pct
FROM e""")
def growth_last_nonzero(t: Tables) -> DataFrame:
    rows = t.facts.select("district", "year", F.when(F.col("year") == 2001, 0.0).otherwise(F.col("total")).alias("v"))
    return T.growth_positions(rows, ["district"], "year", "v", last_nonzero=True)


@query("T11", f"""
WITH {VREC}, y AS (SELECT year, CAST(sum(total_value) AS DOUBLE) AS v FROM rec GROUP BY year),
e AS (SELECT arg_min(v, year) AS a, arg_max(v, year) AS b FROM y)
SELECT 'all' AS scope, a AS first_value, b AS last_value, {growth('a', 'b', 2)} AS growth_pct FROM e""")
def growth_of_totals(t: Tables) -> DataFrame:
    years = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(
        money_sum("o_totalprice").cast("double").alias("v"))
    return T.growth_positions(years.withColumn("scope", F.lit("all")), ["scope"], "year", "v")


@query("T12", f"""
WITH {FACTS}
SELECT {pct("sum(local_amount) FILTER (WHERE year = 2000)", "sum(total) FILTER (WHERE year = 2000)", 2, 'NULL')} AS local_amount_pct,
  {pct("sum(state_amount) FILTER (WHERE year = 2000)", "sum(total) FILTER (WHERE year = 2000)", 2, 'NULL')} AS state_amount_pct
FROM (SELECT year, CAST(local_amount AS DECIMAL(18,2)) AS local_amount, CAST(state_amount AS DECIMAL(18,2)) AS state_amount,
  CAST(total AS DECIMAL(18,2)) AS total FROM facts)""")
def fixed_year_share(t: Tables) -> DataFrame:
    return T.fixed_year_share(t.facts, "year", 2000, ["local_amount", "state_amount"], "total")


_MATRIX_TYPES = ("Individual", "LLC", "Trust", "Corporation", "Estate", "Non-Profit")
_BREAKDOWN = f"""g AS (SELECT year, entity_type, count(*) AS n, sum(total_value) AS v FROM lots GROUP BY year, entity_type),
b AS (SELECT year, entity_type, CAST(v AS DOUBLE) AS v, {pct('n', 'sum(n) OVER (PARTITION BY year)', 1)} AS pr,
  {pct('v', 'sum(v) OVER (PARTITION BY year)', 1)} AS pv FROM g),
m AS (SELECT t.entity_type, y.year, coalesce(pr, 0) AS pct_records, coalesce(pv, 0) AS pct_value, coalesce(v, 0) AS v
  FROM (SELECT unnest([{', '.join(repr(x) for x in _MATRIX_TYPES)}]) AS entity_type) t
  CROSS JOIN (SELECT CAST(unnest(range(1994, 2003)) AS BIGINT) AS year) y
  LEFT JOIN b ON b.entity_type = t.entity_type AND b.year = y.year)"""


def _matrix(t: Tables) -> DataFrame:
    return T.share_matrix(R.entity_breakdown(t.lots("year"), scope=["year"], weight="n"), YEARS, _MATRIX_TYPES)


@query("T13 J10", f"WITH {LOTS}, {_BREAKDOWN} SELECT entity_type, year, pct_records, pct_value, v AS total_value FROM m")
def share_matrix(t: Tables) -> DataFrame:
    return _matrix(t).withColumn("year", F.col("year").cast("bigint"))


@query("T13", f"""
WITH {LOTS}, {_BREAKDOWN}, e AS (SELECT entity_type, arg_min(v, year) AS a, arg_max(v, year) AS b
  FROM m WHERE entity_type IN ('Individual', 'LLC', 'Trust', 'Corporation') GROUP BY entity_type)
SELECT entity_type, a AS first_year_value, b AS last_year_value, {growth('a', 'b', 1)} AS growth_pct,
  b - a AS absolute_change FROM e WHERE a > 0""")
def share_matrix_growth(t: Tables) -> DataFrame:
    return T.matrix_growth(_matrix(t))


@query("T14", f"""
WITH {FACTS}, y AS (SELECT *, lag(total) OVER (PARTITION BY district ORDER BY year) AS p FROM facts),
g AS (SELECT *, {growth('p', 'total', 2)} AS yoy FROM y),
s AS (SELECT *, yoy - lag(yoy) OVER (PARTITION BY district ORDER BY year) AS step FROM g),
e AS (SELECT district, arg_min(total, year) AS a, arg_max(total, year) AS b, max(year) - min(year) AS n,
    avg(step) AS acc FROM s GROUP BY district)
SELECT district, a AS start_value, b AS end_value, {rnd('(pow(b/a, 1e0/n) - 1e0)*1e2', 2)} AS cagr_pct,
  CASE WHEN b > a THEN 'increasing' WHEN b < a THEN 'decreasing' ELSE 'flat' END AS direction,
  {rnd('acc', 2)} AS acceleration FROM e""")
def trend_summary(t: Tables) -> DataFrame:
    return T.trend_summary(t.facts, ["district"], "year", "total")


@query("T15", f"""
WITH {FACTS}, s AS (SELECT year, avg(CAST(adm AS DOUBLE)) AS r FROM facts GROUP BY year)
SELECT district, f.year, CAST(adm AS DOUBLE) AS adm, r AS reference_value,
  {rnd('(CAST(adm AS DOUBLE) - r)/nullif(r, 0)*1e2', 1)} AS variance_pct FROM facts f JOIN s ON f.year = s.year""")
def variance_vs_reference(t: Tables) -> DataFrame:
    rows = t.gold_facts.select("district", "year", F.col("adm").cast("double").alias("adm"))
    mean = rows.groupBy("year").agg(F.avg("adm").alias("adm"))
    return J.variance_vs_reference(rows, mean, "adm", ["year"])


@query("J6", f"""
WITH {FACTS}, c AS (SELECT n_name, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k, c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n.n_name AS nation, coalesce(c_acctbal, 0) AS c_acctbal FROM nation n LEFT JOIN c ON c.n_name = n.n_name AND k = 1""")
def first_match_lookup(t: Tables) -> DataFrame:
    """First customer of each nation; nations without one get 0."""
    customers = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .select(F.col("n_name").alias("nation"), "c_custkey", "c_acctbal"))
    nations = t.nation.select(F.col("n_name").alias("nation"))
    return J.first_match_lookup(nations, customers, ["nation"], {"c_acctbal": 0.0}, [F.col("c_custkey")])
