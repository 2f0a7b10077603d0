"""Flag, anomaly and contract queries (Q*, A25)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.numbers import money_sum, percent
from auditloom.operators import quality as Q, rollups as R
from auditloom.operators.quality import Check
from auditloom.workload.binding import FACTS, LOTS, REC, VREC, Tables, pct, rat, rnd
from auditloom.workload.registry import query

_METRICS = f"""m AS (SELECT district, year, {pct('administration', 'total', 2)} AS administration_pct,
  {pct('instruction', 'total', 2)} AS instruction_pct, {rat('adm', 'admins', 1)} AS admin_to_student,
  {rat('administration', 'adm', 2)} AS per_pupil_admin FROM facts)"""


def _metrics(t: Tables) -> DataFrame:
    from auditloom.functions.numbers import ratio

    return t.facts.select(
        "district", "year", percent("administration", "total", 2).alias("administration_pct"),
        percent("instruction", "total", 2).alias("instruction_pct"),
        ratio("adm", "admins", digits=1).alias("admin_to_student"),
        ratio("administration", "adm", digits=2).alias("per_pupil_admin"))


_FLAGS = """fl AS (
  SELECT district, year, 'admin_ratio' AS indicator, administration_pct AS value,
    CASE WHEN administration_pct > 10 THEN 10e0 ELSE 5e0 END AS threshold,
    CASE WHEN administration_pct > 10 THEN 'high' ELSE 'medium' END AS severity,
    'Administrative spending ratio (' || administration_pct || '%) ' || CASE WHEN administration_pct > 10 THEN 'exceeds 10.0% threshold' ELSE 'above 5.0% target' END AS message FROM m WHERE administration_pct > 5
  UNION ALL SELECT district, year, 'instruction_ratio', instruction_pct, CASE WHEN instruction_pct < 60 THEN 60e0 ELSE 65e0 END,
    CASE WHEN instruction_pct < 60 THEN 'high' ELSE 'medium' END,
    'Instruction spending ratio (' || instruction_pct || '%) below ' || CASE WHEN instruction_pct < 60 THEN '60.0% minimum' ELSE '65.0% target' END FROM m WHERE instruction_pct > 0 AND instruction_pct < 65
  UNION ALL SELECT district, year, 'admin_to_student', admin_to_student,
    CASE WHEN admin_to_student < 150 THEN 150e0 ELSE 250e0 END,
    CASE WHEN admin_to_student < 150 THEN 'high' ELSE 'medium' END,
    'Admin-to-student ratio (1:' || admin_to_student || ') below ' || CASE WHEN admin_to_student < 150 THEN '1:150 threshold' ELSE '1:250 target' END FROM m WHERE admin_to_student > 0 AND admin_to_student < 250
  UNION ALL SELECT district, year, 'per_pupil_admin', per_pupil_admin, 1200e0, 'medium',
    'Per-pupil admin spending ($' || per_pupil_admin || ') exceeds $1200 threshold' FROM m WHERE per_pupil_admin > 1200)"""


@query("Q1 Q5", f"WITH {FACTS}, {_METRICS}, {_FLAGS} SELECT * FROM fl")
def tiered_flags(t: Tables) -> DataFrame:
    return Q.tiered_flags(_metrics(t), ["district", "year"])


def _short_texts(form: str, money: str, instruction: str) -> str:
    """The flags that consolidated and historical metrics share, with their own texts."""
    return f"""SELECT district, year, indicator, value, threshold, severity, CASE indicator
  WHEN 'admin_ratio' THEN 'Admin spending (' || {form} || '%) ' || CASE severity WHEN 'high' THEN 'exceeds 10.0% threshold' ELSE 'above 5.0% target' END
  WHEN 'instruction_ratio' THEN '{instruction} (' || {form} || '%) below 60.0% minimum'
  ELSE 'Per-pupil admin ($' || {money} || ') exceeds $1200' END AS message
FROM fl WHERE indicator <> 'admin_to_student' AND NOT (indicator = 'instruction_ratio' AND severity = 'medium')"""


@query("Q2 Q5", f"WITH {FACTS}, {_METRICS}, {_FLAGS} {_short_texts('value', 'value', 'Instruction spending')}")
def consolidated_flags(t: Tables) -> DataFrame:
    return Q.tiered_flags(_metrics(t), ["district", "year"], Q.CONSOLIDATED_RULES)


@query("Q3 Q5", f"WITH {FACTS}, {_METRICS}, {_FLAGS} {_short_texts("printf('%.1f', value)", "printf('%.0f', value)", 'Instruction')}")
def history_flags(t: Tables) -> DataFrame:
    return Q.tiered_flags(_metrics(t), ["district", "year"], Q.HISTORY_RULES)


@query("A25", f"WITH {FACTS}, {_METRICS}, {_FLAGS} SELECT severity, count(*) AS flags FROM fl GROUP BY severity")
def flag_tally(t: Tables) -> DataFrame:
    return R.tally(Q.tiered_flags(_metrics(t), ["district", "year"]))


@query("Q4", f"""
WITH {FACTS}, r AS (SELECT district || ' ' || fiscal_year AS district, {pct('admins', '(support + teachers)', 2)} AS p,
    {rat('admins', 'adm', 2, '0.0::DOUBLE', '*1e3')} AS k, {rat('admins', 'teachers', 4, '0.0::DOUBLE')} AS a
  FROM facts),
g AS (SELECT district, (b - a) / a * 1e2 AS ag, (d - c) / c * 1e2 AS eg FROM (
  SELECT district, CAST(max(admins) FILTER (WHERE year = 1995) AS DOUBLE) AS a, CAST(max(admins) FILTER (WHERE year = 2000) AS DOUBLE) AS b,
    CAST(max(adm) FILTER (WHERE year = 1995) AS DOUBLE) AS c, CAST(max(adm) FILTER (WHERE year = 2000) AS DOUBLE) AS d
  FROM facts GROUP BY district)),
d AS (SELECT district, arg_min({pct('local_amount', 'total', 2)}, year) AS a, arg_max({pct('local_amount', 'total', 2)}, year) AS b,
    'FY' || min(year) AS y, 'FY' || max(year) AS z FROM facts GROUP BY district)
SELECT district, 'admin_pct_of_total_staff' AS indicator, p AS value, 1e1 AS threshold,
  CASE WHEN p > 10 THEN 'WARNING' ELSE 'OK' END AS severity,
  CASE WHEN p > 10 THEN 'Admin staff (' || p || '%) exceeds 10.0% threshold' ELSE 'Admin staff ratio (' || p || '%) is within acceptable range' END AS message,
  CASE WHEN p > 10 THEN 'High Admin Ratio' ELSE 'Admin Ratio Within Threshold' END AS flag FROM r
UNION ALL SELECT district, 'admin_per_1000_students', k, 3.5e0, 'WARNING',
  'Admin positions per 1000 students (' || k || ') exceeds 3.5 threshold', 'High Admin Per Student' FROM r WHERE k > 3.5
UNION ALL SELECT district, 'admin_to_teacher_ratio', a, 5e-2, 'WARNING',
  'Admin-to-teacher ratio (' || printf('%.4f', a) || ') exceeds 0.05 threshold', 'High Admin-to-Teacher Ratio' FROM r WHERE a > 5e-2
UNION ALL SELECT district, 'admin_growth_vs_enrollment', {rnd('ag / nullif(eg, 0)', 2)}, 2e0, 'CRITICAL',
  'Admin growth (' || {rnd('ag', 2)} || '%) is ' || printf('%.1f', ag / eg) || 'x enrollment growth (' || {rnd('eg', 2)} || '%)',
  'Admin Growing Faster Than Enrollment' FROM g WHERE ag / nullif(eg, 0) > 2
UNION ALL SELECT district, 'school_pct_of_budget', b, a, 'INFO',
  'School share declined from ' || a || '% (' || y || ') to ' || b || '% (' || z || ')', 'Declining School Share of County Budget'
  FROM d WHERE b < a""")
def audit_flags(t: Tables) -> DataFrame:
    from auditloom.functions.numbers import ratio

    g = t.gold_facts
    staff = F.col("support") + F.col("teachers")
    ratios = g.select(
        F.concat_ws(" ", "district", "fiscal_year").alias("district"), percent("admins", staff, 2).alias("admin_pct_of_total_staff"),
        ratio("admins", "adm", scale=1000.0, digits=2, default=0.0).alias("admin_per_1000_students"),
        ratio("admins", "teachers", digits=4, default=0.0).alias("admin_to_teacher_ratio"))

    def at(c: str, year: int):
        return F.max(F.when(F.col("year") == year, F.col(c))).cast("double")

    ends = g.groupBy("district").agg(at("admins", 1995).alias("a"), at("admins", 2000).alias("b"),
                                     at("adm", 1995).alias("c"), at("adm", 2000).alias("d"))
    growth = ends.select("district", ((F.col("b") - F.col("a")) / F.col("a") * 100.0).alias("admin_growth"),
                         ((F.col("d") - F.col("c")) / F.col("c") * 100.0).alias("base_growth"))
    budget = g.select("district", "year", "fiscal_year", percent("local_amount", "total", 2).alias("share"))
    return Q.audit_flags(ratios, growth, budget, ["district"], "year", "share", ("admin_growth", "base_growth"), "fiscal_year")


@query("Q6", f"""
WITH {VREC} SELECT parcel FROM vrec WHERE coalesce(improvement_value, 0) > 0
  AND (CASE WHEN parcel % 11 = 0 THEN 0 ELSE total_value END) = 0""")
def anomaly_zero_value(t: Tables) -> DataFrame:
    zeroed = F.when(F.col("parcel") % 11 == 0, F.lit(0)).otherwise(F.col("total_value"))
    return Q.zero_value_improved(t.valued_records.withColumn("total_value", zeroed)).select("parcel")


@query("Q7", f"""
WITH {VREC} SELECT parcel, CAST(land_value AS DOUBLE) / CAST(total_value AS DOUBLE) AS land_ratio FROM vrec
WHERE total_value > 100000 AND improvement_value > 0 AND CAST(land_value AS DOUBLE) / CAST(total_value AS DOUBLE) > 0.9""")
def anomaly_high_ratio(t: Tables) -> DataFrame:
    return Q.high_land_ratio(t.valued_records).select("parcel", "land_ratio")


@query("Q8", f"""
WITH {VREC} SELECT parcel FROM vrec WHERE acreage / 1000 > 0 AND acreage / 1000 < 0.1 AND total_value > 480000""")
def anomaly_small_high(t: Tables) -> DataFrame:
    rows = t.valued_records.withColumn("acreage", F.col("acreage") / 1000)
    return Q.small_lot_high_value(rows, {"tiny_acres": 0.1, "tiny_total": 480_000}).select("parcel")


@query("Q9", f"""
WITH {VREC} SELECT parcel, CAST(property_class AS BIGINT) AS property_class FROM (
  SELECT parcel, acreage, total_value, CASE WHEN property_class = 5 THEN 6 WHEN property_class = 4 THEN NULL
    ELSE property_class END AS property_class FROM vrec)
WHERE acreage > 50 AND total_value < 100000 AND property_class IS DISTINCT FROM 6""")
def anomaly_large_low(t: Tables) -> DataFrame:
    cls = F.col("property_class")
    recoded = F.when(cls == 5, F.lit(6)).when(cls == 4, F.lit(None)).otherwise(cls)
    out = Q.large_lot_low_value(t.valued_records.withColumn("property_class", recoded))
    return out.select("parcel", F.col("property_class").cast("bigint").alias("property_class"))


@query("Q10 A21", f"""
WITH {REC}, g AS (SELECT owner, left(address, 30) AS address, parcel,
    row_number() OVER (PARTITION BY owner, left(address, 30) ORDER BY parcel) AS n,
    count(*) OVER (PARTITION BY owner, left(address, 30)) AS c FROM rec WHERE owner <> '')
SELECT owner, address, c AS parcel_count, string_agg(CAST(parcel AS VARCHAR), ',' ORDER BY parcel) AS parcels
FROM g WHERE c > 3 AND n <= 10 GROUP BY owner, address, c""")
def repeat_holdings(t: Tables) -> DataFrame:
    out = Q.repeat_holdings(t.records, "owner", "address", "parcel")
    return out.withColumn("parcels", F.array_join(F.col("parcels.parcel").cast("array<string>"), ","))


@query("Q11", f"WITH {LOTS} SELECT zone, count(*) AS count FROM lots WHERE zone <> '' GROUP BY zone")
def zone_frequency(t: Tables) -> DataFrame:
    return Q.zone_frequency(t.lots(), weight="n")


@query("Q12", f"""
WITH {VREC} SELECT parcel, CAST(total_value AS DOUBLE) AS total_value FROM vrec
WHERE property_class = 2 AND improvement_value > 15000 ORDER BY vrec.total_value DESC, parcel LIMIT 20""")
def high_value_agricultural(t: Tables) -> DataFrame:
    bounds = {"agricultural_class": 2, "agricultural_improvement": 15_000}
    out = Q.high_value_agricultural(t.valued_records, "parcel", bounds)
    return out.select("parcel", F.col("total_value").cast("double").alias("total_value"))


@query("Q13 A21", f"""
WITH {REC}, o AS (SELECT owner, CAST(sum(total_value) AS DOUBLE) AS total_value, count(*) AS property_count
    FROM rec GROUP BY owner ORDER BY total_value DESC, owner LIMIT 25),
s AS (SELECT owner, parcel, row_number() OVER (PARTITION BY owner ORDER BY parcel) AS n FROM rec)
SELECT o.owner, o.total_value, o.property_count, string_agg(CAST(parcel AS VARCHAR), ',' ORDER BY parcel) AS parcels
FROM o JOIN s ON o.owner = s.owner AND n <= 5 GROUP BY ALL""")
def top_holders(t: Tables) -> DataFrame:
    from auditloom.functions.names import classify_entity

    rows = t.records.withColumn("entity_type", classify_entity("owner"))
    out = Q.top_holders_with_samples(rows, "owner", "parcel", "entity_type")
    ids = F.col("top_properties.parcel").cast("array<string>")
    return out.select("owner", "total_value", "property_count", F.array_join(ids, ",").alias("parcels"))


@query("Q14 W4", f"""
WITH {VREC}, o AS (SELECT owner, sum(acreage) AS a, CAST(sum(total_value) AS DOUBLE) AS v, count(*) AS n FROM vrec
  WHERE acreage <> 0 AND acreage < 10000 GROUP BY owner ORDER BY a DESC, owner LIMIT 25)
SELECT owner, {rnd('a', 1)} AS total_acreage, v AS total_value, n AS property_count, {rat('v', 'a', 0)} AS value_per_acre
FROM o WHERE a >= 50""")
def largest_holders(t: Tables) -> DataFrame:
    return Q.largest_landowners(t.valued_records, "owner")


@query("Q15", """
SELECT 'o_orderkey' AS field, 'required' AS "check", count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'o_orderpriority', 'pattern', count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]+$'))
  FROM orders
UNION ALL SELECT 'o_totalprice', 'minimum', count(*) FILTER (WHERE o_totalprice < 10000) FROM orders
UNION ALL SELECT 'o_totalprice', 'maximum', count(*) FILTER (WHERE o_totalprice > 450000) FROM orders""")
def contract_violations(t: Tables) -> DataFrame:
    return Q.contract_violations(t.orders, [
        Check("o_orderkey", "required"), Check("o_orderpriority", "pattern", r"^[1-4]-[A-Z]+$"),
        Check("o_totalprice", "minimum", 10000), Check("o_totalprice", "maximum", 450000)])


@query("Q16", """
WITH a AS (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1),
b AS (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders
  WHERE o_orderkey % 20 <> 0 GROUP BY 1)
SELECT k, a.v AS left_value, b.v AS right_value,
  CASE WHEN a.v IS NULL OR b.v IS NULL THEN 'one side only' ELSE 'differs' END AS state
FROM a FULL JOIN b USING (k)
WHERE a.v IS NULL OR b.v IS NULL OR abs(a.v - b.v) / nullif(abs(b.v), 0) > 0.05""")
def cross_source_discrepancy(t: Tables) -> DataFrame:
    """Customer totals of all orders against a source that lost every twentieth order."""
    from auditloom.operators.joins import discrepancy

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("k")).agg(
            money_sum("o_totalprice").alias("v"))

    return discrepancy(totals(t.orders), totals(t.orders.filter("o_orderkey % 20 <> 0")), ["k"], "v")


@query("Q17", f"""
WITH {VREC}, c AS (SELECT parcel, abs(land_value + improvement_value - total_value) < 100 AS sum_ok,
    coalesce(total_value > 0 AND CAST(tax_amount AS DOUBLE) / CAST(total_value AS DOUBLE) > 0.001
      AND CAST(tax_amount AS DOUBLE) / CAST(total_value AS DOUBLE) < 0.02, false) AS rate_ok,
    total_value < 100000000 AND tax_amount < 1000000 AS cap_ok FROM vrec)
SELECT sum_ok, rate_ok, cap_ok, count(*) AS parcels FROM c GROUP BY ALL""")
def arithmetic_consistency(t: Tables) -> DataFrame:
    return Q.consistency(t.valued_records).groupBy("sum_ok", "rate_ok", "cap_ok").agg(
        F.count(F.lit(1)).alias("parcels"))
