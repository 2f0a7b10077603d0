"""SQL surface: presets, filters, joins on keys, paging, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.numbers import money_sum
from auditloom.functions.predicates import latest_partition, structured_filters, target_filter, within_caps
from auditloom.operators.joins import semi_join
from auditloom.operators.rank import page
from auditloom.operators.trends import distinct_years, union_sources
from auditloom.plans.vocabulary import register_functions
from auditloom.workload.binding import FACTS, REC, VREC, Tables
from auditloom.workload.registry import query


@query("C1 C3 J1 P1 P4 O1", f"""
WITH {FACTS}, e AS (SELECT district, fiscal_year, adm FROM facts), x AS (SELECT district, fiscal_year, total FROM facts),
r AS (SELECT district, fiscal_year, teachers FROM facts)
SELECT e.district, e.fiscal_year, e.adm AS students, x.total AS spending, r.teachers
FROM e JOIN x ON e.district = x.district AND e.fiscal_year = x.fiscal_year
JOIN r ON e.district = r.district AND e.fiscal_year = r.fiscal_year
WHERE e.fiscal_year IN ('FY1999', 'FY2000') AND e.district IN ('ASIA', 'EUROPE', 'AFRICA')""")
def preset_peer_join(t: Tables) -> DataFrame:
    """Three views joined on two keys with membership filters, as Spark SQL over views."""
    facts = t.gold_facts
    for name, column in (("peer_enrolment", "adm"), ("peer_spending", "total"), ("peer_staff", "teachers")):
        facts.select("district", "fiscal_year", column).createOrReplaceTempView(name)
    return t.spark.sql("""
        SELECT e.district, e.fiscal_year, e.adm AS students, x.total AS spending, r.teachers
        FROM peer_enrolment e JOIN peer_spending x USING (district, fiscal_year)
        JOIN peer_staff r USING (district, fiscal_year)
        WHERE e.fiscal_year IN (:y1, :y2) AND e.district IN ('ASIA', 'EUROPE', 'AFRICA')
        ORDER BY spending DESC""", args={"y1": "FY1999", "y2": "FY2000"})


@query("J2 P3 O1", f"""
WITH {FACTS}
SELECT e.district, e.fiscal_year, e.adm, x.total FROM facts e
JOIN facts x ON e.district = x.district AND e.fiscal_year = x.fiscal_year
WHERE e.district = 'EUROPE'""")
def two_key_join(t: Tables) -> DataFrame:
    keys = ["district", "fiscal_year"]
    left = t.gold_facts.select(*keys, "adm").filter(F.col("district") == "EUROPE")
    return left.join(t.gold_facts.select(*keys, "total"), keys).orderBy("fiscal_year")


@query("P2 P5 O1", """
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) / 1e6 AS total_m FROM orders
WHERE o_totalprice > 400000 AND o_orderstatus = 'F'""")
def preset_scaled_filter(t: Tables) -> DataFrame:
    rows = t.orders.filter((F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "F"))
    return rows.select("o_orderkey", (F.col("o_totalprice") / 1e6).alias("total_m")).orderBy(
        F.col("total_m").desc_nulls_last(), "o_orderkey")


@query("P4 O1", f"""
WITH {REC}
SELECT year, zone, CAST(sum(total_value) AS DOUBLE) / 1e6 AS total_m FROM rec
WHERE zone NOT IN ('BUILDING') GROUP BY year, zone""")
def preset_not_in(t: Tables) -> DataFrame:
    rows = t.records.filter(~F.col("zone").isin("BUILDING"))
    out = rows.groupBy("year", "zone").agg((money_sum("total_value").cast("double") / 1e6).alias("total_m"))
    return out.orderBy("year", F.col("total_m").desc_nulls_last())


@query("P4 P1", f"""
WITH {FACTS}
SELECT district, year, floor(CAST(teachers AS DOUBLE)/CAST(adm AS DOUBLE)*1e3*1e2+5e-1)/1e2 AS per_1000
FROM facts WHERE district IN ('AMERICA', 'ASIA')""")
def preset_in_ratio(t: Tables) -> DataFrame:
    from auditloom.functions.numbers import ratio

    rows = t.facts.filter(F.col("district").isin("AMERICA", "ASIA"))
    return rows.select("district", "year", ratio("teachers", "adm", scale=1000.0, digits=2).alias("per_1000"))


@query("P6", """
WITH o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders)
SELECT o_orderkey, y AS year, o_totalprice FROM o WHERE y = (SELECT max(y) FROM o)""")
def latest_year_filter(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("year", F.year("o_orderdate").cast("bigint"))
    return latest_partition(rows).select("o_orderkey", "year", "o_totalprice")


@query("J9", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_join_keys(t: Tables) -> DataFrame:
    keys = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return semi_join(t.orders, keys, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query("C2 O2 O3", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200""")
def paged_preview(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return page(rows, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 100, 200)


@query("U4", """
SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'intersect all', count(*) FROM
  (SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except all', count(*) FROM
  (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)""")
def set_ops_keys(t: Tables) -> DataFrame:
    customers, suppliers = t.customer.select("c_custkey"), t.supplier.select("s_suppkey")
    homes, others = t.customer.select("c_nationkey"), t.supplier.select("s_nationkey")
    parts = {"union": homes.union(others).distinct(), "intersect": customers.intersect(suppliers),
             "except": customers.subtract(suppliers), "intersect all": homes.intersectAll(others),
             "except all": homes.exceptAll(others)}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n") for op, df in parts.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionAll(other)
    return out


@query("U1", f"""
WITH {REC}
SELECT 'orders' AS source, parcel, owner, zone, CAST(total_value AS DOUBLE) AS total_value, NULL::VARCHAR AS supplier,
  NULL::DOUBLE AS balance FROM rec
UNION ALL SELECT 'suppliers', NULL, NULL, NULL, NULL, s_name, s_acctbal FROM supplier""")
def union_sources_merged(t: Tables) -> DataFrame:
    """Two sources with different fields in one table."""
    orders = t.records.select("parcel", "owner", "zone", F.col("total_value").cast("double").alias("total_value"))
    suppliers = t.supplier.select(F.col("s_name").alias("supplier"), F.col("s_acctbal").alias("balance"))
    return union_sources({"orders": orders, "suppliers": suppliers})


@query("U2", f"""
WITH {FACTS}
SELECT district, year, adm, total FROM facts
UNION ALL SELECT 'STATE', year, CAST(sum(adm) AS BIGINT),
  CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) FROM facts GROUP BY year""")
def union_sources_totals(t: Tables) -> DataFrame:
    """State totals appended to the division rows."""
    rows = t.gold_facts.select("district", "year", "adm", "total")
    state = rows.groupBy("year").agg(
        F.sum("adm").alias("adm"), F.sum(F.col("total").cast("decimal(18,2)")).cast("double").alias("total"))
    return rows.unionByName(state.withColumn("district", F.lit("STATE")))


@query("U3", f"WITH {FACTS} SELECT DISTINCT fiscal_year FROM facts")
def distinct_years_all(t: Tables) -> DataFrame:
    years = t.orders.select(F.concat(F.lit("FY"), F.year("o_orderdate").cast("string")).alias("fiscal_year"))
    return distinct_years(years, "fiscal_year")


@query("P11", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 100000 AND o_totalprice < 200000
  AND contains(o_orderpriority, 'IGH') AND o_custkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987)""")
def structured_filters_all(t: Tables) -> DataFrame:
    rows = structured_filters(t.orders, [
        ("o_orderstatus", "eq", "O"), ("o_totalprice", "gt", 100000), ("o_totalprice", "lt", 200000),
        ("o_orderpriority", "contains", "IGH"),
        ("o_custkey", "in", (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987))])
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query("P7", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt')""")
def target_by_name(t: Tables) -> DataFrame:
    """No part is called by a code, so the names decide."""
    return target_filter(t.part, "p_name", {"069": "Ring", "043": "Bolt"}).select("p_partkey", "p_name")


@query("P7", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING')")
def target_by_code(t: Tables) -> DataFrame:
    """A code matches somewhere, so the name MACHINERY is not tried."""
    rows = target_filter(t.customer, "c_mktsegment", {"BUILDING": "machinery", "NONE": "household"})
    return rows.select("c_custkey", "c_mktsegment")


@query("P10", f"""
WITH {VREC} SELECT parcel FROM vrec WHERE total_value < 300000 AND tax_amount < 10000""")
def sanity_bounds(t: Tables) -> DataFrame:
    caps = {"total": 300_000, "tax": 10_000}
    return t.valued_records.filter(within_caps("total_value", "tax_amount", caps)).select("parcel")


@query("C1 N12", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(date_part('year', o_orderdate) AS BIGINT) AS y,
  strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS month, substr(o_orderpriority, 3) AS part,
  length(o_orderpriority) AS n, lower(o_orderpriority) AS low, replace(o_orderpriority, ' ', '_') AS swapped,
  concat(o_orderstatus, '-', ltrim('  x ')) AS joined, rtrim(' y  ') AS rt, floor(o_totalprice) AS fl, ceil(o_totalprice) AS ce,
  abs(-o_totalprice) AS ab, sqrt(o_totalprice) AS sq, CAST(round(log10(o_totalprice), 6) AS DOUBLE) AS lg,
  coalesce(nullif(o_orderstatus, 'F'), 'none') AS st, CASE WHEN o_totalprice BETWEEN 1000 AND 2000 THEN 1 ELSE 0 END AS low_price
FROM orders WHERE o_orderpriority LIKE '%URGENT' AND o_custkey = ANY (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def vocabulary_scalars(t: Tables) -> DataFrame:
    """Scalar vocabulary; strftime is a registered SQL function, = ANY is IN."""
    register_functions(t.spark)
    t.orders.createOrReplaceTempView("vocabulary_orders")
    t.customer.createOrReplaceTempView("vocabulary_customer")
    return t.spark.sql("""
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(date_part('year', o_orderdate) AS BIGINT) AS y,
          strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS month, substr(o_orderpriority, 3) AS part,
          CAST(length(o_orderpriority) AS BIGINT) AS n, lower(o_orderpriority) AS low,
          replace(o_orderpriority, ' ', '_') AS swapped, concat(o_orderstatus, '-', ltrim('  x ')) AS joined,
          rtrim(' y  ') AS rt, CAST(floor(o_totalprice) AS DOUBLE) AS fl, CAST(ceil(o_totalprice) AS DOUBLE) AS ce,
          abs(-o_totalprice) AS ab, sqrt(o_totalprice) AS sq, round(log10(o_totalprice), 6) AS lg,
          coalesce(nullif(o_orderstatus, 'F'), 'none') AS st,
          CASE WHEN o_totalprice BETWEEN 1000 AND 2000 THEN 1 ELSE 0 END AS low_price
        FROM vocabulary_orders
        WHERE o_orderpriority LIKE '%URGENT'
          AND o_custkey IN (SELECT c_custkey FROM vocabulary_customer WHERE c_acctbal > 0)""")


@query("C1 U4", f"""
WITH {FACTS}
SELECT district, year, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(3) OVER w AS nt,
  lag(adm) OVER w AS before, lead(adm, 2, 0) OVER w AS after, first_value(adm) OVER w AS fst,
  last_value(adm) OVER (PARTITION BY district ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lst,
  CAST(sum(adm) OVER (PARTITION BY district ORDER BY year RANGE BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS two_years
FROM facts WINDOW w AS (PARTITION BY district ORDER BY year)""")
def vocabulary_windows(t: Tables) -> DataFrame:
    """Window vocabulary over the yearly figures (few rows per district)."""
    t.gold_facts.createOrReplaceTempView("vocabulary_facts")
    return t.spark.sql("""
        SELECT district, year, CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER w AS BIGINT) AS rk,
          CAST(dense_rank() OVER w AS BIGINT) AS dr, CAST(ntile(3) OVER w AS BIGINT) AS nt,
          lag(adm) OVER w AS before, lead(adm, 2, 0L) OVER w AS after, first_value(adm) OVER w AS fst,
          last_value(adm) OVER (PARTITION BY district ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lst,
          sum(adm) OVER (PARTITION BY district ORDER BY year RANGE BETWEEN 1 PRECEDING AND CURRENT ROW) AS two_years
        FROM vocabulary_facts WINDOW w AS (PARTITION BY district ORDER BY year)""")


@query("C1", f"""
WITH {FACTS}
SELECT district, string_agg(fiscal_year, ',' ORDER BY year) AS years, count(DISTINCT teachers > 100) AS kinds, min(adm) AS lo,
  max(adm) AS hi, len(array_agg(adm)) AS items
FROM facts GROUP BY district HAVING count(*) > 1""")
def vocabulary_aggregates(t: Tables) -> DataFrame:
    t.gold_facts.createOrReplaceTempView("vocabulary_facts")
    return t.spark.sql("""
        SELECT district, listagg(fiscal_year, ',') WITHIN GROUP (ORDER BY fiscal_year) AS years,
          count(DISTINCT teachers > 100) AS kinds, min(adm) AS lo, max(adm) AS hi,
          CAST(size(array_agg(adm)) AS BIGINT) AS items
        FROM vocabulary_facts GROUP BY district HAVING count(*) > 1""")
