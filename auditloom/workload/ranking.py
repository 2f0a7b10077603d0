"""Ranking and top-k queries (W*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.numbers import growth_pct, money_sum, ratio
from auditloom.operators import rank as W, rollups as R
from auditloom.workload.binding import FACTS, LOTS, REC, Tables, growth, rat
from auditloom.workload.registry import query


@query("W1", f"""
WITH {FACTS}
SELECT district, year, total, adm,
  row_number() OVER (PARTITION BY year ORDER BY total ASC, district) AS total_rank,
  row_number() OVER (PARTITION BY year ORDER BY adm DESC, district) AS adm_rank
FROM facts""")
def ordinal_ranks(t: Tables) -> DataFrame:
    rows = t.facts.select("district", "year", "total", "adm")
    return W.ordinal_ranks(rows, {"total": "asc", "adm": "desc"}, "district", ["year"])


@query("W1", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""")
def global_order_rank(t: Tables) -> DataFrame:
    """Every order ranked over the whole table, without a one-task window."""
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")]
    return W.global_rank(t.orders.select("o_orderkey", "o_totalprice"), order).select("o_orderkey", "rank")


@query("W1", """
SELECT o_orderkey, o_totalprice, o_orderdate, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS customer,
  row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS o_totalprice_rank,
  row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) AS o_orderdate_rank,
  row_number() OVER (ORDER BY CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END DESC NULLS LAST, o_orderkey) AS customer_rank FROM orders""")
def table_ranks(t: Tables) -> DataFrame:
    """Three metrics of different types ranked over the whole table by one range shuffle; a third of one is null."""
    customer = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("customer")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", customer)
    return W.ordinal_ranks(rows, {"o_totalprice": "desc", "o_orderdate": "asc", "customer": "desc"}, "o_orderkey")


@query("W2 A9", f"""
WITH {REC}
SELECT owner, CAST(sum(total_value) AS DOUBLE) AS total_value, count(*) AS properties
FROM rec WHERE owner <> '' GROUP BY owner ORDER BY total_value DESC, owner LIMIT 50""")
def topk_owners_value(t: Tables) -> DataFrame:
    owners = R.owner_rollup(t.records)
    return W.top_k(owners, [F.col("total_value").desc(), F.col("owner")], 50)


@query("W3", f"""
WITH {REC}, o AS (SELECT district, owner, sum(total_value) AS v, count(*) AS n FROM rec GROUP BY district, owner),
q AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY v DESC, owner) AS rk FROM o)
SELECT district, owner, CAST(v AS DOUBLE) AS total_value, n AS properties, rk AS rank FROM q WHERE rk <= 10""")
def topk_per_group(t: Tables) -> DataFrame:
    return R.district_top_owners(t.records)


@query("W4", f"""
WITH {LOTS}, top AS (SELECT owner, count(*) AS properties, CAST(sum(total_value) AS DOUBLE) AS total_value
  FROM lots WHERE owner <> '' GROUP BY owner ORDER BY properties DESC, owner LIMIT 50)
SELECT owner, properties, total_value, {rat('total_value', 'properties', 0)} AS avg_value FROM top
WHERE properties >= 250""")
def topk_then_threshold(t: Tables) -> DataFrame:
    owners = R.owner_rollup(t.lots(), weight="n")
    top = W.limit_then_threshold(owners, [F.col("properties").desc(), F.col("owner")], 50,
                                 F.col("properties") >= 250)
    return top.withColumn("avg_value", ratio("total_value", "properties", digits=0))


@query("W5", f"""
WITH {REC}
SELECT owner, count(*) AS properties, CAST(sum(total_value) AS DOUBLE) AS total_value
FROM rec GROUP BY owner HAVING count(*) >= 15""")
def threshold_then_sort(t: Tables) -> DataFrame:
    return W.threshold_then_sort(R.owner_rollup(t.records), F.col("properties") >= 15,
                                 [F.col("properties").desc(), F.col("owner")])


@query("W7", f"""
WITH {FACTS}, l AS (SELECT district, CAST(max(adm) FILTER (WHERE year = (SELECT max(year) FROM facts)) AS DOUBLE) AS adm,
    max(total) FILTER (WHERE year = (SELECT max(year) FROM facts)) AS total FROM facts GROUP BY district)
SELECT district, adm, total FROM l
UNION ALL SELECT 'Peer Average', floor(avg(CASE WHEN adm > 0 THEN adm END)*1e2+5e-1)/1e2,
  floor(avg(CASE WHEN total > 0 THEN total END)*1e2+5e-1)/1e2 FROM l""")
def latest_year_matrix(t: Tables) -> DataFrame:
    return W.latest_year_matrix(t.gold_facts, ["district"], "year", ["adm", "total"])


@query("W7", f"""
WITH {FACTS}, q AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY (fiscal_year = 'FY2000') DESC, year) AS n
  FROM facts)
SELECT district, fiscal_year, adm FROM q WHERE n = 1""")
def preferred_year(t: Tables) -> DataFrame:
    out = W.preferred_year_row(t.facts, ["district"], "fiscal_year", "FY2000", [F.col("year")])
    return out.select("district", "fiscal_year", "adm")


@query("W8", f"""
WITH {FACTS}
SELECT district, coalesce(max(adm) FILTER (WHERE fiscal_year = 'FY1998'), 0) AS adm,
  CASE WHEN count(*) FILTER (WHERE fiscal_year = 'FY2000') > 0
    THEN max(total) FILTER (WHERE fiscal_year = 'FY2000') ELSE max(total) FILTER (WHERE fiscal_year = 'FY1998') END AS total
FROM facts WHERE NOT (district = 'ASIA' AND fiscal_year = 'FY2000') GROUP BY district""")
def mixed_year_compare(t: Tables) -> DataFrame:
    rows = t.facts.filter("not (district = 'ASIA' and fiscal_year = 'FY2000')")
    return W.mixed_year_compare(rows, ["district"], "fiscal_year", "FY1998", "FY2000", ["adm"], ["total"])


@query("W9", f"""
WITH {REC}, y AS (SELECT nation, sum(total_value) FILTER (WHERE year = 1995) AS a,
    sum(total_value) FILTER (WHERE year = 2000) AS b FROM rec GROUP BY nation),
g AS (SELECT nation, {growth('CAST(a AS DOUBLE)', 'CAST(b AS DOUBLE)', 1)} AS growth_pct FROM y)
SELECT min(nation) AS nation, growth_pct FROM g WHERE growth_pct = (SELECT max(growth_pct) FROM g) GROUP BY growth_pct""")
def fastest_growing(t: Tables) -> DataFrame:
    def total(year: int):
        return money_sum(F.when(F.col("year") == year, F.col("total_value"))).cast("double")

    ends = t.records.filter(F.col("year").isin(1995, 2000)).groupBy("nation").agg(total(1995).alias("a"), total(2000).alias("b"))
    return W.arg_max(ends.select("nation", growth_pct("a", "b", 1).alias("growth_pct")), "nation", "growth_pct")


@query("W11", f"""
WITH {FACTS}
SELECT district, year, ntile(4) OVER (PARTITION BY year ORDER BY total, district) AS quartile FROM facts""")
def quartile_rank(t: Tables) -> DataFrame:
    return W.quartile(t.facts.select("district", "year", "total"), "total", "district", ["year"]).drop("total")


@query("W11", """
SELECT c_custkey, ntile(4) OVER (ORDER BY c_acctbal, c_custkey) AS quartile FROM customer""")
def quartile_rank_all(t: Tables) -> DataFrame:
    """Quartiles of a whole table through the global rank."""
    return W.global_quartile(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey").drop("c_acctbal")


@query("W6", f"""
WITH {LOTS}, y AS (SELECT year, CAST(sum(total_value) AS DOUBLE) AS v, count(*) AS n,
    count(DISTINCT owner) FILTER (WHERE entity_type = 'LLC') AS u FROM lots GROUP BY year),
l AS (SELECT *, lag(year) OVER (ORDER BY year) AS py, lag(v) OVER (ORDER BY year) AS pv,
    lag(n) OVER (ORDER BY year) AS pn, lag(u) OVER (ORDER BY year) AS pu FROM y)
SELECT py AS from_year, year AS to_year, v - pv AS value_change, {growth('pv', 'v', 1)} AS value_change_pct,
  n - pn AS records_change, u - pu AS llcs_change FROM l WHERE py IS NOT NULL""")
def yoy_change(t: Tables) -> DataFrame:
    # Distinct names fold to (year, owner) first, so the count of names sums flags.
    cells = t.lots("year").groupBy("year", "entity_type", "owner").agg(
        F.sum("n").alias("n"), money_sum("total_value", wide=True).alias("v"))
    yearly = cells.groupBy("year").agg(
        F.sum("v").cast("double").alias("value"), F.sum("n").alias("records"),
        F.sum(F.when(F.col("entity_type") == "LLC", 1).otherwise(0)).alias("llcs"))
    return W.year_over_year(yearly, "year", ["value", "records", "llcs"], pct=["value"])
