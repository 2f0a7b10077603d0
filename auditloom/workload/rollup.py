"""Rollup queries (A*, G1 is in ``join``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom import fixed
from auditloom.functions.numbers import money_sum
from auditloom.operators import rollups as R
from auditloom.workload.binding import FACTS, LOTS, REC, VREC, Tables, pct, rat
from auditloom.workload.registry import query

_CLASS_NAMES = "CASE property_class " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in fixed.PROPERTY_CLASSES.items()
) + " ELSE 'Class ' || CAST(property_class AS VARCHAR) END"


@query("S1 N1 N2 A4 A8", f"""
WITH {LOTS}, g AS (SELECT entity_type, count(*) AS n, sum(total_value) AS v FROM lots GROUP BY entity_type)
SELECT entity_type, n AS count, {pct('n', 'sum(n) OVER ()', 1)} AS pct_records, CAST(v AS DOUBLE) AS total_value,
  {pct('v', 'sum(v) OVER ()', 1)} AS pct_value
FROM g""")
def entity_breakdown(t: Tables) -> DataFrame:
    return R.entity_breakdown(t.lots(), weight="n")


@query("A1", f"""
WITH {VREC}
SELECT count(*) AS total_records, CAST(sum(land_value) AS DOUBLE) AS land_value,
  CAST(sum(improvement_value) AS DOUBLE) AS improvement_value, CAST(sum(total_value) AS DOUBLE) AS total_value,
  CAST(sum(tax_amount) AS DOUBLE) AS tax_amount
FROM vrec""")
def totals(t: Tables) -> DataFrame:
    return R.totals(t.valued_records, ["land_value", "improvement_value", "total_value", "tax_amount"])


@query("A2 A4 A5", f"""
WITH {VREC}, g AS (
  SELECT district, count(*) AS n, sum(land_value) AS lv, sum(improvement_value) AS iv, sum(total_value) AS tv, sum(tax_amount) AS tx,
    sum(CASE WHEN parcel % 4 = 0 THEN land_value ELSE 0 END) AS df, coalesce(sum(acreage), 0) AS ac FROM vrec GROUP BY district)
SELECT district, n AS property_count, CAST(lv AS DOUBLE) AS land_value, CAST(iv AS DOUBLE) AS improvement_value,
  CAST(tv AS DOUBLE) AS total_value, CAST(tx AS DOUBLE) AS tax_amount, CAST(df AS DOUBLE) AS deferred_value, CAST(ac AS DOUBLE) AS total_acreage,
  {pct('tv', 'sum(tv) OVER ()', 2)} AS pct_of_county_value, {pct('tx', 'sum(tx) OVER ()', 2)} AS pct_of_county_tax,
  {rat('tv', 'n', 0)} AS avg_property_value
FROM g""")
def district_rollup(t: Tables) -> DataFrame:
    """All five sums; a fourth of the land counts as deferred."""
    deferred = F.when(F.col("parcel") % 4 == 0, F.col("land_value")).otherwise(F.lit(0.0))
    return R.district_rollup(t.valued_records.withColumn("deferred_value", deferred))


@query("A3", f"""
WITH {REC}
SELECT district, CAST(property_class AS BIGINT) AS property_class, count(*) AS count,
  CAST(sum(total_value) AS DOUBLE) AS total_value
FROM rec GROUP BY district, property_class""")
def district_class_rollup(t: Tables) -> DataFrame:
    out = R.nested_rollup(t.records, "district", "property_class", ["total_value"])
    return out.withColumn("property_class", F.col("property_class").cast("bigint"))


@query("A3", f"""
WITH {REC}, g AS (SELECT district, property_class, count(*) AS n, CAST(sum(total_value) AS DOUBLE) AS v
  FROM rec GROUP BY district, property_class)
SELECT district, string_agg(CAST(property_class AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY property_class)
  AS classes FROM g GROUP BY district""")
def district_class_map(t: Tables) -> DataFrame:
    """The nested sink form, read back from its map."""
    rollup = R.nested_rollup(t.records, "district", "property_class", ["total_value"])
    nested = R.nest(rollup, "district", "property_class", "by_class")
    entries = F.transform(F.map_entries("by_class"), lambda e: F.concat(
        e["key"], F.lit(":"), e["value"]["count"].cast("string")))
    return nested.select("district", F.array_join(entries, ",").alias("classes"))


@query("A6 J7 A4", f"""
WITH {REC}, g AS (SELECT property_class, count(*) AS n, sum(total_value) AS v FROM rec GROUP BY property_class)
SELECT CAST(property_class AS BIGINT) AS property_class, n AS count, CAST(v AS DOUBLE) AS total_value,
  {_CLASS_NAMES} AS class_name, {pct('v', 'sum(v) OVER ()', 2)} AS pct_of_total
FROM g""")
def class_rollup_named(t: Tables) -> DataFrame:
    out = R.class_rollup(t.records)
    return out.withColumn("property_class", F.col("property_class").cast("bigint"))


@query("A7", f"""
WITH {REC}
SELECT coalesce(nullif(zone, ''), 'Unknown') AS zone, count(*) AS count, CAST(sum(total_value) AS DOUBLE) AS total_value
FROM rec GROUP BY 1""")
def zone_rollup(t: Tables) -> DataFrame:
    return R.zone_rollup(t.records)


@query("A9", f"""
WITH {LOTS}
SELECT owner, CAST(sum(total_value) AS DOUBLE) AS total_value, count(*) AS properties, min(entity_type) AS entity_type,
  string_agg(DISTINCT district, '|' ORDER BY district) AS districts
FROM lots WHERE owner <> '' GROUP BY owner""")
def owner_rollup(t: Tables) -> DataFrame:
    out = R.owner_rollup(t.lots(), entity="entity_type", district="district", weight="n")
    return out.withColumn("districts", F.array_join("districts", "|"))


@query("A10", f"""
WITH {LOTS}, p AS (
  SELECT property_class, entity_type, count(*) AS n FROM lots GROUP BY property_class, entity_type),
q AS (SELECT *, row_number() OVER (PARTITION BY property_class ORDER BY n DESC, entity_type) AS rk,
    sum(n) OVER (PARTITION BY property_class) AS total FROM p)
SELECT CAST(property_class AS BIGINT) AS property_class, entity_type, n AS count, rk AS rank,
  {pct('n', 'total', 1)} AS pct FROM q WHERE rk <= 5""")
def class_type_mix_top5(t: Tables) -> DataFrame:
    out = R.group_top_mix(t.lots("property_class"), "property_class", "entity_type", 5, weight="n")
    return out.select(F.col("property_class").cast("bigint").alias("property_class"), "entity_type", "count",
                      "rank", "pct")


@query("A11", f"""
WITH {REC}, p AS (SELECT property_class, owner, sum(total_value) AS v FROM rec GROUP BY property_class, owner),
g AS (SELECT property_class, count(*) AS n, sum(total_value) AS gv FROM rec GROUP BY property_class),
q AS (SELECT *, row_number() OVER (PARTITION BY property_class ORDER BY v DESC, owner) AS rk FROM p)
SELECT CAST(property_class AS BIGINT) AS property_class, owner, CAST(v AS DOUBLE) AS value, rk AS rank,
  n AS group_count, {rat('gv', 'n', 0)} AS group_avg
FROM q JOIN g USING (property_class) WHERE rk <= 10""")
def class_top_owners(t: Tables) -> DataFrame:
    out = R.group_top_mix(t.records, "property_class", "owner", 10, by="value")
    return out.select(F.col("property_class").cast("bigint").alias("property_class"), "owner", "value", "rank",
                      F.col("group_count").cast("bigint").alias("group_count"), "group_avg")


@query("N5 A12", f"""
WITH {LOTS}
SELECT state, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM lots)', 2)} AS pct
FROM lots WHERE state IS NOT NULL GROUP BY state""")
def state_distribution(t: Tables) -> DataFrame:
    return R.state_distribution(t.lots(), weight="n")


@query("A13", f"""
WITH {LOTS}
SELECT owner, arg_max(state, p_partkey) AS state, count(*) AS properties,
  CAST(sum(total_value) AS DOUBLE) AS total_value
FROM lots WHERE state IS NOT NULL AND state <> 'VA' GROUP BY owner
ORDER BY total_value DESC, owner LIMIT 30""")
def out_of_state_owners(t: Tables) -> DataFrame:
    return R.out_of_state_owners(t.lots(), "owner", "state", "p_partkey", weight="n")


_LAST_NAME = """CASE WHEN owner = '' OR regexp_matches(upper(owner),
    'LLC|INC|CORP|TRUST|CHURCH|BANK|COUNTY|ESTATE|FOUNDATION|ASSOC| LC') THEN NULL
  WHEN contains(owner, ',') THEN upper(regexp_replace(trim(split_part(owner, ',', 1)),
    '(?i)\\s+(JR|SR|II|III|IV)\\.?$', ''))
  WHEN contains(owner, ' ') AND split_part(upper(owner), ' ', 1) NOT IN ('THE', 'A', 'AN')
    THEN split_part(upper(owner), ' ', 1) END"""


@query("N3 A14", f"""
WITH {LOTS}, n AS (SELECT total_value, {_LAST_NAME} AS last_name FROM lots WHERE entity_type = 'Individual')
SELECT last_name, count(*) AS properties, CAST(sum(total_value) AS DOUBLE) AS total_value,
  {rat('sum(total_value)', 'count(*)', 0)} AS avg_value
FROM n WHERE length(last_name) > 1 GROUP BY last_name ORDER BY properties DESC, last_name LIMIT 30""")
def surname_frequency(t: Tables) -> DataFrame:
    return R.surname_frequency(t.lots(), weight="n")


@query("A15", f"""
WITH {LOTS}, l AS (SELECT * FROM lots WHERE entity_type = 'LLC'),
o AS (SELECT owner, count(*) AS properties, CAST(sum(total_value) AS DOUBLE) AS total_value,
    string_agg(DISTINCT district, '|' ORDER BY district) AS districts FROM l GROUP BY owner),
c AS (SELECT owner, property_class, row_number() OVER (PARTITION BY owner ORDER BY count(*) DESC, property_class) AS rk
  FROM l GROUP BY owner, property_class),
k AS (SELECT owner, string_agg('C' || CAST(property_class AS VARCHAR), ',' ORDER BY rk) AS classes
  FROM c WHERE rk <= 3 GROUP BY owner)
SELECT o.*, classes FROM o LEFT JOIN k USING (owner)""")
def type_deep_dive(t: Tables) -> DataFrame:
    return R.type_deep_dive(t.lots("property_class"), "LLC", weight="n")


@query("A19 A20", f"""
WITH {LOTS}
SELECT year, count(*) AS total_records, CAST(sum(total_value) AS DOUBLE) AS total_value,
  CAST(coalesce(sum(total_value) FILTER (WHERE entity_type = 'LLC'), 0) AS DOUBLE) AS llc_value,
  CAST(coalesce(sum(total_value) FILTER (WHERE entity_type = 'Trust'), 0) AS DOUBLE) AS trust_value,
  {pct("coalesce(sum(total_value) FILTER (WHERE entity_type = 'LLC'), 0)", 'sum(total_value)', 1)} AS llc_pct,
  {pct("coalesce(sum(total_value) FILTER (WHERE entity_type = 'Trust'), 0)", 'sum(total_value)', 1)} AS trust_pct,
  count(DISTINCT owner) FILTER (WHERE entity_type = 'LLC') AS unique_llcs
FROM lots GROUP BY year""")
def conditional_totals(t: Tables) -> DataFrame:
    # One fold to (year, owner) serves the totals and the count of distinct names.
    lots = t.lots("year")
    owners = lots.groupBy("year", "entity_type", "owner").agg(
        F.sum("n").alias("n"), money_sum("total_value", wide=True).alias("total_value"))
    llc = F.when(F.col("entity_type") == "LLC", 1).otherwise(0)
    out = R.conditional_totals(owners.withColumn("llc", llc), ["LLC", "Trust"], scope=["year"], weight="n",
                               extra=[F.sum("llc").alias("unique_llcs")])
    return out


_PROFILE = {"Individual": "individual", "LLC": "llc", "Trust": "trust", "Corporation": "corporation", "Estate": "estate"}
_PROFILE_SUMS = ",\n    ".join(
    f"count(*) FILTER (WHERE entity_type = '{kind}') AS {name}_n, coalesce(sum(total_value) FILTER (WHERE entity_type = '{kind}'), 0) AS {name}_v"
    for kind, name in _PROFILE.items())
_PROFILE_COLUMNS = ",\n  ".join(
    f"{name}_n AS {name}_count, CAST({name}_v AS DOUBLE) AS {name}_value, {pct(f'{name}_n', 'n', 1)} AS {name}_pct_records, "
    f"{pct(f'{name}_v', 'v', 1)} AS {name}_pct_value" for name in _PROFILE.values())


@query("A22", f"""
WITH {LOTS}, g AS (SELECT district, year, count(*) AS n, sum(total_value) AS v,
    {_PROFILE_SUMS}
  FROM lots GROUP BY district, year)
SELECT district, year, n AS total_records, CAST(v AS DOUBLE) AS total_value, {_PROFILE_COLUMNS}
FROM g""")
def district_profile(t: Tables) -> DataFrame:
    return R.district_profile(t.lots("year"), scope=["year"], weight="n")


@query("A22 W3", f"""
WITH {REC}, o AS (SELECT district, year, owner, count(*) AS n, sum(total_value) AS v FROM rec GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY district, year ORDER BY n DESC, owner) AS rk FROM o)
SELECT district, year, owner, CAST(v AS DOUBLE) AS total_value, n AS properties, rk AS rank
FROM q WHERE rk <= 10 AND n >= 3""")
def district_top_multi(t: Tables) -> DataFrame:
    """Top ten by count per district and year, then three or more."""
    return R.district_top_owners(t.records, by="count", at_least=3, scope=["year"])


@query("A23", f"""
WITH {VREC}
SELECT zone, count(*) AS parcels, CAST(sum(total_value) AS DOUBLE) AS total_value, sum(acreage) AS acres,
  {rat('sum(total_value)', 'count(*)', 2)} AS avg_value
FROM vrec GROUP BY zone""")
def land_use_rollup(t: Tables) -> DataFrame:
    return R.land_use_rollup(t.valued_records, "zone", "total_value", "acreage")


@query("A24 V6", f"""
WITH {REC}
SELECT district, nation, CAST(grouping(district, nation) AS BIGINT) AS level,
  CAST(sum(total_value) AS DOUBLE) AS value, count(*) AS records
FROM rec GROUP BY ROLLUP (district, nation)""")
def hierarchy_rollup(t: Tables) -> DataFrame:
    return R.hierarchy(t.records, ["district", "nation"], "total_value")


@query("A17", f"""
WITH {FACTS}
SELECT year, {{avg_adm}} AS adm, {{avg_total}} AS total, {{avg_admins}} AS admins
FROM facts GROUP BY year""".replace("{avg_adm}", "floor(avg(CASE WHEN adm > 0 THEN CAST(adm AS DOUBLE) END)*1e2+5e-1)/1e2")
       .replace("{avg_total}", "floor(avg(CASE WHEN total > 0 THEN total END)*1e2+5e-1)/1e2")
       .replace("{avg_admins}", "floor(avg(CASE WHEN admins > 0 THEN CAST(admins AS DOUBLE) END)*1e2+5e-1)/1e2"))
def peer_average_positive(t: Tables) -> DataFrame:
    return R.positive_means(t.facts, ["adm", "total", "admins"], ["year"])


@query("A18", f"""
WITH {FACTS}
SELECT year, count(adm) AS peers, floor(avg(CAST(adm AS DOUBLE))*1e2+5e-1)/1e2 AS mean,
  floor(quantile_cont(CAST(adm AS DOUBLE), 0.5)*1e2+5e-1)/1e2 AS median,
  floor(stddev_samp(CAST(adm AS DOUBLE))*1e2+5e-1)/1e2 AS std_dev
FROM facts GROUP BY year""")
def peer_stats(t: Tables) -> DataFrame:
    return R.peer_stats(t.facts, "adm", ["year"])
