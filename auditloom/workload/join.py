"""Dirty-key joins, labels, features, networks (J3, J4, J8, J11, J12, G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.numbers import money_sum
from auditloom.operators import joins as J, networks as G, rollups as R
from auditloom.operators.rank import top_k_per_group
from auditloom.workload.binding import LOTS, REC, Tables, pct
from auditloom.workload.registry import query

_LATEST = "(SELECT max(year(o_orderdate)) FROM orders)"


@query("J3 N4 P6 A26", f"""
WITH j AS (SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders
  ON o_custkey = c_custkey AND o_orderkey % 3 <> 0 AND year(o_orderdate) = {_LATEST})
SELECT count(*) AS rows, count(o_orderkey) AS matched, {pct('count(o_orderkey)', 'count(*)', 1)} AS match_pct FROM j""")
def left_join_match_rate(t: Tables) -> DataFrame:
    """Customers as parcels; the latest year's orders carry the normalised id."""
    parcels = t.customer.select("c_custkey", F.concat(F.lit(" "), F.col("c_custkey").cast("string"),
                                                      F.lit("   A ")).alias("ptm_id"))
    records = t.orders.select(
        F.year("o_orderdate").alias("year"), "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit("--A "))).alias("code"))
    return J.match_rate(J.parcel_join(parcels, records, "ptm_id", "code", ["o_orderkey"]), "o_orderkey")


def _accounts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and orders with blank account numbers on both sides."""
    parcels = t.customer.select("c_custkey", F.col("c_name").alias("owner"),
                                F.when(F.col("c_custkey") % 7 == 0, 0).otherwise(F.col("c_custkey")).alias("macct"))
    records = t.orders.select(
        F.year("o_orderdate").alias("year"), "o_orderkey", F.col("o_orderstatus").alias("owner"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("account_number"))
    return parcels, records


@query("J4 N4b P6", f"""
SELECT c_custkey, c_name AS owner_gis, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS macct_str,
  o_orderkey, o_orderstatus AS owner_tax
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND c_custkey % 7 <> 0 AND o_orderkey % 13 <> 0
  AND year(o_orderdate) = {_LATEST}""")
def blank_key_join(t: Tables) -> DataFrame:
    parcels, records = _accounts(t)
    out = J.account_join(parcels, records, "macct", "account_number", ["o_orderkey", "owner"])
    return out.select("c_custkey", "owner_gis", "macct_str", "o_orderkey", "owner_tax")


@query("J4", """
WITH l AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS k, count(*) AS l
  FROM customer GROUP BY 1),
r AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS k, count(*) AS r
  FROM orders GROUP BY 1),
p AS (SELECT l.k, l, coalesce(r, 0) AS r, CASE WHEN l.k = '' THEN 0 ELSE coalesce(r, 0) END AS s
  FROM l LEFT JOIN r ON l.k = r.k)
SELECT CAST(sum(l) AS BIGINT) AS parcels, CAST(sum(l * greatest(s, 1)) AS BIGINT) AS rows_strict,
  CAST(sum(l * s) AS BIGINT) AS matched_strict, CAST(sum(l * greatest(r, 1)) AS BIGINT) AS rows_blank,
  CAST(sum(l * r) AS BIGINT) AS matched_blank FROM p""")
def blank_key_report(t: Tables) -> DataFrame:
    """Result sizes with and without matching blanks, from counts per key."""
    parcels, records = _accounts(t)
    return J.account_match_report(parcels, records, "macct", "account_number")


@query("J8 N12", f"""
WITH {REC}, o AS (SELECT district, owner, CAST(sum(total_value) AS BIGINT) AS v, count(*) AS n FROM rec GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY v DESC, owner) AS rk FROM o)
SELECT district, rk - 1 AS i, owner, v AS total_value, n AS properties FROM q WHERE rk <= 30""")
def json_array_unnest(t: Tables) -> DataFrame:
    """A JSON array of thirty owners per district, read back whole."""
    owners = t.records.groupBy("district", "owner").agg(
        F.round(money_sum("total_value"), 0).cast("bigint").alias("total_value"), F.count(F.lit(1)).alias("properties"))
    top = top_k_per_group(owners, ["district"], [F.col("total_value").desc(), F.col("owner")], 30)
    entry = F.struct("rank", "owner", "total_value", "properties")
    packed = top.groupBy("district").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("top_owners"))
    out = J.unnest_json(packed, "top_owners", "struct<owner string, total_value bigint, properties bigint>", ["district"])
    return out.withColumn("i", F.col("i").cast("bigint"))


@query("J11 V6", f"""
WITH {REC}, g AS (SELECT district, count(*) AS n, CAST(sum(total_value) AS DOUBLE) AS v FROM rec GROUP BY district)
SELECT r_name || ' district' AS name, n AS records, v AS total_value
FROM region LEFT JOIN g ON district = r_name AND r_name IN ('ASIA', 'EUROPE', 'AFRICA')""")
def feature_enrichment(t: Tables) -> DataFrame:
    """Regions as features; two of them are not in the name map and stay as they are."""
    features = t.region.select(F.concat("r_name", F.lit(" district")).alias("name"))
    rollup = R.group_rollup(t.records, ["district"], ["total_value"], "records")
    names = {f"{n} district": n for n in ("ASIA", "EUROPE", "AFRICA")}
    out = J.enrich_features(features, rollup, "name", "district", names)
    return out.select("name", "ownership.records", "ownership.total_value")


@query("J12 A16", f"""
WITH j AS (SELECT coalesce(CAST(quality AS VARCHAR), 'UNKNOWN') AS quality, n_chars
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT quality, count(*) AS m, CAST(sum(n_chars) AS BIGINT) AS w FROM j GROUP BY quality)
SELECT quality, m AS members, w AS weight, {pct('m', 'sum(m) OVER ()', 2)} AS pct_members,
  {pct('w', 'sum(w) OVER ()', 2)} AS pct_weight FROM g""")
def weighted_label_distribution(t: Tables) -> DataFrame:
    members = t.documents.select("doc_id", "n_chars")
    return R.weighted_labels(members, t.labels, "doc_id", "quality", "n_chars")


@query("W12", """
WITH j AS (SELECT d.doc_id, n_chars, CAST(quality AS VARCHAR) AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
q AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY n_chars DESC, doc_id) AS rank FROM j)
SELECT * FROM q WHERE rank <= 20""")
def top_members_per_label(t: Tables) -> DataFrame:
    out = R.top_members_per_label(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id", "quality", "n_chars")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("G1", """
WITH v AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, count(*) AS n FROM lineitem GROUP BY 1),
s AS (SELECT 'HOUSE OF ' || n_name AS address, s_name, v, n FROM v JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey),
a AS (SELECT address, count(DISTINCT s_name) AS name_count, CAST(sum(n) AS BIGINT) AS property_count,
    CAST(sum(v) AS DOUBLE) AS total_value FROM s GROUP BY address HAVING count(DISTINCT s_name) >= 3
  ORDER BY total_value DESC, address LIMIT 50),
r AS (SELECT address, s_name, row_number() OVER (PARTITION BY address ORDER BY v DESC, s_name) AS k FROM s)
SELECT a.*, (SELECT string_agg(s_name, ',' ORDER BY k) FROM r WHERE r.address = a.address AND k <= 15) AS names FROM a""")
def shared_key_networks(t: Tables) -> DataFrame:
    """Suppliers that share a nation; lines fold to the supplier before the join."""
    folded = t.lineitem.groupBy("l_suppkey").agg(money_sum("l_extendedprice").alias("total_value"),
                                                 F.count(F.lit(1)).alias("n"))
    rows = (folded.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .withColumn("mail", F.concat(F.lit("House of "), "n_name")))
    out = G.top_networks(rows, "mail", "s_name", "s_suppkey", entity=None, weight="n")
    return out.withColumn("names", F.array_join(F.col("names.name"), ","))


@query("G1 N6", f"""
WITH {LOTS}, l AS (SELECT upper(trim(left(address, 40))) AS address, left(owner, 40) AS k, total_value FROM lots
  WHERE entity_type = 'LLC'),
a AS (SELECT address, count(DISTINCT k) AS name_count, count(*) AS property_count, CAST(sum(total_value) AS DOUBLE) AS total_value
  FROM l WHERE length(address) > 5 GROUP BY address HAVING count(DISTINCT k) >= 2)
SELECT * FROM a""")
def llc_networks(t: Tables) -> DataFrame:
    """All addresses shared by two or more companies."""
    networks, _ = G.shared_addresses(t.lots(), "address", "owner", "p_partkey", min_names=2, weight="n")
    return networks
