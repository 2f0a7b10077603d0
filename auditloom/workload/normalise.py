"""Normaliser queries (N*, P8, P9). Texts are derived from the tables' own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom import fixed
from auditloom.functions import keys as K, names as N, numbers as U
from auditloom.functions.predicates import same_fiscal_year
from auditloom.workload.binding import PARTIES, Tables, sql_classify
from auditloom.workload.registry import query
from auditloom.workload.rollup import _LAST_NAME

_BUSINESS = "|".join(w.replace(".", "\\.") for w in fixed.BUSINESS_WORDS)


@query("N1 N3 N11", f"""
WITH {PARTIES}
SELECT p_partkey, owner, {_LAST_NAME} AS last_name, left(owner, 10) AS display FROM parties""")
def normalize_names(t: Tables) -> DataFrame:
    raw = t.parties.select("p_partkey", "owner")
    return raw.select("p_partkey", "owner", N.extract_last_name("owner").alias("last_name"),
                      K.display_key("owner", 10).alias("display"))


@query("N2", f"""
WITH {PARTIES}
SELECT p_partkey, {sql_classify('owner', 'detailed')} AS detailed, {sql_classify('owner', 'yearly')} AS yearly,
  {sql_classify('owner', 'district')} AS district FROM parties""")
def classify_three_rule_sets(t: Tables) -> DataFrame:
    kinds = [N.classify_entity("owner", rules).alias(rules) for rules in ("detailed", "yearly", "district")]
    return t.parties.select("p_partkey", "owner").select("p_partkey", *kinds)


@query("N3b P9", f"""
WITH {PARTIES}, r AS (SELECT p_partkey,
    CASE WHEN p_partkey % 5 = 0 THEN 'VAN ' ELSE '' END || trim(owner_raw) || '    SOLD 2020' AS raw FROM parties),
h AS (SELECT p_partkey, trim(regexp_extract(raw, '^(.*?)\\s{{3,}}', 1)) AS head FROM r)
SELECT p_partkey, regexp_matches(upper(head), '{_BUSINESS}') AS business,
  CASE WHEN regexp_matches(upper(head), '{_BUSINESS}') OR head = '' THEN NULL
    WHEN split_part(upper(head), ' ', 1) IN ('DE','LA','DEL','VAN','VON','MC','O','DI','DA','LE','DU')
      AND contains(head, ' ') THEN split_part(upper(head), ' ', 1) || ' ' || split_part(upper(head), ' ', 2)
    WHEN length(split_part(head, ' ', 1)) >= 2 THEN split_part(upper(head), ' ', 1) END AS surname
FROM h""")
def normalize_surnames(t: Tables) -> DataFrame:
    prefix = F.when(F.col("p_partkey") % 5 == 0, F.lit("VAN ")).otherwise(F.lit(""))
    raw = t.parties.select("p_partkey", F.concat(prefix, F.trim("owner_raw"), F.lit("    SOLD 2020")).alias("raw"))
    head = U.strip(F.split("raw", r"\s{3,}").getItem(0))
    return raw.select("p_partkey", N.is_business(head).alias("business"), N.extract_surname("raw").alias("surname"))


@query("N4 N4b N6", """
SELECT o_orderkey,
  CAST(o_custkey AS VARCHAR) || '--' || left(o_orderpriority, 1) || '--' || o_orderstatus AS parcel_key,
  CASE WHEN o_custkey % 7 = 0 THEN '' ELSE CAST(o_custkey % 7 AS VARCHAR) END AS account_key,
  upper(trim(left('  ' || o_orderpriority || ' street ' || o_orderstatus, 12))) AS address_key
FROM orders""")
def normalize_keys(t: Tables) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    parcel = F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("    "), first, F.lit("\t "),
                      "o_orderstatus", F.lit(" "))
    address = F.concat(F.lit("  "), "o_orderpriority", F.lit(" street "), "o_orderstatus")
    return t.orders.select("o_orderkey", K.parcel_key(parcel).alias("parcel_key"),
                           K.account_key(F.col("o_custkey") % 7).alias("account_key"),
                           K.address_key(address, 12).alias("address_key"))


@query("N5", f"""
WITH {PARTIES}
SELECT p_partkey, state, nullif(trim(regexp_extract(city_state_zip, '^([A-Z\\s]+)\\s+[A-Z]{{2}}\\s+\\d{{5}}', 1)), '') AS city
FROM parties""")
def normalize_places(t: Tables) -> DataFrame:
    return t.parties.select("p_partkey", K.extract_state("city_state_zip").alias("state"),
                            K.extract_city("city_state_zip").alias("city"))


@query("N7 P8 N13", """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT o_orderkey, 'FY' || CAST(y AS VARCHAR) AS from_school_year, CASE WHEN o_orderstatus = 'F' AND y < 2000 THEN 'Unknown' ELSE 'FY' || CAST(y AS VARCHAR) END AS from_file,
  'FY' || CAST(y AS VARCHAR) AS from_text, CASE WHEN o_orderstatus = 'F' THEN 'FY' || CAST(y AS VARCHAR) END AS strict,
  CAST(y - 1 AS VARCHAR) || '-' || lpad(CAST(y % 100 AS VARCHAR), 2, '0') AS school_year,
  y = 1999 AS is_1999,
  CASE o_orderstatus WHEN 'F' THEN 'acfr' WHEN 'O' THEN 'adopted' ELSE 'unknown' END AS document_type
FROM o""")
def fiscal_year_forms(t: Tables) -> DataFrame:
    y = F.year("o_orderdate")
    span = F.concat((y - 1).cast("string"), F.lit("-"), F.lpad((y % 100).cast("string"), 2, "0"))
    status = F.col("o_orderstatus")
    file = (F.when(status == "F", F.concat(F.lit("FY"), y.cast("string"), F.lit("_ACFR.pdf")))
            .when(status == "O", F.concat(F.lit("Adopted_"), span, F.lit(".pdf")))
            .otherwise(F.concat(F.lit("table_"), span, F.lit(".xlsx"))))
    text = (F.when(status == "F", F.concat(F.lit("Budget for fy "), y.cast("string")))
            .otherwise(F.concat(F.lit("School year "), (y - 1).cast("string"), F.lit(" - "), y.cast("string"))))
    rows = t.orders.select("o_orderkey", span.alias("span"), file.alias("file"), text.alias("text"),
                           F.concat(F.lit("FY"), y.cast("string")).alias("fy"))
    return rows.select(
        "o_orderkey", K.fiscal_year_key("span").alias("from_school_year"), K.fiscal_year_from_file("file").alias("from_file"),
        K.fiscal_year_from_text("text").alias("from_text"), K.fiscal_year_strict("file").alias("strict"),
        K.school_year("fy").alias("school_year"), same_fiscal_year("span", "FY1999").alias("is_1999"),
        K.document_type("file").alias("document_type"))


@query("N8", """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 1 THEN -c ELSE CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE c END END AS DOUBLE)
    AS amount,
  CAST(CASE WHEN o_orderkey % 4 = 1 THEN -c WHEN o_orderkey % 4 = 3 THEN NULL ELSE c END AS DOUBLE) AS amount_or_null,
  CAST(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS DOUBLE) AS coded
FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders)""")
def number_cleaning(t: Tables) -> DataFrame:
    """Whole amounts written as $1,234 / (1,234) / 1,234% / N/A and read back."""
    pretty = F.format_number(F.floor("o_totalprice"), 0)
    kind = F.col("o_orderkey") % 4
    text = (F.when(kind == 0, F.concat(F.lit(" $"), pretty, F.lit(" "))).when(kind == 1, F.concat(F.lit("("), pretty, F.lit(")")))
            .when(kind == 2, F.concat(pretty, F.lit("%"))).otherwise(F.lit("N/A")))
    code = F.when(F.col("o_custkey") % 5 == 0, F.lit("-9")).otherwise(F.col("o_custkey").cast("string"))
    rows = t.orders.select("o_orderkey", text.alias("text"), code.alias("code"))
    return rows.select("o_orderkey", U.clean_amount("text").alias("amount"),
                       U.amount_or_null("text", fixed.NULL_AMOUNT_MARKS).alias("amount_or_null"),
                       U.coded_number("code", fixed.SURVEY_MISSING).alias("coded"))


_SQL_DISTRICTS = " ".join(
    f"WHEN contains(replace(upper(x), ' ', ''), '{k}') THEN '{v}'" for k, v in fixed.DISTRICTS.items())


@query("N9", f"""
SELECT o_orderkey, CASE {_SQL_DISTRICTS} END AS district FROM (
  SELECT o_orderkey, o_orderpriority || ' ' || CASE o_custkey % 5 WHEN 0 THEN 'Back  Creek' WHEN 1 THEN 'redbud opequon'
    WHEN 2 THEN 'STEPHENS CITY' WHEN 3 THEN 'Middle town' ELSE 'elsewhere' END AS x FROM orders)""")
def canonical_districts(t: Tables) -> DataFrame:
    n = F.col("o_custkey") % 5
    place = (F.when(n == 0, "Back  Creek").when(n == 1, "redbud opequon").when(n == 2, "STEPHENS CITY")
             .when(n == 3, "Middle town").otherwise("elsewhere"))
    return t.orders.select("o_orderkey", N.canonical_district(
        F.concat("o_orderpriority", F.lit(" "), place)).alias("district"))


@query("N12", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
  json_extract_string(props, '$.none') AS missing FROM events""")
def json_path_get(t: Tables) -> DataFrame:
    return t.events.select("event_id", K.json_value("props", "$.k", "bigint").alias("k"),
                           K.json_value("props", "$.k").alias("k_text"),
                           K.json_value("props", "$.none").alias("missing"))


@query("N10", 'SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS total FROM orders')
def canonical_column_names(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("CUSTOMER KEY"),
                           F.col("o_totalprice").alias("Total"))
    return K.canonical_columns(rows)
