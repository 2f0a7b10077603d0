"""Chart and map frames, flattening, checksum audit (V*, S4, S12)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.predicates import latest_partition
from auditloom.operators import frames as V
from auditloom.session import ensure_checkpoint_dir
from auditloom.sources.records import flatten
from auditloom.sources.sinks import verify, write_csv, write_parquet
from auditloom.sources.tabular import read_coded_tsv
from auditloom.workload.binding import FACTS, Tables
from auditloom.workload.registry import query


@query("V1", f"""
WITH {FACTS}, f AS (SELECT district || ' ' || fiscal_year AS label, CAST(adm AS DOUBLE) AS adm, CASE WHEN year = 1999 THEN 0 ELSE total END AS total
  FROM facts)
SELECT label, 'adm' AS dataset, adm AS value FROM f UNION ALL SELECT label, 'total', total FROM f""")
def series_long(t: Tables) -> DataFrame:
    total = F.when(F.col("year") != 1999, F.col("total"))
    return V.series_long(t.facts.select(F.concat_ws(" ", "district", "fiscal_year").alias("label"), "adm",
                                        total.alias("total")))


@query("V2", "SELECT o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y FROM orders")
def scatter_frame(t: Tables) -> DataFrame:
    return V.scatter_frame(t.orders.select("o_totalprice", "o_custkey"))


@query("V3", """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 20e0), 19) AS BIGINT) AS bin, count(*) AS rows
FROM orders, e GROUP BY 1""")
def histogram_bins(t: Tables) -> DataFrame:
    return V.histogram(t.orders, "o_totalprice", 20)


_LINEAR = """e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT i AS idx, lo + (hi - lo) / 5e0 * CAST(i AS DOUBLE) AS edge FROM e, (SELECT CAST(unnest(range(0, 6)) AS BIGINT) AS i))"""


@query("V4", f"WITH {_LINEAR} SELECT idx, edge FROM b")
def class_breaks_linear(t: Tables) -> DataFrame:
    return V.breaks(t.orders, "o_totalprice", 5, "jenks")


@query("V4", """
WITH s AS (SELECT l_quantity AS v, row_number() OVER (ORDER BY l_quantity) - 1 AS p, count(*) OVER () AS n FROM lineitem),
w AS (SELECT CAST(i AS BIGINT) AS idx, CASE WHEN i = 0 THEN 0 WHEN i = 7 THEN n - 1
    ELSE CAST(floor(n / 7e0 * i) AS BIGINT) END AS p
  FROM (SELECT count(*) AS n FROM lineitem), (SELECT unnest(range(0, 8)) AS i))
SELECT idx, v AS edge FROM w JOIN s USING (p)""")
def class_breaks_quantile(t: Tables) -> DataFrame:
    """Exact quantile edges of a column with few distinct values and many rows each."""
    return V.breaks(t.lineitem, "l_quantity", 7, "quantile")


@query("V4", """
WITH s AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) - 1 AS p FROM orders),
w AS (SELECT CAST(i AS BIGINT) AS idx, CASE WHEN i = 0 THEN 0 WHEN i = 4 THEN n - 1
    ELSE CAST(floor(n / 4e0 * i) AS BIGINT) END AS p
  FROM (SELECT count(*) AS n FROM orders), (SELECT unnest(range(0, 5)) AS i))
SELECT idx, v AS edge FROM w JOIN s USING (p)""")
def class_breaks_quantile_price(t: Tables) -> DataFrame:
    return V.breaks(t.orders, "o_totalprice", 4, "quantile")


@query("V5", f"""
WITH {_LINEAR}, c AS (SELECT o_orderkey, (SELECT min(idx) - 1 FROM b WHERE idx > 0 AND o_totalprice <= edge) AS k FROM orders)
SELECT o_orderkey, CAST(coalesce(k, 4) AS BIGINT) AS class FROM c""")
def class_assign(t: Tables) -> DataFrame:
    edges = V.linear_breaks(t.orders, "o_totalprice", 5)
    return V.assign_classes(t.orders, "o_totalprice", edges).select("o_orderkey", "class")


@query("V6", """
SELECT '{"type":"Feature","geometry":' || CASE WHEN c_custkey % 5 = 0 THEN 'null'
    ELSE '{"coordinates":[' || CAST(c_custkey AS VARCHAR) || ',' || CAST(c_nationkey AS VARCHAR) || '],"type":"Point"}' END
  || ',"properties":{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"}}' AS feature,
  c_custkey % 5 = 0 AS geometry_missing
FROM customer""")
def feature_json(t: Tables) -> DataFrame:
    """Features with JSON geometry; every fifth geometry is text that is no JSON."""
    point = F.concat(F.lit('{"type": "Point", "coordinates": ['), F.col("c_custkey").cast("string"), F.lit(", "),
                     F.col("c_nationkey").cast("string"), F.lit("]}"))
    geometry = F.when(F.col("c_custkey") % 5 == 0, F.lit("POINT (1 2)")).otherwise(point)
    return V.feature_json(t.customer.select("c_custkey", "c_mktsegment", geometry.alias("geometry")), "geometry")


@query("V7", f"""
WITH {FACTS}
SELECT district || ' ' || fiscal_year AS label, total AS value,
  (SELECT floor(CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 1e2 + 5e-1) / 1e2 FROM facts WHERE total > 0) AS average
FROM facts""")
def comparison_bars(t: Tables) -> DataFrame:
    return V.comparison_bars(t.gold_facts.select(F.concat_ws(" ", "district", "fiscal_year").alias("bar"), "total"), "bar", "total")


@query("V7", f"""
WITH {FACTS}
SELECT district || ' ' || fiscal_year AS label, CAST(admins AS DOUBLE) AS value, 250e0 AS target, 150e0 AS warning FROM facts
WHERE admins > 0""")
def threshold_bars(t: Tables) -> DataFrame:
    bars = t.facts.select(F.concat_ws(" ", "district", "fiscal_year").alias("bar"), "admins")
    return V.threshold_bars(bars, "bar", "admins", 250, 150, positive_only=True)


@query("S4", """
SELECT o_orderkey, o_orderstatus AS order_status, o_totalprice AS order_money_total, o_custkey AS order_money_customer,
  '[{"n":1,"p":"' || left(o_orderpriority, 1) || '"}]' AS tags FROM orders""")
def flatten_nested(t: Tables) -> DataFrame:
    """Nested structs to flat columns; an array of structs becomes JSON text."""
    money = F.struct(F.col("o_totalprice").alias("total"), F.col("o_custkey").alias("customer"))
    tags = F.array(F.struct(F.lit(1).alias("n"), F.substring("o_orderpriority", 1, 1).alias("p")))
    nested = t.orders.select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), money.alias("money"))
                             .alias("order"), tags.alias("tags"))
    return flatten(nested)


def _scratch(t: Tables) -> str:
    """A fresh path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(t.spark)}/tables-{uuid.uuid4().hex}"


@query("S10 P6", """
WITH o AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders)
SELECT * FROM o WHERE year = (SELECT max(year) FROM o)""")
def partitioned_sink_latest(t: Tables) -> DataFrame:
    """Orders written by year and read back: only the latest partition is scanned for rows."""
    path = _scratch(t)
    write_parquet(t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")), path, ["year"])
    out = latest_partition(t.spark.read.parquet(path))
    return out.withColumn("year", F.col("year").cast("bigint"))


#: Survey columns between the first two and the last one; the n-th holds the customer plus n.
_SURVEY = {"TFEDREV": "federal_revenue", "TSTREV": "state_revenue", "TLOCREV": "local_revenue", "TOTALEXP": "total_expenditures",
           "TCURELSC": "current_expenditures", "TCURINST": "instruction_expenditures", "TCURSSVC": "support_services", "E17": "pupil_support",
           "E07": "instructional_staff_support", "E08": "general_administration", "E09": "school_administration", "TCUROTH": "other_current",
           "E11": "operations_maintenance", "TNONELSE": "non_elementary_secondary"}


@query("S6 S11", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "LEAID", CAST(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS DOUBLE) AS enrollment,
  CAST(CASE o_orderstatus WHEN 'F' THEN NULL ELSE o_orderkey END AS DOUBLE) AS total_revenue,
  {", ".join(f"CAST(CASE WHEN o_orderkey % 2 = 1 AND {i} % 3 = 0 THEN NULL WHEN o_custkey % {i + 7} = 0 THEN NULL ELSE o_custkey + {i} END AS DOUBLE) AS {name}"
             for i, name in enumerate(_SURVEY.values()))},
  NULL::DOUBLE AS capital_outlay
FROM orders""")
def coded_tsv_scan(t: Tables) -> DataFrame:
    """Orders written as tab-separated survey files of two header orders, the second without some of the columns,
    with missing codes, read back by header name."""
    pupils = F.when(F.col("o_custkey") % 5 == 0, "M").otherwise(F.col("o_custkey").cast("string")).alias("V33")
    revenue = F.when(F.col("o_orderstatus") == "F", "-2").otherwise(F.col("o_orderkey").cast("string")).alias("TOTALREV")
    codes = ("-1", "-2", "-3", "-9", "M", "N", "R", None)
    more = [F.when(F.col("o_custkey") % (i + 7) == 0, F.lit(codes[i % 8])).otherwise((F.col("o_custkey") + i).cast("string")).alias(name)
            for i, name in enumerate(_SURVEY)]
    base = _scratch(t)
    even, odd = (t.orders.filter(F.col("o_orderkey") % 2 == k) for k in (0, 1))
    key = F.col("o_orderkey").alias("LEAID")
    write_csv(even.select(key, *more, pupils, revenue), f"{base}/a", sep="\t")
    write_csv(odd.select(revenue, *[c for i, c in enumerate(more) if i % 3][::-1], key, pupils), f"{base}/b", sep="\t")
    return read_coded_tsv(t.spark, [f"{base}/a", f"{base}/b"]).drop("source_file")


@query("S12", """
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS file, doc_id % 7 AS k FROM documents)
SELECT file, CASE k WHEN 0 THEN 'unlisted' WHEN 1 THEN 'changed' WHEN 2 THEN 'changed' ELSE 'ok' END AS state FROM d
UNION ALL SELECT 'ghost/' || file, 'missing' FROM d WHERE k = 3""")
def checksum_audit(t: Tables) -> DataFrame:
    """All document texts as files, against a manifest that lacks some, invents some, and has wrong sizes and digests."""
    files = t.documents.select(F.col("doc_id").cast("string").alias("file"), F.octet_length("text").alias("size"),
                               F.col("text").alias("content"), (F.col("doc_id") % 7).alias("k"))
    listed = files.filter("k <> 0").select(
        "file", "k", F.when(F.col("k") == 1, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
        F.when(F.col("k") == 2, F.sha2(F.lit("other"), 256)).otherwise(F.upper(F.sha2("content", 256))).alias("sha256"))
    ghosts = listed.filter("k = 3").withColumn("file", F.concat(F.lit("ghost/"), "file"))
    return verify(files, listed.unionByName(ghosts)).select("file", "state")
