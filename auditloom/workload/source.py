"""Source queries: JSON, GeoJSON and files written from the test tables, views and previews.

Spark writes the files from the tables' rows, several files at once; the source operators read them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.plans import presets
from auditloom.plans.query import run
from auditloom.session import scratch
from auditloom.sources import catalog, records, sinks, tabular
from auditloom.workload.binding import FACTS, Tables
from auditloom.workload.registry import query

#: Bytes of a range here, so that the small test files are cut as well.
_RANGE = 256 << 10


#: Rows of one file of wrapped rows, about; the task that writes a file sorts no more, however large the table.
_FILE_ROWS = 250_000


def _wrapped(t: Tables, rows: DataFrame, key: str, parts: int, head: str, tail: str, name: str) -> str:
    """A folder of JSON files, each an object that wraps rows (``id``, ``json``) in an array ``key``; the remainder of
    the ids by ``parts`` decides the file, or the set of files once a remainder has more rows than a file takes."""
    folder = scratch(t.spark, name)
    files = parts * max(1, -(-rows.count() // (parts * _FILE_ROWS)))
    body = rows.select(F.coalesce(F.pmod("id", F.lit(files)), F.lit(0)).alias("part"), F.lit(1).alias("place"), F.concat("json", F.lit(",")).alias("value"))
    numbers = t.spark.range(files).select(F.col("id").alias("part"))
    opening = numbers.select("part", F.lit(0).alias("place"), F.lit(f'{head}"{key}": [').alias("value"))
    closing = numbers.select("part", F.lit(2).alias("place"), F.lit(f"null]{tail}").alias("value"))
    (body.unionByName(opening).unionByName(closing).repartitionById(files, F.col("part").cast("int")).sortWithinPartitions("part", "place")
     .select("part", "value").write.partitionBy("part").text(folder))
    return folder


@query("S3 S4 N12", """
SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS price, 'note "' || o_orderstatus || '" {[' AS status_note, o_custkey AS customer_key,
  lower(o_orderpriority) AS customer_priority, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS extra FROM orders""")
def wrapped_json_records(t: Tables) -> DataFrame:
    """Orders wrapped in the ``records`` of files that hold other arrays too; strings hold quotes and brackets."""
    row = F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("price"),
                   F.struct(F.concat(F.lit('note "'), "o_orderstatus", F.lit('" {[')).alias("note")).alias("status"),
                   F.struct(F.col("o_custkey").alias("key"), F.lower("o_orderpriority").alias("priority")).alias("customer"),
                   F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("extra"))
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.to_json(row).alias("json"))
    folder = _wrapped(t, rows, "records", 4, '{"meta": {"records": [{"id": -1}]}, "notes": [{"id": -2}], ',
                      ', "more": [{"id": -3}]}', "wrapped")
    return records.flatten(records.split_records(t.spark, folder, size=_RANGE))


@query("S5", """
SELECT 'Point' AS geometry_type, '{"coordinates":[' || CAST(c_custkey AS VARCHAR) || ',' || CAST(c_nationkey AS VARCHAR) || '],"type":"Point"}' AS geometry_json,
  c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS even,
  CASE WHEN c_custkey % 5 = 0 THEN '{"segment":"' || c_mktsegment || '"}' END AS detail FROM customer""")
def geojson_features(t: Tables) -> DataFrame:
    """Customers as features; some properties only some of them have."""
    point = F.struct(F.lit("Point").alias("type"), F.array("c_custkey", F.col("c_nationkey").cast("bigint")).alias("coordinates"))
    properties = F.struct(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("even"),
                          F.when(F.col("c_custkey") % 5 == 0, F.struct(F.col("c_mktsegment").alias("segment"))).alias("detail"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties"))
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.to_json(feature).alias("json"))
    folder = _wrapped(t, rows, "features", 3, '{"type": "FeatureCollection", ', "}", "features")
    found = records.split_features(t.spark, folder, size=_RANGE)
    return found.select("geometry_type", "geometry_json", "name", "even", "detail")


#: Orders of each family of files.
_FAMILY = {"Enrollment": "o_orderkey % 4 = 0", "EXPENDITURE_table15": "o_orderkey % 4 = 1", "apa_exhibit": "o_orderkey % 4 = 2", "other": "o_orderkey % 4 = 3"}


@query("S8 P6", """
SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'enrollment' WHEN 1 THEN 'expenditure' ELSE 'apa' END AS bucket,
  CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS adm, CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice END AS amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'adm,id' WHEN 1 THEN 'amount,id' ELSE 'id,status' END AS columns,
  CASE WHEN o_orderkey % 4 = 2 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 4 < 3""")
def file_family(t: Tables) -> DataFrame:
    """Orders as JSON files of four families with different fields: read at once, bucketed by name, written by bucket,
    and each bucket read back with its own columns."""
    folder = scratch(t.spark, "family")
    field = {"Enrollment": F.col("o_custkey").alias("adm"), "EXPENDITURE_table15": F.col("o_totalprice").alias("amount"),
             "apa_exhibit": F.col("o_orderstatus").alias("status"), "other": F.col("o_orderpriority").alias("none")}
    for name, rows in _FAMILY.items():
        sinks.write_json(t.orders.filter(rows).select(F.col("o_orderkey").alias("id"), field[name]), f"{folder}/{name}")
    named = tabular.read_family(t.spark, f"{folder}/*", name=F.element_at(F.split("_metadata.file_path", "/"), -2))
    buckets = tabular.write_family(named, scratch(t.spark, "buckets"))
    parts = [rows.drop("source_file").withColumns({"bucket": F.lit(b), "columns": F.lit(",".join(sorted(c for c in rows.columns if c != "source_file")))})
             for b, rows in buckets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("id", "bucket", "adm", "amount", "columns", "status")


@query("S12", """
WITH f AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey) || chr(10) AS body
  FROM orders GROUP BY 1)
SELECT month, CAST(octet_length(encode(body)) AS BIGINT) AS actual_size, sha256(body) AS actual_sha256,
  CASE WHEN month LIKE '%-01' THEN 'changed' WHEN month LIKE '%-02' THEN 'unlisted' ELSE 'ok' END AS state FROM f""")
def file_checksums(t: Tables) -> DataFrame:
    """A file of order keys per month, hashed by ranges and compared with a manifest that is wrong in January and
    lacks February."""
    folder = scratch(t.spark, "months")
    keys = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    (keys.repartition("month").sortWithinPartitions("month", "o_orderkey")
     .select("month", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("month").text(folder))
    found = sinks.contents(t.spark, folder).filter(F.col("file").endswith(".txt"))
    month = F.regexp_extract("file", r"month=(\d+-\d+)", 1)
    listed = found.filter(~month.endswith("-02")).withColumn("sha256", F.when(month.endswith("-01"), F.lit("0")).otherwise(F.upper("sha256")))
    return sinks.verify(found, listed).select(month.alias("month"), "actual_size", "actual_sha256", "state")


@query("S1 S2 C1", """
SELECT c_mktsegment AS segment, count(*) AS orders, count(DISTINCT o_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment""")
def detached_views(t: Tables) -> DataFrame:
    """One table registered at once, one detached and loaded on demand; the query runs over both by name."""
    name = catalog.register(t.spark, f"{t.folder}/orders.parquet", "attached_orders", on_exists="replace")
    sets = catalog.Datasets(t.spark, {"detached_customers": f"{t.folder}/customer.parquet"})
    t.spark.catalog.dropTempView("detached_customers")
    sets.load("detached_customers")
    out = run(t.spark, f"SELECT c_mktsegment AS segment, count(*) AS orders, count(DISTINCT o_custkey) AS customers FROM {name} "
                       "JOIN detached_customers ON o_custkey = c_custkey GROUP BY c_mktsegment").frame
    sets.unload("detached_customers")
    return out


@query("C2 O1 O2", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_totalprice >= 1000) AS total_rows,
  (SELECT count(*) > 100 FROM orders WHERE o_totalprice >= 1000) AS truncated
FROM orders WHERE o_totalprice >= 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def capped_preview(t: Tables) -> DataFrame:
    """The capped rows of a result with its size and whether it was cut."""
    catalog.register(t.spark, f"{t.folder}/orders.parquet", "preview_orders", on_exists="replace")
    result = run(t.spark, "SELECT o_orderkey, o_totalprice FROM preview_orders WHERE o_totalprice >= :least ORDER BY o_totalprice DESC, o_orderkey",
                 limit=100, least=1000)
    return result.preview()


#: Input views of the presets over the yearly figures: source column -> expression of either engine.
_VIEWS = {
    "county_budget_schools": {
        "fiscal_year": "fiscal_year", "total_county_budget_all_funds_net": "total", "county_transfers_total_county_to_schools": "local_amount",
        "county_transfers_pct_of_general_fund": "adm", "county_transfers_to_school_operating": "state_amount",
        "county_transfers_to_school_debt": "teachers", "county_transfers_to_school_capital": "support",
        "general_fund_expenditures_public_safety": "admins", "general_fund_expenditures_school_transfers": "total",
        "general_fund_expenditures_health_welfare": "adm", "general_fund_expenditures_public_works": "teachers"},
    "vdoe_table15_expenditures": {"fiscal_year": "fiscal_year", "division_name": "district", "metrics_total_per_pupil": "total",
                                  "metrics_local_per_pupil": "local_amount", "metrics_state_per_pupil": "state_amount"},
    "vdoe_table8_enrollment": {"fiscal_year": "fiscal_year", "division_name": "district", "metrics_adm_total": "adm",
                               "metrics_adm_elementary": "teachers", "metrics_adm_secondary": "support"},
    "vdoe_table17_ratios": {"fiscal_year": "fiscal_year", "division_name": "district", "metrics_pupil_teacher_ratio_k7": "teachers",
                            "metrics_pupil_teacher_ratio_8_12": "support"},
    "vdoe_table18_admin": {"fiscal_year": "fiscal_year", "division_name": "district", "metrics_instruction_administrative": "admins",
                           "metrics_admin_health_administrative": "support", "metrics_technology_administrative": "teachers"},
    "tax_summary": {"district": "district", "year": "year", "tax": "total"},
    "county_govt_time_series": {"fiscal_year": "fiscal_year", "total_budget_net": "total", "general_fund_total": "local_amount",
                                "school_to_operating": "state_amount", "tax_real_estate_per_100": "adm"},
    "county_govt_budget_detail": {"fiscal_year": "fiscal_year", "category": "CASE WHEN district = 'ASIA' THEN 'total' ELSE district END",
                                  "adopted": "total", "prior_actual": "local_amount"},
    "apa_education_by_division": {"division_name": "district", "exp_instruction": "local_amount", "exp_admin_attendance_health": "state_amount",
                                  "exp_total": "CASE WHEN year = 1995 THEN 0 ELSE total END", "pct_state_avg_instruction": "adm"},
    "apa_exhibit_b": {"locality": "district", "total_general_property_taxes": "local_amount", "total_local_revenue": "total",
                      "population": "CASE WHEN year = 1996 THEN 0 ELSE adm END", "per_capita": "teachers"},
    "apa_exhibit_b1": {"locality": "district", "total_from_the_commonwealth": "CASE WHEN year = 1997 THEN 0 ELSE total END",
                       "total_from_the_federal_government": "local_amount", "categorical_state_aid": "state_amount"},
}
_PARAMS = {"school_year": "FY1999", "fiscal_year": "FY2000", "division": "EUROPE", "peers": ("ASIA", "EUROPE", "AFRICA"), "year": 1998, "top": 3}


def _long(name: str, labels: list[str], rows: str) -> str:
    """SQL of the values of a preset: the first column names a row."""
    return " UNION ALL ".join(f"""SELECT '{name}' AS preset, CAST(a0 AS VARCHAR) AS entity, '{label}' AS label, CAST(a{i} AS VARCHAR) AS text,
  TRY_CAST(a{i} AS DOUBLE) AS number FROM ({rows})""" for i, label in enumerate(labels))


_M = "CAST({} AS DOUBLE) / 1e6"
_PRESET_SQL = " UNION ALL ".join([
    _long("County Budget Overview", ["Year", "Total Budget", "To Schools", "Schools %"], "SELECT fiscal_year a0, total a1, local_amount a2, adm a3 FROM facts"),
    _long("County vs Schools Funding", ["Year", "Operating", "Debt Service", "Capital", "Total"],
          "SELECT fiscal_year a0, state_amount a1, teachers a2, support a3, local_amount a4 FROM facts"),
    _long("General Fund Breakdown", ["Year", "Public Safety", "Schools", "Health/Welfare", "Public Works"],
          "SELECT fiscal_year a0, admins a1, total a2, adm a3, teachers a4 FROM facts"),
    _long("School Spending Comparison", ["District", "$/Student", "Local", "State"],
          "SELECT district a0, total a1, local_amount a2, state_amount a3 FROM facts WHERE year = 1999"),
    _long("Enrollment Trends", ["Year", "Students", "Elementary", "Secondary"],
          "SELECT fiscal_year a0, adm a1, teachers a2, support a3 FROM facts WHERE district = 'EUROPE'"),
    _long("Teacher Ratios", ["District", "K-7 Ratio", "8-12 Ratio"], "SELECT district a0, teachers a1, support a2 FROM facts WHERE year = 1999"),
    _long("Admin Staff Counts", ["District", "Instruction Admin", "Admin/Health", "Technology"],
          "SELECT district a0, admins a1, support a2, teachers a3 FROM facts WHERE year = 2000"),
    _long("Tax Summary", ["district", "year", "tax"], "SELECT district a0, year a1, total a2 FROM facts"),
    _long("County Budget Trends", ["Year", "Total Budget (M)", "General Fund (M)", "School Operating (M)", "RE Tax Rate"],
          f"SELECT fiscal_year a0, {_M.format('total')} a1, {_M.format('local_amount')} a2, {_M.format('state_amount')} a3, adm a4 FROM facts"),
    _long("Budget by Category", ["Year", "Category", "Adopted (M)", "Prior Actual (M)"],
          f"SELECT fiscal_year a0, district a1, {_M.format('total')} a2, {_M.format('local_amount')} a3 FROM facts WHERE district <> 'ASIA'"),
    _long("APA Education Comparison", ["District", "Instruction (M)", "Admin (M)", "Total (M)", "% of State Avg"],
          f"SELECT district a0, {_M.format('local_amount')} a1, {_M.format('state_amount')} a2, {_M.format('total')} a3, adm a4 FROM facts WHERE total > 0 AND year <> 1995"),
    _long("Local Revenue Sources", ["Locality", "Property Tax (M)", "Total Revenue (M)", "Population", "Per Capita"],
          f"SELECT district a0, {_M.format('local_amount')} a1, {_M.format('total')} a2, adm a3, teachers a4 FROM facts WHERE adm > 0 AND year <> 1996"),
    _long("State & Federal Aid", ["Locality", "State Aid (M)", "Federal Aid (M)", "State Categorical (M)"],
          f"SELECT district a0, {_M.format('total')} a1, {_M.format('local_amount')} a2, {_M.format('state_amount')} a3 FROM facts WHERE total > 0 AND year <> 1997"),
    _long("Peer District Comparison", ["District", "Students", "$/Student", "K-7 Ratio"],
          "SELECT district a0, adm a1, total a2, teachers a3 FROM facts WHERE year = 1999 AND district IN ('ASIA', 'EUROPE', 'AFRICA')"),
    _long("Top Property Owners", ["Owner", "Total Value", "Properties", "Type"],
          "SELECT district a0, CAST(floor(total) AS BIGINT) a1, adm a2, 'Division' a3 FROM (SELECT * FROM facts WHERE year = 1998 ORDER BY total DESC, district LIMIT 3)")])


@query("C3 S1 S2 J8", f"WITH {FACTS}, l AS ({_PRESET_SQL}) SELECT preset, entity, label, CASE WHEN number IS NULL THEN text END AS text, number FROM l")
def preset_reports(t: Tables) -> DataFrame:
    """All 15 presets by their parameters, over views of the yearly figures: one row per value."""
    facts = t.gold_facts
    for view, columns in _VIEWS.items():
        facts.select(*[F.expr(e).alias(c) for c, e in columns.items()]).createOrReplaceTempView(view)
    # A year has one division a row, so its list is short.
    owner = F.struct((-F.col("total")).alias("least"), F.col("district").alias("owner"), F.floor("total").cast("bigint").alias("total_value"),
                     F.col("adm").alias("properties"), F.lit("Division").alias("entity_type"))
    owners = facts.groupBy("year").agg(F.to_json(F.array_sort(F.collect_list(owner))).alias("top_owners_by_value"))
    owners.createOrReplaceTempView("ownership_analysis")

    def values(name: str) -> DataFrame:
        rows = presets.run_preset(t.spark, name, **_PARAMS)
        first, kinds = rows.columns[0], dict(rows.dtypes)
        cells = [F.struct(F.lit(c).alias("label"), (F.col(f"`{c}`") if kinds[c] == "string" else F.lit(None)).cast("string").alias("text"),
                          (F.lit(None) if kinds[c] == "string" else F.col(f"`{c}`")).cast("double").alias("number")) for c in rows.columns]
        return rows.select(F.lit(name).alias("preset"), F.col(f"`{first}`").cast("string").alias("entity"), F.explode(F.array(*cells)).alias("c")).select(
            "preset", "entity", "c.*")

    out = None
    for name in presets.names():
        out = values(name) if out is None else out.unionAll(values(name))
    return out
