"""Text, HTML and grid queries (S7, S9, W10, X*).

Where the test tables have no such text, Spark writes it from their rows (a tax
book from orders, budget pages from orders, sheets from customers) and the
operator reads it back, so the SQL side can state the values directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from auditloom.operators import extract as X
from auditloom.plans.ingest import tax_books
from auditloom.session import durable, scratch
from auditloom.sources.tabular import read_cells
from auditloom.sources.text import split_lines
from auditloom.workload.binding import VREC, Tables
from auditloom.workload.registry import query

@query("W10", """
WITH f AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS r
  FROM conversations)
SELECT conv_id, CAST(r AS BIGINT) AS record_id, count(*) AS lines, CAST(sum(length(text)) AS BIGINT) AS chars,
  min(turn) AS first_pos, max(turn) AS last_pos, arg_min(text, turn) AS first_line
FROM f WHERE r > 0 GROUP BY conv_id, r""")
def record_assembly(t: Tables) -> DataFrame:
    """Turns as lines: a user turn starts a record."""
    rows = t.conversations.select("conv_id", "turn", "role", "text")
    piece = F.floor(F.col("turn") / 1000)
    return X.record_spans(rows, ["conv_id"], piece, ["turn"], F.col("role") == "user", "text")


def _money(c: Column | str, digits: int = 0) -> Column:
    return F.format_number(c, digits)


def _whole(name: str) -> Column:
    return F.floor(F.coalesce(F.col(name), F.lit(0))).cast("bigint")


def _number(value: Column) -> Column:
    """A number with one decimal place at least and no exponent, as SQL writes it."""
    return F.regexp_replace(value.cast("decimal(18,4)").cast("string"), r"(\.\d+?)0*$", "$1")


_REGION_TEXT = {"AFRICA": "RED BUD", "AMERICA": "OPEQUON", "ASIA": "STEPHENS CITY", "EUROPE": "SHAWNEE"}


def _tax_book(t: Tables, strict: bool) -> str:
    """Folder of tax books, a folder of text files per year; page headers are mixed in."""
    land, improvement = _whole("land_value"), _whole("improvement_value")
    total = land + improvement if strict else _whole("total_value")
    tax = F.floor(total * 6 / 10) / 100
    account = F.concat(F.lit(" ACCT- "), F.col("parcel").cast("string"))
    four = F.concat_ws(" ", _money(land), _money(improvement), _money(total), _money(tax, 2))
    three = F.concat_ws(" ", _money(total), _money(total), F.format_string("%.2f", tax.cast("double")) if strict
                        else _money(tax, 2))
    if strict:
        four = F.concat(F.lit("10 20 9,999 1.00 "), four)
    value = F.concat(F.when(F.col("parcel") % 3 == 0, three).otherwise(four), account)
    place = None
    for region, text in _REGION_TEXT.items():
        place = F.when(F.col("district") == region, text) if place is None else place.when(F.col("district") == region, text)
    cls = F.col("property_class").cast("string")
    lines = F.array(
        F.when(F.col("parcel") % 50 == 0, F.lit("COUNTY OF FREDERICK  PAGE 3")).otherwise(F.lit("")),
        F.concat(F.col("parcel").cast("string"), F.lit("A-   -"), cls, F.lit("- 63")),
        F.col("owner"), F.col("address"), F.lit("WINCHESTER VA 22601"),
        F.concat(F.lit("Lot "), (F.col("parcel") % 100).cast("string"), F.lit("B IN "), place.otherwise("NO PLACE")),
        F.when(F.col("parcel") % 70 == 0, F.lit("PAGE TOTALS 1 2 3")).otherwise(F.lit("")),
        F.concat((F.col("parcel") % 90).cast("string"), F.lit(".5 AC CL "), cls, F.lit(" ZN "), F.col("zone")),
        value,
        F.concat(F.lit("FH "), _money(F.col("parcel") % 5000, 2), F.lit(" SH "), _money(F.col("parcel") % 3000, 2)),
        F.when(F.col("parcel") % 4 == 0, F.concat(_money(F.col("parcel")), F.lit(" DEFERRED"))).otherwise(F.lit("")))
    folder = scratch(t.spark, "books")
    books = t.wide_records.select(F.col("year").alias("book"), F.array_join(lines, "\n").alias("value"))
    books.write.partitionBy("book").text(folder)
    return folder


def _records(t: Tables, strict: bool) -> DataFrame:
    """Property records of the books, in the types of the SQL side."""
    year = F.regexp_extract("path", r"book=(\d+)", 1).cast("bigint")
    out = tax_books(t.spark, _tax_book(t, strict), strict, year)
    doubles = ("first_half_tax", "second_half_tax", "tax_amount")
    return out.drop("record_id", "path").withColumns(
        {**{c: F.col(c).cast("double") for c in doubles}, "year": F.col("year").cast("bigint"), "property_class": F.col("property_class").cast("bigint")})


_BOOK_FIELDS = """CAST(parcel AS VARCHAR) || 'A--' || CAST(property_class AS VARCHAR) || '-63' AS parcel_code,
  owner AS owner_name, address AS owner_address, 'WINCHESTER VA 22601' AS owner_city_state_zip,
  CASE WHEN parcel % 100 = 0 THEN 'Lot 0B' ELSE 'Lot ' || CAST(parcel % 100 AS VARCHAR) || 'B' END AS description,
  CAST(parcel % 90 AS DOUBLE) + 0.5::DOUBLE AS acreage, CAST(property_class AS BIGINT) AS property_class, zone,
  CAST(parcel AS VARCHAR) AS account_number,
  CASE district WHEN 'AFRICA' THEN 'Red Bud' WHEN 'AMERICA' THEN 'Opequon' WHEN 'ASIA' THEN 'Stephens City'
    WHEN 'EUROPE' THEN 'Shawnee' END AS district,
  CAST(parcel % 5000 AS DOUBLE) AS first_half_tax, CAST(parcel % 3000 AS DOUBLE) AS second_half_tax,
  CASE WHEN parcel % 4 = 0 THEN parcel ELSE 0 END AS deferred_value, CAST(NULL AS VARCHAR) AS deed_book"""


@query("S7 W10 X1 N9", f"""
WITH {VREC}, b AS (SELECT *, CAST(floor(coalesce(land_value, 0)) AS BIGINT) AS lv,
    CAST(floor(coalesce(improvement_value, 0)) AS BIGINT) AS iv, CAST(floor(total_value) AS BIGINT) AS tv FROM vrec)
SELECT year, {_BOOK_FIELDS}, CASE WHEN parcel % 3 = 0 THEN tv ELSE lv END AS land_value,
  CASE WHEN parcel % 3 = 0 THEN 0 ELSE iv END AS improvement_value, tv AS total_value,
  CAST(tv * 6 // 10 AS DOUBLE) / 100 AS tax_amount
FROM b WHERE tv > 0 OR lv > 0""")
def tax_book_records(t: Tables) -> DataFrame:
    """Text files of the tax books to records to typed fields."""
    return _records(t, strict=False)


@query("S7 X2 Q17 W10", f"""
WITH {VREC}, b AS (SELECT *, CAST(floor(coalesce(land_value, 0)) AS BIGINT) AS lv,
    CAST(floor(coalesce(improvement_value, 0)) AS BIGINT) AS iv FROM vrec)
SELECT year, {_BOOK_FIELDS}, CASE WHEN parcel % 3 = 0 THEN lv + iv ELSE lv END AS land_value,
  CASE WHEN parcel % 3 = 0 THEN 0 ELSE iv END AS improvement_value, lv + iv AS total_value,
  CAST((lv + iv) * 6 // 10 AS DOUBLE) / 100 AS tax_amount
FROM b WHERE lv + iv > 0""")
def tax_book_strict(t: Tables) -> DataFrame:
    """A decoy block stands before the values; only the consistent block counts."""
    return _records(t, strict=True)


@query("X3", """
WITH o AS (SELECT o_orderkey, o_orderkey % 3 AS k, CAST(floor(o_totalprice) AS BIGINT) AS v, o_custkey AS c FROM orders)
SELECT o_orderkey, 'personnel' AS kind, 'Fire and Rescue' AS label,
  [CAST(c AS DOUBLE) + 0.5::DOUBLE, 14e0, 157.5::DOUBLE, 10e0, 164.5::DOUBLE, CAST(c % 9 AS DOUBLE)]::VARCHAR AS measures FROM o WHERE k = 0
UNION ALL SELECT o_orderkey, 'expenditure', 'Parks/Recreation (all)', [CAST(v AS DOUBLE), 0e0, CAST(c AS DOUBLE), CAST(v + c AS DOUBLE)]::VARCHAR FROM o
  WHERE k = 1 AND v + c > 0
UNION ALL SELECT o_orderkey, 'summary', 'Public Safety', [CAST(v AS DOUBLE), 1000e0, 2e0, 3456e0, 7.25::DOUBLE]::VARCHAR FROM o WHERE k = 2""")
def line_measures(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey")
    v = _money(F.floor("o_totalprice"))
    text = (F.when(k == 0, F.concat_ws(" ", F.lit("Fire and Rescue"), F.concat(c.cast("string"), F.lit(".5")), F.lit("14"),
                                       F.lit("157.5 10 164.5"), (c % 9).cast("string")))
            .when(k == 1, F.concat(F.lit("  Parks/Recreation (all) $"), v, F.lit(" $0 "), _money(c)))
            .otherwise(F.concat(F.lit("Public Safety $"), v, F.lit(" $1,000 $2 $3,456 7.25% of all"))))
    docs = t.wide_orders.select("o_orderkey", F.concat(F.lit("Header line\n"), text, F.lit("\nno numbers here")).alias("text"))
    lines = split_lines(docs, "text", ["o_orderkey"])

    return X.all_line_measures(lines, ["o_orderkey"]).select(
        "o_orderkey", "kind", "label", F.concat(F.lit("["), F.array_join(F.transform("measures", _number), ", "), F.lit("]")).alias("measures"))


@query("X4", """
WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS v, CAST(o_custkey AS DOUBLE) AS c FROM orders)
SELECT o_orderkey, 'general_govt_admin' AS category, v AS prior_budgeted, c AS prior_actual, 3e0 AS current_budgeted, v AS adopted FROM o
UNION ALL SELECT o_orderkey, 'public_safety', c, c, v, 12345e0 FROM o WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'total', v, v, v, c FROM o""")
def section_extract(t: Tables) -> DataFrame:
    """Budget pages: only lines inside the section count."""
    v, c = _money(F.floor("o_totalprice")), _money(F.col("o_custkey"))
    safety = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(" ", F.lit("Public  Safety"), c, c, v, F.lit("12,345\n"))
                    ).otherwise(F.lit(""))
    text = F.concat(
        F.lit("Public Safety 9 9 9 9\nTotal expenditures all funds\nAdministration "), v, F.lit(" "), c, F.lit(" 3 "), v,
        F.lit("\n"), safety, F.lit("Total Expenditures $"), v, F.lit(" $"), v, F.lit(" $"), v, F.lit(" $"), c,
        F.lit("\nCounty of Frederick\nLandfill 1 2 3 4"))
    return X.section_measures(t.wide_orders.select("o_orderkey", text.alias("text")), "text", ["o_orderkey"])


@query("X4 X10", """
WITH o AS (SELECT o_orderkey, o_orderkey % 10 AS d, CAST(o_custkey AS DOUBLE) AS c FROM orders WHERE o_orderkey % 7 <> 0),
r AS (SELECT o_orderkey, d, 'department' AS kind, 'board_of_supervisors' AS category, [7e0, 1e0, 7e0, 1e0, 8e0, d] AS n FROM o
UNION ALL SELECT o_orderkey, d, 'department', 'commissioner_revenue', [c, 0e0, c + 1e0, 0e0, c + 2e0, 1e0] FROM o
UNION ALL SELECT o_orderkey, d, 'department', 'sheriff', [c + 0.5::DOUBLE, 2e0, 0.5::DOUBLE, 3e0, 130e0, 4e0] FROM o
UNION ALL SELECT o_orderkey, d, 'total', 'general_fund_total', [c, 10e0, c, 11e0, c, 12e0] FROM o
UNION ALL SELECT o_orderkey, d, 'total', 'school_funds', [c + 0.25::DOUBLE, 1e0, 2e0, 3e0, 4e0, 5e0] FROM o WHERE d < 5
UNION ALL SELECT o_orderkey, d, 'total', 'all_funds_total', [c + 0.75::DOUBLE, 11e0, 1e0, 12e0, 2e0, 13e0] FROM o)
SELECT o_orderkey, CAST(40 + d AS BIGINT) AS page, kind, category, CAST(n[1] AS DOUBLE) AS fy_minus_2_full_time, CAST(n[2] AS DOUBLE) AS fy_minus_2_part_time,
  CAST(n[3] AS DOUBLE) AS fy_minus_1_full_time, CAST(n[4] AS DOUBLE) AS fy_minus_1_part_time, CAST(n[5] AS DOUBLE) AS current_full_time,
  CAST(n[6] AS DOUBLE) AS current_part_time FROM r""")
def personnel_summary(t: Tables) -> DataFrame:
    """A budget book per order: a page without all markers, the personnel table, and a later page that repeats it
    with other numbers. In every seventh book no page has all markers."""
    c, d = F.col("o_custkey"), F.col("o_orderkey") % 10
    early = F.lit("PERSONNEL NEEDS by department, Full-Time\nSheriff 1 1 1 1 1 1")
    school = F.when(d < 5, F.concat(F.lit("School Funds "), c.cast("string"), F.lit(".25 1 2 3 4 5\n"))).otherwise(F.lit(""))
    table = F.concat(
        F.lit("Finance 9 9 9 9 9 9\nPersonnel Needs PERSONNEL NEEDS\nFull-Time Part-Time\nBoard of Supervisors 7 1 7 1 8 "), d.cast("string"),
        F.lit("\nCOR/Reassessment "), c.cast("string"), F.lit(" 0 "), (c + 1).cast("string"), F.lit(" 0 "), (c + 2).cast("string"),
        F.lit(" 1\nTreasurer vacant\nSheriff "), c.cast("string"), F.lit(".5 2 .5 3 130.0 4\nTotal Positions  General Fund "),
        F.concat_ws(" ", c.cast("string"), F.lit("10"), c.cast("string"), F.lit("11"), c.cast("string"), F.lit("12\n")), school,
        F.lit("Total Positions All Funds "), c.cast("string"), F.lit(".75 11 1.0 12 2 13\nThe reasons for the change\nFinance 5 5 5 5 5 5"))
    late = F.lit("PERSONNEL NEEDS Full-Time Part-Time\nTreasurer 1 2 3 4 5 6")
    marked = F.when(F.col("o_orderkey") % 7 == 0, F.translate(table, "-", " ")).otherwise(table)
    last = F.when(F.col("o_orderkey") % 7 == 0, early).otherwise(late)
    pages = F.array(F.struct((d + 30).alias("page"), early.alias("text")), F.struct((d + 50).alias("page"), last.alias("text")),
                    F.struct((d + 40).alias("page"), marked.alias("text")))
    books = t.wide_orders.select("o_orderkey", F.explode(pages).alias("p")).select("o_orderkey", "p.*")
    return X.personnel_summary(books, ["o_orderkey"], "page", "text")


@query("X5", """
WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS v, CAST(o_custkey AS DOUBLE) AS c FROM orders)
SELECT o_orderkey, 'general_fund' AS label, greatest(v, c) AS value FROM o
UNION ALL SELECT o_orderkey, 'debt_service', c FROM o WHERE c <> 0""")
def max_match_per_label(t: Tables) -> DataFrame:
    v, c = _money(F.floor("o_totalprice")), _money(F.col("o_custkey"))
    text = F.concat(F.lit("General Fund Total was "), v, F.lit("\ngeneral fund now "), c, F.lit("\nDebt Service due "), c)
    return X.max_per_label(t.wide_orders.select("o_orderkey", text.alias("text")), "text", ["o_orderkey"])


@query("X5", """
WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS v, CAST(o_custkey AS DOUBLE) AS c FROM orders)
SELECT o_orderkey, 'public_safety' AS label, v AS value FROM o
UNION ALL SELECT o_orderkey, 'public_works', c FROM o""")
def first_match_per_label(t: Tables) -> DataFrame:
    v, c = _money(F.floor("o_totalprice")), _money(F.col("o_custkey"))
    text = F.concat(F.lit("Public Safety budget "), v, F.lit("\nPublic Works: "), c, F.lit("\nPublic Safety again 5"))
    return X.first_per_label(t.wide_orders.select("o_orderkey", text.alias("text")), "text", ["o_orderkey"])


@query("X5", """
WITH o AS (SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS c, lower(o_orderpriority) AS p FROM orders)
SELECT o_orderkey, 'Sheriff' AS name, c + 2e0 AS count FROM o
UNION ALL SELECT o_orderkey, 'Position Summary' || chr(10) || 'Sheriff', c FROM o WHERE c <> 0
UNION ALL SELECT o_orderkey, 'Parks & Rec', 12.5::DOUBLE FROM o""")
def name_count_pairs(t: Tables) -> DataFrame:
    """Staffing section: short names and zero counts drop out, the last count of a name stays, and the
    heading stands before the first name."""
    c = F.col("o_custkey")
    text = F.concat(F.lit("Intro 5\n\nPosition Summary\nSheriff "), c.cast("string"), F.lit(" FTE\nSheriff "),
                    (c + 5).cast("string"), F.lit(" FTE\nParks & Rec 12.5 positions\nAB 3\n"
                    "Empty Office 0\nSheriff "), (c + 2).cast("string"), F.lit("\n\nOutside 77"))
    return X.name_counts(t.wide_orders.select("o_orderkey", text.alias("text")), "text", ["o_orderkey"])


_PAGE_FIELDS = {
    "title": (r"<title>([^<]*)</title>", "string"),
    "lang": (r'<html lang="(\w+)"', "string"),
    "track": (r"track\((\d+)\)", "bigint"),
    "nav.first": (r'<nav><ul><li><a href="([^"]*)"', "string"),
    "nav.ad": (r"<!-- ad (\d+) -->", "double"),
}


@query("X6", r"""
SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  nullif(regexp_extract(html, '<html lang="(\w+)"', 1), '') AS lang,
  TRY_CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS track,
  nullif(regexp_extract(html, '<nav><ul><li><a href="([^"]*)"', 1), '') AS first,
  TRY_CAST(regexp_extract(html, '<!-- ad (\d+) -->', 1) AS DOUBLE) AS ad
FROM pages""")
def html_fields(t: Tables) -> DataFrame:
    out = X.html_fields(t.pages, "html", ["page_id"], _PAGE_FIELDS)
    return out.select("page_id", "title", "lang", "track", "nav.first", "nav.ad")


def _sheets(t: Tables) -> DataFrame:
    """A sheet per customer: a title row, a header row, then one row per year."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("v"))
    sheet = [F.lit("book").alias("file"), F.col("o_custkey").cast("string").alias("sheet")]

    def cells(rows: DataFrame, row_idx: Column, values: list[Column]) -> DataFrame:
        return rows.select(*sheet, row_idx.cast("int").alias("row_idx"),
                           F.posexplode(F.array(*values)).alias("col_idx", "value"))

    data = cells(yearly, F.col("y") - 1990, [
        F.lit("note"), F.concat(F.lit("FY"), F.col("y").cast("string")), F.col("n").cast("string"),
        F.concat(F.lit("$"), _money(F.col("v")))])
    customers = t.orders.select("o_custkey").distinct()
    title = cells(customers, F.lit(0), [F.lit("Report of the year"), F.lit(None).cast("string")])
    header = cells(customers, F.lit(1), [F.lit("Remarks"), F.lit("School Division"), F.lit("ADM Total"),
                                         F.lit("Elementary Membership")])
    # Written once, as the decoded cells of the sheets would be.
    return durable(title.unionAll(header).unionAll(data))


@query("S9 X7 P7", """
WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, sum(floor(o_totalprice)) AS v FROM orders GROUP BY ALL),
c AS (SELECT o_custkey, max(y = 1999) AS coded FROM y GROUP BY o_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS sheet, 'FY' || CAST(y AS VARCHAR) AS key, CAST(n AS DOUBLE) AS adm_total,
  CAST(v AS DOUBLE) AS adm_elementary
FROM y JOIN c USING (o_custkey) WHERE y = 1999 OR (NOT coded AND y = 2001)""")
def grid_header_promotion(t: Tables) -> DataFrame:
    """Rows with the target code; sheets without it keep the rows that name a target."""
    out = X.promote_header(_sheets(t), ["file", "sheet"], "enrollment", {"FY1999": "fy2001"})
    return out.select("sheet", "key", "adm_total", "adm_elementary")


@query("X7 S9", """
WITH c AS (SELECT c_custkey, c_mktsegment, c_acctbal, CASE c_custkey % 4 WHEN 0 THEN 'County of CLARKE' WHEN 1 THEN 'Loudoun County, Virginia'
    WHEN 2 THEN 'Fairfax' ELSE ' Warrenton' END AS place, 'book' || CAST(c_custkey % 5 AS VARCHAR) AS file FROM customer),
s AS (SELECT *, CASE WHEN file = 'book0' THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'Exhibit C-6' ELSE 'Schools' END AS sheet FROM c)
SELECT file, sheet, CAST(c_custkey AS INTEGER) AS row_idx, trim(place) AS place,
  CASE WHEN c_custkey % 4 = 0 THEN '043' WHEN c_custkey % 4 = 1 THEN '107' ELSE '187' END AS division_code, h.header,
  CASE h.header WHEN 'Segment' THEN c_mktsegment ELSE CAST(c_custkey * 2 AS VARCHAR) END AS value
FROM s, (VALUES ('Segment'), ('Instruction')) AS h(header)
WHERE c_custkey % 4 <> 2 AND NOT (file <> 'book0' AND c_custkey % 7 = 0)""")
def comparative_report(t: Tables) -> DataFrame:
    """Sheets of a report by customer number: a title, a header, then a row a customer, written as cells and read back.
    Every seventh customer stands on a sheet that is not read, but in the one book without a named sheet."""
    key = F.col("c_custkey")
    book = F.concat(F.lit("book"), (key % 5).cast("string"))
    sheet = F.when((book != "book0") & (key % 7 == 0), "Summary").when(book == "book0", "Other").when(key % 2 == 0, "Exhibit C-6").otherwise("Schools")
    place = F.when(key % 4 == 0, "County of CLARKE").when(key % 4 == 1, "Loudoun County, Virginia").when(key % 4 == 2, "Fairfax").otherwise(" Warrenton")
    rows = t.customer.select(book.alias("file"), sheet.alias("sheet"), key.cast("int").alias("row_idx"),
                             F.array(F.col("c_mktsegment"), place, (key * 2).cast("string")).alias("v"))
    sheets = rows.select("file", "sheet").distinct()
    text = F.array(*[F.lit(x) for x in ("Report", "", "of the year")])
    title = sheets.select("file", "sheet", F.lit(-2).alias("row_idx"), text.alias("v"))
    head = sheets.select("file", "sheet", F.lit(-1).alias("row_idx"), F.array(*[F.lit(x) for x in ("Segment", "Locality", "Instruction")]).alias("v"))
    cells = rows.unionByName(title).unionByName(head).select("file", "sheet", "row_idx", F.posexplode("v").alias("col_idx", "value"))
    folder = scratch(t.spark, "cells")
    cells.write.parquet(folder)
    return X.comparative_rows(read_cells(t.spark, folder)).drop("col_idx")


_KEYWORDS = ("tion", "ing", "ment", "ungen", "ciónas", "eaux")


@query("X8", f"""
WITH l AS (SELECT doc_id, string_split(lower(text), chr(10)) AS p FROM documents),
w AS (SELECT doc_id, p[1] || ' ' || array_to_string(p[2:6], '') AS s FROM l),
k AS (SELECT doc_id, {' + '.join(f"CAST(contains(s, '{k}') AS BIGINT)" for k in _KEYWORDS)} AS keyword_matches FROM w)
SELECT *, row_number() OVER (ORDER BY keyword_matches DESC, doc_id) AS rank FROM k WHERE keyword_matches >= 2""")
def table_scoring(t: Tables) -> DataFrame:
    """Each document as a table: line 0 is its header, the next lines its rows."""
    rows = split_lines(t.documents.select("doc_id", "text"), "text", ["doc_id"])
    return X.score_tables(rows, ["doc_id"], "pos", "line", _KEYWORDS)


_ROW_PATTERNS = {"metal": "bolt|ring|anvil", "moving": "gear|widget", "flat": "plate|g[io]zmo"}


@query("X9", """
WITH r AS (SELECT l_orderkey, l_linenumber, greatest(l_extendedprice, l_quantity) AS a,
    CASE WHEN l_linenumber % 3 = 0 AND l_returnflag = 'R' THEN 'Grand Total' WHEN l_returnflag = 'A' THEN 'nothing' ELSE p_name END AS s
  FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT *, CAST(a AS DECIMAL(18,2)) AS m, CASE WHEN regexp_matches(lower(s), 'bolt|ring|anvil') THEN 'metal'
    WHEN regexp_matches(lower(s), 'gear|widget') THEN 'moving' WHEN regexp_matches(lower(s), 'plate|g[io]zmo') THEN 'flat'
    WHEN contains(lower(s), 'total') THEN 'total' WHEN a > 5000 THEN 'other' END AS c FROM r),
g AS (SELECT l_orderkey,
    CAST(coalesce(sum(m) FILTER (WHERE c = 'metal'), 0) AS DOUBLE) AS metal,
    CAST(coalesce(sum(m) FILTER (WHERE c = 'moving'), 0) AS DOUBLE) AS moving,
    CAST(coalesce(sum(m) FILTER (WHERE c = 'flat'), 0) AS DOUBLE) AS flat,
    CAST(coalesce(sum(m) FILTER (WHERE c = 'other'), 0) AS DOUBLE) AS other,
    CAST((max({'i': l_linenumber, 'm': m}) FILTER (WHERE c = 'total')).m AS DOUBLE) AS stated,
    CAST(coalesce(sum(m) FILTER (WHERE c <> 'total'), 0) AS DOUBLE) AS summed FROM k GROUP BY l_orderkey)
SELECT l_orderkey, metal, moving, flat, other, coalesce(nullif(stated, 0), summed) AS total FROM g""")
def row_categorisation(t: Tables) -> DataFrame:
    text = (F.when((F.col("l_linenumber") % 3 == 0) & (F.col("l_returnflag") == "R"), "Grand Total")
            .when(F.col("l_returnflag") == "A", "nothing").otherwise(F.col("p_name")))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", text.alias("text"),
        "l_extendedprice", "l_quantity", (-F.col("l_tax")).alias("minus"))
    amounts = ["l_extendedprice", "l_quantity", "minus"]
    return X.row_categories(rows, ["l_orderkey"], "l_linenumber", "text", amounts, _ROW_PATTERNS, 5000)


@query("X10", """
SELECT conv_id, min(turn) AS page FROM conversations WHERE contains(text, ',') AND contains(text, 'en') GROUP BY conv_id""")
def page_locator(t: Tables) -> DataFrame:
    return X.locate_page(t.conversations, ["conv_id"], "turn", "text", [",", "en"])
