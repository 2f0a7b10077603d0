"""How the test tables stand in for the record shapes, in Spark and in SQL.

``Tables`` gives the Spark frames; the ``*_SQL`` texts are the same shapes as
common table expressions for the equivalent SQL of a query.

* ``records``: one row per order as a property record;
* ``lots``: line items folded to the part before the part dimension is joined,
  so name rules run once per part and a part that holds most lines collapses in
  the map-side combine;
* ``facts``: one row per region and year, as a division's yearly figures.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from auditloom import fixed
from auditloom.functions.keys import extract_state
from auditloom.functions.names import classify_entity, clean_owner_name
from auditloom.functions.numbers import money_sum
from auditloom.session import durable

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
         "embeddings", "pages", "benchmark", "labels", "conversations")


def _cents(c: str) -> Column:
    return F.rint(F.col(c) * 100).cast("bigint")


def _to_money(total: Column) -> Column:
    """Sum of cents x percent to money, half up to the cent (the sums are not negative)."""
    shifted = total + 50
    return (shifted - F.pmod(shifted, F.lit(100))) / F.lit(10000.0)


class Tables:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def order_values(self) -> DataFrame:
        """Land, improvement, tax and acreage per order, in whole numbers until the last step."""
        cents, off, tax = _cents("l_extendedprice"), _cents("l_discount"), _cents("l_tax")
        sums = self.lineitem.groupBy("l_orderkey").agg(
            F.sum(cents * (100 - off)).alias("land"), F.sum(cents * off).alias("improvement"),
            F.sum(cents * tax).alias("tax"), F.sum("l_quantity").alias("acreage"))
        return sums.select("l_orderkey", _to_money(F.col("land")).alias("land_value"),
                           _to_money(F.col("improvement")).alias("improvement_value"),
                           _to_money(F.col("tax")).alias("tax_amount"), "acreage")

    @cached_property
    def wide_orders(self) -> DataFrame:
        """``orders`` for text work."""
        return self.orders

    @cached_property
    def records(self) -> DataFrame:
        return self._records(self.orders)

    def _records(self, orders: DataFrame) -> DataFrame:
        places = (self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
                  .select("n_nationkey", "n_name", "r_name"))
        cls = F.substring("o_orderpriority", 1, 1)
        # The fact stays the streamed side: customers first, then the small place table.
        owned = orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        return owned.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_orderkey").alias("parcel"),
            F.col("c_name").alias("owner"), cls.cast("int").alias("property_class"),
            F.col("r_name").alias("district"), F.col("n_name").alias("nation"),
            F.col("c_mktsegment").alias("zone"), F.col("o_orderstatus").alias("status"),
            F.concat("n_name", F.lit(" BOX "), cls).alias("address"),
            F.col("o_totalprice").alias("total_value"))

    @cached_property
    def valued_records(self) -> DataFrame:
        """``records`` with land, improvement, tax and acreage (null without line items)."""
        return self._valued(self.records)

    @cached_property
    def wide_records(self) -> DataFrame:
        return self._valued(self._records(self.wide_orders))

    def _valued(self, records: DataFrame) -> DataFrame:
        return records.join(self.order_values, F.col("parcel") == F.col("l_orderkey"), "left").drop("l_orderkey")

    @cached_property
    def parties(self) -> DataFrame:
        """Parts as owners: text with entity words, embedded tax tails and comma names."""
        upper = F.upper("p_name")
        first, second = F.split_part(upper, F.lit(" "), F.lit(1)), F.split_part(upper, F.lit(" "), F.lit(2))
        chain = None
        for column, value, before, after in PARTY_FORMS:
            text = F.concat(F.lit(before), upper, F.lit(after))
            test = F.col(column) == value
            chain = F.when(test, text) if chain is None else chain.when(test, text)
        chain = chain.when(F.col("p_type") == "SMALL", F.concat(second, F.lit(", "), first, F.lit(" JR")))
        raw = self.part.select(
            "p_partkey", chain.otherwise(F.concat(F.lit("  "), upper)).alias("owner_raw"),
            F.concat(F.lit("po box "), F.col("p_size").cast("string"), F.lit(" "), F.lower("p_brand")).alias("address"),
            _place_of(F.col("p_size") % 6).alias("city_state_zip"),
            F.col("p_type").alias("district"), F.col("p_brand").alias("zone"))
        named = raw.withColumn("owner", clean_owner_name("owner_raw"))
        return named.select("*", classify_entity("owner", "yearly").alias("entity_type"),
                            extract_state("city_state_zip").alias("state"))

    def lots(self, *by: str) -> DataFrame:
        """Line items folded to part and ``by`` (year, property_class), joined to the owner.

        ``n`` counts the records of a row and ``total_value`` is their sum, so a
        part that holds most lines is small before it meets the join.
        """
        columns = {"year": F.year("l_shipdate").cast("bigint"), "property_class": F.col("l_linenumber")}
        folded = self.lineitem.groupBy("l_partkey", *[columns[c].alias(c) for c in by]).agg(
            F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("total_value"))
        return folded.join(self.parties, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def facts(self) -> DataFrame:
        """Per region and year; ``fiscal_year`` as FYnnnn."""
        def rows(test: Column) -> Column:
            return F.sum(F.when(test, 1).otherwise(0))

        def money(value: str, test: Column | None = None) -> Column:
            return money_sum(F.col(value) if test is None else F.when(test, F.col(value))).cast("double")

        status, cls = F.col("status"), F.col("property_class")
        out = self.valued_records.groupBy("district", "year").agg(
            F.count(F.lit(1)).alias("adm"), rows(cls <= 2).alias("teachers"),
            rows((cls == 5) & (status == "F")).alias("admins"), rows(cls >= 4).alias("support"),
            money("total_value").alias("total"), money("total_value", status == "O").alias("local_amount"),
            money("total_value", status == "P").alias("state_amount"),
            money("total_value", status == "F").alias("federal_amount"),
            money("land_value").alias("instruction"), money("tax_amount").alias("administration"),
            money("improvement_value").alias("technology"))
        return out.withColumn("fiscal_year", F.concat(F.lit("FY"), F.col("year").cast("string")))


    @cached_property
    def gold_facts(self) -> DataFrame:
        """``facts`` written once, for queries that read it more than once."""
        return durable(self.facts)


# (column, value, text before the name, text after it); the first match decides.
PARTY_FORMS = (
    ("p_brand", "Brand#1", "COUNTY OF ", ""),
    ("p_brand", "Brand#2", "", " BAPTIST CHURCH"),
    ("p_brand", "Brand#3", "", " CLUB"),
    ("p_brand", "Brand#4", "", " ELECTRIC"),
    ("p_brand", "Brand#5", "ESTATE OF ", ""),
    ("p_brand", "Brand#6", "", " SAVINGS"),
    ("p_brand", "Brand#7", "", " LP"),
    ("p_brand", "Brand#8", "", " CONDO"),
    ("p_type", "ECONOMY", "", " LLC"),
    ("p_type", "LARGE", "", " INC"),
    ("p_type", "STANDARD", "", " TRUST"),
    ("p_type", "PROMO", "", " L.L.C. FH 1,234.50 SH 9.00"),
)
PLACES = {0: "WINCHESTER VA 22601", 1: "BUNKER HILL WV 25413", 2: "HAGERSTOWN MD 21740", 3: "VA 22602",
          4: "NO PLACE KNOWN"}


def _place_of(number: Column) -> Column:
    chain = None
    for key, text in PLACES.items():
        chain = F.when(number == key, F.lit(text)) if chain is None else chain.when(number == key, F.lit(text))
    return chain


# --- the same shapes in SQL ---------------------------------------------------------

def rnd(e: str, digits: int) -> str:
    """Half away from zero on the scaled double."""
    scale = f"1e{digits}"
    return (f"(CASE WHEN ({e}) < 0 THEN -(floor(abs({e})*{scale}+5e-1)/{scale}) "
            f"ELSE floor(abs({e})*{scale}+5e-1)/{scale} END)")


def pct(num: str, den: str, digits: int, default: str = "0.0::DOUBLE") -> str:
    n, d = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return f"(CASE WHEN {d} > 0 THEN {rnd(f'{n}/{d}*1e2', digits)} ELSE {default} END)"


def rat(num: str, den: str, digits: int, default: str = "NULL", scale: str = "") -> str:
    n, d = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return f"(CASE WHEN {d} > 0 THEN {rnd(f'{n}/{d}{scale}', digits)} ELSE {default} END)"


def growth(a: str, b: str, digits: int) -> str:
    return f"(CASE WHEN {a} > 0 THEN {rnd(f'({b}-{a})/{a}*1e2', digits)} END)"


def sql_classify(name: str, rules: str) -> str:
    arms = []
    for label, kind, spec in fixed.ENTITY_RULES[rules]:
        def words(ws: tuple[str, ...]) -> str:
            return "(" + " OR ".join(f"contains(upper({name}),'{w}')" for w in ws) + ")"

        if kind == "words":
            test = words(spec)
        elif kind == "regex":
            test = f"regexp_matches(upper({name}),'{spec}')"
        else:
            test = f"(regexp_matches(upper({name}),'{spec[0]}') AND NOT {words(spec[1])})"
        arms.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE '{fixed.ENTITY_DEFAULT}' END"


_VALUES = """
  SELECT l_orderkey,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))*(1-CAST(l_discount AS DECIMAL(5,2)))) AS DECIMAL(18,2)) AS land_value,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))*CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2)) AS improvement_value,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))*CAST(l_tax AS DECIMAL(5,2))) AS DECIMAL(18,2)) AS tax_amount,
    sum(l_quantity) AS acreage
  FROM lineitem GROUP BY l_orderkey"""

REC = """rec AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderkey AS parcel, c_name AS owner,
    CAST(left(o_orderpriority,1) AS INTEGER) AS property_class, r_name AS district, n_name AS nation,
    c_mktsegment AS zone, o_orderstatus AS status, n_name || ' BOX ' || left(o_orderpriority,1) AS address,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

VREC = REC + f""", vals AS ({_VALUES}), vrec AS (
  SELECT rec.*, land_value, improvement_value, tax_amount, acreage
  FROM rec LEFT JOIN vals ON parcel = l_orderkey)"""

_PARTY_CASE = "CASE " + " ".join(
    f"WHEN {c} = '{v}' THEN '{b}' || upper(p_name) || '{a}'" for c, v, b, a in PARTY_FORMS) + (
    " WHEN p_type = 'SMALL' THEN split_part(upper(p_name),' ',2) || ', ' || split_part(upper(p_name),' ',1) || ' JR'"
    " ELSE '  ' || upper(p_name) END")
_PLACE_CASE = "CASE p_size % 6 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PLACES.items()) + " END"


def sql_clean(e: str) -> str:
    inner = e
    for mark in ("FH", "SH"):
        inner = f"regexp_replace({inner}, '\\s+{mark}\\s+[\\d,\\.]+.*$', '')"
    return f"trim({inner})"


PARTIES = f"""parties AS (
  SELECT *, {sql_classify('owner', 'yearly')} AS entity_type,
    nullif(regexp_extract(city_state_zip, '\\b([A-Z]{{2}})\\s+\\d{{5}}', 1), '') AS state
  FROM (SELECT *, {sql_clean('owner_raw')} AS owner FROM (
    SELECT p_partkey, {_PARTY_CASE} AS owner_raw,
      'po box ' || CAST(p_size AS VARCHAR) || ' ' || lower(p_brand) AS address,
      {_PLACE_CASE} AS city_state_zip, p_type AS district, p_brand AS zone
    FROM part)))"""

# One row per line item, not folded: the SQL side counts and sums plainly.
LOTS = PARTIES + """, lots AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_linenumber AS property_class,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS total_value, parties.*
  FROM lineitem JOIN parties ON l_partkey = p_partkey)"""

FACTS = VREC + """, facts AS (
  SELECT district, year, 'FY' || CAST(year AS VARCHAR) AS fiscal_year, count(*) AS adm,
    CAST(sum(CASE WHEN property_class <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS teachers,
    CAST(sum(CASE WHEN property_class = 5 AND status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS admins,
    CAST(sum(CASE WHEN property_class >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS support,
    CAST(sum(total_value) AS DOUBLE) AS total,
    CAST(sum(CASE WHEN status = 'O' THEN total_value END) AS DOUBLE) AS local_amount,
    CAST(sum(CASE WHEN status = 'P' THEN total_value END) AS DOUBLE) AS state_amount,
    CAST(sum(CASE WHEN status = 'F' THEN total_value END) AS DOUBLE) AS federal_amount,
    CAST(sum(land_value) AS DOUBLE) AS instruction, CAST(sum(tax_amount) AS DOUBLE) AS administration,
    CAST(sum(improvement_value) AS DOUBLE) AS technology
  FROM vrec GROUP BY district, year)"""
