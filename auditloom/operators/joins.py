"""Joins and joins with dirty keys.

No side is broadcast by hint here: Spark broadcasts a side when its measured
size is under the session's threshold, and otherwise shuffles both, where
adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from auditloom.functions.keys import account_key, parcel_key
from auditloom.functions.names import lookup
from auditloom.functions.numbers import percent, round_to, strip
from auditloom.functions.predicates import latest_partition


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def all_present(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Entities that have a row in every table (each already one row per key)."""
    out = tables[0]
    for other in tables[1:]:
        out = out.join(other, list(keys))
    return out


def first_match_lookup(df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Mapping[str, object],
                       order: Sequence[Column]) -> DataFrame:
    """Left join to the first row per key of ``other``; gaps take the given default."""
    one = first_per_key(other, keys, order).select(*keys, *columns)
    joined = df.join(one, list(keys), "left")
    return joined.fillna({c: d for c, d in columns.items() if d is not None})


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def _keyed_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join in which blank keys, however many, stay out of the shuffle."""
    blank = F.coalesce(F.col(left_key), F.lit("")) == ""
    matched = left.filter(~blank).join(right, F.col(left_key) == F.col(right_key), "left")
    return matched.unionByName(left.filter(blank), allowMissingColumns=True)


def parcel_join(parcels: DataFrame, records: DataFrame, parcel_id: str, code: str, columns: Sequence[str],
                year: str = "year") -> DataFrame:
    """Parcels with the latest year's record of the same normalised id; blank ids match nothing."""
    latest = latest_partition(records, year)
    right = latest.select(strip(F.col(code)).alias("_code"), *columns).filter("_code <> ''")
    return _keyed_left_join(parcels.withColumn("parcel_key", parcel_key(parcel_id)), right, "parcel_key", "_code").drop("_code")


def account_join(parcels: DataFrame, records: DataFrame, left_key: str, right_key: str,
                 columns: Sequence[str], year: str | None = "year") -> DataFrame:
    """Parcels with the latest year's record of the same account number.

    Shared column names get ``_gis`` and ``_tax``. Blank keys match nothing;
    :func:`account_match_report` counts what matching them would give, without
    forming the pairs.
    """
    latest = latest_partition(records, year) if year else records
    shared = set(parcels.columns) & set(columns)
    left = parcels.select(*[F.col(c).alias(f"{c}_gis" if c in shared else c) for c in parcels.columns],
                          account_key(left_key).alias("macct_str"))
    right = latest.select(account_key(right_key, zero_is_blank=False).alias("acct_str"),
                          *[F.col(c).alias(f"{c}_tax" if c in shared else c) for c in columns])
    return _keyed_left_join(left, right.filter("acct_str <> ''"), "macct_str", "acct_str")


def account_match_report(parcels: DataFrame, records: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows and matches of :func:`account_join` in both modes, from per-key counts."""
    left = parcels.groupBy(account_key(left_key).alias("k")).agg(F.count(F.lit(1)).alias("l"))
    right = records.groupBy(account_key(right_key, zero_is_blank=False).alias("k")).agg(
        F.count(F.lit(1)).alias("r"))
    pairs = left.join(right, "k", "left").withColumn("r", F.coalesce("r", F.lit(0)))
    blank = F.col("k") == ""
    strict = F.when(blank, F.lit(0)).otherwise(F.col("r"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return pairs.agg(
        total(F.col("l")).alias("parcels"),
        total(F.col("l") * F.greatest(strict, F.lit(1))).alias("rows_strict"),
        total(F.col("l") * strict).alias("matched_strict"),
        total(F.col("l") * F.greatest(F.col("r"), F.lit(1))).alias("rows_blank"),
        total(F.col("l") * F.col("r")).alias("matched_blank"))


def match_rate(joined: DataFrame, column: str) -> DataFrame:
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count(column).alias("matched")).withColumn(
        "match_pct", percent("matched", "rows", 1))


def unnest_json(df: DataFrame, column: str, element: str, keep: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Elements of a JSON array column (0..limit-1 if there is a limit), one row each.

    ``element`` is the DDL type of one element; the position is ``i``.
    """
    items = F.from_json(F.col(column), f"array<{element}>")
    if limit is not None:
        items = F.slice(items, 1, limit)
    return (df.select(*keep, F.posexplode(items).alias("i", "item"))
            .filter(F.col("item").isNotNull()).select(*keep, "i", "item.*"))


def year_scaffold(members: DataFrame, year: str, years: Sequence) -> DataFrame:
    """Every member in every listed year: each row is expanded by the fixed list."""
    return members.withColumn(year, F.explode(F.array(*[F.lit(y) for y in years])))


def densify(df: DataFrame, member: Sequence[str], year: str, years: Sequence, measures: Sequence[str],
            fill: float | None = None) -> DataFrame:
    """(member x year) rows with null or ``fill`` in the gaps.

    ``df`` has one row per member and year, so a member folds to a map from year
    to measures no longer than its years; the fixed list is then looked up in it.
    """
    by_year = F.map_from_entries(F.collect_list(F.struct(F.col(year), F.struct(*measures))))
    packed = df.groupBy(*member).agg(by_year.alias("_by_year"))
    kind = df.schema[year].dataType
    rows = year_scaffold(packed, year, years).withColumn(year, F.col(year).cast(kind))
    found = F.element_at("_by_year", F.col(year))
    out = rows.select(*member, year, *[found.getField(m).alias(m) for m in measures])
    return out if fill is None else out.fillna(fill, subset=list(measures))


def enrich_features(features: DataFrame, rollup: DataFrame, name: str, district: str,
                    names: Mapping[str, str], field: str = "ownership") -> DataFrame:
    """Add a rollup to features as a struct, through a name map; others stay unchanged."""
    nested = rollup.select(F.col(district).alias("_district"),
                           F.struct(*[c for c in rollup.columns if c != district]).alias(field))
    return (features.withColumn("_district", lookup(name, names))
            .join(nested, "_district", "left").drop("_district"))


def discrepancy(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str,
                tolerance: float = 0.05) -> DataFrame:
    """Keys whose two sources differ by more than ``tolerance``, or exist in one only."""
    joined = (left.select(*keys, F.col(measure).cast("double").alias("left_value"))
              .join(right.select(*keys, F.col(measure).cast("double").alias("right_value")),
                    list(keys), "full_outer"))
    one_sided = F.col("left_value").isNull() | F.col("right_value").isNull()
    gap = F.abs(F.col("left_value") - F.col("right_value")) / F.nullif(F.abs("right_value"), F.lit(0.0))
    state = F.when(one_sided, F.lit("one side only")).when(gap > tolerance, F.lit("differs"))
    return joined.withColumn("state", state).filter(F.col("state").isNotNull())


def variance_vs_reference(df: DataFrame, reference: DataFrame, measure: str, keys: Sequence[str] = (),
                          digits: int = 1) -> DataFrame:
    """Percent above or below the reference row; null where there is none or it is 0."""
    ref = F.col("reference_value")
    gap = round_to((F.col(measure).cast("double") - ref) / F.nullif(ref, F.lit(0.0)) * F.lit(100.0), digits)
    value = F.col(measure).cast("double")
    if keys:
        one = reference.select(*keys, value.alias("reference_value"))
        return df.join(one, list(keys), "left").withColumn("variance_pct", gap)
    only = reference.agg(F.max(value)).scalar()
    return df.withColumn("reference_value", only).withColumn("variance_pct", gap)
