"""Yearly ownership analysis: one silver table, then gold tables for all years at once.

Names are cleaned and classified once, in silver, which is written partitioned
by year. The gold tables are independent aggregations with the year as a group
key; trends run over the small yearly tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from auditloom import fixed
from auditloom.functions import keys as K, names as N
from auditloom.functions.numbers import percent, ratio
from auditloom.functions.predicates import latest_partition
from auditloom.operators import joins as J, networks as G, quality as Q, rank as W, rollups as R, trends as T
from auditloom.sources.sinks import write_parquet


def silver(records: DataFrame, rules: str | Sequence[tuple] = "yearly") -> DataFrame:
    """Property records with clean owner, entity type and state."""
    named = records.withColumn("owner", N.clean_owner_name("owner_name"))
    return named.select("*", N.classify_entity("owner", rules).alias("entity_type"),
                        K.extract_state("owner_city_state_zip").alias("state"))


def write_silver(records: DataFrame, path: str, rules: str | Sequence[tuple] = "yearly") -> None:
    write_parquet(silver(records, rules), path, partition_by=["year"])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def year_summary(rows: DataFrame) -> DataFrame:
    """One row per year: totals, value per main type, distinct company names."""
    llc = fixed.TREND_TYPES[1]
    # (year, type, owner) first, so the distinct names are a sum of flags and a hot owner is one row.
    owners = rows.groupBy("year", "entity_type", "owner").agg(
        F.count(F.lit(1)).alias("n"), *R.sums(["total_value", "land_value", "improvement_value"]))
    is_llc = F.col("entity_type") == llc
    out = R.conditional_totals(owners, ["Individual", llc, "Corporation", "Trust"], scope=["year"], weight="n", extra=[
        R.value_sum("land_value", "n").alias("land_value"),
        R.value_sum("improvement_value", "n").alias("improvement_value"),
        F.sum(F.when(is_llc, 1).otherwise(0)).alias("unique_llcs"),
        F.sum(F.when(is_llc, F.col("n")).otherwise(0)).alias("total_llc_records")])
    return out.select("*", percent("land_value", "total_value", 1).alias("land_pct"),
                      percent("improvement_value", "total_value", 1).alias("improvement_pct"))


def yearly_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The gold tables of every year."""
    year = ["year"]
    owners = R.owner_rollup(rows, keys=year, entity="entity_type", district="district")
    by_value, by_count = F.col("total_value").desc(), F.col("properties").desc()
    multi = W.top_k_per_group(owners, year, [by_count, F.col("owner")], 50).filter("properties >= 5")
    llcs = R.type_deep_dive(rows, "LLC", scope=year)
    return {
        "summary": year_summary(rows),
        "entity_breakdown": R.entity_breakdown(rows, scope=year),
        "top_last_names": R.surname_frequency(rows, scope=year),
        "top_owners_by_value": W.top_k_per_group(owners, year, [by_value, F.col("owner")], 50),
        "multi_property_owners": multi.withColumn("avg_value", ratio("total_value", "properties", digits=0)),
        "property_classes": R.group_top_mix(rows, "property_class", "entity_type", 5, scope=year).withColumn(
            "class_name", N.lookup("property_class", fixed.PROPERTY_CLASSES,
                                   F.concat(F.lit("Class "), F.col("property_class").cast("string")))),
        "state_distribution": R.state_distribution(rows, k=20, scope=year),
        "top_out_of_state": R.out_of_state_owners(rows, "owner", "state", "parcel_code", scope=year),
        "llc_top_by_count": W.top_k_per_group(llcs, year, [by_count, F.col("owner")], 25).filter("properties >= 3"),
        "llc_top_by_value": W.top_k_per_group(llcs, year, [by_value, F.col("owner")], 25),
        "district_profile": R.district_profile(rows.filter(F.col("district").isNotNull()), scope=year),
        "district_top_owners": R.district_top_owners(rows, scope=year),
        "district_top_multi": R.district_top_owners(rows, by="count", at_least=3, scope=year),
    }


def latest_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Networks and investigations of the latest year."""
    latest = latest_partition(rows)
    return {
        "llc_networks": G.top_networks(latest, "owner_address", "owner", "parcel_code", district="district"),
        "high_value_agricultural": Q.high_value_agricultural(latest, "parcel_code"),
        "high_value_individuals": Q.top_holders_with_samples(latest, "owner", "parcel_code", "entity_type"),
        "largest_landowners": Q.largest_landowners(latest, "owner"),
        "repeat_holdings": Q.repeat_holdings(latest, "owner", "owner_address", "parcel_code"),
        "zero_value_improved": Q.zero_value_improved(latest),
        "very_high_land_ratio": Q.high_land_ratio(latest),
        "tiny_acreage_high_value": Q.small_lot_high_value(latest),
        "large_acreage_low_value": Q.large_lot_low_value(latest),
        "zones": Q.zone_frequency(latest),
    }


def multi_year_tables(summary: DataFrame, breakdown: DataFrame, years: Sequence[int]) -> dict[str, DataFrame]:
    """Trends over the yearly gold tables (pass them as written tables)."""
    matrix = T.share_matrix(breakdown, years)
    growth = T.matrix_growth(matrix)
    measures = ["total_value", "total_records", "unique_llcs"]
    scoped = summary.withColumn("scope", F.lit("all"))
    growths = None
    for m in (*measures, "llc_value", "trust_value"):
        one = T.growth_positions(scoped, ["scope"], "year", m, digits=1).select(F.lit(m).alias("measure"), "growth_pct")
        growths = one if growths is None else growths.unionAll(one)
    return {
        "share_matrix": matrix,
        "type_growth": growth,
        "fastest_growing": W.arg_max(growth.select("entity_type", "growth_pct"), "entity_type", "growth_pct"),
        "year_over_year": W.year_over_year(summary, "year", measures, pct=["total_value"]),
        "growth": growths,
    }


def enrich_districts(features: DataFrame, profile: DataFrame, name: str = "NAME") -> DataFrame:
    """District features with the profile of each year as a map from year to struct."""
    packed = profile.groupBy("district").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.col("year").cast("string"), F.struct(*[c for c in profile.columns if c not in ("district", "year")])
    )))).alias("years"))
    return J.enrich_features(features, packed, name, "district", fixed.DISTRICT_FEATURE_NAMES)
