"""Shared-address networks: owners of one type behind the same mailing address."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.functions.keys import address_key
from auditloom.functions.numbers import money_sum
from auditloom.operators.rank import top_k_per_group
from auditloom.operators.rollups import row_count


def shared_addresses(df: DataFrame, address: str, owner: str, seq: str, value: str = "total_value",
                     entity: str | None = "entity_type", wanted: str = "LLC", district: str | None = None,
                     min_names: int = 3, address_width: int = 40, name_width: int = 40,
                     min_address: int = 6, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(networks, names): one row per address with enough distinct names, and its names.

    Rows fold to (address, name) before anything else is shuffled, so an address
    with very many records costs one row per name and task. No pairs of names
    are formed.
    """
    rows = df.filter(F.col(entity) == wanted) if entity else df
    rows = (rows.withColumn("address", address_key(address, address_width))
            .filter(F.length("address") >= min_address)
            .withColumn("name_key", F.substring(F.col(owner), 1, name_width)))
    aggs = [money_sum(value, bool(weight)).alias("_value"), row_count(weight).alias("properties"),
            F.max_by(owner, seq).alias("full_name")]
    if district:
        aggs.append(F.array_sort(F.collect_set(district)).alias("districts"))
    names = rows.groupBy("address", "name_key").agg(*aggs)
    networks = (names.groupBy("address")
                .agg(F.count(F.lit(1)).alias("name_count"), F.sum("properties").cast("bigint").alias("property_count"),
                     F.sum("_value").cast("double").alias("total_value"))
                .filter(F.col("name_count") >= min_names))
    return networks, names.withColumn("value", F.col("_value").cast("double")).drop("_value")


def top_networks(df: DataFrame, address: str, owner: str, seq: str, k: int = 50, names_per_network: int = 15,
                 **options) -> DataFrame:
    """Top ``k`` networks by value, each with its top names by value."""
    networks, names = shared_addresses(df, address, owner, seq, **options)
    best = networks.orderBy(F.col("total_value").desc(), F.col("address")).limit(k)
    # ``best`` has at most k rows, so it may be broadcast; it hands its totals to the names.
    members = names.join(F.broadcast(best), "address")
    top = top_k_per_group(members, ["address"], [F.col("value").desc(), F.col("name_key")], names_per_network)
    fields = [F.substring("full_name", 1, 50).alias("name"), "properties", "value"]
    if "districts" in names.columns:
        fields.append("districts")
    listed = top.groupBy(*best.columns).agg(
        F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("names"))
    return listed.orderBy(F.col("total_value").desc(), F.col("address"))
