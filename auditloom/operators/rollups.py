"""Totals, group rollups and shares.

Counts can be carried by a ``weight`` column, so a fact may be pre-aggregated
to its join key before it is joined to a dimension: the hot keys collapse in
the map-side combine and the rule expressions run once per key.

Shares use one total per scope: a scalar subquery for the whole table, a small
joined table per year. No window runs over facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from auditloom import fixed
from auditloom.functions.names import extract_last_name, lookup
from auditloom.functions.numbers import as_money, col, money_sum, percent, positive, ratio, round_to
from auditloom.operators.rank import top_k_per_group
from auditloom.session import durable


def row_count(weight: str | None) -> Column:
    return (F.sum(weight) if weight else F.count(F.lit(1))).cast("bigint")


def count_if(test: Column, weight: str | None) -> Column:
    one = F.col(weight) if weight else F.lit(1)
    return F.sum(F.when(test, one).otherwise(F.lit(0))).cast("bigint")


def value_sum(c: Column | str, weight: str | None = None) -> Column:
    """Exact sum as a double, 0 for no rows; weighted rows carry sums already."""
    return F.coalesce(money_sum(c, wide=bool(weight)), as_money(F.lit(0))).cast("double")


def sums(measures: Sequence[str], weight: str | None = None) -> list[Column]:
    return [value_sum(m, weight).alias(m) for m in measures]


def totals(df: DataFrame, measures: Sequence[str], weight: str | None = None) -> DataFrame:
    return df.agg(row_count(weight).alias("total_records"), *sums(measures, weight))


def group_rollup(df: DataFrame, keys: Mapping[str, Column | str] | Sequence[str], measures: Sequence[str],
                 count: str = "property_count", weight: str | None = None,
                 acreage: str | None = None) -> DataFrame:
    """Count and sums per group; ``acreage`` sums its non-null values."""
    by = [col(c).alias(k) for k, c in keys.items()] if isinstance(keys, Mapping) else list(keys)
    extra = [F.coalesce(F.sum(acreage), F.lit(0)).cast("double").alias("total_acreage")] if acreage else []
    return df.groupBy(*by).agg(row_count(weight).alias(count), *sums(measures, weight), *extra)


def with_share(rollup: DataFrame, measure: str, name: str, scope: Sequence[str] = (), digits: int = 2,
               small: bool = False) -> DataFrame:
    """Percent of the scope's total, 0 if the total is 0.

    ``rollup`` must already be aggregated. ``small`` says that a scope holds few
    rows (types, classes, districts), so the total is a window over them; set it
    to False for groups that grow with the data (owners), where the total is a
    scalar subquery or a joined total per scope.
    """
    exact = as_money(measure, wide=True)
    if small:
        return rollup.withColumn(name, percent(measure, F.sum(exact).over(Window.partitionBy(*scope)), digits))
    if not scope:
        return rollup.withColumn(name, percent(measure, rollup.agg(F.sum(exact)).scalar(), digits))
    per_scope = rollup.groupBy(*scope).agg(F.sum(exact).alias("_total"))
    return rollup.join(per_scope, list(scope)).withColumn(name, percent(measure, "_total", digits)).drop("_total")


def district_rollup(df: DataFrame, district: str = "district", tax: str = "tax_amount",
                    measures: Sequence[str] = ("land_value", "improvement_value", "total_value", "tax_amount",
                                               "deferred_value"),
                    acreage: str | None = "acreage") -> DataFrame:
    """Per district: count, sums, acreage, shares of county value and tax, mean value."""
    by = {"district": F.coalesce(F.col(district), F.lit("Unknown"))}
    out = group_rollup(df, by, measures, acreage=acreage)
    out = with_share(out, "total_value", "pct_of_county_value", small=True)
    if tax in measures:
        out = with_share(out, tax, "pct_of_county_tax", small=True)
    return out.withColumn("avg_property_value", ratio("total_value", "property_count", digits=0, default=0.0))


def nested_rollup(df: DataFrame, outer: str, inner: str, measures: Sequence[str]) -> DataFrame:
    """Rows per (outer, inner); :func:`nest` turns them into one map per outer key."""
    return group_rollup(df, {outer: F.col(outer), inner: F.coalesce(F.col(inner), F.lit(0))}, measures, "count")


def nest(rollup: DataFrame, outer: str, inner: str, name: str) -> DataFrame:
    """Sink form of a nested rollup; the map holds one entry per inner value."""
    rest = [c for c in rollup.columns if c not in (outer, inner)]
    entry = F.struct(F.col(inner).cast("string").alias("key"), F.struct(*rest).alias("value"))
    return rollup.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))


def class_rollup(df: DataFrame, class_column: str = "property_class", measures: Sequence[str] = ("total_value",),
                 names: Mapping[int, str] = fixed.PROPERTY_CLASSES) -> DataFrame:
    """Per class, null as 0, with class names and percent of the total value."""
    cls = F.coalesce(F.col(class_column), F.lit(0))
    out = group_rollup(df, {"property_class": cls}, measures, "count")
    fallback = F.concat(F.lit("Class "), F.col("property_class").cast("string"))
    out = out.withColumn("class_name", lookup("property_class", names, fallback))
    return with_share(out, "total_value", "pct_of_total", small=True)


def zone_rollup(df: DataFrame, zone: str = "zone") -> DataFrame:
    by = {"zone": F.coalesce(F.nullif(F.col(zone), F.lit("")), F.lit("Unknown"))}
    return group_rollup(df, by, ["total_value"], "count")


def entity_breakdown(df: DataFrame, entity: str = "entity_type", value: str = "total_value",
                     scope: Sequence[str] = (), weight: str | None = None, digits: int = 1) -> DataFrame:
    """Per entity type: count, percent of records, value, percent of value."""
    out = df.groupBy(*scope, entity).agg(
        row_count(weight).alias("count"),
        value_sum(value, weight).alias("total_value"))
    out = with_share(out, "count", "pct_records", scope, digits, small=True)
    return with_share(out, "total_value", "pct_value", scope, digits, small=True)


def owner_rollup(df: DataFrame, owner: str = "owner", value: str = "total_value", keys: Sequence[str] = (),
                 entity: str | None = None, district: str | None = None, weight: str | None = None) -> DataFrame:
    """Per non-blank owner: value, count and, if given, type and sorted district set.

    The district set is at most as long as the list of districts.
    """
    aggs = [value_sum(value, weight).alias("total_value"), row_count(weight).alias("properties")]
    if entity:
        aggs.append(F.first(entity, ignorenulls=True).alias("entity_type"))
    if district:
        aggs.append(F.array_sort(F.collect_set(district)).alias("districts"))
    return df.filter(F.col(owner) != "").groupBy(*keys, owner).agg(*aggs)


def group_top_mix(df: DataFrame, group: str, member: str, k: int, value: str = "total_value",
                  by: str = "count", weight: str | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` members inside each group, with their percent of the group's rows.

    ``by`` is "count" (type mix) or "value" (top owners). Pairs are aggregated
    first; the group totals come from the pairs, not from a second scan.
    """
    keys = [*scope, group]
    pairs = (df.filter(F.col(group).isNotNull()).groupBy(*keys, member)
             .agg(row_count(weight).alias("count"), money_sum(value, bool(weight)).alias("_value")))
    groups = pairs.groupBy(*keys).agg(F.sum("count").alias("group_count"),
                                      F.sum("_value").cast("double").alias("group_value"))
    pairs = pairs.withColumn("value", F.col("_value").cast("double"))
    order = [F.col("count" if by == "count" else "value").desc(), F.col(member)]
    top = top_k_per_group(pairs, keys, order, k).withColumn("rank", F.col("rank").cast("bigint"))
    return (top.join(groups, keys)
            .withColumn("pct", percent("count", "group_count", 1))
            .withColumn("group_avg", ratio("group_value", "group_count", digits=0, default=0.0))
            .drop("_value"))


def _top(df: DataFrame, scope: Sequence[str], order: Sequence[Column], k: int | None) -> DataFrame:
    """First ``k`` rows overall or per scope; all rows if ``k`` is None."""
    if k is None:
        return df
    if not scope:
        return df.orderBy(*order).limit(k)
    return top_k_per_group(df, scope, order, k, "_rank").drop("_rank")


def state_distribution(df: DataFrame, state: str = "state", weight: str | None = None, k: int | None = None,
                       digits: int = 2, scope: Sequence[str] = ()) -> DataFrame:
    """Rows per state and percent of all rows, those without a state included."""
    # At most 26 x 26 states and the null group, so the total is a window over them.
    counts = df.groupBy(*scope, state).agg(row_count(weight).alias("count"))
    total = F.sum("count").over(Window.partitionBy(*scope))
    shares = counts.withColumn("pct", percent("count", total, digits)).filter(F.col(state).isNotNull())
    return _top(shares, scope, [F.col("count").desc(), F.col(state)], k)


def out_of_state_owners(df: DataFrame, owner: str, state: str, seq: str, value: str = "total_value",
                        home: str = fixed.HOME_STATE, k: int | None = 30, weight: str | None = None,
                        scope: Sequence[str] = ()) -> DataFrame:
    """Owners elsewhere by value; the state of the last record (by ``seq``) is shown."""
    out = (df.filter(F.col(state).isNotNull() & (F.col(state) != home)).groupBy(*scope, owner)
           .agg(F.max_by(state, seq).alias("state"), row_count(weight).alias("properties"),
                value_sum(value, weight).alias("total_value")))
    return _top(out, scope, [F.col("total_value").desc(), F.col(owner)], k)


def surname_frequency(df: DataFrame, owner: str = "owner", entity: str = "entity_type",
                      value: str = "total_value", k: int | None = 30, weight: str | None = None,
                      entity_words: Sequence[str] = fixed.LAST_NAME_ENTITY_WORDS,
                      scope: Sequence[str] = ()) -> DataFrame:
    """Last names of individuals (2+ letters): rows, value, mean value."""
    named = (df.filter(F.col(entity) == fixed.ENTITY_DEFAULT)
             .withColumn("last_name", extract_last_name(owner, entity_words))
             .filter(F.length("last_name") > 1))
    out = (named.groupBy(*scope, "last_name").agg(row_count(weight).alias("properties"),
                                                  value_sum(value, weight).alias("total_value"))
           .withColumn("avg_value", ratio("total_value", "properties", digits=0, default=0.0)))
    return _top(out, scope, [F.col("properties").desc(), F.col("last_name")], k)


def type_deep_dive(df: DataFrame, wanted: str, owner: str = "owner", entity: str = "entity_type",
                   class_column: str = "property_class", district: str = "district",
                   value: str = "total_value", top_classes: int = 3, weight: str | None = None,
                   scope: Sequence[str] = ()) -> DataFrame:
    """Per owner of one type: count, value, top classes (``C4,C1``) and districts."""
    rows, keys = df.filter(F.col(entity) == wanted), [*scope, owner]
    # One shuffle on (owner, class, district); both levels above it reuse small rows.
    cells = rows.groupBy(*keys, class_column, district).agg(
        row_count(weight).alias("_n"), money_sum(value, bool(weight)).alias("_v"))
    owners = cells.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("properties"), F.sum("_v").cast("double").alias("total_value"),
        F.array_join(F.array_sort(F.collect_set(district)), "|").alias("districts"))
    by_class = (cells.filter(F.col(class_column).isNotNull() & (F.col(class_column) != 0))
                .groupBy(*keys, class_column).agg(F.sum("_n").alias("_c")))
    ranked = top_k_per_group(by_class, keys, [F.col("_c").desc(), F.col(class_column)], top_classes)
    classes = ranked.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", class_column))),
        lambda s: F.concat(F.lit("C"), s.getField(class_column).cast("string"))), ",").alias("classes"))
    return owners.join(classes, keys, "left")


def weighted_labels(members: DataFrame, labels: DataFrame, key: str, label: str, weight: str,
                    default: str = "UNKNOWN", digits: int = 2) -> DataFrame:
    """Label table joined to members: members and weight per label, with percents."""
    joined = members.join(labels.select(key, label), key, "left").withColumn(
        label, F.coalesce(F.col(label).cast("string"), F.lit(default)))
    out = joined.groupBy(label).agg(F.count(F.lit(1)).alias("members"),
                                    F.sum(weight).cast("bigint").alias("weight"))
    out = with_share(out, "members", "pct_members", digits=digits, small=True)
    return with_share(out, "weight", "pct_weight", digits=digits, small=True)


def top_members_per_label(members: DataFrame, labels: DataFrame, key: str, label: str, weight: str,
                          k: int = 20) -> DataFrame:
    joined = members.join(labels.select(key, F.col(label).cast("string").alias(label)), key)
    return top_k_per_group(joined, [label], [F.col(weight).desc(), F.col(key)], k)


def positive_means(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Mean of the values above zero, per column."""
    return df.groupBy(*keys).agg(*[round_to(F.avg(positive(F.col(m).cast("double"))), digits).alias(m)
                                   for m in measures])


#: Buckets of a histogram of :func:`medians`.
BUCKETS = 1024


def medians(df: DataFrame, measure: str | Column, keys: Sequence[str] = (), name: str = "median") -> DataFrame:
    """Exact median per group, however large: selection by repeated histograms.

    A round counts the values between the bounds in ``BUCKETS`` equal buckets, and goes on in the bucket that
    holds the wanted rank, with the least and greatest value found there as the new bounds; it ends when
    these agree. Only counts are shuffled, a few rows per group and bucket; no group is held or sorted.
    Null and NaN measures are left out; a group of none has a null median.
    """
    value = F.col(measure) if isinstance(measure, str) else measure
    keys = list(keys)
    # Negative and positive zero are one value.
    named = df.select(*keys, (value.cast("double") + F.lit(0.0)).alias("_x"))
    rows = named.filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    middle = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))
    state = durable(sizes.withColumn("_rank", F.explode(middle)).withColumn("_left", F.col("_rank")).drop("_n"))
    while not (todo := state.filter("_lo < _hi")).isEmpty():
        wide = F.col("_hi") / 2 - F.col("_lo") / 2
        place = (F.col("_x") / 2 - F.col("_lo") / 2) / wide * F.lit(BUCKETS)
        bucket = F.when(F.col("_x") == F.col("_hi"), BUCKETS).otherwise(F.least(F.floor(place), F.lit(BUCKETS - 1))).cast("int")
        counts = _met(rows, todo, keys).filter("_x BETWEEN _lo AND _hi").groupBy(*keys, "_rank", "_left", bucket.alias("_b")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = Window.partitionBy(*keys, "_rank").orderBy("_b")
        found = counts.withColumn("_upto", F.sum("_n").over(upto)).filter((F.col("_upto") > F.col("_left")) & (F.col("_upto") - F.col("_n") <= F.col("_left")))
        next_ = found.withColumn("_left", F.col("_left") - (F.col("_upto") - F.col("_n"))).select(*state.columns)
        state = durable(next_.unionByName(state.filter("_lo = _hi")))
    both = state.groupBy(*keys).agg((F.min("_lo") / 2 + F.max("_lo") / 2).alias("_even"), F.min("_lo").alias("_a"), F.max("_lo").alias("_z"))
    # Halves are exact but for the smallest numbers; two equal middles need none.
    return both.select(*keys, F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(F.col("_even")).alias(name))


def _met(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their group's state, null keys included; the state has one or two rows a group."""
    if not keys:
        return rows.withColumn("_one", F.lit(1)).join(F.broadcast(state.withColumn("_one", F.lit(1))), "_one").drop("_one")
    named = state.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in state.columns if c not in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return rows.join(named, same).drop(*[f"_k{i}" for i in range(len(keys))])


def peer_stats(df: DataFrame, measure: str, keys: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Mean, median and sample standard deviation over the peers of a group of any size."""
    x = F.col(measure).cast("double")
    sums = df.groupBy(*keys).agg(
        F.count(x).cast("bigint").alias("peers"), round_to(F.avg(x), digits).alias("mean"), round_to(F.stddev_samp(x), digits).alias("std_dev"))
    middle = medians(df, x, keys)
    if not keys:
        return sums.withColumn("_one", F.lit(1)).join(middle.withColumn("_one", F.lit(1)), "_one", "left").select("peers", "mean", round_to(F.col("median"), digits).alias("median"), "std_dev")
    named = middle.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "median")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return sums.join(named, same, "left").select(*keys, "peers", "mean", round_to(F.col("median"), digits).alias("median"), "std_dev")


def conditional_totals(df: DataFrame, types: Sequence[str], entity: str = "entity_type",
                       value: str = "total_value", scope: Sequence[str] = (),
                       weight: str | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Value and percent per listed type, in one pass and one row per scope."""
    def total(t: str) -> Column:
        return value_sum(F.when(F.col(entity) == t, F.col(value)), weight)

    slug = {t: t.lower().replace(" ", "_").replace("-", "_") for t in types}
    out = df.groupBy(*scope).agg(row_count(weight).alias("total_records"),
                                 value_sum(value, weight).alias("total_value"),
                                 *[total(t).alias(f"{slug[t]}_value") for t in types], *extra)
    return out.select("*", *[percent(f"{s}_value", "total_value", 1).alias(f"{s}_pct") for s in slug.values()])


def samples_per_group(df: DataFrame, keys: Sequence[str], seq: str, item: Sequence[str], k: int,
                      name: str = "samples", carry: Sequence[str] = ()) -> DataFrame:
    """First ``k`` items per group as an array; rows beyond ``k`` never reach it.

    ``carry`` names columns that are constant in a group and stay in the result.
    """
    columns = dict.fromkeys([*keys, *carry, seq, *item])
    first = top_k_per_group(df.select(*columns), keys, [F.col(seq)], k, "_rank")
    entry = F.struct("_rank", *item)
    return first.groupBy(*keys, *carry).agg(F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda s: F.struct(*[s.getField(c).alias(c) for c in item])).alias(name))


def district_profile(df: DataFrame, district: str = "district", owner: str = "owner",
                     entity: str = "entity_type", value: str = "total_value", scope: Sequence[str] = (),
                     types: Sequence[str] = fixed.PROFILE_TYPES, weight: str | None = None) -> DataFrame:
    """Per district (and scope): count, percent, value and percent of each listed type."""
    keys = [*scope, district]
    slug = {t: t.lower() for t in types}
    is_type = {t: F.col(entity) == t for t in types}
    out = df.groupBy(*keys).agg(
        row_count(weight).alias("total_records"), value_sum(value, weight).alias("total_value"),
        *[count_if(is_type[t], weight).alias(f"{slug[t]}_count") for t in types],
        *[value_sum(F.when(is_type[t], F.col(value)), weight)
          .alias(f"{slug[t]}_value") for t in types])
    shares = []
    for s in slug.values():
        shares.append(percent(f"{s}_count", "total_records", 1).alias(f"{s}_pct_records"))
        shares.append(percent(f"{s}_value", "total_value", 1).alias(f"{s}_pct_value"))
    return out.select("*", *shares)


def district_top_owners(df: DataFrame, district: str = "district", owner: str = "owner",
                        value: str = "total_value", k: int = 10, by: str = "value", at_least: int = 1,
                        scope: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Top ``k`` owners per district by value or count; the threshold applies after the cut."""
    keys = [*scope, district]
    owners = owner_rollup(df, owner, value, keys, weight=weight)
    order = [F.col("total_value" if by == "value" else "properties").desc(), F.col(owner)]
    top = top_k_per_group(owners, keys, order, k).withColumn("rank", F.col("rank").cast("bigint"))
    return top.filter(F.col("properties") >= at_least)


def land_use_rollup(df: DataFrame, use: str, value: str, acreage: str) -> DataFrame:
    return (df.groupBy(use).agg(F.count(F.lit(1)).alias("parcels"),
                                value_sum(value).alias("total_value"),
                                F.sum(acreage).cast("double").alias("acres"))
            .withColumn("avg_value", ratio("total_value", "parcels", digits=2, default=0.0)))


def hierarchy(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Totals at every level of a hierarchy (treemap, sunburst)."""
    return df.rollup(*levels).agg(F.grouping_id().cast("bigint").alias("level"),
                                  money_sum(value).cast("double").alias("value"),
                                  F.count(F.lit(1)).alias("records"))


def tally(df: DataFrame, key: str = "severity", name: str = "flags") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
