"""Ordering: global ranks, top-k, latest rows, change over time, record ids.

Scale notes
* top-k per group filters ``row_number <= k``, which Spark turns into a group
  limit before the shuffle, so a hot group sends at most k rows per task;
* global top-k is ``orderBy.limit`` (take-ordered), never a one-task window;
* a global rank over a large table uses range partitions plus one offset per
  partition instead of a window without partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from auditloom.functions.numbers import growth_pct, round_to
from auditloom.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low bits


ROWS_PER_PARTITION = 1_000_000


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; end ``order`` with a unique key so ties are settled."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def limit_then_threshold(df: DataFrame, order: Sequence[Column], k: int, keep: Column) -> DataFrame:
    """Top ``k`` first, then the test; fewer than ``k`` rows may remain."""
    return top_k(df, order, k).filter(keep)


def threshold_then_sort(df: DataFrame, keep: Column, order: Sequence[Column]) -> DataFrame:
    return df.filter(keep).orderBy(*order)


def ordinal_ranks(df: DataFrame, metrics: Mapping[str, str], key: str,
                  partition: Sequence[str] = ()) -> DataFrame:
    """``<metric>_rank`` 1..n per metric ("asc" or "desc"), nulls last, ties by ``key``.

    With ``partition`` each group is ranked by a window. Without it the whole table is, by one range
    shuffle of the rows' (metric, value, key), and ``key`` must be unique and not null.
    """
    if not partition:
        return _table_ranks(df, metrics, key)
    for metric, direction in metrics.items():
        value = F.col(metric)
        order = value.asc_nulls_last() if direction == "asc" else value.desc_nulls_last()
        w = Window.partitionBy(*partition).orderBy(order, F.col(key))
        df = df.withColumn(f"{metric}_rank", F.row_number().over(w).cast("bigint"))
    return df


def _table_ranks(df: DataFrame, metrics: Mapping[str, str], key: str) -> DataFrame:
    """Ranks of several metrics of a whole table: a row per metric and key, each with one value column that is not
    null, ranged by all of them, so that the rows of a metric follow each other in its own order."""
    places = list(enumerate(metrics.items()))
    kinds = df.schema
    values = [F.array(*[F.struct(F.lit(i).alias("metric"), F.col(key).alias("key"), *[
        (F.col(m) if i == j else F.lit(None).cast(kinds[m].dataType)).alias(f"v{j}") for j, (m, _) in places]) for i, _ in places])]
    long = durable(df.select(F.explode(values[0]).alias("r")).select("r.*"))
    order = [F.col("metric"), *[F.col(f"v{j}").asc_nulls_last() if d == "asc" else F.col(f"v{j}").desc_nulls_last() for j, (_, d) in places],
             F.col("key")]
    ranked = global_rank(long, order, "_at")
    # One row per metric.
    starts = ranked.groupBy("metric").agg(F.min("_at").alias("_start"))
    wide = (ranked.join(F.broadcast(starts), "metric").withColumn("_at", F.col("_at") - F.col("_start") + 1).groupBy(F.col("key").alias(key))
            .agg(*[F.max(F.when(F.col("metric") == i, F.col("_at"))).alias(f"{m}_rank") for i, (m, _) in places]))
    return df.join(wide, key)


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """1..n over the whole table in ``order`` (must be a total order).

    One range shuffle; the ranged rows are checkpointed, so that counting and
    numbering see the same partitions and the loss of an executor cannot change
    them. The offset table has one row per partition. A partition has about
    ``ROWS_PER_PARTITION`` rows; a first job counts them.
    """
    n = partitions or max(1, -(-df.count() // ROWS_PER_PARTITION))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id()))
    ranged = durable(ranged.withColumn("_part", F.shiftrightunsigned("_id", _ROW_BITS))
                     .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
                     .drop("_id"))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # At most ``n`` rows, so the broadcast is bounded by the partition count.
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_before") + F.col("_row") + 1).cast("bigint"))
            .drop("_part", "_row", "_before"))


def quartile(df: DataFrame, metric: str, key: str, partition: Sequence[str] = (),
             buckets: int = 4, name: str = "quartile") -> DataFrame:
    """``ntile`` inside each (small) peer group."""
    w = Window.partitionBy(*partition).orderBy(F.col(metric).asc_nulls_last(), F.col(key))
    return df.withColumn(name, F.ntile(buckets).over(w).cast("bigint"))


def global_quartile(df: DataFrame, metric: str, key: str, buckets: int = 4,
                    name: str = "quartile") -> DataFrame:
    """``ntile`` of a whole large table from its global rank.

    The first ``total % buckets`` tiles hold one row more, as ``ntile`` does.
    """
    ranked = global_rank(df, [F.col(metric).asc_nulls_last(), F.col(key)], "_rank")
    # Counted from the checkpoint of the ranks.
    total = ranked.agg(F.count(F.lit(1))).scalar()
    base, extra = F.floor(total / buckets), total % buckets
    wide = extra * (base + 1)
    tile = (F.when(F.col("_rank") <= wide, F.floor((F.col("_rank") - 1) / (base + 1)))
            .otherwise(extra + F.floor((F.col("_rank") - 1 - wide) / F.greatest(base, F.lit(1)))))
    return ranked.withColumn(name, (tile + 1).cast("bigint")).drop("_rank")


def year_over_year(df: DataFrame, year: str, measures: Sequence[str], pct: Sequence[str] = (),
                   partition: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Change against the previous year present; the first year has no row.

    For the yearly gold table, one row per year (and partition).
    """
    w = Window.partitionBy(*partition).orderBy(year)
    out = df.withColumn("from_year", F.lag(year).over(w))
    columns = [*partition, "from_year", F.col(year).alias("to_year")]
    for m in measures:
        out = out.withColumn(f"_{m}", F.lag(m).over(w))
        columns.append((F.col(m) - F.col(f"_{m}")).alias(f"{m}_change"))
        if m in pct:
            columns.append(growth_pct(f"_{m}", m, digits).alias(f"{m}_change_pct"))
    return out.filter(F.col("from_year").isNotNull()).select(*columns)


def latest_year_matrix(df: DataFrame, entity: Sequence[str], year: str, measures: Sequence[str],
                       average_label: str = "Peer Average") -> DataFrame:
    """Each entity with its measures in the overall latest year, plus an average row.

    An entity without that year keeps only its keys; of several rows of that year one whole row
    counts, the greatest by its measures in order. Averages use positive values only. ``entity[-1]`` carries the label of the average row.
    """
    newest = df.agg(F.max(year)).scalar()
    latest = F.col(year) == newest
    row = F.struct(*[F.col(m).cast("double").alias(m) for m in measures])
    rows = df.groupBy(*entity).agg(F.max(F.when(latest, row)).alias("_row")).select(
        *entity, *[F.col("_row").getField(m).alias(m) for m in measures])
    average = rows.agg(*[round_to(F.avg(F.when(F.col(m) > 0, F.col(m))), 2).alias(m) for m in measures])
    blanks = [F.lit(None).cast(rows.schema[e].dataType).alias(e) for e in entity[:-1]]
    return rows.unionByName(average.select(*blanks, F.lit(average_label).alias(entity[-1]), *measures))


def preferred_year_row(df: DataFrame, entity: Sequence[str], year: str, preferred: str,
                       order: Sequence[Column]) -> DataFrame:
    """One row per entity: the preferred year, else the first in ``order``."""
    w = Window.partitionBy(*entity).orderBy((F.col(year) == preferred).desc(), *order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def mixed_year_compare(df: DataFrame, entity: Sequence[str], year: str, base_year: str, new_year: str,
                       base: Sequence[str], newer: Sequence[str]) -> DataFrame:
    """``base`` columns from one year; ``newer`` ones from another, else from the base year."""
    def at(y: str, m: str) -> Column:
        return F.max(F.when(F.col(year) == y, F.col(m)))

    zero = F.lit(0)
    has_new = F.max(F.when(F.col(year) == new_year, F.lit(1))).isNotNull()
    columns = [F.coalesce(at(base_year, m), zero).alias(m) for m in base]
    columns += [F.coalesce(F.when(has_new, at(new_year, m)).otherwise(at(base_year, m)), zero).alias(m)
                for m in newer]
    return df.groupBy(*entity).agg(*columns)


def arg_max(df: DataFrame, label: str, value: str) -> DataFrame:
    """The label with the greatest value; the smallest label on a tie."""
    best = df.filter(F.col(value).isNotNull()).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(label).alias("l"))).alias("b"))
    return best.filter(F.col("b").isNotNull()).select(F.col("b.l").alias(label), (-F.col("b.v")).alias(value))


def running_id(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], starts: Column,
               name: str = "record_id") -> DataFrame:
    """Number of start rows up to and including each row, per key.

    ``chunk`` splits a key into ordered pieces of bounded size (a file block, a
    range of positions), so a key that holds most rows is still spread over
    tasks. Inside a chunk a window counts; across chunks only one count per
    chunk is summed.
    """
    flagged = df.withColumn("_chunk", chunk).withColumn("_start", F.when(starts, 1).otherwise(0))
    by = [*keys, "_chunk"]
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = flagged.groupBy(*by).agg(F.sum("_start").alias("_n"))
    offsets = totals.select(*by, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    counted = flagged.withColumn("_here", F.sum("_start").over(inside))
    return (counted.join(offsets, by)
            .withColumn(name, (F.col("_before") + F.col("_here")).cast("bigint"))
            .drop("_chunk", "_start", "_here", "_before"))


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)
