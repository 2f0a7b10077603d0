"""Frames that charts and maps draw from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from auditloom.functions.numbers import round_to
from auditloom.session import durable


def number_or_zero(c: Column | str) -> Column:
    value = F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def series_frame(df: DataFrame) -> DataFrame:
    """First column as text label, the others as doubles with null as 0."""
    label, *values = df.columns
    return df.select(F.coalesce(F.col(label).cast("string"), F.lit("")).alias("label"),
                     *[number_or_zero(v).alias(v) for v in values])


def series_long(df: DataFrame) -> DataFrame:
    """One row per label and dataset."""
    wide = series_frame(df)
    values = wide.columns[1:]
    return wide.unpivot(["label"], values, "dataset", "value")


def scatter_frame(df: DataFrame) -> DataFrame:
    x, y = df.columns[:2]
    return df.select(number_or_zero(x).alias("x"), number_or_zero(y).alias("y"))


def _numeric(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.select(v.alias("v")).filter(v.isNotNull() & ~F.isnan(v))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between min and max; the max falls in the last bin."""
    rows = _numeric(df, value)
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.floor((F.col("v") - lo) / F.nullif(hi - lo, F.lit(0.0)) * F.lit(float(bins)))
    bucket = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint")
    return rows.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def linear_breaks(df: DataFrame, value: str, classes: int) -> DataFrame:
    """``classes + 1`` equally spaced edges from min to max; no row for an empty input."""
    ends = _numeric(df, value).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo is not null")
    edges = ends.withColumn("idx", F.explode(F.array(*[F.lit(i) for i in range(classes + 1)])))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(classes))
    return edges.select(F.col("idx").cast("bigint").alias("idx"),
                        (F.col("lo") + step * F.col("idx").cast("double")).alias("edge"))


def quantile_breaks(df: DataFrame, value: str, classes: int, partitions: int | None = None) -> DataFrame:
    """Exact edges: min, the values at ``floor(n / classes * i)`` of the sorted list, max.

    Equal values are counted first, so a value that fills a third of the table
    is one row. The distinct values are range-partitioned and their counts run
    on from partition to partition; nothing is sorted in one task. Runs one job
    when called.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = _numeric(df, value).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranged = durable(counts.repartitionByRange(n, "v").withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One offset per range partition, so the broadcast is bounded.
    placed = (ranged.join(F.broadcast(offsets), "part")
              .withColumn("upto", F.col("before") + F.sum("n").over(inside))
              .withColumn("since", F.col("upto") - F.col("n")))
    total = sizes.agg(F.sum("size")).scalar()
    step = F.col("total").cast("double") / F.lit(float(classes))
    wanted = [F.struct(F.lit(0).cast("bigint").alias("idx"), F.lit(0).cast("bigint").alias("at"))]
    wanted += [F.struct(F.lit(i).cast("bigint").alias("idx"), F.floor(step * F.lit(float(i))).cast("bigint").alias("at"))
               for i in range(1, classes)]
    wanted += [F.struct(F.lit(classes).cast("bigint").alias("idx"), (F.col("total") - 1).cast("bigint").alias("at"))]
    hits = F.filter(F.array(*wanted), lambda w: (w["at"] >= F.col("since")) & (w["at"] < F.col("upto")))
    placed = placed.withColumn("total", total)
    return placed.select(F.explode(hits).alias("w"), "v").select(F.col("w.idx").alias("idx"), F.col("v").alias("edge"))


def breaks(df: DataFrame, value: str, classes: int, scale: str = "linear") -> DataFrame:
    """Class breaks; any scale other than quantile is linear."""
    return quantile_breaks(df, value, classes) if scale == "quantile" else linear_breaks(df, value, classes)


def assign_classes(df: DataFrame, value: str, edges: DataFrame, name: str = "class") -> DataFrame:
    """First class whose upper edge is not below the value; the last class above all; null stays null.

    The edges (one per class) come in as one array through a scalar subquery.
    """
    packed = edges.agg(F.array_sort(F.collect_list(F.struct("idx", "edge"))).alias("e"))
    with_edges = df.withColumn("_upper", packed.select(F.slice(F.col("e.edge"), F.lit(2), F.greatest(F.size("e.edge") - 1, F.lit(0))).alias("edges")).scalar())
    upper, v = F.col("_upper"), F.col(value).cast("double")
    first = F.size(F.filter(upper, lambda edge: edge < v))
    place = F.least(first, F.size(upper) - 1).cast("bigint")
    return with_edges.withColumn(name, F.when(v.isNotNull() & ~F.isnan(v), place)).drop("_upper")


def feature_json(df: DataFrame, geometry: str) -> DataFrame:
    """One GeoJSON feature text per row; text that is no JSON gives a null geometry."""
    properties = [c for c in df.columns if c != geometry]
    feature = F.struct(F.lit("Feature").alias("type"), F.try_parse_json(F.col(geometry)).alias("geometry"),
                       F.struct(*properties).alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"),
                     F.try_parse_json(F.col(geometry)).isNull().alias("geometry_missing"))


def comparison_bars(df: DataFrame, label: str, value: str) -> DataFrame:
    """Bars with the mean of the positive values as a reference line."""
    mean = df.agg(round_to(F.avg(F.when(F.col(value) > 0, F.col(value).cast("double"))), 2)).scalar()
    return df.select(F.col(label).alias("label"), F.col(value).cast("double").alias("value"), mean.alias("average"))


def threshold_bars(df: DataFrame, label: str, value: str, target: float, warning: float,
                   positive_only: bool = False) -> DataFrame:
    """Bars with target and warning lines; optionally only values above zero."""
    rows = df.filter(F.col(value) > 0) if positive_only else df
    return rows.select(F.col(label).alias("label"), F.col(value).cast("double").alias("value"),
                       F.lit(float(target)).alias("target"), F.lit(float(warning)).alias("warning"))
