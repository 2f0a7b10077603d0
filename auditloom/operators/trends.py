"""Ratios and trends.

Facts are one row per (entity, year). Series stay in long form; arrays are
built only at the sink. Every growth operator is one ``groupBy`` over entities.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from auditloom import fixed
from auditloom.functions.numbers import as_money, cagr_pct, growth_pct, percent, ratio, round_to
from auditloom.operators.joins import all_present, densify, first_per_key


def per_unit(df: DataFrame, units: str, amounts: Mapping[str, str] = fixed.PER_UNIT_CATEGORIES,
             suffix: str = "_per_unit") -> DataFrame:
    """Amount per unit, 2 digits, where both are above zero; else null."""
    out = [F.when(F.col(a) > 0, ratio(a, units, digits=2)).alias(name + suffix) for a, name in amounts.items()]
    return df.select("*", *out)


def spending_shares(df: DataFrame, total: str = "total",
                    categories: Sequence[str] = fixed.SHARE_CATEGORIES) -> DataFrame:
    """Percent of the total, 2 digits; null if the total is not above zero."""
    return df.select("*", *[percent(c, total, 2, default=None).alias(f"{c}_pct") for c in categories])


def staff_ratios(df: DataFrame, units: str, teachers: str, admins: str) -> DataFrame:
    """Units per teacher, units per administrator, teachers per administrator; null when guarded."""
    def guarded(num: str, den: str) -> Column:
        return F.when(F.col(num) > 0, ratio(num, den, digits=1))

    return df.select("*", guarded(units, teachers).alias("teacher_to_student"),
                     guarded(units, admins).alias("admin_to_student"),
                     guarded(teachers, admins).alias("admin_to_teacher"))


def admin_ratios(admin: DataFrame, instruction: DataFrame, enrollment: DataFrame, keys: Sequence[str],
                 order: Sequence[Column]) -> DataFrame:
    """Administrative ratios of entities present in all three tables; 0 where guarded.

    Inputs: ``admin_positions, support_total``; ``teachers, instructional``; ``adm``.
    """
    tables = [first_per_key(t, keys, order) for t in (admin, instruction, enrollment)]
    staff = F.col("support_total") + F.col("instructional")
    return all_present(tables, keys).withColumn("total_staff", staff).select(
        "*",
        percent("admin_positions", "total_staff", 2).alias("admin_pct_of_total_staff"),
        ratio("admin_positions", "adm", scale=1000.0, digits=2, default=0.0).alias("admin_per_1000_students"),
        ratio("admin_positions", "teachers", digits=4, default=0.0).alias("admin_to_teacher_ratio"),
        ratio("adm", "admin_positions", digits=1, default=0.0).alias("students_per_admin"))


def source_shares(df: DataFrame, total: str, sources: Mapping[str, str], digits: int = 1) -> DataFrame:
    """Percent of the total per source; a zero total gives null."""
    t = F.nullif(F.col(total).cast("double"), F.lit(0.0))
    return df.select("*", *[round_to(F.col(c).cast("double") / t * F.lit(100.0), digits).alias(name)
                            for c, name in sources.items()])


def survey_metrics(df: DataFrame) -> DataFrame:
    """Derived columns of the finance survey; zero counts as missing."""
    def known(c: str) -> Column:
        return F.nullif(F.col(c).cast("double"), F.lit(0.0))

    units, spent = known("enrollment"), known("total_expenditures")
    taught = known("instruction_expenditures")
    admin = F.when(spent.isNotNull(), known("general_administration") + known("school_administration"))
    return df.select(
        "*", admin.alias("total_administration"),
        round_to(spent / units, 2).alias("per_pupil_total"),
        round_to(taught / units, 2).alias("per_pupil_instruction"),
        round_to(admin / spent * F.lit(100.0), 2).alias("admin_pct"),
        round_to(admin / units, 2).alias("per_pupil_admin"),
        round_to(taught / spent * F.lit(100.0), 2).alias("instruction_pct"))


def dense_trend(df: DataFrame, entity: Sequence[str], year: str, years: Sequence,
                measures: Sequence[str]) -> DataFrame:
    """Each entity in each listed year, null in the gaps, with the year's position ``idx``."""
    out = densify(df, entity, year, years, measures)
    places = F.array(*[F.lit(y) for y in years])
    return out.withColumn("idx", (F.array_position(places, F.col(year)) - 1).cast("bigint"))


def own_year_trend(df: DataFrame, entity: Sequence[str], year: str, measures: Sequence[str]) -> DataFrame:
    """Each entity over its own years, missing as 0; entities with one year are left out."""
    enough = df.groupBy(*entity).agg(F.count_distinct(year).alias("_years")).filter("_years >= 2")
    filled = [F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]
    return df.select(*entity, year, *filled).join(enough.select(*entity), list(entity), "left_semi")


def series(df: DataFrame, entity: Sequence[str], year: str, measures: Sequence[str]) -> DataFrame:
    """Sink form: arrays aligned on ``years``; one element per year of the entity."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(year, *measures)))
    packed = df.groupBy(*entity).agg(sorted_rows.alias("_rows"))
    return packed.select(*entity, F.col(f"_rows.{year}").alias("years"),
                         *[F.col(f"_rows.{m}").alias(f"{m}_trend") for m in measures])


def growth_nonnull(df: DataFrame, entity: Sequence[str], idx: str, measure: str) -> DataFrame:
    """Growth and yearly rate between the first and the last non-null value.

    Entities with fewer than two points or a first value not above zero have no row.
    """
    at = F.when(F.col(measure).isNotNull(), F.col(idx))
    v = F.col(measure).cast("double")
    ends = df.groupBy(*entity).agg(
        F.min_by(v, at).alias("start_value"), F.max_by(v, at).alias("end_value"),
        (F.max(at) - F.min(at)).cast("bigint").alias("periods"))
    return (ends.filter((F.col("periods") > 0) & (F.col("start_value") > 0))
            .select("*", growth_pct("start_value", "end_value", 2).alias("total_growth_pct"),
                    cagr_pct("start_value", "end_value", "periods", 2).alias("cagr_pct")))


def growth_positions(df: DataFrame, entity: Sequence[str], year: str, measure: str,
                     last_nonzero: bool = False, digits: int = 2) -> DataFrame:
    """Growth from the first year to the last, missing as 0; needs two rows.

    ``last_nonzero`` takes the last value that is not 0 and then needs it above zero.
    """
    v = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    last = F.max_by(F.when(v != 0, v), F.when(v != 0, F.col(year))) if last_nonzero else F.max_by(v, year)
    ends = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("_rows"), F.min_by(v, year).alias("first_value"),
                                   F.coalesce(last, F.lit(0.0)).alias("last_value"))
    ok = (F.col("_rows") >= 2) & (F.col("first_value") > 0)
    if last_nonzero:
        ok = ok & (F.col("last_value") > 0)
    growth = F.when(ok, growth_pct("first_value", "last_value", digits))
    return ends.withColumn("growth_pct", growth).drop("_rows")


def fixed_year_share(df: DataFrame, year: str, wanted, parts: Sequence[str], total: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Percent of parts in the total, in one given year."""
    at = F.col(year) == F.lit(wanted)

    def sum_at(c: str) -> Column:
        return F.sum(F.when(at, as_money(c))).cast("double")

    wide = df.groupBy(*keys).agg(*[sum_at(p).alias(p) for p in parts], sum_at(total).alias(total))
    return wide.select(*keys, *[percent(p, total, 2, default=None).alias(f"{p}_pct") for p in parts])


def share_matrix(breakdown: DataFrame, years: Sequence, types: Sequence[str] = fixed.TREND_TYPES,
                 year: str = "year", entity: str = "entity_type") -> DataFrame:
    """Listed types x years with percent by count and by value, 0 in the gaps.

    ``breakdown`` is the yearly entity breakdown (a gold table).
    """
    rows = breakdown.filter(F.col(entity).isin(list(types)))
    # The member list is the fixed type list, so the scaffold is built from literals.
    frame = (breakdown.sparkSession.range(1)
             .select(F.explode(F.array(*[F.lit(t) for t in types])).alias(entity))
             .withColumn(year, F.explode(F.array(*[F.lit(y) for y in years]))))
    joined = frame.join(rows.select(entity, F.col(year), "pct_records", "pct_value", "total_value"),
                        [entity, year], "left")
    return joined.fillna(0.0, subset=["pct_records", "pct_value", "total_value"])


def matrix_growth(matrix: DataFrame, types: Sequence[str] = fixed.GROWTH_TYPES, year: str = "year",
                  entity: str = "entity_type") -> DataFrame:
    """Growth of total value between the first and last year for the listed types."""
    rows = matrix.filter(F.col(entity).isin(list(types)))
    ends = rows.groupBy(entity).agg(F.min_by("total_value", year).alias("first_year_value"),
                                    F.max_by("total_value", year).alias("last_year_value"))
    return ends.filter(F.col("first_year_value") > 0).select(
        "*", growth_pct("first_year_value", "last_year_value", 1).alias("growth_pct"),
        (F.col("last_year_value") - F.col("first_year_value")).alias("absolute_change"))


def trend_summary(df: DataFrame, entity: Sequence[str], year: str, measure: str) -> DataFrame:
    """Yearly rate, direction, and acceleration of a yearly series.

    Acceleration is the mean change of the yearly percent change.
    """
    w = Window.partitionBy(*entity).orderBy(year)
    v = F.col(measure).cast("double")
    steps = (df.withColumn("_yoy", growth_pct(F.lag(v).over(w), v, 2))
             .withColumn("_step", F.col("_yoy") - F.lag("_yoy").over(w)))
    out = steps.groupBy(*entity).agg(
        F.min_by(v, year).alias("start_value"), F.max_by(v, year).alias("end_value"),
        (F.max(year) - F.min(year)).cast("bigint").alias("periods"),
        round_to(F.avg("_step"), 2).alias("acceleration"))
    direction = (F.when(F.col("end_value") > F.col("start_value"), F.lit("increasing"))
                 .when(F.col("end_value") < F.col("start_value"), F.lit("decreasing"))
                 .otherwise(F.lit("flat")))
    return out.select(*entity, "start_value", "end_value",
                      cagr_pct("start_value", "end_value", "periods", 2).alias("cagr_pct"),
                      direction.alias("direction"), "acceleration")


def union_sources(parts: Mapping[str, DataFrame], name: str = "source") -> DataFrame:
    """Rows of several sources with a source tag; fields of one source are null in the others."""
    tagged = [df.withColumn(name, F.lit(label)) for label, df in parts.items()]
    out = tagged[0]
    for other in tagged[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def distinct_years(df: DataFrame, year: str) -> DataFrame:
    return df.select(year).distinct()
