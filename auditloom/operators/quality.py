"""Flags, anomaly lists, contract and consistency checks.

Rules are data. Each rule set becomes one projection (flags) or one aggregate
(contract), whatever the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from auditloom import fixed
from auditloom.functions.numbers import fixed_digits, money_sum, ratio, round_to
from auditloom.operators.rank import top_k
from auditloom.operators.rollups import row_count, samples_per_group


@dataclass(frozen=True)
class Rule:
    """Tiers are ``(threshold, severity, text)``, the worst first; ``{v}`` is the value."""

    indicator: str
    column: str
    above: bool
    tiers: tuple[tuple[float, str, str], ...]
    positive_only: bool = False


_T = fixed.THRESHOLDS


def _tiers(texts: Mapping[str, str], *steps: tuple[str, str]) -> tuple[tuple[float, str, str], ...]:
    return tuple((_T[name], severity, texts[name]) for name, severity in steps)


def _benchmarks(texts: Mapping[str, str]) -> tuple[Rule, ...]:
    """Rules of consolidated and historical metrics: no medium tier for instruction, no staff ratio."""
    return (
        Rule("admin_ratio", "administration_pct", True,
             _tiers(texts, ("admin_ratio_warning", "high"), ("admin_ratio_target", "medium"))),
        Rule("instruction_ratio", "instruction_pct", False, _tiers(texts, ("instruction_ratio_warning", "high")), True),
        Rule("per_pupil_admin", "per_pupil_admin", True, _tiers(texts, ("per_pupil_admin_warning", "medium"))))


_FULL = _benchmarks(fixed.BENCHMARK_MESSAGES)
BENCHMARK_RULES = (
    _FULL[0],
    Rule("instruction_ratio", "instruction_pct", False, _tiers(
        fixed.BENCHMARK_MESSAGES, ("instruction_ratio_warning", "high"), ("instruction_ratio_target", "medium")), True),
    Rule("admin_to_student", "admin_to_student", False, _tiers(
        fixed.BENCHMARK_MESSAGES, ("admin_to_student_warning", "high"), ("admin_to_student_target", "medium")), True),
    _FULL[2],
)
CONSOLIDATED_RULES = _benchmarks(fixed.CONSOLIDATED_MESSAGES)
HISTORY_RULES = _benchmarks(fixed.HISTORY_MESSAGES)
AUDIT_RULES = tuple(
    Rule(name, name, True, ((fixed.AUDIT_THRESHOLDS[name], "WARNING", fixed.AUDIT_MESSAGES[name]),))
    for name in ("admin_pct_of_total_staff", "admin_per_1000_students", "admin_to_teacher_ratio"))


def _message(text: str, value: Column, threshold: float) -> Column:
    """``{v}`` as the number stands, ``{v:.1f}`` with that many digits."""
    before, digits, after = re.fullmatch(r"(.*)\{v(?::\.(\d)f)?\}(.*)", text.replace("{t}", str(threshold))).groups()
    shown = fixed_digits(value, int(digits)) if digits else value.cast("string")
    return F.concat(F.lit(before), shown, F.lit(after))


def _flag(rule: Rule) -> Column:
    value = F.col(rule.column).cast("double")
    chain = None
    for threshold, severity, text in rule.tiers:
        limit = F.lit(float(threshold))
        test = value > limit if rule.above else value < limit
        if rule.positive_only:
            test = test & (value > 0)
        item = F.struct(F.lit(rule.indicator).alias("indicator"), value.alias("value"), limit.alias("threshold"),
                        F.lit(severity).alias("severity"), _message(text, value, threshold).alias("message"))
        chain = F.when(test, item) if chain is None else chain.when(test, item)
    return chain


def with_flags(df: DataFrame, rules: Sequence[Rule], name: str = "red_flags") -> DataFrame:
    """Array of the flags each row raises; the worst matching tier of a rule counts."""
    return df.withColumn(name, F.array_compact(F.array(*[_flag(r) for r in rules])))


def flag_table(flagged: DataFrame, keys: Sequence[str], name: str = "red_flags") -> DataFrame:
    """One row per flag."""
    return flagged.select(*keys, F.explode(name).alias("flag")).select(*keys, "flag.*")


def tiered_flags(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = BENCHMARK_RULES) -> DataFrame:
    return flag_table(with_flags(df, rules), keys)


def growth_flags(df: DataFrame, keys: Sequence[str], growth: str, base: str,
                 times: float = fixed.AUDIT_THRESHOLDS["admin_growth_vs_enrollment"]) -> DataFrame:
    """CRITICAL where one growth is more than ``times`` the other (which must not be 0)."""
    r = F.col(growth).cast("double") / F.nullif(F.col(base).cast("double"), F.lit(0.0))
    name = "admin_growth_vs_enrollment"
    text = F.format_string(fixed.AUDIT_MESSAGES[name], round_to(growth, 2).cast("string"), fixed_digits("_ratio", 1), round_to(base, 2).cast("string"))
    return df.withColumn("_ratio", r).filter(F.col("_ratio") > times).select(
        *keys, F.lit(name).alias("indicator"), round_to("_ratio", 2).alias("value"),
        F.lit(float(times)).alias("threshold"), F.lit("CRITICAL").alias("severity"), text.alias("message"))


def decline_flags(df: DataFrame, keys: Sequence[str], year: str, share: str, label: str | None = None) -> DataFrame:
    """INFO where the last year's share is below the first year's; needs two years. ``label`` is
    the column that names a year in the text."""
    v, named = F.col(share).cast("double"), F.col(label or year).cast("string")
    ends = df.groupBy(*keys).agg(F.min_by(v, year).alias("threshold"), F.max_by(v, year).alias("value"),
                                 F.min_by(named, year).alias("_from"), F.max_by(named, year).alias("_to"),
                                 F.count(F.lit(1)).alias("_n"))
    name = "school_pct_of_budget"
    text = F.format_string(fixed.AUDIT_MESSAGES[name], F.col("threshold").cast("string"), "_from", F.col("value").cast("string"), "_to")
    return ends.filter((F.col("_n") >= 2) & (F.col("value") < F.col("threshold"))).select(
        *keys, F.lit(name).alias("indicator"), "value", "threshold", F.lit("INFO").alias("severity"), text.alias("message"))


def audit_flags(ratios: DataFrame, growth: DataFrame, budget: DataFrame, keys: Sequence[str], year: str,
                share: str, growth_columns: tuple[str, str], label: str | None = None) -> DataFrame:
    """Static, growth and decline flags, plus an OK row where no staff-share flag was raised; each with
    its title (``flag``) and text."""
    static = tiered_flags(ratios, keys, AUDIT_RULES)
    head = AUDIT_RULES[0]
    quiet = ratios.join(static.filter(F.col("indicator") == head.indicator).select(*keys), list(keys), "left_anti")
    value = F.coalesce(F.col(head.column).cast("double"), F.lit(0.0))
    ok = quiet.select(
        *keys, F.lit(head.indicator).alias("indicator"), value.alias("value"),
        F.lit(float(head.tiers[0][0])).alias("threshold"), F.lit("OK").alias("severity"),
        F.format_string(fixed.AUDIT_MESSAGES["ok"], value.cast("string")).alias("message"))
    parts = [static, growth_flags(growth, keys, *growth_columns), decline_flags(budget, keys, year, share, label), ok]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    titles = F.create_map(*(F.lit(x) for item in fixed.AUDIT_TITLES.items() for x in item))
    return out.withColumn("flag", titles[F.when(F.col("severity") == "OK", F.lit("ok")).otherwise(F.col("indicator"))])


# --- anomaly lists: filters over property records ---------------------------------

def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def zero_value_improved(df: DataFrame) -> DataFrame:
    return df.filter((_zero("improvement_value") > 0) & (_zero("total_value") == 0))


def high_land_ratio(df: DataFrame, bounds: Mapping = fixed.ANOMALY) -> DataFrame:
    share = ratio(_zero("land_value"), _zero("total_value"), default=0.0)
    return (df.filter((_zero("total_value") > bounds["land_ratio_total"]) & (_zero("improvement_value") > 0))
            .withColumn("land_ratio", share).filter(F.col("land_ratio") > bounds["land_ratio"]))


def small_lot_high_value(df: DataFrame, bounds: Mapping = fixed.ANOMALY) -> DataFrame:
    acres = _zero("acreage")
    return df.filter((acres > 0) & (acres < bounds["tiny_acres"]) & (_zero("total_value") > bounds["tiny_total"]))


def large_lot_low_value(df: DataFrame, bounds: Mapping = fixed.ANOMALY) -> DataFrame:
    """A null class is not the exempt class, so it passes."""
    exempt = F.col("property_class").eqNullSafe(F.lit(bounds["exempt_class"]))
    return df.filter((_zero("acreage") > bounds["large_acres"])
                     & (_zero("total_value") < bounds["large_total"]) & ~exempt)


def repeat_holdings(df: DataFrame, owner: str, address: str, parcel: str, width: int = 30,
                    bounds: Mapping = fixed.ANOMALY, sample: int | None = None) -> DataFrame:
    """Owners with more than 3 parcels at one address (first 30 characters), with a sample.

    Counts and samples are two aggregates joined on the key; a hot owner sends
    at most ``sample`` rows per task to the sample side.
    """
    key = F.substring(F.coalesce(F.col(address), F.lit("")), 1, width)
    rows = df.filter(F.col(owner) != "").select(F.col(owner).alias("owner"), key.alias("address"),
                                                F.col(parcel).alias("parcel"))
    counts = rows.groupBy("owner", "address").agg(F.count(F.lit(1)).alias("parcel_count")).filter(
        F.col("parcel_count") > bounds["repeat_over"])
    some = samples_per_group(rows, ["owner", "address"], "parcel", ["parcel"],
                             sample or bounds["repeat_sample"], "parcels")
    return counts.join(some, ["owner", "address"])


def zone_frequency(df: DataFrame, zone: str = "zone", weight: str | None = None) -> DataFrame:
    known = F.coalesce(F.col(zone), F.lit("")) != ""
    return df.filter(known).groupBy(zone).agg(row_count(weight).alias("count"))


def high_value_agricultural(df: DataFrame, parcel: str, bounds: Mapping = fixed.ANOMALY, k: int = 20) -> DataFrame:
    rows = df.filter((F.col("property_class") == bounds["agricultural_class"])
                     & (_zero("improvement_value") > bounds["agricultural_improvement"]))
    return top_k(rows, [_zero("total_value").desc(), F.col(parcel)], k)


def top_holders_with_samples(df: DataFrame, owner: str, parcel: str, entity: str, value: str = "total_value",
                             wanted: str = fixed.ENTITY_DEFAULT, k: int = 25, sample: int = 5,
                             district: str = "district") -> DataFrame:
    """Top individual holders by value, each with its first parcels."""
    rows = df.filter(F.col(entity) == wanted)
    owners = rows.groupBy(owner).agg(money_sum(value).cast("double").alias("total_value"),
                                     F.count(F.lit(1)).alias("property_count"))
    best = top_k(owners, [F.col("total_value").desc(), F.col(owner)], k)
    # At most k owners, so they may be broadcast; only their rows are sampled.
    theirs = rows.select(owner, parcel, F.col(value).cast("double").alias("value"), district).join(
        F.broadcast(best), owner)
    return samples_per_group(theirs, [owner], parcel, [parcel, "value", district], sample, "top_properties",
                             carry=["total_value", "property_count"])


def largest_landowners(df: DataFrame, owner: str, value: str = "total_value", acreage: str = "acreage",
                       bounds: Mapping = fixed.ANOMALY, k: int = 25) -> DataFrame:
    """Top owners by acreage, then only those with 50 acres or more."""
    acres = F.col(acreage)
    rows = df.filter((acres != 0) & (acres < bounds["acreage_cap"]))
    owners = rows.groupBy(owner).agg(F.sum(acreage).cast("double").alias("acreage"),
                                     money_sum(value).cast("double").alias("total_value"),
                                     F.count(F.lit(1)).alias("property_count"))
    top = top_k(owners, [F.col("acreage").desc(), F.col(owner)], k)
    return (top.filter(F.col("acreage") >= bounds["landowner_acres"])
            .select(owner, round_to("acreage", 1).alias("total_acreage"), "total_value", "property_count",
                    ratio("total_value", "acreage", digits=0, default=0.0).alias("value_per_acre")))


# --- checks ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """``kind``: required, pattern, minimum or maximum."""

    column: str
    kind: str
    bound: object = None


def _violates(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "required":
        return c.isNull()
    if check.kind == "pattern":
        return c.isNotNull() & ~c.cast("string").rlike(str(check.bound))
    if check.kind == "minimum":
        return c < F.lit(check.bound)
    if check.kind == "maximum":
        return c > F.lit(check.bound)
    raise ValueError(f"unknown check {check.kind!r}")


def contract_violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Violations per check, from one pass over the table."""
    counts = df.agg(*[F.sum(F.when(_violates(c), 1).otherwise(0)).cast("bigint").alias(f"_{i}")
                      for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.column).alias("field"), F.lit(c.kind).alias("check"),
                              F.coalesce(F.col(f"_{i}"), F.lit(0)).alias("violations"))
                     for i, c in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def consistency(df: DataFrame, land: str = "land_value", improvement: str = "improvement_value",
                total: str = "total_value", tax: str = "tax_amount",
                caps: Mapping = fixed.VALUE_CAPS_STRICT) -> DataFrame:
    """Booleans: parts add up, tax rate is plausible, values are under the caps."""
    low, high = fixed.TAX_RATE_RANGE
    rate = F.col(tax).cast("double") / F.nullif(F.col(total).cast("double"), F.lit(0.0))
    sum_ok = F.abs(F.col(land) + F.col(improvement) - F.col(total)) < fixed.SUM_TOLERANCE
    rate_ok = F.coalesce((F.col(total) > 0) & (rate > low) & (rate < high), F.lit(False))
    cap_ok = (F.col(total) < caps["total"]) & (F.col(tax) < caps["tax"])
    return df.select("*", sum_ok.alias("sum_ok"), rate_ok.alias("rate_ok"), cap_ok.alias("cap_ok"))
