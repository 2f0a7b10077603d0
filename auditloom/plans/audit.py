"""Audit report: ratios, shares, trends, ranks and flags per division.

Inputs are the flat division tables. Fiscal years are brought to one form once,
after which every step is an equality join or an aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from auditloom import fixed
from auditloom.functions.keys import fiscal_year_key
from auditloom.operators import joins as J, quality as Q, rank as W, trends as T

KEYS = ["division_code", "fiscal_year"]


def normalise(table: DataFrame, state_totals: DataFrame | None = None) -> DataFrame:
    """Division rows (and state totals) with ``fiscal_year`` as FYnnnn."""
    rows = table if state_totals is None else table.unionByName(state_totals, allowMissingColumns=True)
    return rows.withColumn("fiscal_year", fiscal_year_key("fiscal_year"))


def ratios(admin: DataFrame, instruction: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Administrative ratios of the divisions that are in all three tables."""
    return T.admin_ratios(admin, instruction, enrollment, KEYS, [F.col("fiscal_year")])


def expenditure(table: DataFrame, year: str, state_code: str = "STATE") -> DataFrame:
    """Source shares of one year and the variance of the total against the state row."""
    rows = table.filter(F.col("fiscal_year") == year)
    shares = T.source_shares(rows, "total_per_pupil", {
        "local_per_pupil": "local_pct", "state_per_pupil": "state_pct", "federal_per_pupil": "federal_pct"})
    state = rows.filter(F.col("division_code") == state_code)
    return J.variance_vs_reference(shares, state, "total_per_pupil")


def trends(table: DataFrame, measure: str, years: Sequence[str] = fixed.TREND_YEARS) -> tuple[DataFrame, DataFrame]:
    """(dense series, growth) of one measure per division over the listed years."""
    one = J.first_per_key(table, KEYS, [F.col("fiscal_year")])
    dense = T.dense_trend(one, ["division_code"], "fiscal_year", years, [measure])
    return dense, T.growth_nonnull(dense, ["division_code"], "idx", measure)


def rankings(ratio_table: DataFrame, spending: DataFrame, year: str) -> DataFrame:
    """Ranks of the peers by spending and by administrative staff."""
    rows = (ratio_table.filter(F.col("fiscal_year") == year)
            .join(spending.select("division_code", "total_per_pupil"), "division_code"))
    return W.ordinal_ranks(rows, {"total_per_pupil": "asc", "admin_per_1000_students": "asc",
                                  "students_per_admin": "desc"}, "division_code")


def flags(ratio_table: DataFrame, admin_growth: DataFrame, enrollment_growth: DataFrame, budget: DataFrame,
          year: str, target: str = fixed.TARGET_DIVISION) -> DataFrame:
    """All flags of the target division."""
    def growth(table: DataFrame, name: str) -> DataFrame:
        return table.select("division_code", F.col("total_growth_pct").alias(name))

    both = growth(admin_growth, "admin_growth").join(growth(enrollment_growth, "enrollment_growth"), "division_code")
    is_target = F.col("division_code") == target
    return Q.audit_flags(ratio_table.filter(is_target & (F.col("fiscal_year") == year)), both.filter(is_target),
                         budget.filter(is_target), ["division_code"], "fiscal_year", "pct_of_total_budget",
                         ("admin_growth", "enrollment_growth"))
