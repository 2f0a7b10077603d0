"""Join keys, fiscal years, addresses, document types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from auditloom import fixed
from auditloom.functions.numbers import col, strip


def match(text: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; null where there is none."""
    return F.nullif(F.regexp_extract(col(text), pattern, group), F.lit(""))


def parcel_key(c: Column | str) -> Column:
    """Strip, then each run of white space becomes ``--``; null is ''."""
    return F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), r"\s+", "--")


def account_key(c: Column | str, zero_is_blank: bool = True) -> Column:
    """Account number as integer text; null, text that is no number (and zero) is ''.

    Numbers of up to 38 digits stay exact; a fraction is cut.
    """
    # Text, or a number of any type as text; reals of 10^7 and more come with an exponent.
    number = F.regexp_extract(col(c).cast("string"), r"^\s*([+-]?[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?)\s*$", 1)
    whole = F.regexp_extract(number, r"^([+-]?[0-9]+)(?:\.[0-9]*)?$", 1)
    exact = number.try_cast("decimal(38,12)")
    cut = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
    number = F.when(whole != "", whole.try_cast("decimal(38,0)")).otherwise(
        F.coalesce(cut.cast("decimal(38,0)"), number.try_cast("decimal(38,0)")))
    blank = number.isNull() | (number == 0) if zero_is_blank else number.isNull()
    return F.when(blank, F.lit("")).otherwise(number.cast("string"))


def extract_state(c: Column | str) -> Column:
    return match(c, fixed.STATE_PATTERN)


def extract_city(c: Column | str) -> Column:
    return strip(match(c, fixed.CITY_PATTERN))


def address_key(c: Column | str, width: int | None = 40) -> Column:
    """Upper-case address. Addresses equal in the first ``width`` characters count as one; None
    compares them whole."""
    text = F.coalesce(col(c), F.lit(""))
    return F.upper(strip(text if width is None else F.substring(text, 1, width)))


def _fy(year: Column) -> Column:
    return F.concat(F.lit("FY"), year.cast("string"))


def fiscal_year_key(c: Column | str) -> Column:
    """``FY2024`` and ``2023-24`` to ``FY2024``; other text unchanged.

    The end year is start + 1, so ``1999-00`` is FY2000.
    """
    text = col(c)
    start = match(text, r"^(\d{4})-").try_cast("int")
    return F.when(text.startswith("FY"), text).when(start.isNotNull(), _fy(start + 1)).otherwise(text)


def school_year(c: Column | str) -> Column:
    """``FY2024`` to ``2023-24``; other text unchanged."""
    year = match(c, r"^FY(\d{4})$").try_cast("int")
    end = F.lpad((year % 100).cast("string"), 2, "0")
    return F.coalesce(F.concat((year - 1).cast("string"), F.lit("-"), end), col(c))


def fiscal_year_from_file(c: Column | str) -> Column:
    """From a file name: ``2023-24`` first, then any 20xx, else Unknown."""
    span = match(c, r"(\d{4})-(\d{2})").try_cast("int")
    single = match(c, r"20(\d{2})")
    return F.coalesce(_fy(span + 1), F.concat(F.lit("FY20"), single), F.lit("Unknown"))


def fiscal_year_from_text(c: Column | str) -> Column:
    """From running text: ``FY 2024``, then ``2023-2024`` (end year), then any 20xx."""
    return F.coalesce(
        F.concat(F.lit("FY"), match(c, r"(?i)FY\s*(\d{4})")),
        F.concat(F.lit("FY"), match(c, "(\\d{4})\\s*[-–]\\s*(\\d{4})", 2)),
        F.concat(F.lit("FY20"), match(c, r"20(\d{2})")),
        F.lit("Unknown"))


def fiscal_year_strict(c: Column | str) -> Column:
    """Only a literal ``FY`` and four digits; else null."""
    return F.concat(F.lit("FY"), match(c, r"FY(\d{4})"))


def document_type(file_name: Column | str, kinds: Sequence[str] = fixed.DOCUMENT_TYPES,
                  default: str = "unknown") -> Column:
    name = F.lower(col(file_name))
    chain = F.when(name.contains(kinds[0]), F.lit(kinds[0]))
    for kind in kinds[1:]:
        chain = chain.when(name.contains(kind), F.lit(kind))
    return chain.otherwise(F.lit(default))


def report_type(file_name: Column | str) -> Column:
    """``acfr`` (also for "comprehensive") or ``budget``."""
    name = F.lower(col(file_name))
    return F.when(name.contains("acfr") | name.contains("comprehensive"), F.lit("acfr")).otherwise(F.lit("budget"))


def canonical_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case with ``_`` for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def display_key(c: Column | str, width: int) -> Column:
    """Cut for display only; group on the full value first."""
    return F.substring(col(c), 1, width)


def json_value(c: Column | str, path: str, kind: str = "string") -> Column:
    value = F.get_json_object(col(c), path)
    return value if kind == "string" else value.try_cast(kind)
