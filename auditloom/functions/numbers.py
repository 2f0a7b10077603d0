"""Rounding, guarded ratios and amount cleaners (column expressions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
MONEY_WIDE = "decimal(36,2)"
WHITESPACE = " \t\n\r\f\x0b"
# A plain decimal number. try_cast alone would also take "1d", "NaN" or "0x1p3".
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A rule chain refers to its input many times; without this, each pushed-down
    filter would repeat the input expression at every reference.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Cut white space of any kind at both ends (``trim`` cuts spaces only)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def round_to(c: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the scaled double; the same on every engine.

    Values whose scaled form passes 2^53 have no digits left to round and stay.
    """
    x = col(c).cast("double")
    scale = float(10**digits)
    scaled = F.abs(x) * F.lit(scale)
    magnitude = F.when(scaled < float(2**53), F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(F.abs(x))
    return F.when(x < 0, -magnitude).otherwise(magnitude)


def fixed_digits(c: Column | str, digits: int) -> Column:
    """A double as text with that many decimal places: nearest to its binary value, exact ties to the even digit, as
    C and Python print it. ``format_string`` rounds the shortest decimal form half up instead (2.05 to 2.1, 0.25 to 0.3)."""
    return F.call_function("format_number", col(c).cast("double"), F.lit("0." + "0" * digits if digits else "0"))


def ratio(num: Column | str, den: Column | str, *, scale: float = 1.0,
          digits: int | None = None, default: float | None = None) -> Column:
    """``num / den * scale`` where ``den > 0``, else ``default`` (null if None)."""
    n, d = col(num).cast("double"), col(den).cast("double")
    value = n / d * F.lit(scale) if scale != 1.0 else n / d
    if digits is not None:
        value = round_to(value, digits)
    return F.when(d > 0, value).otherwise(F.lit(default).cast("double"))


def percent(num: Column | str, den: Column | str, digits: int = 1,
            default: float | None = 0.0) -> Column:
    return ratio(num, den, scale=100.0, digits=digits, default=default)


def growth_pct(first: Column | str, last: Column | str, digits: int = 2) -> Column:
    """Change from first to last in percent; null unless ``first > 0``."""
    a, b = col(first).cast("double"), col(last).cast("double")
    return F.when(a > 0, round_to((b - a) / a * F.lit(100.0), digits))


def cagr_pct(first: Column | str, last: Column | str, periods: Column | str, digits: int = 2) -> Column:
    a, b, n = (col(c).cast("double") for c in (first, last, periods))
    ok = (a > 0) & (n > 0) & (b >= 0)
    return F.when(ok, round_to((F.pow(b / a, F.lit(1.0) / n) - F.lit(1.0)) * F.lit(100.0), digits))


def as_money(c: Column | str, wide: bool = False) -> Column:
    """Two-digit decimal; ``wide`` for values that are sums already."""
    return col(c).cast(MONEY_WIDE if wide else MONEY)


def money_sum(c: Column | str, wide: bool = False) -> Column:
    """Exact sum of amounts with two digits: whole cents add in any order, doubles do not.

    Rounding to cents and widening a long is far cheaper per row than casting a
    double to a decimal. ``wide`` is for decimal sums that are summed again. NaN and
    amounts beyond 18 digits of cents count as missing.
    """
    if wide:
        return F.sum(as_money(c, wide=True))
    cents = F.rint(col(c).cast("double") * F.lit(100.0)).try_cast("bigint").try_cast("decimal(18,0)")
    return (F.sum(cents) / F.lit(100)).cast("decimal(30,2)")


def positive(c: Column | str) -> Column:
    """The value where it is above zero, else null (zero counts as missing)."""
    return F.when(col(c) > 0, col(c))


def _parse(text: Column) -> Column:
    """The text as a double if all of it is a number, else null."""
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def clean_amount(c: Column | str) -> Column:
    """Currency text to double; brackets mean negative; blank or junk is 0.0."""
    raw = col(c).cast("string")
    sign = F.when(raw.contains("(") & raw.contains(")"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.coalesce(_parse(F.regexp_replace(raw, r"[$,\s()%]", "")) * sign, F.lit(0.0))


def amount_or_null(c: Column | str, missing: tuple[str, ...], strip_chars: str = "$,%") -> Column:
    """Currency text to double; a missing mark or junk is null; ``(x)`` is ``-x``."""
    raw = strip(col(c).cast("string"))
    signed = F.regexp_replace(F.translate(raw, strip_chars, ""), r"^\((.*)\)$", "-$1")
    return F.when(~raw.isin(list(missing)), _parse(signed))


def coded_number(c: Column | str, codes: tuple[str, ...]) -> Column:
    """Survey number; a missing-data code is null."""
    raw = col(c)
    return F.when(~raw.isin(list(codes)), _parse(raw))


def int_text(c: Column | str) -> Column:
    """``"1,305,900"`` to a long; null when there are no digits."""
    return F.nullif(F.translate(col(c), ",", ""), F.lit("")).try_cast("bigint")


def decimal_text(c: Column | str, kind: str = MONEY) -> Column:
    return F.nullif(F.translate(col(c), ",", ""), F.lit("")).try_cast(kind)
