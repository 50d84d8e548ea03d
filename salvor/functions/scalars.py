"""Column expressions with the null rules of the source data.

A comparison with a missing value is false (0), never null; a value that does
not parse is missing; clipping keeps a missing value missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that count as yes and no.
YES = ("y", "yes", "true", "1")
NO = ("n", "no", "false", "0")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: Column | str, default: float | None = None) -> Column:
    """Lenient double: unparsable text and NaN are missing, then ``default``."""
    value = F.nullif(_col(c).try_cast("double"), F.lit(float("nan")))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def whole(c: Column | str) -> Column:
    """Lenient long; accepts ``'5'`` and ``'5.0'`` without losing long precision."""
    value = _col(c)
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def clip(c: Column | str, low=None, high=None) -> Column:
    """Clamp; missing stays missing although greatest/least skip nulls."""
    value = _col(c)
    bounded = value
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(low))
    return F.when(value.isNotNull(), bounded)


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def stripped(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(" \t\n\r\f\x0b"))


def to_bool(c: Column | str) -> Column:
    text = F.lower(stripped(_col(c).cast("string")))
    return F.when(text.isin(*YES), 1).when(text.isin(*NO), 0)


def is_yes(c: Column | str, literal: str | None = None) -> Column:
    """The truthy test of the analyses: any yes spelling, or one exact ``literal``."""
    return _col(c) == literal if literal is not None else to_bool(c) == 1


def matches(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regex search as 0/1."""
    return flag(_col(c).rlike(f"(?i){pattern}"))


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (lpad alone would cut it)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def half_up(value: Column, digits: int) -> Column:
    """Round a mean as its decimal value: summing order must not decide a final 5."""
    return F.round(F.round(value, 8), digits)


def pct(part: Column, whole_: Column, digits: int = 2) -> Column:
    return half_up(F.try_divide(part * F.lit(100.0), whole_), digits)


def display_number(c: Column | str, digits: int = 2) -> Column:
    """Thousands separators; missing shows as N/A."""
    return F.coalesce(F.format_number(_col(c), digits), F.lit("N/A"))


def display_text(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit("N/A"))


def display_money(c: Column | str) -> Column:
    """No decimals, halves away from zero; a value that is not finite shows as -."""
    value = _col(c)
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(finite, F.format_number(F.round(value, 0), 0)).otherwise(F.lit("-"))


def digest(key: Column, seed: int | str, digits: int = 8) -> Column:
    """First hex digits of md5 of "seed:key": a uniform text that any engine with md5 can state."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, digits)


def digest_below(key: Column, seed: int | str, percent: int) -> Column:
    """A pick of ``percent`` % of the keys by their digest."""
    return digest(key, seed) < f"{percent * 2**32 // 100:08x}" if percent < 100 else F.lit(True)
