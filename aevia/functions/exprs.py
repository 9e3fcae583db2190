"""Column-expression helpers. All built-in functions: they stay inside
whole-stage codegen and never leave the JVM.

Raw text is parsed with ``try_*`` functions so that one malformed value
becomes a null rather than failing a task (ANSI mode stays on).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from aevia.schemas import (
    AGE_UNIT_TO_YEARS,
    FLAG_NO,
    FLAG_YES,
    MAX_AGE_YEARS,
    MIN_AGE_YEARS,
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def code_as_int(x: Column | str) -> Column:
    """Text code to int; '1', ' 1', '1.0' -> 1, anything unparsable -> null."""
    return _c(x).cast("string").try_cast("double").try_cast("int")


def binary_flag(x: Column | str) -> Column:
    """Safety-report yes/no code (1 yes, 2 no) -> 1 / 0; anything else null."""
    v = code_as_int(x)
    return F.when(v == FLAG_YES, F.lit(1)).when(v == FLAG_NO, F.lit(0)).otherwise(
        F.lit(None).cast("int")
    )


def age_in_years(age: Column | str, unit: Column | str) -> Column:
    """Onset age in whole years.

    The unit code scales the value; an unknown or missing unit means years.
    The 0..120 range is tested on the fractional value, then it is truncated.
    """
    a = _c(age).cast("string").try_cast("double")
    u = _c(unit).cast("string")
    years = None
    for code, (op, factor) in AGE_UNIT_TO_YEARS.items():
        val = a * F.lit(factor) if op == "mul" else a / F.lit(factor)
        years = F.when(u == code, val) if years is None else years.when(u == code, val)
    years = years.otherwise(a)
    return F.when(
        (years >= MIN_AGE_YEARS) & (years <= MAX_AGE_YEARS), years.cast("int")
    ).otherwise(F.lit(None).cast("int"))


def parse_yyyymmdd(x: Column | str) -> Column:
    """`yyyyMMdd` text -> date; unparsable -> null."""
    return F.try_to_date(_c(x), "yyyyMMdd")


def code_label(x: Column | str, labels: Mapping[str, str]) -> Column:
    """Lookup of a text code in a fixed code book; a miss is null."""
    kv = []
    for k, v in labels.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)[_c(x).cast("string")]


def relabel(x: Column | str, labels: Mapping[str, str]) -> Column:
    """Code-book lookup that passes unknown values through unchanged."""
    return F.coalesce(code_label(x, labels), _c(x).cast("string"))


def rate_pct(num: Column | str, den: Column | str) -> Column:
    """round(num / den * 100, 2); a zero denominator gives null."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den)) * F.lit(100.0), 2)


def drug_name(x: Column | str) -> Column:
    return F.upper(F.trim(_c(x)))


def reaction_name(x: Column | str) -> Column:
    return F.initcap(F.trim(_c(x)))


def not_blank(x: Column | str) -> Column:
    """True when the text is present and not only spaces (null -> false)."""
    return F.coalesce(F.trim(_c(x)) != F.lit(""), F.lit(False))


def raw_equals_flag(x: Column | str, value: str = "1") -> Column:
    """Raw equality as 0/1; null counts as 0."""
    return F.coalesce(_c(x) == F.lit(value), F.lit(False)).cast("int")


def period_label(year: Column | str, month: Column | str) -> Column:
    """`YYYY-MM`, month zero padded."""
    return F.format_string("%d-%02d", _c(year), _c(month))


def size_or_zero(x: Column | str) -> Column:
    """Array length; a missing array counts 0."""
    return F.when(_c(x).isNull(), F.lit(0)).otherwise(F.size(_c(x)))
