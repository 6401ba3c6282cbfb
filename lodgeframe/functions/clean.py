"""Cleaning of single values: text to number, flag or date, bounds, fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks stripped from money and rate text.
CURRENCY_MARKS = r"[$,%€]"

# Java's double parser also takes suffixes such as "1d"; only plain numbers count as numbers here.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_true(condition: Column) -> Column:
    """The condition with null read as false."""
    return F.coalesce(condition, F.lit(False))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = c.cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def clean_currency(c: Column, strict: bool = False) -> Column:
    """Money or percent text to double. ``strict`` fails on junk instead of giving null."""
    bare = F.regexp_replace(c.cast("string"), CURRENCY_MARKS, "")
    return bare.cast("double") if strict else to_number(bare)


def in_range_or_null(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """The value where it lies in [lo, hi], else null."""
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (c >= F.lit(lo))
    if hi is not None:
        inside = inside & (c <= F.lit(hi))
    return F.when(inside, c)


def clean_rate(c: Column) -> Column:
    """Percent text to a number in [0, 100]; junk and outliers become null."""
    return in_range_or_null(clean_currency(c), 0.0, 100.0)


def to_numeric_range(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    return in_range_or_null(to_number(c), lo, hi)


def map_bool(c: Column) -> Column:
    """'t'/'f', true/false and 1/0 to boolean; everything else is null."""
    text = c.cast("string")
    return F.when(text.isin("t", "true", "1", "1.0"), True).when(
        text.isin("f", "false", "0", "0.0"), False
    )


def bool_eq(c: Column, truth: str = "t") -> Column:
    """Equality as a flag; null counts as false."""
    return c.eqNullSafe(F.lit(truth))


def map_lookup(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Small literal lookup; unlisted values give ``default`` (null unless given)."""
    chain = None
    for key, value in mapping.items():
        chain = (F if chain is None else chain).when(c == F.lit(key), F.lit(value))
    if chain is None:
        raise ValueError("mapping is empty")
    return chain if default is None else chain.otherwise(default)


def parse_numeric(c: Column) -> Column:
    """First number in the text; 'half' and 'medio' mean 0.5; no number gives null."""
    text = F.lower(c.cast("string"))
    return F.when(text.rlike("half|medio"), F.lit(0.5)).otherwise(
        to_number(F.regexp_extract(text, r"[0-9.]+", 0))
    )


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """Text to date, junk to null."""
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def not_after(c: Column, limit: Column) -> Column:
    """Dates past the limit become null."""
    return F.when(c <= limit, c)


def ordered_pair(first: Column, last: Column) -> tuple[Column, Column]:
    """Both null where first lies after last."""
    wrong = is_true(first > last)
    return F.when(~wrong, first), F.when(~wrong, last)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound the value; null stays null (greatest/least would turn it into the bound)."""
    out = None
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo))
    if hi is not None:
        out = (F if out is None else out).when(c > F.lit(hi), F.lit(hi))
    return c if out is None else out.otherwise(c)


def cond_assign(c: Column, condition: Column, value: Column) -> Column:
    """``value`` where the condition holds; unknown conditions keep the old value."""
    return F.when(is_true(condition), value).otherwise(c)


def fill(c: Column, value) -> Column:
    return F.coalesce(c, value if isinstance(value, Column) else F.lit(value))


def tri_state(known: Column, yes: Column, no: Column, undecided: Column) -> Column:
    """Fill an unknown status: yes-rule first, then no-rule, else the undecided value."""
    return (
        F.when(known.isNotNull(), known)
        .when(is_true(yes), F.lit(True))
        .when(is_true(no), F.lit(False))
        .otherwise(undecided)
    )


def every_of(conditions: Sequence[Column]) -> Column:
    """Conjunction of masks, each with null read as false."""
    out = F.lit(True)
    for condition in conditions:
        out = out & is_true(condition)
    return out


def round_half_even(c: Column, digits: int = 0) -> Column:
    """Round like NumPy and Python do: ties go to the even digit."""
    return F.bround(c, digits)
