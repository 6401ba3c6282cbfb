"""Derived features of a listing, all as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.functions.clean import clip, is_true
from lodgeframe.functions.text import keyword_flag

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    dlat = F.radians(lat2) - F.radians(lat1)
    dlon = F.radians(lon2) - F.radians(lon1)
    chord = (
        F.pow(F.sin(dlat / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def trust_score(rating: Column, reviews: Column, missing_as_zero: bool = True) -> Column:
    """Rating damped by the number of reviews."""
    score = F.coalesce(rating, F.lit(0.0)) if missing_as_zero else rating
    return score * F.log1p(reviews)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio, 0 where the denominator is not positive."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).otherwise(F.lit(0.0))


def revenue(price: Column, nights: Column) -> Column:
    """Price times nights, never negative."""
    return clip(price * nights, lo=0.0)


def residual_count(total: Column, parts: Sequence[Column]) -> Column:
    """What the parts leave of the total, never negative."""
    rest = total
    for part in parts:
        rest = rest - part
    return clip(rest, lo=0)


def segment_count(count: Column, small_below: int = 5) -> Column:
    """Host size class; a missing count falls in the last class."""
    # The three class names.
    return (
        F.when(count == 1, "Individual")
        .when(count < small_below, "Small_Investor")
        .otherwise("Agency")
    )


def company_flag(
    name: Column, total: Column, keywords: str, from_total: int = 5, whole_word: bool = True
) -> Column:
    """1 for a company-like name or at least ``from_total`` listings."""
    named = keyword_flag(name, keywords, whole_word) == 1
    return (named | is_true(total >= from_total)).cast("int")


def status_rule(
    known: Column,
    reviews: Column,
    response_rate: Column,
    acceptance_rate: Column,
    rating: Column,
    rate_threshold: float = 0.9,
    min_reviews: int = 10,
    min_rating: float = 4.8,
) -> Column:
    """Fill an unknown host status by the quality rule; missing inputs fail the rule."""
    rule = (
        (reviews >= min_reviews)
        & (response_rate >= rate_threshold)
        & (acceptance_rate >= rate_threshold)
        & (rating >= min_rating)
    )
    return F.coalesce(known, is_true(rule))


def has_review(reviews: Column) -> Column:
    return is_true(reviews > 0).cast("int")


def reviewed_in(last_review: Column, year: int, count_last_year: Column | None = None) -> Column:
    """1 if the last review fell in ``year`` (or, if given, a last-year count is positive)."""
    hit = is_true(F.year(last_review) == year)
    if count_last_year is not None:
        hit = hit | is_true(count_last_year > 0)
    return hit.cast("int")


def long_stay(maximum_nights: Column, over: int = 365) -> Column:
    return is_true(maximum_nights > over)


def interval_label(left: Column, right: Column, suffix: str = "") -> Column:
    return F.concat(left.cast("string"), F.lit("-"), right.cast("string"), F.lit(suffix))
