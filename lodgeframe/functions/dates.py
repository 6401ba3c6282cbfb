"""Date parts, elapsed days, movable feasts and event labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventNames:
    """Labels of the event calendar."""

    # Labels of the gold calendar table.
    easter: str = "Semana Santa"
    fair: str = "Feria de Málaga"
    midsummer: str = "Noche de San Juan"
    summer: str = "Verano"
    christmas: str = "Navidad/Reyes"
    normal: str = "Temporada normal"


def weekday(d: Column) -> Column:
    """Monday is 0."""
    return F.weekday(d)


def is_weekend(d: Column) -> Column:
    return F.coalesce(F.weekday(d).isin(5, 6), F.lit(False))


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def days_since(d: Column, reference: Column) -> Column:
    """Whole days from the date to the reference; a missing date gives 0."""
    return F.coalesce(F.datediff(reference, d), F.lit(0))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Oudin's rule, in whole-number columns.

    ``full`` is the age of the paschal moon, ``late`` its two calendar exceptions, and the
    Sunday after it is counted from March 28.
    """

    def div(a: Column, b: int | Column) -> Column:
        return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)

    y = year.cast("bigint")
    century = div(y, 100)
    golden = y % 19
    moon = (century - div(century, 4) - div(century * 8 + 13, 25) + golden * 19 + 15) % 30
    late = (moon == 29) | ((moon == 28) & (golden > 10))
    full = moon - F.when(late, 1).otherwise(0)
    weekday_of_moon = (y + div(y, 4) + full + 2 - century + div(century, 4)) % 7
    march_28 = F.make_date(y.cast("int"), F.lit(3), F.lit(28))
    return F.date_add(march_28, (full - weekday_of_moon).cast("int"))


def good_friday(year: Column) -> Column:
    return F.date_sub(easter_sunday(year), 2)


def event_label(d: Column, names: EventNames = EventNames()) -> Column:
    """Season or holiday of a date; the first matching label wins."""
    month, day = F.month(d), F.dayofmonth(d)
    # From a week before Good Friday to the day after it: 9 to 1 days before Easter, which lies
    # between March 22 and April 25. Other months never reach the Easter rule.
    days_to_easter = F.datediff(easter_sunday(F.year(d)), d)
    return (
        F.when(d.isNull(), F.lit(None).cast("string"))
        .when(month.isin(3, 4) & days_to_easter.isin(*range(1, 10)), names.easter)
        .when((month == 8) & day.between(15, 22), names.fair)
        .when((month == 6) & (day == 23), names.midsummer)
        .when(month.between(6, 8), names.summer)
        .when(((month == 12) & (day >= 20)) | ((month == 1) & (day <= 6)), names.christmas)
        .otherwise(names.normal)
    )
