"""Calendar: one row per listing and day, with date features and the booked flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.clean import map_bool, parse_date
from lodgeframe.functions.dates import EventNames, event_label, is_weekend, weekday
from lodgeframe.operators.quality import Rule
from lodgeframe.operators.tables import drop_columns, on_columns

# Bounds of the calendar rules.
LAST_DATE = "2027-12-31"


def clean(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(on_columns, ["available"], map_bool)
        .withColumn("date", parse_date(F.col("date").cast("string")))
        .transform(drop_columns, ["price", "adjusted_price"])
    )


def enrich(df: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    date = F.col("date")
    return df.withColumns(
        {
            "day_of_week": weekday(date),
            "is_weekend": is_weekend(date),
            "month": F.month(date),
            "event": event_label(date, names),
            "booked": ~F.col("available"),
        }
    )


def gold(raw: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """Raw rows to gold rows; no shuffle."""
    return raw.transform(clean).transform(enrich, names)


def rules() -> list[Rule]:
    return [
        Rule("category", "Invalid format in available column", "available", [True, False]),
        Rule("range", "Date out of logical range or null", "date", (None, LAST_DATE)),
        Rule("not_null", "Date is null", "date"),
    ]
