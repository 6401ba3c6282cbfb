"""Reviews: comments with their length, a normalised copy, and date parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.clean import parse_date
from lodgeframe.functions.text import clean_text, text_length
from lodgeframe.operators.quality import Rule
from lodgeframe.operators.tables import drop_columns, drop_null_rows

# The extraction date of the source.
EXTRACTED = "2025-09-30"


def clean(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(drop_null_rows, ["id", "reviewer_id", "comments"])
        .withColumn("date", parse_date(F.col("date").cast("string")))
        .transform(drop_columns, ["reviewer_name"])
    )


def enrich(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "comments_len": text_length(F.col("comments")),
            "comments_clean": clean_text(F.col("comments")),
            "review_year": F.year("date"),
            "review_month": F.month("date"),
        }
    )


def gold(raw: DataFrame) -> DataFrame:
    """Raw rows to gold rows; no shuffle."""
    return raw.transform(clean).transform(enrich)


def rules(extracted: str = EXTRACTED) -> list[Rule]:
    return [
        Rule("date_limit", "Review date is in the future relative to extraction", "date", extracted),
        Rule("range", "Review comment is empty after cleaning", "comments_len", (1, None)),
    ]
