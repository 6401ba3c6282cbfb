"""Report sections: every section of a payload is one small DataFrame.

``LISTINGS``, ``CALENDAR`` and ``REVIEWS`` map section names to functions of the gold table, so a
caller runs only the sections it shows; ``build`` makes all of one report.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.features import interval_label
from lodgeframe.operators import aggregates as A
from lodgeframe.operators import distributions as D
from lodgeframe.operators.lookups import event_windows
from lodgeframe.operators.quantiles import exact_quantiles, group_mode, quantile_row
from lodgeframe.operators.windows import centred_means

WEEKDAYS = range(7)


def _rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.bround(F.col(c), d) for c, d in digits.items()})


# Digits of the bin edges shown on the listings report.
EDGE_DIGITS = {"price_hist": 1, "price_log_hist": 2, "geo_trend": 1}


def build(sections: Mapping[str, Callable[[DataFrame], DataFrame]], df: DataFrame) -> dict[str, DataFrame]:
    """All sections as shown, bin edges rounded; the sections themselves keep exact edges."""
    out = {name: section(df) for name, section in sections.items()}
    for name, digits in EDGE_DIGITS.items():
        if name in out:
            out[name] = _rounded(out[name], {"left": digits, "right": digits})
    return out


def payload(sections: Mapping[str, DataFrame]) -> DataFrame:
    """One JSON text per section, rows in the section's order.

    Sections are aggregates: at most a row per day, bin, category or listed rank.
    """
    parts = []
    for name, df in sections.items():
        placed = df.select(
            F.struct(F.monotonically_increasing_id().alias("at"), F.struct("*").alias("row")).alias("r")
        )
        placed = placed.agg(F.array_sort(F.collect_list("r")).alias("rows"))
        content = F.to_json(F.transform("rows", lambda r: r["row"]))
        parts.append(placed.select(F.lit(name).alias("section"), content.alias("content")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def flag_split(df: DataFrame, column: str, yes: str, no: str) -> DataFrame:
    """Rows with and without a flag, labelled."""
    hits = F.coalesce(F.sum(F.col(column).cast("int")), F.lit(0))
    cells = F.array(
        F.struct(F.lit(yes).alias("label"), hits.alias("n")),
        F.struct(F.lit(no).alias("label"), (F.count(F.lit(1)) - hits).alias("n")),
    )
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


def price_stats(df: DataFrame) -> DataFrame:
    table = exact_quantiles(df, "price", {"median": 0.5}, extras={"mean": F.avg("price")})
    return _rounded(table, {"mean": 2, "median": 2})


def long_stay_share(df: DataFrame) -> DataFrame:
    share = F.avg(F.col("long_stay").cast("double")) * 100
    return df.agg(F.bround(share, 2).alias("long_stay_pct"))


def areas(df: DataFrame, top: int = 15) -> DataFrame:
    table = exact_quantiles(df, "price", {"median_price": 0.5}, ["neighbourhood_cleansed"])
    return table.orderBy(F.col("median_price").desc_nulls_last(), "neighbourhood_cleansed").limit(top)


# Fixed values in the sections: bin counts, clip, list lengths and digits of the reports.
CORRELATED = ("price", "dist_center_km", "num_amenities", "trust_score")

LISTINGS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "meta": size,
    "price_hist": lambda df: D.histogram(df, "price", 40, clip_upper=500),
    "price_log_hist": lambda df: D.histogram(df, "price_log", 30),
    "price_stats": price_stats,
    "host_near": lambda df: flag_split(df, "host_near", "Local", "Remote/Other"),
    "center": lambda df: flag_split(df, "neighbourhood_center", "Center", "Periphery"),
    "location": lambda df: A.value_counts(df, "host_location_cat"),
    "long_stay": long_stay_share,
    "geo_trend": lambda df: D.cut_equal_median(df, "dist_center_km", "price", 10),
    "areas": areas,
    "room_type": lambda df: A.value_counts(df, "room_type"),
    "host_segment": lambda df: A.value_counts(df, "host_segment", share=True),
    "nulls": lambda df: A.null_profile(df, top=15),
    "corr": lambda df: A.corr_matrix(df, CORRELATED, 3),
}


def daily_rate(df: DataFrame) -> DataFrame:
    """One row per day; nothing larger than this is windowed."""
    return A.rate_by(df.where("date is not null"), ["date"], F.col("booked"), "value")


def period(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
    )


def calendar_kpis(df: DataFrame) -> DataFrame:
    booked, weekend = F.col("booked").cast("double"), F.col("day_of_week") >= 5
    shares = df.agg(
        F.bround(F.avg(booked), 4).alias("occ_mean"),
        F.bround(F.avg(F.when(weekend, booked)), 4).alias("occ_weekend"),
        F.bround(F.avg(F.when(~weekend, booked)), 4).alias("occ_weekday"),
    )
    peak = A.peak_key(daily_rate(df), "date", "value").select(
        F.struct(F.col("date").alias("peak_date"), F.bround("value", 4).alias("peak_value"))
    ).scalar()
    return shares.withColumns({n: peak[n] for n in ("peak_date", "peak_value")})


def daily(df: DataFrame) -> DataFrame:
    table = centred_means(daily_rate(df), "date", "value", {"ma7": 7, "ma30": 30})
    return _rounded(table, {"value": 4, "ma7": 4, "ma30": 4}).orderBy("date")


def events(df: DataFrame) -> DataFrame:
    """Event windows of the year most rows fall in."""
    return event_windows(group_mode(df.select(F.year("date").alias("year")), "year", out="year"))


def weekly(df: DataFrame) -> DataFrame:
    table = A.mean_ci(df.where("day_of_week is not null"), "day_of_week", F.col("booked"))
    return _rounded(table, {"mean": 4, "sem": 4, "ci95": 4}).orderBy("day_of_week")


def heatmap(df: DataFrame) -> DataFrame:
    table = A.pivot_mean(
        df.where("month is not null"), "month", "day_of_week", WEEKDAYS, F.col("booked")
    )
    return table.select(
        "month", *[F.bround(f"`{d}`", 4).alias(f"d{d}") for d in WEEKDAYS]
    ).orderBy("month")


def event_stats(df: DataFrame) -> DataFrame:
    means = {
        "occupancy": F.col("booked"),
        "min_nights": F.col("minimum_nights"),
        "max_nights": F.col("maximum_nights"),
    }
    table = A.event_stats(
        df.where("event is not null"), "event", means, F.col("booked"), "occupancy"
    )
    return _rounded(table, {"occupancy": 4, "min_nights": 2, "max_nights": 2})


CALENDAR: dict[str, Callable[[DataFrame], DataFrame]] = {
    "meta": period,
    "kpis": calendar_kpis,
    "daily": daily,
    "events": events,
    "weekly": weekly,
    "heatmap": heatmap,
    "event_stats": event_stats,
}


def reviews_meta(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_distinct("reviewer_id").alias("unique_users"),
        F.count_distinct("listing_id").alias("unique_listings"),
        F.bround(F.avg("comments_len"), 2).alias("avg_len"),
    )


def length_hist(df: DataFrame) -> DataFrame:
    """Comment lengths in ten bins from 0 to the whole part of the 95th percentile."""
    longest = quantile_row(df, "comments_len", {"p95": 0.95})["p95"].cast("int")
    left, right = (F.col(c).cast("int") for c in ("left", "right"))
    table = D.histogram(df, "comments_len", 10, lo=0.0, hi=longest)
    return table.select("bin", interval_label(left, right).alias("label"), "n")


REVIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "meta": reviews_meta,
    "yearly": lambda df: A.counts_by_year(df.where("date is not null"), "date"),
    "reviewers": lambda df: A.value_counts(df, "reviewer_id", top=10),
    "length_hist": length_hist,
    "words": lambda df: A.word_freq(df, "comments", top=20),
}
