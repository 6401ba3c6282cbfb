"""Listings: cleaning, imputation and features of one row per listing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import features as X
from lodgeframe.functions.clean import clean_currency, clip, cond_assign, map_bool, parse_date, parse_numeric
from lodgeframe.functions.dates import days_since
from lodgeframe.functions.text import categorize_text, clean_text, keyword_flag, list_size, parse_list, printed_list
from lodgeframe.operators.encode import categories, one_hot_list
from lodgeframe.operators.impute import Noise, impute_counted
from lodgeframe.operators.quality import Rule, ranges
from lodgeframe.operators.quantiles import count_values, counted_statistics
from lodgeframe.operators.sizing import attach_by_key
from lodgeframe.operators.tables import (
    drop_columns,
    log1p_columns,
    override_by_id,
    present,
    rename_columns,
    translate_values,
)
from lodgeframe.session import checkpointed

# Source columns holding 't'/'f'.
FLAG_COLUMNS = (
    "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "has_availability",
    "instant_bookable",
)

# Columns the gold table leaves out.
DROPPED_COLUMNS = (
    "scrape_id", "host_thumbnail_url", "host_picture_url", "minimum_minimum_nights",
    "maximum_minimum_nights", "minimum_maximum_nights", "maximum_maximum_nights",
    "minimum_nights_avg_ntm", "maximum_nights_avg_ntm", "host_about", "host_url",
    "host_neighbourhood", "neighborhood_overview", "neighbourhood",
    "neighbourhood_group_cleansed", "calendar_updated", "bathrooms_text", "source",
    "picture_url", "license", "last_scraped", "calendar_last_scraped", "property_type", "name",
    "listing_url", "host_location", "host_verifications", "amenities",
)

# Columns that get a log1p copy.
LOG_COLUMNS = (
    "price", "estimated_revenue_l365d", "estimated_revenue_n365d", "minimum_nights",
    "number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d",
    "number_of_reviews_ly", "host_listings_count", "host_listings_count_eh",
    "host_listings_count_sr", "host_listings_count_pr",
)

# Gold names of source columns.
GOLD_NAMES = {
    "host_response_time": "host_response_hour",
    "calculated_host_listings_count": "host_listings_count",
    "calculated_host_listings_count_entire_homes": "host_listings_count_eh",
    "calculated_host_listings_count_private_rooms": "host_listings_count_pr",
    "calculated_host_listings_count_shared_rooms": "host_listings_count_sr",
}

# Score columns, all rated 0 to 5.
SCORE_COLUMNS = (
    "review_scores_rating", "review_scores_location", "review_scores_value",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication",
)

LISTINGS_TOTAL = "calculated_host_listings_count"
LISTINGS_PARTS = tuple(f"{LISTINGS_TOTAL}_{kind}" for kind in ("entire_homes", "private_rooms", "shared_rooms"))


@dataclass(frozen=True)
class City:
    """What is specific to one city and one scrape."""

    # Corrections, centre, dates and word patterns of the published source.
    type_names: Mapping[str, str] = field(
        default_factory=lambda: {"Casa Particular": "Private House"}
    )
    bathrooms_by_id: Mapping[float, Sequence[int]] = field(
        default_factory=lambda: {
            1.0: (907846578011191658,),
            0.0: (
                1071778548709501720, 1149444780882723841, 1199390966969605315,
                1209436626693592917,
            ),
        }
    )
    price_by_id: Mapping[str, Sequence[int]] = field(
        default_factory=lambda: {"182.0": (47444051,)}
    )
    centre: tuple[float, float] = (36.7213, -4.4214)
    latitude: tuple[float, float] = (36.3, 37.3)
    longitude: tuple[float, float] = (-5.5, -3.8)
    scraped: str = "2025-09-30"
    review_year: int = 2025
    shared_words: str = "shared|compartido"
    company_words: str = "sl|sa|company|management|rentals|apartments"
    company_whole_words: bool = True
    centre_words: str = "centro|histórico|soho"
    fast_reply_words: str = "within an hour"
    places: Sequence[tuple[Sequence[str], str]] = (
        (("malaga", "málaga"), "Malaga"),
        (("spain", "españa"), "Spain"),
        (("unknown",), "Unknown"),
    )
    home: str = "Malaga"
    verifications: Sequence[str] | None = None
    status_rate: float = 0.9
    noise_seed: int = 42


def typed(raw: DataFrame, city: City = City()) -> DataFrame:
    """Texts to numbers and dates, with the known corrections; no shuffle."""
    df = translate_values(raw, "property_type", city.type_names)
    df = df.withColumn("bathrooms", parse_numeric(F.col("bathrooms_text")))
    for value, ids in city.bathrooms_by_id.items():
        df = override_by_id(df, "id", ids, "bathrooms", value)
    for value, ids in city.price_by_id.items():
        df = override_by_id(df, "id", ids, "price", value)
    money = ["price", "host_response_rate", "host_acceptance_rate"]
    dates = ["host_since", "last_review", "first_review"]
    one_room = F.col("room_type").isin("Shared room", "Private room") & F.col("bedrooms").isNull()
    return df.withColumns(
        {
            "bedrooms": cond_assign(F.col("bedrooms"), one_room, F.lit(1.0)),
            **{c: clean_currency(F.col(c)) for c in money},
            **{c: parse_date(F.col(c).cast("string")) for c in dates},
        }
    )


def clean(raw: DataFrame, city: City = City()) -> DataFrame:
    """Types and imputations.

    All statistics come from one count of values over one scan of the typed columns; what is written of it is a row
    a group, so whatever follows reads a small table instead of repeating the count.
    """
    base = typed(raw, city)
    size, status, reply = "accommodates", "host_is_superhost", "host_response_time"
    acceptance, response = "host_acceptance_rate", "host_response_rate"
    noise = Noise("id", seed=city.noise_seed)
    cells = count_values(base, {"bedrooms": [size], "beds": [size], acceptance: [status], response: [status, reply]})
    times = cells.where((F.col("_column") == response) & F.col(reply).isNotNull()).groupBy(status, reply).agg(F.sum("_m").alias("_m"))
    modes = times.groupBy(status).agg(F.min_by(reply, F.struct(-F.col("_m"), F.col(reply))).alias("_mode"))
    # the response rate is grouped by filled reply times; they are filled on the counts
    late = F.when(F.col("_column") == response, F.coalesce(reply, "_mode")).otherwise(F.col(reply))
    timed = attach_by_key(cells, modes, [status]).withColumn(reply, late).drop("_mode")
    recounted = timed.groupBy("_column", size, status, reply, "_v").agg(F.sum("_m").alias("_m"))
    named = counted_statistics(recounted)
    every = named.unionByName(
        modes.where(F.col(status).isNotNull()).select(F.lit("mode").alias("_column"), status, F.col("_mode").alias(reply)), True
    )
    known = checkpointed(every)
    df = impute_counted(base, ["bedrooms", "beds"], size, known)
    df = impute_counted(df, acceptance, status, known, noise)
    filling = known.where("_column = 'mode'").select(status, F.col(reply).alias("_mode"))
    df = attach_by_key(df, filling, [status]).withColumn(reply, F.coalesce(reply, "_mode")).drop("_mode")
    df = impute_counted(df, response, [status, reply], known, noise)
    rates = {c: clip(F.col(c), 0.0, 100.0) / F.lit(100.0) for c in (response, acceptance)}
    return df.withColumns({**rates, **{c: map_bool(F.col(c)) for c in present(df, FLAG_COLUMNS)}})


def verifications(df: DataFrame) -> list[str]:
    """The kinds of host verification in the data."""
    return categories(df.select(printed_list(F.col("host_verifications")).alias("v")), "v")


def enrich(df: DataFrame, city: City = City()) -> DataFrame:
    """Features, renames and the final column set; no shuffle."""
    c = F.col
    known = verifications(df) if city.verifications is None else city.verifications
    df = df.withColumns(
        {
            "bathroom_shared": keyword_flag(c("bathrooms_text"), city.shared_words),
            "host_is_superhost": X.status_rule(
                c("host_is_superhost"), c("number_of_reviews"), c("host_response_rate"),
                c("host_acceptance_rate"), c("review_scores_rating"), city.status_rate,
            ),
            "amenities_list": parse_list(c("amenities")),
            "host_listings_count_hr": X.residual_count(
                c(LISTINGS_TOTAL), [c(p) for p in LISTINGS_PARTS if p in df.columns]
            ),
            "company": X.company_flag(
                c("host_name"), c("host_total_listings_count"), city.company_words,
                whole_word=city.company_whole_words,
            ),
            "host_location_cat": categorize_text(
                c("host_location"), city.places, "International", "Unknown"
            ),
            "neighbourhood_center": keyword_flag(c("neighbourhood_cleansed"), city.centre_words),
            "description": clean_text(c("description")),
            "has_availability": F.coalesce(
                c("has_availability"), F.coalesce(c("availability_365") > 0, F.lit(False))
            ),
            "estimated_revenue_l365d": X.revenue(c("price"), c("estimated_occupancy_l365d")),
            "estimated_revenue_n365d": X.revenue(c("price"), F.lit(365) - c("availability_365")),
            "has_review": X.has_review(c("number_of_reviews")),
            "has_review_ly": X.reviewed_in(c("last_review"), city.review_year),
            "reviews_per_month": F.coalesce(c("reviews_per_month"), F.lit(0.0)),
            "days_since_last_review": days_since(c("last_review"), F.lit(city.scraped).cast("date")),
            "dist_center_km": X.haversine_km(
                c("latitude"), c("longitude"), *[F.lit(x) for x in city.centre]
            ),
            "trust_score": X.trust_score(c("review_scores_rating"), c("number_of_reviews")),
            "ratio_beds_accommodates": X.safe_ratio(c("beds"), c("accommodates")),
            "host_segment": X.segment_count(c(LISTINGS_TOTAL)),
            "long_stay": X.long_stay(c("maximum_nights")),
            "maximum_nights": clip(c("maximum_nights"), hi=365),
            "_verified": printed_list(c("host_verifications")),
        }
    )
    df = df.withColumns(
        {
            "num_amenities": list_size(c("amenities_list")),
            "host_near": c("host_location_cat") == city.home,
            "bathroom_shared": c("bathroom_shared") == 1,
            "company": c("company") == 1,
        }
    )
    df = one_hot_list(df, "_verified", "host_verif", known).drop("_verified")
    df = rename_columns(df, GOLD_NAMES)
    df = df.withColumn(
        "host_response_hour", keyword_flag(c("host_response_hour"), city.fast_reply_words) == 1
    )
    return df.transform(log1p_columns, LOG_COLUMNS).transform(drop_columns, DROPPED_COLUMNS)


def gold(raw: DataFrame, city: City = City()) -> DataFrame:
    """Raw rows to gold rows."""
    if city.verifications is None:
        # Read off the raw table, where it takes a scan and no join.
        city = replace(city, verifications=verifications(raw))
    return raw.transform(clean, city).transform(enrich, city)


def rules(city: City = City(), inclusive: bool = False) -> list[Rule]:
    """The rule set of the gold table; ranges are open unless ``inclusive``."""
    c = F.col

    def span(column: str, lo: float | None, hi: float | None, message: str) -> Rule:
        return Rule("range", message, column, (lo, hi), inclusive)

    shared = c("room_type").isin("Private room", "Shared room")
    # Bounds and messages of the rules.
    return [
        Rule("unique", "Duplicate Listing IDs found", "id"),
        span("accommodates", 1, None, "Accommodates must be >= 1"),
        span("bathrooms", 0, None, "Bathrooms must be >= 0"),
        span("bedrooms", 0, None, "Bedrooms must be >= 0"),
        span("price", 1, 100000, "Price anomaly detected"),
        span("latitude", *city.latitude, "Latitude outside Malaga province"),
        span("longitude", *city.longitude, "Longitude outside Malaga province"),
        Rule("date_limit", "Future review date detected", "last_review", city.scraped),
        *[
            span(f"availability_{name}", 0, days, f"Availability_{name} out of range")
            for name, days in (("30", 30), ("60", 60), ("90", 90), ("365", 365), ("eoy", 62))
        ],
        *ranges(SCORE_COLUMNS, 0, 5, "{} out of range (0-5)"),
        Rule("logic", "Maximum nights logic failure", None, c("maximum_nights") >= c("minimum_nights")),
        Rule(
            "logic",
            "Room type bedroom consistency error",
            None,
            ~F.coalesce(shared, F.lit(False)) | c("bedrooms").isin(0, 1),
        ),
        Rule(
            "logic",
            "Availability mismatch when has_availability is False",
            None,
            ~c("has_availability").eqNullSafe(F.lit(False)) | (c("availability_365") == 0),
        ),
    ]
