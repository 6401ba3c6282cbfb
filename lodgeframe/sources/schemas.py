"""Raw schemas of the scraped tables (everything textual stays text until the plans type it)."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in fields.items()])


def _texts(names: str) -> dict[str, str]:
    return {name: "string" for name in names.split()}


def _numbers(names: str, kind: str) -> dict[str, str]:
    return {name: kind for name in names.split()}


# Column names of the published source tables.
LISTINGS = _schema(
    id="bigint",
    scrape_id="bigint",
    host_id="bigint",
    **_texts(
        "listing_url last_scraped source name description neighborhood_overview picture_url "
        "host_url host_name host_since host_location host_about host_response_time "
        "host_response_rate host_acceptance_rate host_is_superhost host_thumbnail_url "
        "host_picture_url host_neighbourhood host_verifications host_has_profile_pic "
        "host_identity_verified neighbourhood neighbourhood_cleansed "
        "neighbourhood_group_cleansed property_type room_type bathrooms_text amenities price "
        "calendar_updated has_availability calendar_last_scraped first_review last_review "
        "license instant_bookable"
    ),
    **_numbers("latitude longitude bathrooms bedrooms beds", "double"),
    **_numbers(
        "host_listings_count host_total_listings_count accommodates minimum_nights "
        "maximum_nights minimum_minimum_nights maximum_minimum_nights minimum_maximum_nights "
        "maximum_maximum_nights availability_30 availability_60 availability_90 "
        "availability_365 availability_eoy number_of_reviews number_of_reviews_ltm "
        "number_of_reviews_l30d number_of_reviews_ly calculated_host_listings_count "
        "calculated_host_listings_count_entire_homes "
        "calculated_host_listings_count_private_rooms "
        "calculated_host_listings_count_shared_rooms",
        "int",
    ),
    **_numbers(
        "minimum_nights_avg_ntm maximum_nights_avg_ntm estimated_occupancy_l365d "
        "estimated_revenue_l365d review_scores_rating review_scores_accuracy "
        "review_scores_cleanliness review_scores_checkin review_scores_communication "
        "review_scores_location review_scores_value reviews_per_month",
        "double",
    ),
)

CALENDAR = _schema(
    listing_id="bigint",
    date="string",
    available="string",
    price="string",
    adjusted_price="string",
    minimum_nights="int",
    maximum_nights="int",
)

REVIEWS = _schema(
    listing_id="bigint",
    id="bigint",
    date="string",
    reviewer_id="bigint",
    reviewer_name="string",
    comments="string",
)

NEIGHBOURHOODS = _schema(neighbourhood_group="string", neighbourhood="string")
