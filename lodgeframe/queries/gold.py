"""The gold tables and report sections, on views shaped like the scraped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.quality import evaluate
from lodgeframe.operators.sizing import spread_rows
from lodgeframe.plans import calendar, listings, reports, reviews
from lodgeframe.queries.daily import EASTER, LABEL
from lodgeframe.queries.distributions import edges_sql
from lodgeframe.queries.groups import draw_sql
from lodgeframe.queries.registry import Tables, query, r6, text
from lodgeframe.queries.texts import CLEAN_SQL, words_sql

# ---- calendar ---------------------------------------------------------------------------------

CALENDAR_RAW = [
    "o_custkey AS listing_id",
    "CASE WHEN o_orderkey % 501 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date",
    "CASE WHEN o_orderkey % 301 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'f' ELSE 't' END AS available",
    "CAST(NULL AS STRING) AS price",
    "CAST(NULL AS STRING) AS adjusted_price",
    "CAST(o_orderkey % 7 + 1 AS INT) AS minimum_nights",
    "CAST(o_orderkey % 900 + 1 AS INT) AS maximum_nights",
]
CALENDAR_GOLD = f"""WITH raw AS (SELECT {', '.join(CALENDAR_RAW)} FROM orders), {EASTER},
  typed AS (SELECT listing_id, try_cast(date AS DATE) AS date, CASE available WHEN 't' THEN true WHEN 'f' THEN false END AS available,
    minimum_nights, maximum_nights FROM raw),
  gold AS (SELECT listing_id, date, available, minimum_nights, maximum_nights, isodow(date) - 1 AS day_of_week,
    coalesce(isodow(date) IN (6, 7), false) AS is_weekend, month(date) AS month,
    CASE WHEN date IS NOT NULL THEN {LABEL.format(d='date')} END AS event, NOT available AS booked,
    CASE WHEN available THEN 0.0::DOUBLE WHEN NOT available THEN 1.0::DOUBLE END AS b
    FROM typed LEFT JOIN easter ON year(date) = y)"""


def calendar_gold(t: Tables) -> DataFrame:
    return calendar.gold(t.orders.selectExpr(*CALENDAR_RAW))


@query(
    "calendar_gold",
    CALENDAR_GOLD
    + """ SELECT listing_id, CAST(date AS VARCHAR) AS date, CAST(available AS VARCHAR) AS available, minimum_nights, maximum_nights,
      CAST(day_of_week AS DOUBLE) AS day_of_week, is_weekend, CAST(month AS DOUBLE) AS month, event, CAST(booked AS VARCHAR) AS booked FROM gold""",
)
def calendar_rows(t: Tables) -> DataFrame:
    df = calendar_gold(t)
    shown = {c: text(c) for c in ("date", "available", "booked")}
    return df.withColumns({**shown, **{c: F.col(c).cast("double") for c in ("day_of_week", "month")}})


@query(
    "calendar_rules",
    CALENDAR_GOLD
    + """ SELECT 'available' AS variable, 'category' AS check_kind, count(*) FILTER (available IS NULL) AS n_violations FROM gold
    UNION ALL SELECT 'date', 'range', count(*) FILTER (date >= DATE '2027-12-31') FROM gold
    UNION ALL SELECT 'date', 'not_null', count(*) FILTER (date IS NULL) FROM gold""",
)
def calendar_rules(t: Tables) -> DataFrame:
    return evaluate(calendar_gold(t), calendar.rules()).select("variable", "check_kind", "n_violations")


CALENDAR_SECTIONS = {
    "meta": """SELECT count(*) AS n_rows, CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max FROM gold""",
    "kpis": """SELECT round_even(avg(b), 4) AS occ_mean, round_even(avg(b) FILTER (day_of_week >= 5), 4) AS occ_weekend,
      round_even(avg(b) FILTER (day_of_week < 5), 4) AS occ_weekday,
      (SELECT CAST(date AS VARCHAR) FROM r ORDER BY v DESC, date LIMIT 1) AS peak_date,
      (SELECT round_even(max(v), 4) FROM r) AS peak_value FROM gold""",
    "daily": """SELECT CAST(date AS VARCHAR) AS date, round_even(v, 4) AS value,
      round_even(CASE WHEN count(v) OVER w7 = 7 THEN avg(v) OVER w7 END, 4) AS ma7,
      round_even(CASE WHEN count(v) OVER w30 = 30 THEN avg(v) OVER w30 END, 4) AS ma30 FROM r
      WINDOW w7 AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
             w30 AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""",
    "events": """SELECT label, CAST(a AS VARCHAR) AS "start", CAST(b AS VARCHAR) AS "end" FROM (
      SELECT year(date) AS y FROM gold WHERE date IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) JOIN easter USING (y),
      LATERAL (VALUES ('Feria de Málaga', make_date(y, 8, 15), make_date(y, 8, 22)), ('Puente de diciembre', make_date(y, 12, 6), make_date(y, 12, 8)),
       ('Zambombas flamencas', make_date(y, 12, 12), make_date(y, 12, 19)), ('Navidad', make_date(y, 12, 20), make_date(y + 1, 1, 6)),
       ('Noche de San Juan', make_date(y, 6, 23), make_date(y, 6, 23)), ('Semana Santa', sunday - 9, sunday - 1)) w(label, a, b)""",
    "weekly": """SELECT CAST(day_of_week AS INT) AS day_of_week, round_even(avg(b), 4) AS mean,
      round_even(stddev_samp(b) / sqrt(count(b)), 4) AS sem, round_even(1.96 * stddev_samp(b) / sqrt(count(b)), 4) AS ci95
      FROM gold WHERE date IS NOT NULL GROUP BY 1""",
    "heatmap": "SELECT CAST(month AS INT) AS month, "
    + ", ".join(f"round_even(avg(b) FILTER (day_of_week = {i}), 4) AS d{i}" for i in range(7))
    + " FROM gold WHERE date IS NOT NULL GROUP BY 1",
    "event_stats": """SELECT event, round_even(avg(b), 4) AS occupancy, round_even(avg(minimum_nights), 2) AS min_nights,
      round_even(avg(maximum_nights), 2) AS max_nights, count(b) AS n FROM gold WHERE event IS NOT NULL GROUP BY event""",
}
CALENDAR_DAILY = CALENDAR_GOLD + ", r AS (SELECT date, avg(b) AS v FROM gold WHERE date IS NOT NULL GROUP BY date) "

# ---- reviews ----------------------------------------------------------------------------------

REVIEWS_RAW = [
    "doc_id % 97 AS listing_id",
    "doc_id AS id",
    "CASE WHEN doc_id % 31 = 0 THEN 'soon' ELSE concat(CAST(2015 + doc_id % 11 AS STRING), '-', "
    "lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0')) END AS date",
    "CASE WHEN doc_id % 41 = 0 THEN NULL ELSE doc_id % 53 END AS reviewer_id",
    "source AS reviewer_name",
    "CASE WHEN doc_id % 43 = 0 THEN NULL ELSE text END AS comments",
]
REVIEWS_GOLD = f"""WITH raw AS (SELECT {', '.join(REVIEWS_RAW)} FROM documents),
  gold AS (SELECT listing_id, id, try_cast(date AS DATE) AS date, reviewer_id, comments, length(comments) AS comments_len,
    {CLEAN_SQL.format(c='comments')} AS comments_clean, year(try_cast(date AS DATE)) AS review_year, month(try_cast(date AS DATE)) AS review_month
    FROM raw WHERE id IS NOT NULL AND reviewer_id IS NOT NULL AND comments IS NOT NULL)"""


def reviews_gold(t: Tables) -> DataFrame:
    return reviews.gold(t.documents.selectExpr(*REVIEWS_RAW))


@query(
    "reviews_gold",
    REVIEWS_GOLD
    + """ SELECT listing_id, id, CAST(date AS VARCHAR) AS date, reviewer_id, comments, CAST(comments_len AS INT) AS comments_len, comments_clean,
      CAST(review_year AS DOUBLE) AS review_year, CAST(review_month AS DOUBLE) AS review_month FROM gold""",
)
def reviews_rows(t: Tables) -> DataFrame:
    shown = {c: F.col(c).cast("double") for c in ("review_year", "review_month")}
    return reviews_gold(t).withColumns({"date": text("date"), **shown})


@query(
    "reviews_rules",
    REVIEWS_GOLD
    + """ SELECT 'date' AS variable, 'date_limit' AS check_kind, count(*) FILTER (date > DATE '2025-09-30') AS n_violations FROM gold
    UNION ALL SELECT 'comments_len', 'range', count(*) FILTER (comments_len <= 1) FROM gold""",
)
def reviews_rules(t: Tables) -> DataFrame:
    return evaluate(reviews_gold(t), reviews.rules()).select("variable", "check_kind", "n_violations")


REVIEWS_SECTIONS = {
    "meta": """SELECT count(*) AS total_reviews, count(DISTINCT reviewer_id) AS unique_users, count(DISTINCT listing_id) AS unique_listings,
      round_even(avg(comments_len), 2) AS avg_len FROM gold""",
    "yearly": "SELECT CAST(review_year AS INT) AS year, count(*) AS n FROM gold WHERE date IS NOT NULL GROUP BY 1",
    "reviewers": "SELECT reviewer_id, count(*) AS n FROM gold GROUP BY 1 ORDER BY n DESC, reviewer_id LIMIT 10",
    "length_hist": "SELECT bin, concat(CAST(CAST(floor(\"left\") AS INT) AS VARCHAR), '-', CAST(CAST(floor(\"right\") AS INT) AS VARCHAR)) AS label, n FROM ("
    + edges_sql("WITH x AS (SELECT CAST(comments_len AS DOUBLE) AS v FROM gold)", 10, "0.0::DOUBLE", "CAST(floor(quantile_cont(v, 0.95)) AS DOUBLE)")
    + ")",
    "words": "WITH " + words_sql("gold", "comments", 20),
}

# ---- listings ---------------------------------------------------------------------------------


def _day(year: str, month: str, day: str) -> str:
    return (
        f"concat(CAST({year} AS STRING), '-', lpad(CAST({month} AS STRING), 2, '0'), '-', "
        f"lpad(CAST({day} AS STRING), 2, '0'))"
    )


K = "c_custkey"
Q = '"'
LISTINGS_RAW = [
    f"{K} + 1000000000000000000 AS id",
    f"{K} + 1 AS scrape_id",
    f"{K} % 97 AS host_id",
    "c_name AS name",
    "concat('<br/>Piso BONITO!! ', c_name, ' -- <b>', n_name, '</b> ñandú ½') AS description",
    f"CASE WHEN {K} % 10 = 0 THEN concat(c_name, ' Rentals SL') WHEN {K} % 10 = 1 THEN 'Rosalia' ELSE c_name END AS host_name",
    f"CASE {K} % 5 WHEN 0 THEN 'Málaga, Spain' WHEN 1 THEN 'Madrid, Spain' WHEN 2 THEN NULL WHEN 3 THEN 'Paris, France' ELSE 'Unknown' END AS host_location",
    _day(f"2010 + {K} % 15", f"1 + {K} % 12", "15") + " AS host_since",
    f"CASE WHEN {K} % 9 = 0 THEN NULL ELSE " + _day(f"2018 + {K} % 5", f"1 + {K} % 12", f"1 + {K} % 28") + " END AS first_review",
    f"CASE WHEN {K} % 9 = 0 THEN NULL WHEN {K} % 50 = 1 THEN '2025-13-01' ELSE "
    + _day(f"2023 + {K} % 3", f"1 + {K} % 12", f"1 + {K} % 28") + " END AS last_review",
    f"CASE {K} % 6 WHEN 0 THEN NULL WHEN 1 THEN 'within an hour' WHEN 2 THEN 'within an hour' WHEN 3 THEN 'within a few hours' "
    f"WHEN 4 THEN 'within a day' ELSE 'a few days or more' END AS host_response_time",
    f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE concat(CAST(60 + {K} % 41 AS STRING), '%') END AS host_response_rate",
    f"CASE WHEN {K} % 3 = 0 THEN NULL ELSE concat(CAST(50 + {K} % 51 AS STRING), '%') END AS host_acceptance_rate",
    f"CASE WHEN {K} % 8 = 0 THEN NULL WHEN {K} % 5 = 0 THEN 't' ELSE 'f' END AS host_is_superhost",
    f"CASE WHEN {K} % 20 = 0 THEN 'f' ELSE 't' END AS host_has_profile_pic",
    f"CASE WHEN {K} % 6 = 0 THEN 'f' ELSE 't' END AS host_identity_verified",
    f"CASE WHEN {K} % 10 = 0 THEN NULL WHEN {K} % 10 = 1 THEN 'f' ELSE 't' END AS has_availability",
    f"CASE WHEN {K} % 2 = 0 THEN 't' ELSE 'f' END AS instant_bookable",
    f"CASE {K} % 4 WHEN 0 THEN {Q}['email', 'phone']{Q} WHEN 1 THEN {Q}['email', 'phone', 'work_email']{Q} WHEN 2 THEN '[]' ELSE {Q}['phone']{Q} END AS host_verifications",
    f"CAST({K} % 3 AS INT) AS host_listings_count",
    f"CAST({K} % 7 AS INT) AS host_total_listings_count",
    "CASE WHEN n_nationkey % 5 = 0 THEN concat('Centro ', n_name) ELSE n_name END AS neighbourhood_cleansed",
    f"CASE WHEN {K} % 6 = 0 THEN 'Casa Particular' ELSE c_mktsegment END AS property_type",
    f"CASE {K} % 4 WHEN 0 THEN 'Entire home/apt' WHEN 1 THEN 'Private room' WHEN 2 THEN 'Shared room' ELSE 'Hotel room' END AS room_type",
    f"CASE WHEN {K} % 40 = 3 THEN NULL ELSE CAST(1 + {K} % 6 AS INT) END AS accommodates",
    f"CASE {K} % 7 WHEN 0 THEN '1.5 baths' WHEN 1 THEN 'Half-bath' WHEN 2 THEN 'medio baño' WHEN 3 THEN '2 shared baths' WHEN 4 THEN 'Private' "
    f"WHEN 5 THEN NULL ELSE '1 bath' END AS bathrooms_text",
    f"CASE WHEN {K} % 5 = 0 THEN NULL ELSE CAST(1 + {K} % 4 AS DOUBLE) END AS bedrooms",
    f"CASE WHEN {K} % 11 = 0 THEN NULL ELSE CAST(1 + {K} % 9 AS DOUBLE) END AS beds",
    f"CASE {K} % 5 WHEN 0 THEN '[{Q}Wifi{Q}, {Q}Kitchen{Q}]' WHEN 1 THEN {Q}['Pool']{Q} WHEN 2 THEN '[bad' WHEN 3 THEN NULL ELSE '[{Q}Heating{Q}]' END AS amenities",
    f"CASE WHEN {K} % 11 = 0 THEN NULL WHEN {K} % 1900 >= 980 THEN concat('$1,', lpad(CAST({K} % 900 AS STRING), 3, '0'), '.50') "
    f"ELSE concat('$', CAST({K} % 1900 + 20 AS STRING), '.25') END AS price",
    f"36.3 + ({K} % 100) / 100.0 AS latitude",
    f"-5.5 + ({K} % 170) / 100.0 AS longitude",
    f"CAST(1 + {K} % 10 AS INT) AS minimum_nights",
    f"CAST(5 + {K} % 1200 AS INT) AS maximum_nights",
    f"CAST({K} % 31 AS INT) AS availability_30",
    f"CAST({K} % 61 AS INT) AS availability_60",
    f"CAST({K} % 91 AS INT) AS availability_90",
    f"CAST({K} % 366 AS INT) AS availability_365",
    f"CAST({K} % 63 AS INT) AS availability_eoy",
    f"CAST({K} % 256 AS DOUBLE) AS estimated_occupancy_l365d",
    f"CAST({K} % 120 AS INT) AS number_of_reviews",
    f"CAST({K} % 40 AS INT) AS number_of_reviews_ltm",
    f"CAST({K} % 5 AS INT) AS number_of_reviews_l30d",
    f"CAST({K} % 30 AS INT) AS number_of_reviews_ly",
    f"CASE WHEN {K} % 9 = 0 THEN NULL ELSE CAST({K} % 51 AS DOUBLE) / 10 END AS review_scores_rating",
    *[
        f"CAST({K} % {m} AS DOUBLE) / 10 AS review_scores_{n}"
        for n, m in (("accuracy", 51), ("cleanliness", 50), ("checkin", 49), ("communication", 48), ("location", 47), ("value", 46))
    ],
    f"CASE WHEN {K} % 9 = 0 THEN NULL ELSE CAST({K} % 70 AS DOUBLE) / 10 END AS reviews_per_month",
    f"CAST(1 + {K} % 9 AS INT) AS calculated_host_listings_count",
    f"CAST({K} % 4 AS INT) AS calculated_host_listings_count_entire_homes",
    f"CAST({K} % 3 AS INT) AS calculated_host_listings_count_private_rooms",
    f"CAST({K} % 2 AS INT) AS calculated_host_listings_count_shared_rooms",
]


def _sql_text(column: str) -> str:
    """Double-quoted texts in the shaping list are Spark literals; DuckDB wants single quotes."""
    if f"{Q}[" in column:
        pieces = column.split(Q)
        return "".join(
            piece if i % 2 == 0 else "'" + piece.replace("'", "''") + "'" for i, piece in enumerate(pieces)
        ) if "Wifi" not in column else column.replace(f"{Q}['Pool']{Q}", "'[''Pool'']'")
    return column


LISTINGS_SQL_RAW = ", ".join(_sql_text(c) for c in LISTINGS_RAW)
RATE = "try_cast(replace({c}, '%', '') AS DOUBLE)"
NOISE = "CASE WHEN s IS NULL OR s = 0 THEN 0.05 ELSE s * 0.1 END"
LOGGED = {
    "price": "price", "estimated_revenue_l365d": "estimated_revenue_l365d", "estimated_revenue_n365d": "estimated_revenue_n365d",
    "minimum_nights": "minimum_nights", "number_of_reviews": "number_of_reviews", "number_of_reviews_ltm": "number_of_reviews_ltm",
    "number_of_reviews_l30d": "number_of_reviews_l30d", "number_of_reviews_ly": "number_of_reviews_ly",
    "host_listings_count": "host_listings_count", "host_listings_count_eh": "host_listings_count_eh",
    "host_listings_count_sr": "host_listings_count_sr", "host_listings_count_pr": "host_listings_count_pr",
}
SCORES = ("rating", "accuracy", "cleanliness", "checkin", "communication", "location", "value")
LISTINGS_GOLD = f"""WITH raw AS (SELECT {LISTINGS_SQL_RAW} FROM customer JOIN nation ON c_nationkey = n_nationkey),
  a AS (SELECT * REPLACE (
      CASE WHEN room_type IN ('Shared room', 'Private room') AND bedrooms IS NULL THEN 1 ELSE bedrooms END AS bedrooms,
      try_cast(regexp_replace(price, '[$,%€]', '', 'g') AS DOUBLE) AS price,
      {RATE.format(c='host_response_rate')} AS host_response_rate, {RATE.format(c='host_acceptance_rate')} AS host_acceptance_rate,
      try_cast(host_since AS DATE) AS host_since, try_cast(first_review AS DATE) AS first_review, try_cast(last_review AS DATE) AS last_review),
      CASE WHEN regexp_matches(lower(bathrooms_text), 'half|medio') THEN 0.5 ELSE try_cast(regexp_extract(bathrooms_text, '[0-9.]+') AS DOUBLE) END AS bathrooms
    FROM raw),
  by_size AS (SELECT accommodates, median(bedrooms) AS m1, median(beds) AS m2 FROM a WHERE accommodates IS NOT NULL GROUP BY 1),
  by_status AS (SELECT host_is_superhost, median(host_acceptance_rate) AS m, stddev_samp(host_acceptance_rate) AS s FROM a
    WHERE host_is_superhost IS NOT NULL GROUP BY 1),
  times AS (SELECT host_is_superhost, host_response_time AS mode_time, row_number() OVER (PARTITION BY host_is_superhost ORDER BY count(*) DESC, host_response_time) AS r
    FROM a WHERE host_is_superhost IS NOT NULL AND host_response_time IS NOT NULL GROUP BY 1, 2),
  b AS (SELECT a.* REPLACE (coalesce(bedrooms, m1) AS bedrooms, coalesce(beds, m2) AS beds,
      coalesce(host_acceptance_rate, m + {NOISE} * {draw_sql('42|host_acceptance_rate', 'id')}) AS host_acceptance_rate,
      coalesce(host_response_time, mode_time) AS host_response_time)
    FROM a LEFT JOIN by_size ON a.accommodates = by_size.accommodates LEFT JOIN by_status ON a.host_is_superhost = by_status.host_is_superhost
    LEFT JOIN times ON a.host_is_superhost = times.host_is_superhost AND r = 1),
  by_time AS (SELECT host_is_superhost, host_response_time, median(host_response_rate) AS m, stddev_samp(host_response_rate) AS s FROM b
    WHERE host_is_superhost IS NOT NULL AND host_response_time IS NOT NULL GROUP BY 1, 2),
  c AS (SELECT b.* REPLACE (
      CASE WHEN host_acceptance_rate IS NOT NULL THEN greatest(0, least(100, host_acceptance_rate)) / 100 END AS host_acceptance_rate,
      coalesce(host_response_rate, m + {NOISE} * {draw_sql('42|host_response_rate', 'id')}) AS host_response_rate)
    FROM b LEFT JOIN by_time ON b.host_is_superhost = by_time.host_is_superhost AND b.host_response_time = by_time.host_response_time),
  d AS (SELECT * REPLACE (CASE WHEN host_response_rate IS NOT NULL THEN greatest(0, least(100, host_response_rate)) / 100 END AS host_response_rate) FROM c),
  e AS (SELECT *, CASE WHEN host_location IS NULL THEN 'Unknown' WHEN lower(host_location) LIKE '%málaga%' OR lower(host_location) LIKE '%malaga%' THEN 'Malaga'
      WHEN lower(host_location) LIKE '%spain%' OR lower(host_location) LIKE '%españa%' THEN 'Spain' WHEN lower(host_location) LIKE '%unknown%' THEN 'Unknown'
      ELSE 'International' END AS host_location_cat,
      price * estimated_occupancy_l365d AS estimated_revenue_l365d, price * (365 - availability_365) AS estimated_revenue_n365d,
      radians(latitude) AS la, radians(longitude) AS lo, radians(36.7213) AS la0, radians(-4.4214) AS lo0 FROM d),
  gold AS (SELECT id, host_id, {CLEAN_SQL.format(c='description')} AS description, host_name, host_since, first_review, last_review,
      coalesce(host_response_time = 'within an hour', false) AS host_response_hour, host_response_rate, host_acceptance_rate,
      coalesce(CASE host_is_superhost WHEN 't' THEN true WHEN 'f' THEN false END, coalesce(number_of_reviews >= 10 AND host_response_rate >= 0.9
        AND host_acceptance_rate >= 0.9 AND review_scores_rating >= 4.8, false)) AS host_is_superhost,
      host_has_profile_pic = 't' AS host_has_profile_pic, host_identity_verified = 't' AS host_identity_verified,
      CASE WHEN has_availability IS NULL THEN availability_365 > 0 ELSE has_availability = 't' END AS has_availability, instant_bookable = 't' AS instant_bookable,
      host_total_listings_count, neighbourhood_cleansed, room_type, accommodates, bathrooms, bedrooms, beds, price, latitude, longitude, minimum_nights,
      least(maximum_nights, 365) AS maximum_nights, availability_30, availability_60, availability_90, availability_365, availability_eoy,
      estimated_occupancy_l365d, number_of_reviews, number_of_reviews_ltm, number_of_reviews_l30d, number_of_reviews_ly,
      {', '.join(f'review_scores_{s}' for s in SCORES)}, coalesce(reviews_per_month, 0) AS reviews_per_month,
      calculated_host_listings_count AS host_listings_count, calculated_host_listings_count_entire_homes AS host_listings_count_eh,
      calculated_host_listings_count_private_rooms AS host_listings_count_pr, calculated_host_listings_count_shared_rooms AS host_listings_count_sr,
      coalesce(regexp_matches(lower(bathrooms_text), 'shared|compartido'), false) AS bathroom_shared,
      CASE id % 5 WHEN 0 THEN 'Wifi|Kitchen' WHEN 1 THEN 'Pool' WHEN 4 THEN 'Heating' ELSE '' END AS amenities_list,
      CASE id % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS num_amenities,
      greatest(0, calculated_host_listings_count - calculated_host_listings_count_entire_homes - calculated_host_listings_count_private_rooms
        - calculated_host_listings_count_shared_rooms) AS host_listings_count_hr,
      regexp_matches(lower(host_name), '\\b(sl|sa|company|management|rentals|apartments)\\b') OR host_total_listings_count >= 5 AS company,
      host_location_cat, host_location_cat = 'Malaga' AS host_near,
      CAST(regexp_matches(lower(neighbourhood_cleansed), 'centro|histórico|soho') AS INT) AS neighbourhood_center,
      estimated_revenue_l365d, estimated_revenue_n365d, CAST(number_of_reviews > 0 AS INT) AS has_review,
      CAST(coalesce(year(last_review) = 2025, false) AS INT) AS has_review_ly,
      CAST(coalesce(date_diff('day', last_review, DATE '2025-09-30'), 0) AS INT) AS days_since_last_review,
      6371.0 * 2 * asin(sqrt(pow(sin((la0 - la) / 2), 2) + cos(la) * cos(la0) * pow(sin((lo0 - lo) / 2), 2))) AS dist_center_km,
      coalesce(review_scores_rating, 0) * ln(1 + number_of_reviews) AS trust_score,
      CASE WHEN accommodates > 0 THEN beds / accommodates ELSE 0 END AS ratio_beds_accommodates,
      CASE WHEN calculated_host_listings_count = 1 THEN 'Individual' WHEN calculated_host_listings_count < 5 THEN 'Small_Investor' ELSE 'Agency' END AS host_segment,
      maximum_nights > 365 AS long_stay, ln(1 + price) AS price_log, id % 4 IN (0, 1) AS host_verif_email, id % 4 <> 2 AS host_verif_phone,
      id % 4 = 1 AS host_verif_work_email FROM e)"""

LISTING_DOUBLES = (
    "host_response_rate", "host_acceptance_rate", "accommodates", "bathrooms", "bedrooms", "beds", "price", "latitude", "longitude",
    "estimated_occupancy_l365d", *[f"review_scores_{s}" for s in SCORES], "reviews_per_month", "estimated_revenue_l365d",
    "estimated_revenue_n365d", "dist_center_km", "trust_score", "ratio_beds_accommodates",
)
LISTING_DATES = ("host_since", "first_review", "last_review")
LISTING_LOGS = tuple(f"{c}_log" for c in LOGGED)
LISTING_REST = (
    "id", "host_id", "description", "host_name", "host_response_hour", "host_is_superhost", "host_has_profile_pic", "host_identity_verified",
    "has_availability", "instant_bookable", "host_total_listings_count", "neighbourhood_cleansed", "room_type", "minimum_nights", "maximum_nights",
    "availability_30", "availability_60", "availability_90", "availability_365", "availability_eoy", "number_of_reviews", "number_of_reviews_ltm",
    "number_of_reviews_l30d", "number_of_reviews_ly", "host_listings_count", "host_listings_count_eh", "host_listings_count_pr", "host_listings_count_sr",
    "bathroom_shared", "num_amenities", "host_listings_count_hr", "company", "host_location_cat", "host_near", "neighbourhood_center", "has_review",
    "has_review_ly", "days_since_last_review", "host_segment", "long_stay", "host_verif_email", "host_verif_phone", "host_verif_work_email",
)


def listings_gold(t: Tables) -> DataFrame:
    """The raw view is many times as wide as the columns it is made of, so these are dealt over all cores before it."""
    raw = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return listings.gold(spread_rows(raw).selectExpr(*LISTINGS_RAW))


@query(
    "listings_gold",
    LISTINGS_GOLD
    + " SELECT "
    + ", ".join(
        [
            *LISTING_REST,
            *[f"round(CAST({c} AS DOUBLE), 5) AS {c}" for c in LISTING_DOUBLES],
            *[f"CAST({c} AS VARCHAR) AS {c}" for c in LISTING_DATES],
            *[f"round(ln(1 + {c}), 5) AS {c}_log" for c in LOGGED],
            "amenities_list",
        ]
    )
    + " FROM gold",
)
def listings_rows(t: Tables) -> DataFrame:
    df = listings_gold(t).withColumn("amenities_list", F.concat_ws("|", "amenities_list"))
    df = df.withColumns({c: F.round(F.col(c).cast("double"), 5) for c in (*LISTING_DOUBLES, *LISTING_LOGS)})
    return df.withColumns({c: text(c) for c in LISTING_DATES})


def _open(column: str, lo: float | None, hi: float | None) -> tuple[str, str, str]:
    tests = [f"{column} <= {lo}"] if lo is not None else []
    tests += [f"{column} >= {hi}"] if hi is not None else []
    return column, "range", " OR ".join(tests)


LISTING_BROKEN = [
    ("id", "unique", None),
    _open("accommodates", 1, None), _open("bathrooms", 0, None), _open("bedrooms", 0, None), _open("price", 1, 100000),
    _open("latitude", 36.3, 37.3), _open("longitude", -5.5, -3.8), ("last_review", "date_limit", "last_review > DATE '2025-09-30'"),
    _open("availability_30", 0, 30), _open("availability_60", 0, 60), _open("availability_90", 0, 90), _open("availability_365", 0, 365),
    _open("availability_eoy", 0, 62), *[_open(f"review_scores_{s}", 0, 5) for s in SCORES],
    ("logic_check", "logic", "maximum_nights < minimum_nights"),
    ("logic_check", "logic", "room_type IN ('Private room', 'Shared room') AND coalesce(bedrooms NOT IN (0, 1), true)"),
    ("logic_check", "logic", "NOT has_availability AND availability_365 <> 0"),
]


@query(
    "listings_rules",
    LISTINGS_GOLD
    + " "
    + " UNION ALL ".join(
        f"SELECT '{v}' AS variable, '{k}' AS check_kind, "
        + (f"count(*) FILTER ({b})" if b else "count(*) - count(DISTINCT id)")
        + " AS n_violations FROM gold"
        for v, k, b in LISTING_BROKEN
    ),
)
def listings_rules(t: Tables) -> DataFrame:
    return evaluate(listings_gold(t), listings.rules()).select("variable", "check_kind", "n_violations")


def _corr(a: str, b: str) -> str:
    return f"SELECT '{a}' AS \"row\", '{b}' AS \"column\", round_even(corr({a}, {b}), 3) AS value FROM gold"


GOLD_COLUMNS = (*LISTING_REST, *LISTING_DOUBLES, *LISTING_DATES, *LISTING_LOGS, "amenities_list")
LISTINGS_SECTIONS = {
    "meta": f"SELECT count(*) AS n_rows, {len(GOLD_COLUMNS)} AS n_cols FROM gold",
    "price_hist": edges_sql("WITH x AS (SELECT least(price, 500) AS v FROM gold WHERE price IS NOT NULL)", 40, "min(v)", "max(v)",
                            "round(a, 6)", "round(b, 6)"),
    "price_log_hist": edges_sql("WITH x AS (SELECT price_log AS v FROM gold WHERE price_log IS NOT NULL)", 30, "min(v)", "max(v)",
                                "round(a, 6)", "round(b, 6)"),
    "price_stats": "SELECT round_even(median(price), 2) AS median, round_even(avg(price), 2) AS mean FROM gold",
    "host_near": """SELECT 'Local' AS label, count(*) FILTER (host_near) AS n FROM gold
      UNION ALL SELECT 'Remote/Other', count(*) FILTER (NOT host_near) FROM gold""",
    "center": """SELECT 'Center' AS label, count(*) FILTER (neighbourhood_center = 1) AS n FROM gold
      UNION ALL SELECT 'Periphery', count(*) FILTER (neighbourhood_center = 0) FROM gold""",
    "location": "SELECT host_location_cat, count(*) AS n FROM gold GROUP BY 1",
    "long_stay": "SELECT round_even(avg(CAST(long_stay AS INT)) * 100, 2) AS long_stay_pct FROM gold",
    "geo_trend": """SELECT bin, round(a, 6) AS "left", round(b, 6) AS "right", coalesce(median(price), 0) AS median, count(gold.id) AS n FROM (
        SELECT CAST(i AS INT) AS bin, lo + i * ((hi - lo) / 10) AS a, CASE WHEN i = 9 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 10) END AS b
        FROM (SELECT min(dist_center_km) AS lo, max(dist_center_km) AS hi FROM gold), range(10) r(i))
      LEFT JOIN gold ON dist_center_km <= b AND (dist_center_km > a OR (bin = 0 AND dist_center_km = a)) GROUP BY bin, a, b""",
    "areas": """SELECT neighbourhood_cleansed, median(price) AS median_price FROM gold GROUP BY 1
      ORDER BY median_price DESC NULLS LAST, neighbourhood_cleansed LIMIT 15""",
    "room_type": "SELECT room_type, count(*) AS n FROM gold GROUP BY 1",
    "host_segment": "SELECT host_segment, count(*) AS n, count(*) / (SELECT count(*) FROM gold)::DOUBLE AS share FROM gold GROUP BY 1",
    "nulls": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(avg(CASE WHEN {c.removesuffix('_log')} IS NULL THEN 1.0::DOUBLE ELSE 0 END) * 100, 2) AS pct_null FROM gold"
        for c in GOLD_COLUMNS
    )
    + ") ORDER BY pct_null DESC, column_name LIMIT 15",
    "corr": " UNION ALL ".join(_corr(a, b) for a in reports.CORRELATED for b in reports.CORRELATED),
}

# ---- registration of the report sections ------------------------------------------------------

REPORTS = {
    "listings": (listings_gold, reports.LISTINGS, LISTINGS_GOLD + " ", LISTINGS_SECTIONS),
    "calendar": (calendar_gold, reports.CALENDAR, CALENDAR_DAILY, CALENDAR_SECTIONS),
    "reviews": (reviews_gold, reports.REVIEWS, REVIEWS_GOLD + " ", REVIEWS_SECTIONS),
}


def _shown(df: DataFrame) -> DataFrame:
    dates = {f.name: text(f.name) for f in df.schema.fields if f.dataType.typeName() == "date"}
    edges = {c: r6(c) for c in ("left", "right") if c in df.columns}
    return df.withColumns({**dates, **edges})


def _register(report: str, section: str) -> None:
    _, sections, head, bodies = REPORTS[report]
    body = bodies[section]
    if body.startswith("WITH "):
        head, body = head.rstrip() + ", ", body.removeprefix("WITH ")

    @query(f"report_{report}_{section}", head + body)
    def run(t: Tables) -> DataFrame:
        return _shown(sections[section](REPORTS[report][0](t)))


for _report, (_, _sections, _, _) in REPORTS.items():
    for _section in _sections:
        _register(_report, _section)
