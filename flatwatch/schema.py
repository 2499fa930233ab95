"""Table schemas and the fixed values every run must share."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must stay exactly as written: results depend on them) -----------------------------
# Main voivodeship cities used for the main-city summary, in the original order.
MAIN_CITIES = (
    "Białystok", "Bydgoszcz", "Gdańsk", "Gorzów Wielkopolski", "Katowice", "Kielce", "Kraków", "Lublin",
    "Łódź", "Olsztyn", "Opole", "Poznań", "Rzeszów", "Szczecin", "Toruń", "Warszawa", "Wrocław",
    "Zielona Góra",
)
# Title keywords that mark a post as urgent (case-sensitive substring match).
URGENCY_KEYWORDS = ("pilne", "pilnie")
URGENT, NORMAL = "urgent", "normal"
# Area buckets: (label, lower bound inclusive, upper bound, upper bound inclusive?); anything else is '>100'.
AREA_BUCKETS = (
    ("<30", None, 30.0, False),
    ("30-49", 30.0, 50.0, False),
    ("50-74", 50.0, 75.0, False),
    ("75-100", 75.0, 100.0, True),
)
AREA_BUCKET_OTHER = ">100"
# Post categories and sources.
TYPES = ("rent", "sell", "room")
# ------------------------------------------------------------------------------------------------------

PAGE = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("page", T.LongType(), False),
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])

# One row per post after extraction, before cleaning: the inner HTML of each configured field.
POST_RAW = T.StructType([
    T.StructField("source", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("page", T.LongType(), True),
    T.StructField("pos", T.IntegerType(), True),
    T.StructField("title_html", T.StringType(), True),
    T.StructField("price_html", T.StringType(), True),
    T.StructField("location_html", T.StringType(), True),
    T.StructField("spans_html", T.ArrayType(T.StringType()), True),
    T.StructField("area_html", T.StringType(), True),
])

# Cleaned post (before the derived columns).
LISTING_BASE = T.StructType([
    T.StructField("post_title", T.StringType(), True),
    T.StructField("post_price", T.DoubleType(), True),
    T.StructField("post_city", T.StringType(), True),
    T.StructField("post_sqmetrage", T.DoubleType(), True),
    T.StructField("post_rooms", T.IntegerType(), True),
    T.StructField("download_date", T.DateType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
])

DERIVED = T.StructType([
    T.StructField("sqm_bucket", T.StringType(), True),
    T.StructField("urgency", T.StringType(), True),
    T.StructField("price_per_sqm", T.DoubleType(), True),
])

LISTING = T.StructType(LISTING_BASE.fields + DERIVED.fields)

LISTING_COLUMNS = tuple(f.name for f in LISTING.fields)

SUMMARY = T.StructType([
    T.StructField("post_city", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("avg_price", T.DoubleType(), True),
    T.StructField("min_price", T.DoubleType(), True),
    T.StructField("max_price", T.DoubleType(), True),
    T.StructField("avg_rooms", T.DoubleType(), True),
    T.StructField("avg_sqmetrage", T.DoubleType(), True),
    T.StructField("min_sqmetrage", T.DoubleType(), True),
    T.StructField("max_sqmetrage", T.DoubleType(), True),
    T.StructField("avg_price_sqm", T.DoubleType(), True),
    T.StructField("min_price_sqm", T.DoubleType(), True),
    T.StructField("max_price_sqm", T.DoubleType(), True),
    T.StructField("number_of_posts", T.LongType(), False),
    T.StructField("download_date", T.DateType(), True),
])

SUMMARY_COLUMNS = tuple(f.name for f in SUMMARY.fields)

SNAPSHOT_PARTITIONS = ("download_date", "source", "type")
