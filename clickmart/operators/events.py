"""Product events and the product URL candidates in them."""

from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.functions.text import coalesce_clean, coalesce_raw, present

# Events whose own page is the product page.
CURRENT_URL_EVENTS = (
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
)
# The event whose product page is the page it came from.
RECOMMEND_CLICK_EVENT = "product_view_all_recommend_clicked"
PRODUCT_EVENTS = CURRENT_URL_EVENTS + (RECOMMEND_CLICK_EVENT,)

# Marks of a missing value that raw mode drops, in this exact spelling.
RAW_MISSING = ("", "none", "null", "nan")

GROUP_KEYS = ["product_id", "candidate_url", "source_event_type", "url_source_field"]

MODES = ("raw", "clean")


def _filled(column):
    return column.isNotNull() & (column != "")


def product_events(events):
    """Events of the product kinds that carry a page URL or a referrer URL."""
    urls = present(events, ("current_url", "referrer_url"))
    has_url = F.lit(False)
    for url in urls:
        has_url = has_url | _filled(url)
    return events.filter(F.col("collection").isin(*PRODUCT_EVENTS) & has_url)


def with_ip(events, ip_field="ip"):
    return events.filter(_filled(F.col(ip_field)))


def flagged_candidates(events, mode="raw", keep=()):
    """One row per event with product, URL and ``is_candidate``.

    ``raw`` takes values as they are stored and trusts the stored event type. ``clean`` trims, skips
    words for null, falls through to the next alias, and lets only known event types pass.
    ``keep`` lists further input columns to carry along.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    pick = coalesce_clean if mode == "clean" else coalesce_raw
    viewing_id = pick(events, schemas.VIEWING_PRODUCT_ID_ALIASES)
    named = events.select(
        F.lower(pick(events, schemas.EVENT_TYPE_ALIASES)).alias("source_event_type"),
        F.coalesce(pick(events, schemas.PRODUCT_ID_ALIASES), viewing_id).alias("_own_id"),
        viewing_id.alias("_viewing_id"),
        pick(events, schemas.CURRENT_URL_ALIASES).alias("_page"),
        pick(events, schemas.REFERRER_URL_ALIASES).alias("_referrer"),
        pick(events, schemas.EVENT_TIME_ALIASES).alias("event_time"),
        *keep,
    )
    clicked = F.col("source_event_type") == RECOMMEND_CLICK_EVENT
    rows = named.select(
        F.when(clicked, F.col("_viewing_id")).otherwise(F.col("_own_id")).alias("product_id"),
        F.when(clicked, F.col("_referrer")).otherwise(F.col("_page")).alias("candidate_url"),
        "source_event_type",
        F.when(clicked, "referrer_url").otherwise("current_url").alias("url_source_field"),
        "event_time",
        *keep,
    )
    product_id, url = F.col("product_id"), F.col("candidate_url")
    if mode == "clean":
        known_type = F.col("source_event_type").isin(*PRODUCT_EVENTS)
        complete = known_type & product_id.isNotNull() & url.isNotNull()
    else:
        complete = ~product_id.isin(*RAW_MISSING) & ~url.isin(*RAW_MISSING)
    return rows.withColumn("is_candidate", F.coalesce(complete, F.lit(False)))


def candidates(events, mode="raw", keep=()):
    """The events that name a product and its URL, in five columns."""
    flagged = flagged_candidates(events, mode, keep)
    if mode == "clean":
        # Spark would move the filter below the cleaning and so clean every value twice. A column
        # that is no function of the row keeps the filter where it is.
        flagged = flagged.withColumn("_line", F.monotonically_increasing_id())
        return flagged.filter((F.col("_line") >= 0) & F.col("is_candidate")).drop("is_candidate", "_line")
    return flagged.filter("is_candidate").drop("is_candidate")


def candidate_groups(candidate_rows):
    """Count, first and last time of each product, URL, event type and URL source.

    The map side combines first, so a product with a large share of all events adds one row per
    task and group to the shuffle.
    """
    return candidate_rows.groupBy(*GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_time").alias("first_seen_at"),
        F.max("event_time").alias("last_seen_at"),
    )


def grouped_events(events, mode="raw"):
    return candidate_groups(candidates(product_events(events), mode))


def event_count(events):
    return events.agg(F.count(F.lit(1)).alias("event_count"))
