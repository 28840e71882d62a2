"""Row shapes of the inputs and outputs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings(*names):
    return [T.StructField(name, T.StringType()) for name in names]


# Alternative names under which an event may carry a value, best first.
EVENT_TYPE_ALIASES = ("event_type", "event", "event_name", "collection", "action")
PRODUCT_ID_ALIASES = ("product_id", "productid", "product")
VIEWING_PRODUCT_ID_ALIASES = ("viewing_product_id", "viewingProductId")
CURRENT_URL_ALIASES = ("current_url", "currentUrl", "url")
REFERRER_URL_ALIASES = ("referrer_url", "referrerUrl", "referer_url", "referer")
EVENT_TIME_ALIASES = ("event_time", "time_stamp", "timestamp", "created_at", "time", "datetime")
ALIASES = (
    *EVENT_TYPE_ALIASES, *PRODUCT_ID_ALIASES, *VIEWING_PRODUCT_ID_ALIASES,
    *CURRENT_URL_ALIASES, *REFERRER_URL_ALIASES, *EVENT_TIME_ALIASES,
)


# Documented fields of an event document.
DOCUMENTED_EVENT = T.StructType(
    strings(
        "_id", "api_version", "collect_id", "collection", "currency", "current_url", "device_id",
        "email_address", "ip", "local_time", "price", "product_id", "recommendation_product_id",
        "recommendation_product_position", "referrer_url", "resolution", "store_id", "user_agent",
        "user_id_db", "viewing_product_id", "key_search", "show_recommendation", "cat_id", "is_paypal",
    )
    + [
        T.StructField("utm_medium", T.VariantType()),
        T.StructField("utm_source", T.VariantType()),
        T.StructField("order_id", T.VariantType()),
        T.StructField("recommendation", T.BooleanType()),
        T.StructField("recommendation_clicked_position", T.IntegerType()),
        T.StructField("time_stamp", T.LongType()),
        T.StructField(
            "cart_products",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("amount", T.IntegerType()),
                        T.StructField("currency", T.StringType()),
                        T.StructField("option", T.VariantType()),
                        T.StructField("price", T.StringType()),
                        T.StructField("product_id", T.IntegerType()),
                    ]
                )
            ),
        ),
        T.StructField("option", T.VariantType()),
    ]
)

# What a scan reads: the documented fields, and as text every other name that a value may have.
EVENTS = T.StructType(
    DOCUMENTED_EVENT.fields + strings(*[name for name in ALIASES if name not in DOCUMENTED_EVENT.fieldNames()])
)

# Columns of product targets.
TARGETS = T.StructType(
    strings("product_id", "candidate_url", "source_event_type", "url_source_field")
    + [T.StructField("event_count", T.LongType())]
    + strings("first_seen_at", "last_seen_at")
    + [T.StructField("url_rank", T.IntegerType())]
)

# Fields of an attempt.
ATTEMPT = T.StructType(
    strings("url", "resolved_url", "strategy")
    + [
        T.StructField("status_code", T.IntegerType()),
        T.StructField("react_data_found", T.BooleanType()),
        T.StructField("product_id_matches", T.BooleanType()),
    ]
    + strings("status", "error_message")
)

# Fields of a crawl log line.
PRODUCT_INFO = T.StructType(
    strings(
        "requested_product_id", "product_id", "source_url", "original_url", "resolved_url",
        "country_store", "crawl_url_strategy", "product_name", "name", "sku",
    )
    + [T.StructField("category", T.VariantType())]
    + strings("category_name")
    + [T.StructField("price", T.VariantType())]
    + strings("currency", "store_code")
    + [T.StructField("active", T.BooleanType())]
    + strings("scraped_at", "status", "failure_reason", "error_message")
    + [
        T.StructField("react_data_basic", T.VariantType()),
        T.StructField("react_data", T.VariantType()),
        T.StructField("attempts", T.ArrayType(ATTEMPT)),
    ]
)

# Columns of the warehouse table, of the archive, and of failed targets.
WAREHOUSE_FIELDS = [
    field.name
    for field in PRODUCT_INFO
    if field.name not in ("react_data_basic", "react_data", "attempts")
] + ["react_data_available"]

ARCHIVE_FIELDS = ["requested_product_id", "product_id", "scraped_at", "status", "react_data"]

FAILED_TARGET_FIELDS = [
    "product_id", "candidate_url", "last_status", "failure_reason", "error_message", "attempt_count",
    "last_source_url", "last_resolved_url", "scraped_at",
]

# Columns of located addresses.
IP_LOCATIONS = T.StructType(
    strings("ip", "country", "region", "city")
    + [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    + strings("processed_at", "status", "error_message")
)


def as_strings(schema):
    """The same fields, all text: the shape of a CSV file."""
    return T.StructType(strings(*schema.fieldNames()))


def shaped(df, schema):
    """The columns of ``schema`` in its order and types; those ``df`` lacks are null."""
    known = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in known else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )
