"""The title of a page and the JSON object embedded in it."""

from pyspark.sql import functions as F

from clickmart.functions.text import collapse_spaces, first_filled, strip

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
PAYLOAD = r"(?sU)react_data\s*=[^{]*(\{.*)"

# Payload keys kept in the short form.
BASIC_KEYS = (
    "product_id", "name", "sku", "attribute_set_id", "attribute_set", "type_id", "price", "min_price",
    "max_price", "min_price_format", "max_price_format", "gold_weight", "none_metal_weight",
    "fixed_silver_weight", "material_design", "qty", "collection", "collection_id", "product_type",
    "product_type_value", "category", "category_name", "store_code",
)

# A page describes a product when one of these has a value.
USEFUL_KEYS = ("name", "sku", "store_code")


def page_title(html):
    return collapse_spaces(F.regexp_extract(html, TITLE, 1))


def page_payload(html):
    """The object assigned to the payload variable as VARIANT, null where there is none.

    The JSON reader stops at the end of the object, so the rest of the page needs no cutting. Text with the numbers
    ``NaN`` or ``Infinity``, which the strict reader refuses, goes to the lenient one.
    """
    text = F.nullif(F.regexp_extract(html, PAYLOAD, 1), F.lit(""))
    lenient = F.when(text.rlike("NaN|Infinity"), F.from_json(text, "variant"))
    return F.coalesce(F.try_parse_json(text), lenient)


def text_of(payload, key):
    return F.try_variant_get(payload, f"$.{key}", "string")


def value_of(payload, key):
    """The value itself; JSON null becomes null."""
    value = F.try_variant_get(payload, f"$.{key}", "variant")
    return F.when(~F.is_variant_null(value), value)


def has_value(payload, key):
    """False for missing, null, empty text, zero, false and empty containers."""
    text = text_of(payload, key)
    kind = F.schema_of_variant(F.try_variant_get(payload, f"$.{key}", "variant"))
    empty = (text == "") | (
        (kind != "STRING") & (text.isin("false", "[]", "{}") | (F.expr("0") == text.try_cast("double")))
    )
    return F.coalesce(~F.coalesce(empty, text == ""), F.lit(False))


def is_useful(payload):
    useful = F.lit(False)
    for key in USEFUL_KEYS:
        useful = useful | has_value(payload, key)
    return useful


def is_requested(payload_product_id, product_id):
    return F.coalesce(strip(payload_product_id) == strip(product_id), F.lit(False))


def is_filled_object(payload):
    """A JSON object with at least one key."""
    return F.coalesce(F.size(payload.try_cast("map<string,variant>")) > 0, F.lit(False))


def basic_payload(payload):
    """Only the basic keys that the payload has, as a VARIANT object."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(key).alias("key"),
                F.try_variant_get(payload, f"$.{key}", "variant").alias("value"),
            )
            for key in BASIC_KEYS
        ]
    )
    kept = F.filter(pairs, lambda pair: pair["value"].isNotNull())
    return F.to_variant_object(F.map_from_entries(kept))


def currency_of(payload):
    return first_filled(text_of(payload, "currency"), text_of(payload, "currency_code"))
