"""Product rows split into a flat warehouse table and an archive of the raw payloads."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions.payload import is_filled_object
from clickmart.functions.text import first_filled
from clickmart.schemas import ARCHIVE_FIELDS, PRODUCT_INFO, WAREHOUSE_FIELDS, shaped


def warehouse_columns():
    """The default warehouse projection as columns."""
    computed = {
        "product_id": first_filled(F.col("product_id"), F.col("requested_product_id")),
        "product_name": first_filled(F.col("product_name"), F.col("name")),
        "react_data_available": is_filled_object(F.col("react_data")),
    }
    return [computed.get(name, F.col(name)).alias(name) for name in WAREHOUSE_FIELDS]


def archive_columns():
    """The default archive projection as columns; a payload that is no object becomes ``{}``."""
    payload = F.col("react_data")
    is_object = payload.try_cast("map<string,variant>").isNotNull()
    computed = {
        "product_id": first_filled(F.col("product_id"), F.col("requested_product_id")),
        "react_data": F.when(is_object, payload).otherwise(F.parse_json(F.lit("{}"))),
    }
    return [computed.get(name, F.col(name)).alias(name) for name in ARCHIVE_FIELDS]


# What the projections read: every product column but the attempts and the short payload.
READ = T.StructType(
    [field for field in PRODUCT_INFO if field.name not in ("attempts", "react_data_basic")]
)


def warehouse_products(products, columns=None):
    return shaped(products, READ).select(*(columns or warehouse_columns()))


def payload_archive(products, columns=None):
    return shaped(products, READ).select(*(columns or archive_columns()))
