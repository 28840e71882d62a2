"""Distinct visitor addresses and their locations."""

from pyspark.sql import functions as F

from clickmart.functions import ip as I
from clickmart.operators.crawl_log import filled_counts, status_counts  # noqa: F401
from clickmart.operators.events import candidates, flagged_candidates, product_events, with_ip
from clickmart.operators.pages import OK, utc_now
from clickmart.operators.ranges import attach_ranges
from clickmart.operators.ranking import HEAP_ROWS, best_per_group, first_rows
from clickmart.operators.sampling import smallest_rows
from clickmart.schemas import IP_LOCATIONS
from clickmart.session import stored

# Lookup outcomes.
INVALID = "invalid_ip"
NOT_CONFIGURED = "lookup_not_configured"


def distinct_raw_ips(events, ip_field="ip", limit=None):
    """Distinct stored values; with ``limit`` the first ones in text order."""
    ips = with_ip(events, ip_field).select(F.col(ip_field).alias("ip")).distinct()
    return first_rows(ips, limit, ["ip"])


def distinct_normalized_ips(events, order_key, ip_field="ip", limit=None):
    """One stored value per address: the first seen by a BIGINT key, null keys last, then by text.

    The first step shrinks the events to distinct values with a hash aggregate, which a hot address
    does not slow down. Only distinct values are then cleaned and compared as addresses.
    """
    spellings = (
        with_ip(events, ip_field)
        .groupBy(F.col(ip_field).alias("ip"))
        .agg(F.min(order_key).alias("first_at"))
        .withColumn("ip_key", I.distinct_key(F.col("ip")))
    )
    seen = F.struct(F.col("first_at").isNull().alias("never"), "first_at", "ip")
    firsts = spellings.groupBy("ip_key").agg(F.min(seen).alias("seen")).select("ip_key", "seen.ip", "seen.first_at")
    if limit and limit <= HEAP_ROWS:
        return firsts.orderBy(F.col("first_at").asc_nulls_last(), "ip").limit(limit)
    return smallest_rows(stored(firsts, "ips"), "first_at", limit, ties=("ip",)) if limit else firsts


def distinct_ips(events, order_key=None, ip_field="ip", limit=None, discovery_mode="scan"):
    """``aggregate`` compares stored values, ``scan`` compares addresses."""
    if discovery_mode == "aggregate":
        return distinct_raw_ips(events, ip_field, limit)
    return distinct_normalized_ips(events, order_key, ip_field, limit).select("ip")


def _target_events(events, target_ids, order_key, ip_field):
    found = candidates(with_ip(product_events(events), ip_field), "clean", keep=[ip_field, order_key])
    return found.join(target_ids.select("product_id").distinct(), "product_id", "left_semi")


def target_event_ips(events, target_ids, order_key, ip_field="ip", limit=None):
    """Distinct addresses of the events of target products."""
    return distinct_normalized_ips(
        _target_events(events, target_ids, order_key, ip_field), order_key, ip_field, limit
    )


def target_event_ip_stats(events, target_ids, order_key, ip_field="ip", limit=None):
    """Events scanned, candidates among them, and those of target products.

    With ``limit`` counting ends at the event that brought the last address.
    """
    scanned = with_ip(product_events(events), ip_field)
    if limit:
        ips = target_event_ips(events, target_ids, order_key, ip_field, limit)
        last, found = ips.agg(F.max("first_at"), F.count(F.lit(1))).first()
        if found >= limit:
            scanned = scanned.filter(F.col(order_key) <= last)
    # Per product first: a hot product is one row per task before the join sees it.
    per_product = (
        flagged_candidates(scanned, "clean")
        .groupBy("is_candidate", F.when(F.col("is_candidate"), F.col("product_id")).alias("product_id"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    wanted = target_ids.select("product_id").distinct().withColumn("is_target", F.lit(True))
    joined = per_product.join(wanted, "product_id", "left")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("events"))), F.lit(0))

    return joined.agg(
        total(F.lit(True)).alias("product_event_scanned_count"),
        total(F.col("is_candidate")).alias("product_event_candidate_count"),
        total(F.col("is_target")).alias("product_event_matched_count"),
    )


def ip_record_count(events, ip_field="ip"):
    return with_ip(events, ip_field).agg(F.count(F.lit(1)).alias("ip_record_count"))


def locate(ips, ranges=None, v6_ranges=None, allow_private=False, stamp=True, nested=False):
    """Location and status of each address in column ``ip``, which may repeat in many spellings.

    ``ranges`` has BIGINT ``ip_from`` and ``ip_to`` (inclusive) with country, region, city, latitude
    and longitude; ``v6_ranges`` the same with both ends as 32 hex digits. A valid address outside
    every range is ``ok`` with empty fields. An IPv6 address that maps an IPv4 one is looked up as
    either. Without ranges a valid address is not looked up. With ``nested`` ranges may lie in one another and the innermost
    one counts.
    """
    checked = I.with_validity(ips.select("ip"), "ip", allow_private).select(
        F.coalesce("address", F.lit("")).alias("ip"),
        "valid",
        F.when(F.col("valid"), F.coalesce(F.col("v4"), I.mapped_v4(F.col("v6")))).alias("number"),
        F.when(F.col("valid"), F.col("v6")).alias("digits"),
    )
    configured = ranges is not None or v6_ranges is not None
    fields = ["country", "region", "city", "latitude", "longitude"]
    located = checked
    if ranges is not None:
        ends = [F.col(end).cast("bigint").alias(end) for end in ("ip_from", "ip_to")]
        located = attach_ranges(located, ranges.select(*ends, *fields), F.col("number"), "v4", nested)
    if v6_ranges is not None:
        v6_ranges = v6_ranges.select("ip_from", "ip_to", *fields)
        located = attach_ranges(located, v6_ranges, F.col("digits"), "v6", nested)

    sources = [name for name in ("v4", "v6") if name in located.columns]

    def found(field):
        values = [F.col(f"{source}.{field}").cast("string") for source in sources]
        return F.coalesce(*values) if values else F.lit(None).cast("string")

    status = F.when(~F.col("valid"), INVALID).otherwise(OK if configured else NOT_CONFIGURED)
    rows = located.select(
        "ip",
        *[I.clean_geo_text(found(field)).alias(field) for field in fields[:3]],
        *[I.clean_geo_number(found(field)).alias(field) for field in fields[3:]],
        (utc_now() if stamp else F.lit(None).cast("string")).alias("processed_at"),
        status.alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return rows.select(*[F.col(field.name).cast(field.dataType) for field in IP_LOCATIONS])


def location_keys(locations):
    key = I.location_key(*[F.col(name) for name in ("country", "region", "city", "latitude", "longitude")])
    return locations.withColumn("location", key)


def location_counts(locations):
    return filled_counts(location_keys(locations), "location")


def country_counts(locations):
    return filled_counts(locations, "country")


def ip_totals(locations):
    """Processed rows, ok rows and distinct locations, as one row."""
    per_location = location_keys(locations).groupBy("location").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") == OK).alias("ok"),
        F.count_if(F.col("status") == INVALID).alias("invalid"),
    )

    def total(name):
        return F.coalesce(F.sum(name), F.lit(0))

    return per_location.agg(
        total("rows").alias("processed_count"),
        total("ok").alias("ok_count"),
        total("invalid").alias("invalid_count"),
        F.count_if(F.col("location") != "").alias("unique_location_count"),
    )


def newest_per_key(rows, key, order):
    """The row of each key that was written last; rows without a key are left out."""
    return best_per_group(rows.filter(F.col(key) != ""), [key], [F.col(order).desc()])


def upsert(old, new, key="ip"):
    """Rows of ``new`` replace rows of ``old`` with the same key; rows without a key are left out.

    Of several rows of one side the largest counts, by the other columns from left to right.
    """
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    rest = [F.col(name).desc_nulls_last() for name in old.columns if name != key]
    return best_per_group(both.filter(F.col(key) != ""), [key], [F.col("_batch").desc(), *rest]).drop("_batch")
