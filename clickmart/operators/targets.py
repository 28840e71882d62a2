"""Ranked product URL targets."""

from pyspark.sql import functions as F

from clickmart.operators.events import (
    GROUP_KEYS,
    candidate_groups,
    candidates,
    flagged_candidates,
    product_events,
)
from clickmart.operators.ranking import best_per_group, first_rows, running_rank
from clickmart.operators.sampling import smallest_rows
from clickmart.schemas import TARGETS

# A target row without a rank sorts after every ranked one.
NO_RANK = 999999


def rank_order():
    """Most events first, then the one seen last; the rest makes the order total."""
    return [
        F.col("event_count").desc(),
        F.col("last_seen_at").desc_nulls_last(),
        F.col("candidate_url").asc(),
        F.col("source_event_type").asc(),
        F.col("url_source_field").asc(),
    ]


def ranked_targets(groups, include_all=False, keep=None):
    """Candidate groups with their rank inside the product.

    Without ``include_all`` only the best URL of each product is ranked and returned, which needs no
    full ranking. ``keep`` is a condition on ranked rows, evaluated over all ranks.
    """
    if include_all or keep is not None:
        ranked = running_rank(groups, ["product_id"], rank_order(), "url_rank")
        if keep is not None:
            ranked = ranked.filter(keep)
    else:
        ranked = best_per_group(groups, ["product_id"], rank_order()).withColumn("url_rank", F.lit(1))
    return ranked.select(*[F.col(field.name).cast(field.dataType) for field in TARGETS])


def limited_product_events(events, limit=None, order_key=None):
    """The first ``limit`` product events by a BIGINT key; all of them for no limit or 0."""
    matched = product_events(events)
    return smallest_rows(matched, order_key, limit) if limit else matched


def extract_targets(events, mode="raw", include_all=False, limit=None, order_key=None):
    matched = limited_product_events(events, limit, order_key)
    return ranked_targets(candidate_groups(candidates(matched, mode)), include_all)


def target_stats(ranked, include_all=False, keep=None):
    """Groups, events and products in ranked targets, and how many rows an export writes."""
    if keep is None:
        keep = F.lit(True) if include_all else F.col("url_rank") == 1
    per_product = ranked.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("event_count").alias("events"),
        F.count_if(keep).alias("written"),
    )
    return per_product.agg(
        F.coalesce(F.sum("groups"), F.lit(0)).alias("grouped_url_count"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("candidate_records"),
        F.coalesce(F.sum("written"), F.lit(0)).alias("target_rows"),
        F.count(F.lit(1)).alias("unique_products"),
    )


def group_stats(groups, include_all=False):
    """``target_stats`` from groups that are not ranked yet: each product has one best row."""
    per_product = groups.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("event_count").alias("events")
    )
    written = F.sum("groups") if include_all else F.count(F.lit(1))
    return per_product.agg(
        F.coalesce(F.sum("groups"), F.lit(0)).alias("grouped_url_count"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("candidate_records"),
        F.coalesce(written, F.lit(0)).alias("target_rows"),
        F.count(F.lit(1)).alias("unique_products"),
    )


def extraction_stats(events, mode="clean", limit=None, order_key=None):
    """Scanned product events, candidates, groups and products, in one pass over the events.

    Events that are no candidate share one group, which the map side shrinks to a row per task.
    """
    flagged = flagged_candidates(limited_product_events(events, limit, order_key), mode)
    is_candidate = F.col("is_candidate")
    groups = flagged.groupBy(
        "is_candidate", *[F.when(is_candidate, F.col(key)).alias(key) for key in GROUP_KEYS]
    ).agg(F.count(F.lit(1)).alias("events"))
    per_product = groups.groupBy("is_candidate", "product_id").agg(
        F.sum("events").alias("events"), F.count(F.lit(1)).alias("groups")
    )

    def total(column):
        return F.coalesce(F.sum(F.when(is_candidate, column)), F.lit(0))

    return per_product.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("scanned_records"),
        total(F.col("events")).alias("candidate_records"),
        total(F.col("groups")).alias("grouped_url_count"),
        F.count_if(is_candidate).alias("unique_products"),
    )


def valid_targets(targets):
    """Targets with an id and a URL."""
    return targets.filter((F.col("product_id") != "") & (F.col("candidate_url") != ""))


def _number(name):
    return F.col(name).try_cast("bigint")


def best_target_key():
    """A struct whose least value per product is the row that ``best_targets_first`` takes."""
    rank = _number("url_rank")
    return F.struct(rank.isNull().alias("unranked"), rank.alias("rank"), "candidate_url")


def best_targets_first(targets, limit=None):
    """First valid row of each product in rank order; at most ``limit`` products by id."""
    order = [_number("url_rank").asc_nulls_last(), F.col("candidate_url").asc()]
    best = best_per_group(valid_targets(targets), ["product_id"], order)
    return first_rows(best, limit, ["product_id"])


def best_targets_pick(targets, limit=None):
    """Best valid row of each product by rank, then by event count, in any row order."""
    rank = F.coalesce(F.nullif(_number("url_rank"), F.lit(0)), F.lit(NO_RANK))
    count = F.coalesce(_number("event_count"), F.lit(0))
    best = best_per_group(
        valid_targets(targets), ["product_id"], [rank.asc(), count.desc(), F.col("candidate_url").asc()]
    )
    return first_rows(best, limit, ["product_id"])
