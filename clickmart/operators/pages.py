"""Collected pages: classification, and the first page that really is the product."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import payload as P
from clickmart.functions.text import blank_to_null, first_filled
from clickmart.functions.urls import (
    country_store,
    first_of_each_url,
    is_broken_host,
    url_choices,
    url_host,
)
from clickmart.metrics import counted, rows_of
from clickmart.operators.ranking import best_per_group
from clickmart.schemas import ATTEMPT, PRODUCT_INFO, shaped
from clickmart.session import stored

# Crawl outcomes.
OK = "ok"
NOT_FOUND = "not_found_in_configured_stores"
CRAWL_FAILED = "crawl_failed"
REQUEST_FAILED = "request_failed"

# So many attempts at most may be sent to the pages whole; Spark takes the size of an exploded list for that of its arrays' default.
SHORT_LIST = 100_000

NOT_COLLECTED = "page not collected"
BROKEN_URL = "Invalid IPv6 URL"


def utc_now():
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def _payload_columns(payload, title):
    """Product columns read from a payload."""
    name = P.text_of(payload, "name")
    return {
        "product_id": P.text_of(payload, "product_id"),
        "product_name": F.when(P.has_value(payload, "name"), name).otherwise(title),
        "name": name,
        "sku": P.text_of(payload, "sku"),
        "category": P.value_of(payload, "category"),
        "category_name": P.text_of(payload, "category_name"),
        "price": P.value_of(payload, "price"),
        "currency": P.currency_of(payload),
        "store_code": P.text_of(payload, "store_code"),
        "react_data_basic": P.basic_payload(payload),
        "react_data": payload,
    }


def classify_pages(pages, stores, stamp=True):
    """One product row per page, with the reason where the page is not the product.

    Needs ``requested_product_id``, ``source_url`` and ``html``; may have ``status_code``,
    ``resolved_url``, ``crawl_url_strategy``, ``original_url`` and ``attempts``.
    """
    known = set(pages.columns)

    def given(name, default):
        return F.col(name) if name in known else default

    read = pages.withColumns(
        {
            "_payload": F.coalesce(P.page_payload(F.col("html")), F.parse_json(F.lit("{}"))),
            "_title": P.page_title(F.col("html")),
            "_code": given("status_code", F.lit(200)),
        }
    )
    payload, code = F.col("_payload"), F.col("_code")
    same = P.is_requested(P.text_of(payload, "product_id"), F.col("requested_product_id"))
    read = read.withColumns(
        {"_same": same, "_useful": P.is_useful(payload), "_found": P.is_filled_object(payload)}
    )
    active = (code == 200) & F.col("_same") & F.col("_useful")
    http = F.concat(F.lit("http_"), code.cast("string"))
    resolved = first_filled(given("resolved_url", F.lit(None).cast("string")), F.col("source_url"))
    rows = read.withColumns(
        {
            "original_url": first_filled(given("original_url", F.lit(None).cast("string")), F.col("source_url")),
            "resolved_url": resolved,
            "country_store": country_store(resolved, stores),
            "active": active,
            "scraped_at": utc_now() if stamp else F.lit(None).cast("string"),
            "status": F.when(active, OK).otherwise(http),
            "failure_reason": F.when(code != 200, http)
            .when(~F.col("_found"), "react_data_not_found")
            .when(~F.col("_same"), "product_id_mismatch")
            .when(~F.col("_useful"), "missing_basic_product_fields"),
            **_payload_columns(payload, F.col("_title")),
        }
    )
    return shaped(rows, PRODUCT_INFO)


def page_features(pages, order=None):
    """What resolving needs to know of each page, read from the HTML where the page is scanned.

    The HTML stays behind: only a page that can be a hit carries its payload into the shuffle. With
    ``order`` only the last copy of each URL is kept, chosen before and after the shuffle.
    """
    kept = ["url", "resolved_url", "status_code"] + ([order] if order else [])
    read = pages.select(*kept, "html").withColumns(
        {"_payload": P.page_payload(F.col("html")), "_title": P.page_title(F.col("html"))}
    )
    can_hit = F.coalesce((F.col("status_code") == 200) & P.is_useful(F.col("_payload")), F.lit(False))
    features = read.select(
        "url",
        blank_to_null(F.col("resolved_url")).alias("resolved_url"),
        "status_code",
        F.col("_payload").isNotNull().alias("found"),
        P.text_of(F.col("_payload"), "product_id").alias("found_id"),
        can_hit.alias("can_hit"),
        F.when(can_hit, F.col("_payload")).alias("payload"),
        F.when(can_hit, F.col("_title")).alias("title"),
        *([order] if order else []),
    )
    if not order:
        return features
    # Stored, so that a join by URL reads it through a shuffle of its own and can split hot URLs.
    ties = [F.col("can_hit").desc(), F.col("found").desc(), "status_code", "resolved_url", "found_id", F.to_json("payload")]
    return stored(best_per_group(features, ["url"], [F.col(order).desc(), *ties]).drop(order), "pages")


def target_attempts(targets, stores, strategy=None):
    """Adds ``attempts``, the array of (url, strategy) to try; null where the URL cannot be read.

    ``strategy(product_id, source_url, host, stores)`` may replace the built-in order.
    """
    build = strategy or url_choices
    hosted = targets.select("product_id", "candidate_url", url_host(F.col("candidate_url")).alias("_host"))
    choices = build(F.col("product_id"), F.col("candidate_url"), F.col("_host"), stores)
    chosen = hosted.withColumn("_choices", F.when(~is_broken_host(F.col("_host")), choices))
    return chosen.select("product_id", "candidate_url", first_of_each_url(F.col("_choices")).alias("attempts"))


def _exploded(planned):
    # The outer form, as Spark would otherwise build the list once more to filter on its size.
    return planned.select(
        "product_id", "candidate_url", F.posexplode_outer("attempts").alias("place", "attempt")
    ).filter("attempt.url IS NOT NULL").select(
        "product_id",
        "candidate_url",
        (F.col("place") + 1).alias("attempt_no"),
        F.col("attempt.url").alias("url"),
        F.col("attempt.strategy").alias("strategy"),
    )


def exploded_attempts(targets, stores, strategy=None):
    """One row per target and URL to try, numbered from 1."""
    return _exploded(target_attempts(targets, stores, strategy))


def _stored_attempts(targets, stores, strategy):
    """``target_attempts``, built once for both of its readers and stored, and the number of attempts."""
    planned = target_attempts(targets, stores, strategy).withColumns(
        {
            "candidate_url": F.col("candidate_url").cast("string"),
            "attempts": F.transform(
                "attempts", lambda a: F.struct(*[a[name].cast("string").alias(name) for name in ("url", "strategy")])
            ),
        }
    )
    planned, written = counted(planned, "attempts", attempts=F.sum(F.size("attempts")))
    return stored(planned, "attempts"), rows_of(written)["attempts"]


def _step(**known):
    """An entry of the attempts column; fields that are not given are null."""
    return F.struct(
        *[
            known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in ATTEMPT
        ]
    )


def resolve_products(targets, pages, stores, strategy=None, stamp=True, page_order=None):
    """For each target the first attempted page that is the product, or the reason for none.

    Of repeated targets the one with the first URL counts. Where the page table holds several copies of a URL,
    ``page_order`` names the column whose largest value counts; without it, and for equal values, a copy that can be the
    product goes first, then one with a payload, then the order of status code and addresses.
    """
    return resolve_from_features(targets, page_features(pages, page_order), stores, strategy, stamp)


def resolve_from_features(targets, features, stores, strategy=None, stamp=True):
    """``resolve_products`` for pages that were read by ``page_features``.

    Pages and attempts meet in an inner join, so that Spark may send a short list of attempts to the
    pages, or drop pages nobody asks for before they are shuffled. What was not met is known from
    the attempt list itself, which is stored and counted first: a longer one is never broadcast. A URL that many targets
    share is a skewed key of that join, which the adaptive skew join splits; per product there are never more rows than
    entries in the list.
    """
    planned, attempt_count = _stored_attempts(targets, stores, strategy)
    attempts = _exploded(planned)
    if attempt_count > SHORT_LIST:
        attempts, features = attempts.hint("merge"), features.hint("merge")
    met = attempts.join(features, "url")
    same, hit_no, final_url = F.col("same"), F.col("hit_no"), F.col("final_url")
    met = met.withColumns(
        {
            "same": F.col("found") & P.is_requested(F.col("found_id"), F.col("product_id")),
            "final_url": F.coalesce("resolved_url", "url"),
        }
    ).withColumn("hit_no", F.when(F.col("can_hit") & same, F.col("attempt_no")))
    step = _step(
        url=F.col("url"),
        resolved_url=final_url,
        strategy=F.col("strategy"),
        status_code=F.col("status_code"),
        react_data_found=F.col("found"),
        product_id_matches=same,
    )
    page = F.struct("url", final_url.alias("resolved_url"), "strategy", "payload", "title")
    # One copy of each page: the first in the order of the copies, of which there are as many as the page table holds.
    place = F.struct(
        hit_no.isNull().alias("miss"), (~F.col("found")).alias("empty"), "status_code", "final_url", "found_id",
        F.coalesce("title", F.lit("")).alias("title"), F.coalesce(F.to_json("payload"), F.lit("")).alias("payload"),
    )
    copies = met.select(
        "product_id", "candidate_url", "attempt_no", place.alias("place"), step.alias("step"), hit_no.alias("hit_no"),
        F.when(hit_no.isNotNull(), page).alias("page"),
    ).groupBy("product_id", "candidate_url", "attempt_no").agg(
        F.min_by("step", "place").alias("step"), F.min("hit_no").alias("hit_no"), F.min_by("page", "place").alias("page")
    )
    seen = copies.groupBy("product_id", F.col("candidate_url").alias("tried_url")).agg(
        F.min("hit_no").alias("hit_no"),
        F.min_by("page", "hit_no").alias("page"),
        F.map_from_entries(F.collect_list(F.struct("attempt_no", "step"))).alias("steps"),
    )
    first = F.min(F.struct(F.coalesce("candidate_url", F.lit("")), "candidate_url", "attempts")).alias("first")
    planned = planned.groupBy("product_id").agg(first).select("product_id", "first.candidate_url", "first.attempts")
    outcome = planned.withColumnRenamed("attempts", "plan").join(
        seen.withColumnRenamed("product_id", "tried_id"),
        (F.col("product_id") == F.col("tried_id")) & (F.col("candidate_url") == F.col("tried_url")),
        "left",
    )
    tried = F.slice("plan", 1, F.coalesce("hit_no", F.size("plan")))

    def outcome_of(attempt, place):
        missed = _step(
            url=attempt["url"],
            strategy=attempt["strategy"],
            status=F.lit(REQUEST_FAILED),
            error_message=F.lit(NOT_COLLECTED),
        )
        return F.coalesce(F.try_element_at("steps", place + 1), missed)

    found, broken = F.col("hit_no").isNotNull(), F.col("plan").isNull()
    miss = F.when(broken, CRAWL_FAILED).otherwise(NOT_FOUND)
    no_steps = F.array().cast(T.ArrayType(ATTEMPT))
    failures = F.filter("attempts", lambda step: step["error_message"].isNotNull())
    last_error = F.try_element_at(failures, F.lit(-1))["error_message"]
    rows = outcome.withColumn("attempts", F.coalesce(F.transform(tried, outcome_of), no_steps)).withColumns(
        {
            "requested_product_id": F.col("product_id"),
            "source_url": F.when(found, F.col("page.url")).otherwise(F.col("candidate_url")),
            "original_url": F.col("candidate_url"),
            "resolved_url": F.col("page.resolved_url"),
            "country_store": country_store(F.col("page.resolved_url"), stores),
            "crawl_url_strategy": F.col("page.strategy"),
            "active": found,
            "scraped_at": utc_now() if stamp else F.lit(None).cast("string"),
            "status": F.when(found, OK).otherwise(miss),
            "failure_reason": F.when(~found, miss),
            "error_message": F.when(broken, BROKEN_URL).when(~found, last_error),
            **_payload_columns(F.col("page.payload"), F.col("page.title")),
        }
    )
    no_payload = F.parse_json(F.lit("{}"))
    rows = rows.withColumns(
        {
            "react_data_basic": F.when(found, F.col("react_data_basic")).otherwise(no_payload),
            "react_data": F.coalesce("react_data", no_payload),
        }
    )
    return shaped(rows, PRODUCT_INFO)
