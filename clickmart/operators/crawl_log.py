"""The crawl log: one row per crawled product and run, later rows replace earlier ones."""

from pyspark.sql import functions as F

from clickmart.functions.text import first_filled, percentage
from clickmart.operators.pages import OK
from clickmart.operators.ranking import best_per_group
from clickmart.schemas import FAILED_TARGET_FIELDS
from clickmart.sources.readers import BAD_LINE

# A row without a status is counted under this word.
NO_STATUS = "None"


def _status():
    return F.coalesce(F.col("status"), F.lit(NO_STATUS))


def is_bad_line(log):
    return F.col(BAD_LINE).isNotNull() if BAD_LINE in log.columns else F.lit(False)


def logged(log, targets=None):
    """Readable log rows that name a product; only those of ``targets`` where given."""
    rows = log.filter(F.col("requested_product_id").isNotNull())
    if targets is None:
        return rows
    wanted = targets.select(F.col("product_id").alias("requested_product_id")).distinct()
    return rows.join(wanted, "requested_product_id", "left_semi")


def latest_rows(log, order="seq", targets=None):
    """Last row of each product."""
    return best_per_group(logged(log, targets), ["requested_product_id"], [F.col(order).desc()])


def checkpoint_summary(log, targets=None):
    """Distinct products, rows, ok rows, active rows, and lines that could not be read.

    Counted per product first, so no task has to hold all product ids.
    """
    named = F.col("requested_product_id").isNotNull()
    bad = ~named & is_bad_line(log)
    per_product = log.filter(named | bad).groupBy("requested_product_id").agg(
        F.count_if(named).alias("rows"),
        F.count_if(named & (F.col("status") == OK)).alias("ok"),
        F.count_if(named & F.col("active")).alias("active"),
        F.count_if(bad).alias("bad"),
    )
    if targets is not None:
        wanted = targets.select(
            F.col("product_id").alias("requested_product_id"), F.lit(True).alias("_wanted")
        ).distinct()
        per_product = per_product.join(wanted, "requested_product_id", "left").filter(
            F.col("_wanted") | (F.col("bad") > 0)
        )

    def total(name):
        return F.coalesce(F.sum(name), F.lit(0))

    return per_product.agg(
        F.count_if(F.col("rows") > 0).alias("product_count"),
        total("rows").alias("row_count"),
        total("ok").alias("ok_count"),
        total("active").alias("active_count"),
        total("bad").alias("invalid_line_count"),
    )


def status_counts(log):
    return log.groupBy(_status().alias("status")).agg(F.count(F.lit(1)).alias("rows"))


def filled_counts(df, column):
    """Rows per value of a column; null and empty are left out."""
    return df.filter(F.col(column) != "").groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def country_store_counts(log):
    return filled_counts(log, "country_store")


def pending_targets(targets, log):
    """Targets without any row in the log, whatever its status."""
    done = log.select(F.col("requested_product_id").alias("product_id")).distinct()
    return targets.join(done, "product_id", "left_anti")


def failed_targets(log, targets, order="seq", target_order=None):
    """Targets whose last crawl did not succeed, with the reason.

    Only targets with a log row are in it. Of targets that share an id the last by ``target_order``
    counts.
    """
    wanted = targets.filter(F.col("product_id") != "")
    pick = [F.col(target_order).desc()] if target_order else [F.col("candidate_url").desc()]
    wanted = best_per_group(wanted, ["product_id"], pick).select("product_id", "candidate_url")
    last = latest_rows(log, order).filter(~F.col("status").eqNullSafe(OK))
    joined = last.drop("product_id").join(wanted, F.col("requested_product_id") == F.col("product_id"))
    return joined.select(
        "product_id",
        first_filled(
            F.col("candidate_url"), F.col("original_url"), F.coalesce(F.col("source_url"), F.lit(""))
        ).alias("candidate_url"),
        F.col("status").alias("last_status"),
        "failure_reason",
        "error_message",
        F.coalesce(F.size("attempts"), F.lit(0)).alias("attempt_count"),
        F.col("source_url").alias("last_source_url"),
        F.col("resolved_url").alias("last_resolved_url"),
        "scraped_at",
    ).select(*FAILED_TARGET_FIELDS)


def crawl_totals(log, targets, done_before=None):
    """Counts and rates of a crawl over its whole log, as one row.

    ``done_before`` holds the ids that were in the log before this run; by default none were.
    One row per product is built from both sides first, then summed.
    """
    per_product = log.filter(F.col("requested_product_id").isNotNull()).groupBy(
        F.col("requested_product_id").alias("product_id")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("status") == OK).alias("ok"),
        F.count_if(F.col("active")).alias("active"),
    )
    wanted = targets.select("product_id").distinct().withColumn("is_target", F.lit(True))
    both = per_product.join(wanted, "product_id", "full")
    if done_before is None:
        both = both.withColumn("was_done", F.lit(False))
    else:
        before = done_before.select("product_id").distinct().withColumn("was_done", F.lit(True))
        both = both.join(before, "product_id", "left")
    return summed_up(both)


def summed_up(both):
    """Counts and rates of a crawl from one row per product: rows, ok, active, was_done and is_target, any of them null."""
    was_done = F.coalesce("was_done", F.lit(False))
    is_target = F.coalesce("is_target", F.lit(False))
    crawled = F.col("rows").isNotNull()

    def total(name):
        return F.coalesce(F.sum(name), F.lit(0))

    sums = both.agg(
        F.count_if(is_target).alias("target_count"),
        F.count_if(is_target & ~was_done).alias("pending_target_count"),
        F.count_if(is_target & was_done).alias("skipped_checkpoint_count"),
        F.count_if(is_target & ~was_done & ~crawled).alias("remaining_count"),
        total("rows").alias("processed_count"),
        total("ok").alias("ok_count"),
        total("active").alias("active_count"),
    )
    return sums.withColumns(
        {
            "success_rate_processed_percent": percentage(F.col("ok_count"), F.col("processed_count")),
            "success_rate_target_percent": percentage(F.col("ok_count"), F.col("target_count")),
        }
    )
