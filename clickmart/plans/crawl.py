"""Job: targets and collected pages to product rows, with resume and a failure report."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clickmart.metrics import counted, rows_of
from clickmart.operators import crawl_log as log_ops
from clickmart.operators.pages import resolve_products
from clickmart.operators.targets import best_targets_first
from clickmart.plans.counters import CrawlCounters
from clickmart.schemas import FAILED_TARGET_FIELDS, PRODUCT_INFO
from clickmart.session import prepare_session, stored
from clickmart.sources.readers import read_jsonl_tolerant, with_file_order
from clickmart.sources.writers import finish_summary, write_csv, write_jsonl


def _exists(spark, path):
    try:
        read_jsonl_tolerant(spark, path, PRODUCT_INFO)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_log(spark, path):
    """A crawl output with its order: by the time stamp of each row, then by its place in the files.

    An appended run writes further files, whose names do not follow the order of the runs.
    """
    rows = with_file_order(read_jsonl_tolerant(spark, path, PRODUCT_INFO), "_place")
    return rows.withColumn("seq", F.struct("scraped_at", "_place")).drop("_place")


def stored_log(spark, path):
    """The log without its payloads, parsed once and kept for the counts and the report."""
    payloads = ["react_data_basic", "react_data", "category", "price"]
    return stored(read_log(spark, path).drop(*payloads), "log")


def run(
    targets,
    pages,
    stores,
    output_path,
    failed_path=None,
    limit=None,
    resume=False,
    strategy=None,
    page_order=None,
    summary_path=None,
    counts_path=None,
    counters_path=None,
):
    """Resolves the targets, adds them to the log at ``output_path`` and returns the run summary.

    With ``resume`` targets that have a row in the log are left out and the new rows are appended. Stores may be many
    (any other host is one), so their counts, like those per status, are tables below ``counts_path``. With ``counters_path`` the counters of all runs are kept there: which products
    are done and what the log adds up to is then read from them, and only rows of this run are counted.
    """
    spark = prepare_session(targets.sparkSession)
    started = time.monotonic()
    wanted = stored(best_targets_first(targets, limit), "targets")
    resuming = resume and _exists(spark, output_path)
    before = {"row_count": 0, "invalid_line_count": 0}
    done = None
    pending = wanted
    counters, number = None, 0
    if counters_path:
        counters = CrawlCounters(spark, counters_path)
        if not resuming and counters.next_run():
            raise ValueError("counters_path has the counters of another crawl; resume that one or take a new path")
        if resuming and not counters.next_run():
            counters.add(stored_log(spark, output_path), 0)
        number = counters.next_run()
    if resuming and counters:
        before = counters.checkpoint_summary().first().asDict()
        pending = wanted.join(counters.product_ids(), "product_id", "left_anti")
    elif resuming:
        log = stored_log(spark, output_path)
        before = log_ops.checkpoint_summary(log).first().asDict()
        done = stored(
            log_ops.logged(log).selectExpr("requested_product_id AS product_id").distinct(), "done"
        )
        pending = wanted.join(done, "product_id", "left_anti")
    found = resolve_products(pending, pages, stores, strategy, page_order=page_order)
    if counters:
        found = stored(found, "crawled")
    write_jsonl(found, output_path, mode="append" if resuming else "overwrite")

    log = stored_log(spark, output_path)
    if counters:
        counters.add(found, number)
        totals = counters.totals(wanted, number).first().asDict()
    else:
        totals = log_ops.crawl_totals(log, wanted, done).first().asDict()
    failed = log_ops.failed_targets(log, wanted)
    if failed_path:
        report, written = counted(failed.orderBy("product_id"), "failed_targets")
        write_csv(report, failed_path, FAILED_TARGET_FIELDS)
        failed_count = rows_of(written)["rows"]
    else:
        failed_count = failed.count()
    if counts_path:
        rows = log_ops.logged(log)
        status = counters.status_counts() if counters else log_ops.status_counts(rows)
        store = counters.country_store_counts() if counters else log_ops.country_store_counts(rows)
        write_jsonl(status, f"{counts_path}/status_counts")
        write_jsonl(store, f"{counts_path}/country_store_counts")
    summary = {
        "stage": "crawl_products",
        "resume": resume,
        "output": output_path,
        "failed_output": failed_path,
        **totals,
        "checkpoint_row_count": before["row_count"],
        "checkpoint_invalid_line_count": before["invalid_line_count"],
        "processed_this_run_count": totals["processed_count"] - before["row_count"],
        "failed_target_count": failed_count,
        "counts": counts_path,
    }
    return finish_summary(spark, summary, started, summary_path)
