"""Job: product rows to a flat warehouse output and an archive of raw payloads."""

import time

from clickmart.metrics import counted, rows_of
from clickmart.operators.export import payload_archive, warehouse_products
from clickmart.session import prepare_session
from clickmart.sources.writers import finish_summary, write_jsonl, writer_for


def export_warehouse(products, path, fmt="csv", columns=None):
    """Writes the warehouse rows and returns their number."""
    write = writer_for(fmt, "product export")
    rows, written = counted(warehouse_products(products, columns), "warehouse_rows")
    write(rows, path)
    return rows_of(written)["rows"]


def export_archive(products, path, columns=None):
    """Writes the payload rows and returns their number."""
    rows, written = counted(payload_archive(products, columns), "archive_rows")
    write_jsonl(rows, path)
    return rows_of(written)["rows"]


def run(
    products, warehouse_path, warehouse_fmt="csv", archive_path=None, summary_path=None, on_event=None
):
    """Both outputs from one input.

    The warehouse rows say whether there is a payload, so each write reads the payloads once; keeping the wide rows of a
    large crawl between the two would cost more than the second read. ``on_event(name, counts)`` is told when the job
    starts, after each output, and when it is done.
    """
    writer_for(warehouse_fmt, "product export")
    tell = on_event or (lambda name, counts: None)
    spark = prepare_session(products.sparkSession)
    started = time.monotonic()
    tell("product_export_started", {})
    counts = {"warehouse_rows": export_warehouse(products, warehouse_path, warehouse_fmt), "react_data_rows": 0}
    tell("product_export_progress", dict(counts))
    if archive_path is not None:
        counts["react_data_rows"] = export_archive(products, archive_path)
        tell("product_export_progress", dict(counts))
    tell("product_export_completed", dict(counts))
    return finish_summary(spark, {"stage": "export_products", **counts}, started, summary_path)
