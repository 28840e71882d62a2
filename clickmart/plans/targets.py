"""Job: events to ranked product URL targets."""

import time

from clickmart.metrics import counted, rows_of
from clickmart.operators.events import candidate_groups, candidates, event_count, product_events
from clickmart.operators.targets import group_stats, limited_product_events, ranked_targets
from clickmart.schemas import TARGETS
from clickmart.session import prepare_session, stored
from clickmart.sources.writers import finish_summary, writer_for


def run(
    events,
    output_path,
    fmt="csv",
    mode="raw",
    include_all=False,
    limit=None,
    order_key=None,
    keep=None,
    summary_path=None,
):
    """Writes the targets in product and rank order and returns the run summary.

    ``keep`` is a condition on ranked rows that replaces best-only or all.
    """
    write = writer_for(fmt, "product target output")
    spark = prepare_session(events.sparkSession)
    started = time.monotonic()
    # The groups are a small part of the events. Stored once, ranking and counting read only them.
    groups = stored(candidate_groups(candidates(limited_product_events(events, limit, order_key), mode)), "groups")
    ordered = ranked_targets(groups, include_all, keep).orderBy("product_id", "url_rank")
    targets, written = counted(ordered, "product_targets_written")
    write(targets, output_path, TARGETS.fieldNames())
    counts = group_stats(groups, include_all).first().asDict()
    counts["target_rows"] = rows_of(written)["rows"]
    scanned = event_count(product_events(events)).first()["event_count"]
    summary = {
        "stage": "extract_product_targets",
        "aggregation_mode": mode,
        "output": output_path,
        "output_mode": "all_ranked_candidates" if include_all else "one_best_target_per_product",
        "include_all_candidates": include_all,
        "scanned_records": min(scanned, limit) if limit else scanned,
        **counts,
    }
    return finish_summary(spark, summary, started, summary_path)
