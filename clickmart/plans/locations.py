"""Job: events to located visitor addresses."""

import time

from clickmart.metrics import counted, rows_of
from clickmart.operators import ips as ip_ops
from clickmart.session import prepare_session, stored
from clickmart.sources.writers import finish_summary, write_jsonl, write_table


def run(
    events,
    output_path,
    order_key,
    ranges=None,
    v6_ranges=None,
    target_ids=None,
    ip_field="ip",
    limit=None,
    discovery_mode="scan",
    allow_private=False,
    table=None,
    counts_path=None,
    summary_path=None,
    nested=False,
):
    """Writes one located row per distinct address, the counts, and returns the run summary.

    With ``target_ids`` only addresses of events of those products are taken. ``table`` also gets the
    rows, one per address. Addresses are made distinct before any lookup. ``nested`` as in ``locate``.
    """
    spark = prepare_session(events.sparkSession)
    started = time.monotonic()
    scope = {"discovery_scope": "all_collection_ips", "ip_discovery_mode": discovery_mode}
    if target_ids is not None:
        scope["discovery_scope"] = "product_target_events"
        scope["product_target_id_count"] = target_ids.select("product_id").distinct().count()
        scope |= ip_ops.target_event_ip_stats(events, target_ids, order_key, ip_field, limit).first().asDict()
        found = ip_ops.target_event_ips(events, target_ids, order_key, ip_field, limit).select("ip")
    else:
        scope |= ip_ops.ip_record_count(events, ip_field).first().asDict()
        found = ip_ops.distinct_ips(events, order_key, ip_field, limit, discovery_mode)
    located = ip_ops.locate(found, ranges, v6_ranges, allow_private, nested=nested)
    # Stored once; the outputs and the counts read this small result.
    located = stored(located, "locations")
    rows, written = counted(located, "ip_locations_written")
    write_jsonl(rows, output_path)
    table_rows = None
    if table is not None:
        kept, table_written = counted(ip_ops.newest_per_key(located, "ip", "processed_at"), "ip_table_rows")
        write_table(kept, table)
        table_rows = rows_of(table_written)["rows"]
    if counts_path is not None:
        # Locations may be many, so their counts are a table of their own.
        write_jsonl(ip_ops.location_counts(located), f"{counts_path}/location_counts")
        write_jsonl(ip_ops.country_counts(located), f"{counts_path}/country_counts")
        write_jsonl(ip_ops.status_counts(located), f"{counts_path}/status_counts")
    source_count = rows_of(written)["rows"]
    summary = {
        "stage": "process_ip_locations",
        "output": output_path,
        **scope,
        "source_ip_count": source_count,
        "ip_count": source_count,
        **ip_ops.ip_totals(located).first().asDict(),
        "remaining_count": max(limit - source_count, 0) if limit else None,
        "table": table,
        "table_written_count": table_rows,
        "status_counts": {row["status"]: row["rows"] for row in ip_ops.status_counts(located).collect()},
    }
    return finish_summary(spark, summary, started, summary_path)
