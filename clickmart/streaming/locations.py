"""Keyed upsert of located addresses by micro-batch."""

from pyspark.sql import functions as F

from clickmart.operators.ips import distinct_normalized_ips, locate
from clickmart.session import prepare_session
from clickmart.sources.keyed_table import KeyedTable


def location_table(spark, output_path, **settings):
    """The table of located addresses, one row per address."""
    return KeyedTable(spark, output_path, "ip", **settings)


def location_stream(events, order_key, output_path, checkpoint_path, ranges=None, v6_ranges=None, nested=False, **settings):
    """Locates the addresses of new events and merges them into a table; stops when all input is read.

    What a batch writes follows the batch and not the table, and a batch that is repeated after a loss changes nothing.
    """

    def write(batch, batch_id):
        spark = prepare_session(batch.sparkSession)
        found = distinct_normalized_ips(batch, order_key).select("ip")
        location_table(spark, output_path, **settings).merge(locate(found, ranges, v6_ranges, nested=nested), batch_id)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def current_locations(spark, output_path):
    """One row per address, the one of the last batch that had it."""
    return location_table(spark, output_path).read()
