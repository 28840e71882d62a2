"""Resumable crawl as a stream: target files come in, each product is resolved once."""

from functools import cache

from pyspark.sql import functions as F

from clickmart.metrics import BatchCounts
from clickmart.operators.pages import OK, page_features, resolve_from_features
from clickmart.operators.targets import best_target_key, valid_targets
from clickmart.schemas import PRODUCT_INFO, TARGETS, as_strings
from clickmart.session import prepare_session, stored
from clickmart.sources.readers import CSV_OPTIONS
from clickmart.sources.writers import write_jsonl

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_target_stream(spark, path, **options):
    """Target CSV files as they arrive."""
    return spark.readStream.schema(as_strings(TARGETS)).options(**CSV_OPTIONS, **options).csv(path)


def new_products(targets):
    """A streaming frame with one row per product when its first valid target comes in, the best one of that batch.

    The state has one row per product: when it was first seen and its best target then. Time is that of the batch, which a
    repeated batch keeps, so a product is new in one batch only, also after a restart. Used in update mode.
    """
    now = F.current_timestamp()
    valid = valid_targets(targets).select("product_id", best_target_key().alias("best"), now.alias("at"))
    seen = valid.groupBy("product_id").agg(
        F.min(F.struct("at", "best")).alias("first"), F.max("at").alias("last_at")
    )
    fresh = F.col("first.at") == F.col("last_at")
    return seen.select("product_id", "first.best.candidate_url", fresh.alias("is_new"))


def crawl_stream(targets, pages, stores, output_path, checkpoint_path, strategy=None, page_order=None, counts_path=None):
    """Resolves new targets and stops when all input is read. Run again to go on.

    Which products are done is keyed state in the checkpoint (on disk, by RocksDB), so a batch costs what it brings in,
    whatever was crawled before, and no earlier output is read. The pages are parsed once a run, by its first batch, and what
    was read of them is stored for the others. The rows of a batch go to a folder of their own, which a
    repeated batch replaces: a restart after a loss neither loses nor doubles rows. With ``counts_path`` the rows of each batch
    and the products found are counted while they are written, and stored there (``metrics.BatchCounts``).
    """
    targets.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    @cache
    def features():
        return stored(page_features(pages, page_order), "features")

    def write(batch, batch_id):
        spark = prepare_session(batch.sparkSession)
        wanted = batch.filter("is_new").select("product_id", "candidate_url")
        found = resolve_from_features(wanted, features(), stores, strategy)

        def save(rows):
            write_jsonl(rows, f"{output_path}/batch_id={batch_id}")

        if counts_path:
            BatchCounts(spark, counts_path).write(found, batch_id, save, ok=F.count_if(F.col("status") == OK))
        else:
            save(found)

    return (
        new_products(targets)
        .writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_crawl_stream(spark, output_path):
    return spark.read.schema(PRODUCT_INFO).json(output_path)
