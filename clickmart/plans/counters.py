"""Counters of a crawl that go on over its runs, without counting earlier rows again."""

from pyspark.sql import functions as F

from clickmart.operators import crawl_log as log_ops
from clickmart.operators.pages import OK
from clickmart.sources.keyed_table import KeyedTable

COUNTS = ["rows", "ok", "active"]


class CrawlCounters:
    """What the log of a crawl adds up to, as two keyed tables: one row per product, one per status, store and kind of line.

    A run adds its own rows. Product ids are kept exactly, split by their hash, so distinct counts are exact too. A run that
    is added again under its number changes nothing, also after a loss between the two tables.
    """

    def __init__(self, spark, path, **settings):
        self.products = KeyedTable(spark, f"{path}/products", "product_id", **settings)
        self.sums = KeyedTable(spark, f"{path}/sums", "name", **settings | {"splits": 1})
        self.spark = spark

    def next_run(self):
        """The number of the run after the last one that was added whole."""
        last = self.sums.manifest()["batch"]
        return 0 if last is None else last + 1

    def add(self, rows, run):
        """Adds the log rows of one run (and of no other), with their unreadable lines where the reader keeps them."""
        named = F.col("requested_product_id").isNotNull()
        new = log_ops.logged(rows).groupBy(F.col("requested_product_id").alias("product_id"))
        new = new.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") == OK).alias("ok"), F.count_if("active").alias("active"))
        self._add_up(self.products, new.withColumn("first_run", F.lit(run).cast("bigint")), run, ["rows", "ok", "active"])

        names = F.array(
            F.when(named, F.concat(F.lit("status:"), F.coalesce("status", F.lit(log_ops.NO_STATUS)))),
            F.when(named & (F.col("country_store") != ""), F.concat(F.lit("store:"), F.col("country_store"))),
            F.when(~named & log_ops.is_bad_line(rows), F.lit("bad line")),
        )
        sums = rows.select(F.explode(F.array_compact(names)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
        self._add_up(self.sums, sums, run, ["rows"])

    def _add_up(self, table, new, run, counts):
        """Merges new counts, each added to what the table has for its key; other columns keep their first value."""
        old = table.read()
        if old is not None:
            was = old.select(F.col(table.key).alias("_key"), *[F.col(name).alias(f"_{name}") for name in new.columns if name != table.key])
            both = new.join(was, F.col(table.key) == F.col("_key"), "left")
            kept = [
                F.col(name) + F.coalesce(f"_{name}", F.lit(0)) if name in counts else F.coalesce(f"_{name}", name)
                for name in new.columns[1:]
            ]
            new = both.select(table.key, *[column.alias(name) for column, name in zip(kept, new.columns[1:], strict=True)])
        table.merge(new, run)

    def _products(self):
        found = self.products.read()
        if found is None:
            found = self.spark.range(0).selectExpr("'' AS product_id", *[f"0L AS {name}" for name in (*COUNTS, "first_run")])
        return found

    def _sums(self, kind):
        found = self.sums.read()
        if found is None:
            found = self.spark.range(0).selectExpr("'' AS name", "0L AS rows")
        return found.filter(F.col("name").startswith(kind)).select(F.substring("name", len(kind) + 1, 1 << 30).alias("value"), "rows")

    def product_ids(self):
        return self._products().select("product_id")

    def status_counts(self):
        return self._sums("status:").withColumnRenamed("value", "status")

    def country_store_counts(self):
        return self._sums("store:").withColumnRenamed("value", "country_store")

    def checkpoint_summary(self):
        """What ``crawl_log.checkpoint_summary`` says of the whole log."""
        none = F.lit(0).cast("bigint")
        products = self._products().select(F.lit(1).cast("bigint").alias("product"), "rows", "ok", "active", none.alias("bad"))
        bad = self._sums("bad line").select(none, none, none, none, "rows")

        def total(name):
            return F.coalesce(F.sum(name), none)

        return products.unionAll(bad).agg(
            total("product").alias("product_count"),
            total("rows").alias("row_count"),
            total("ok").alias("ok_count"),
            total("active").alias("active_count"),
            total("bad").alias("invalid_line_count"),
        )

    def totals(self, targets, run):
        """What ``crawl_log.crawl_totals`` says of the whole log, for run ``run``: products of earlier runs were done before."""
        per_product = self._products().withColumn("was_done", F.col("first_run") < run)
        wanted = targets.select("product_id").distinct().withColumn("is_target", F.lit(True))
        return log_ops.summed_up(per_product.join(wanted, "product_id", "full"))
