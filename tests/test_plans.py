"""The shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from checks import derive as D
from checks.queries import QUERIES, STORES
from clickmart.functions.urls import Stores
from clickmart.operators import pages, targets
from clickmart.session import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ip_upsert_stream", "export_counts"}))
def test_no_pairwise_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(targets.extract_targets(D.event_records(spark, sf_dir)))
    assert re.search(r"PushedFilters: \[In\(collection", text)
    assert "ip:string" not in text and "user_id" not in text


def test_best_keeps_one_row_per_product_before_the_shuffle(spark, sf_dir):
    text = plan(targets.extract_targets(D.event_records(spark, sf_dir)))
    assert re.search(r"WindowGroupLimit \[product_id#\d+\].*Partial", text)


def test_html_is_not_shuffled(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(pages.resolve_products(D.part_targets(spark, sf_dir), D.page_snapshot(spark, sf_dir), STORES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    # The column is gone above the project that reads it.
    assert all("html#" not in line for line in text.splitlines() if "Exchange" in line or "Sort " in line)


def test_a_long_list_of_attempts_is_not_broadcast(spark):
    """Spark takes the exploded list for a small one, whatever it holds; a short list may still be sent to the pages."""
    collected = stored(
        spark.range(300_000).selectExpr("concat('https://x/', id) AS url", "'' AS resolved_url", "200 AS status_code", "uuid() AS html"),
        "pages",
    )

    def planned(count):
        rows = spark.range(count).selectExpr("cast(id AS string) AS product_id", "concat('https://x/', id) AS candidate_url")
        return pages.resolve_products(rows, collected, STORES)

    assert "BroadcastHashJoin" in plan(planned(10))
    found = planned(40_000)
    assert "BroadcastHashJoin" not in plan(found) and "SortMergeJoin" in plan(found)
    assert found.filter("attempts[0].status_code = 200").count() == 40_000


def test_shared_url_is_split(spark):
    """With small thresholds the adaptive plan splits the partition of the shared URL."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 40_000, 1, 6).select(
            F.col("id").cast("string").alias("product_id"),
            F.when(F.col("id") % 3 > 0, "https://hot/").otherwise(F.concat(F.lit("https://x/"), "id")).alias("candidate_url"),
        )
        collected = stored(
            rows.select(F.col("candidate_url").alias("url")).distinct().selectExpr(
                "url", "cast(NULL as string) AS resolved_url", "200 AS status_code", "'' AS html"
            ),
            "pages",
        )
        found = pages.resolve_products(rows, collected, Stores("shop", (), ()))
        assert found.count() == 40_000
        assert found.selectExpr("sum(attempts[0].status_code)").first()[0] == 200 * 40_000
        narrow = found.selectExpr("attempts[0].status_code AS code")
        narrow.collect()
        assert "isSkew=true" in plan(narrow) or "skew=true" in plan(narrow)
    finally:
        for key in settings:
            spark.conf.unset(key)
