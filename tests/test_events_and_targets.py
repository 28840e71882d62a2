import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators import events as E
from clickmart.operators import targets as R
from clickmart.operators.ranking import first_rows, running_rank

NAMES = [
    "event_type", "event", "collection", "product_id", "viewing_product_id", "current_url", "url",
    "referrer_url", "time_stamp",
]
SCHEMA = T.StructType(
    [T.StructField(name, T.LongType() if name == "time_stamp" else T.StringType()) for name in NAMES]
)


def records(spark, *rows):
    return spark.createDataFrame([tuple(row.get(name) for name in NAMES) for row in rows], SCHEMA)


def only(spark, mode="clean", **row):
    return E.candidates(records(spark, row), mode).collect()


def test_product_id_comes_first(spark):
    [row] = only(
        spark, event_type="view_product_detail", product_id="P100", viewing_product_id="P999", current_url="u"
    )
    assert (row.product_id, row.candidate_url, row.url_source_field) == ("P100", "u", "current_url")


def test_falls_back_to_viewing_id(spark):
    [row] = only(spark, event_type="add_to_cart_action", viewing_product_id="P200", current_url="u")
    assert row.product_id == "P200"


def test_quality_event_counts(spark):
    assert only(spark, event_type="select_product_option_quality", product_id="P", current_url="u")


def test_recommend_click_uses_viewing_id_and_referrer(spark):
    [row] = only(
        spark, event_type="product_view_all_recommend_clicked", product_id="P1", viewing_product_id="P300",
        current_url="c", referrer_url="r",
    )
    assert (row.product_id, row.candidate_url, row.url_source_field) == ("P300", "r", "referrer_url")


def test_type_from_collection_and_time_as_text(spark):
    [row] = only(spark, collection="View_Product_Detail", product_id="P", current_url="u", time_stamp=1718060000)
    assert (row.source_event_type, row.event_time) == ("view_product_detail", "1718060000")


def test_modes_differ(spark):
    rows = dict(collection="view_product_detail", event_type="other", product_id="P", current_url="u")
    assert len(only(spark, "raw", **rows)) == 1 and not only(spark, "clean", **rows)
    empty = dict(collection="view_product_detail", product_id="", viewing_product_id="V", current_url=" u ")
    assert not only(spark, "raw", **empty)
    [row] = only(spark, "clean", **empty)
    assert (row.product_id, row.candidate_url) == ("V", "u")
    words = dict(collection="view_product_detail", product_id="NULL", current_url="u")
    assert len(only(spark, "raw", **words)) == 1 and not only(spark, "clean", **words)
    alias = dict(collection="view_product_detail", product_id="P", current_url=" ", url="second")
    assert only(spark, "clean", **alias)[0].candidate_url == "second"
    assert only(spark, "raw", **alias)[0].candidate_url == " "


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        only(spark, "other", collection="x")


def test_product_event_filter(spark):
    found = E.product_events(
        records(
            spark,
            dict(collection="view_product_detail", current_url="u"),
            dict(collection="view_product_detail", current_url="", referrer_url="r"),
            dict(collection="view_product_detail", current_url=""),
            dict(collection="VIEW_PRODUCT_DETAIL", current_url="u"),
            dict(collection="view_home", current_url="u"),
            dict(collection="view_product_detail", url="u"),
        )
    )
    assert found.count() == 2


def views(*urls, product="P1"):
    return [dict(collection="view_product_detail", product_id=product, current_url=url) for url in urls]


def test_count_ranks_first(spark):
    ranked = R.extract_targets(records(spark, *views("a", "a", "b")), "clean", include_all=True)
    rows = {row.candidate_url: (row.event_count, row.url_rank) for row in ranked.collect()}
    assert rows == {"a": (2, 1), "b": (1, 2)}


def test_best_per_product(spark):
    rows = records(spark, *views("a", "a", "b"), *views("c", product="P2"))
    best = R.extract_targets(rows, "clean").orderBy("product_id").collect()
    assert [(r.product_id, r.candidate_url, r.url_rank) for r in best] == [("P1", "a", 1), ("P2", "c", 1)]


GROUPS = "product_id STRING, candidate_url STRING, source_event_type STRING, url_source_field STRING, event_count BIGINT, first_seen_at STRING, last_seen_at STRING"


def test_last_seen_breaks_ties_and_null_is_last(spark):
    groups = spark.createDataFrame(
        [("P", "a", "t", "s", 2, None, None), ("P", "b", "t", "s", 2, "5", "5"), ("P", "c", "t", "s", 2, "4", "10")],
        GROUPS,
    )
    ranked = R.ranked_targets(groups, include_all=True).orderBy("url_rank").collect()
    assert [row.candidate_url for row in ranked] == ["b", "c", "a"]
    kept = R.ranked_targets(groups, keep=F.col("url_rank") <= 2).count()
    assert kept == 2


def test_rank_of_one_product_that_spans_many_tasks(spark):
    """Half of all groups belong to one product; every rank has to be there once."""
    generator = random.Random(1)
    rows = [("hot", f"u{i}", "t", "s", generator.randint(1, 5), "1", str(generator.randint(1, 9))) for i in range(4000)]
    rows += [(f"P{i % 300}", f"u{i}", "t", "s", generator.randint(1, 5), "1", "2") for i in range(3000)]
    ranked = R.ranked_targets(spark.createDataFrame(rows, GROUPS), include_all=True).collect()
    by_product = {}
    for row in ranked:
        by_product.setdefault(row.product_id, []).append(row)
    assert len(ranked) == 7000
    for product, found in by_product.items():
        wanted = sorted(
            (r for r in rows if r[0] == product), key=lambda r: (-r[4], [-ord(c) for c in r[6]], r[1])
        )
        got = sorted(found, key=lambda r: r.url_rank)
        assert [r.url_rank for r in got] == list(range(1, len(wanted) + 1))
        assert [r.candidate_url for r in got] == [r[1] for r in wanted]


def test_target_stats(spark):
    ranked = spark.createDataFrame(
        [("P1", "a", 10, 1), ("P1", "b", 4, 2), ("P2", "c", 1, 1)],
        "product_id STRING, candidate_url STRING, event_count BIGINT, url_rank INT",
    )
    assert R.target_stats(ranked).first().asDict() == {
        "grouped_url_count": 3, "candidate_records": 15, "target_rows": 2, "unique_products": 2,
    }
    assert R.target_stats(ranked, include_all=True).first()["target_rows"] == 3


def test_stats_of_no_events(spark):
    empty = records(spark)
    assert R.extraction_stats(empty).first()["scanned_records"] == 0


def test_limit_zero_is_no_limit(spark):
    rows = records(spark, *views("a", "b", "c")).withColumn("n", F.monotonically_increasing_id())
    assert R.limited_product_events(rows, 0, "n").count() == 3
    assert R.limited_product_events(rows, 2, "n").count() == 2


def test_best_targets_first_and_pick(spark):
    rows = spark.createDataFrame(
        [("2", "", "9", "1"), ("2", "x", "1", "2"), ("10", "y", "1", None), ("10", "z", "5", None), (None, "w", "1", "1")],
        "product_id STRING, candidate_url STRING, event_count STRING, url_rank STRING",
    )
    first = R.best_targets_first(rows).orderBy("product_id").collect()
    assert [(r.product_id, r.candidate_url) for r in first] == [("10", "y"), ("2", "x")]
    pick = R.best_targets_pick(rows).orderBy("product_id").collect()
    assert [(r.product_id, r.candidate_url) for r in pick] == [("10", "z"), ("2", "x")]
    # Ids are compared as text.
    assert [r.product_id for r in R.best_targets_first(rows, 1).collect()] == ["10"]


def test_first_rows_over_tasks(spark):
    rows = spark.range(0, 5000, 1, 7).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("key"))
    found = sorted(row.key for row in first_rows(rows, 1234, ["key"]).collect())
    assert found == [f"{i:05d}" for i in range(1234)]


def test_running_rank_keeps_columns(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "g STRING, v INT")
    ranked = running_rank(rows, ["g"], [F.col("v").asc()], "place")
    assert {(r.g, r.v, r.place) for r in ranked.collect()} == {("a", 1, 1), ("a", 2, 2), ("b", 5, 1)}
