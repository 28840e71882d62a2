"""Rows that a fixture of well-formed input never holds: they must not get lost."""

import json

import pytest

from pyspark.sql import functions as F

from clickmart.functions import payload as P
from clickmart.functions.urls import Stores
from clickmart.operators import ips, pages, targets
from clickmart.operators.events import candidates
from clickmart.schemas import ALIASES, EVENTS
from clickmart.session import scratch_path
from clickmart.sources.readers import read_events

STORES = Stores("shop", fallback_domains=("www.shop.com",), english_domains=("www.shop.com",))


def test_declared_schema_has_every_alias(spark, tmp_path):
    assert set(ALIASES) <= set(EVENTS.fieldNames())
    rows = [
        {"event_type": "view_product_detail", "productid": "P1", "url": "http://a/1", "event_time": "2020"},
        {"event": "view_product_detail", "product": "P2", "currentUrl": "http://a/2", "created_at": "2021"},
        {"action": "product_view_all_recommend_clicked", "viewingProductId": "P3", "referer": "http://a/3"},
    ]
    path = str(tmp_path / "events.json")
    with open(path, "w") as file:
        file.writelines(json.dumps(row) + "\n" for row in rows)
    for mode in ("raw", "clean"):
        found = candidates(read_events(spark, path, "json"), mode).collect()
        assert sorted((r.product_id, r.candidate_url, r.event_time) for r in found) == [
            ("P1", "http://a/1", "2020"), ("P2", "http://a/2", "2021"), ("P3", "http://a/3", None),
        ]


def test_address_without_order_key_is_kept(spark):
    rows = [("8.8.8.8", None), (" 8.8.8.8", None), ("9.9.9.9 ", 5), ("9.9.9.9", 5), ("9.9.9.9", None)]
    events = spark.createDataFrame(rows, "ip STRING, event_id BIGINT")
    found = {r.ip_key: r.ip for r in ips.distinct_normalized_ips(events, "event_id").collect()}
    assert found == {"8.8.8.8": " 8.8.8.8", "9.9.9.9": "9.9.9.9"}
    assert ips.distinct_normalized_ips(events, "event_id", limit=2).count() == 2


def test_counts_beyond_32_bits(spark):
    rows = [("P1", "http://a/many", "1", "3000000000"), ("P1", "http://a/few", "1", "5")]
    table = spark.createDataFrame(rows, "product_id STRING, candidate_url STRING, url_rank STRING, event_count STRING")
    assert targets.best_targets_pick(table).first().candidate_url == "http://a/many"


@pytest.mark.parametrize("text", ['{"product_id": 1, "price": NaN}', '{"product_id": 1, "price": -Infinity}'])
def test_payload_with_numbers_that_json_lacks(spark, text):
    html = f"<script>var react_data = {text}; var x = {{}};</script>"
    row = spark.createDataFrame([(html,)], "html STRING").select(P.page_payload(F.col("html")).alias("p"))
    assert row.select(P.text_of(F.col("p"), "product_id")).first()[0] == "1"


def page(name):
    return f'<title>{name}</title><script>react_data = {{"product_id": 7, "name": "{name}"}};</script>'


def test_copies_of_pages_and_of_targets(spark):
    url = "https://www.shop.com/catalog/product/view/id/7"
    table = spark.createDataFrame(
        [(url, None, 404, "<html>", 9), (url, None, 200, page("b"), 1), (url, None, 200, page("a"), 2), (url, None, 200, page("a"), 2)],
        "url STRING, resolved_url STRING, status_code INT, html STRING, seen INT",
    )
    wanted = spark.createDataFrame([("7", "https://www.shop.com/p"), ("7", "https://www.shop.com/p"), ("8", None)], "product_id STRING, candidate_url STRING")
    found = {r.requested_product_id: r for r in pages.resolve_products(wanted, table, STORES).collect()}
    assert set(found) == {"7", "8"}
    assert (found["7"].status, found["7"].name, found["7"].attempts[-1].status_code) == ("ok", "a", 200)
    newest = pages.resolve_products(wanted, table, STORES, page_order="seen").collect()
    assert {r.requested_product_id: r.status for r in newest}["7"] != "ok"


def test_ties_of_an_upsert_are_decided(spark):
    rows = spark.createDataFrame([("1.1.1.1", "x"), ("1.1.1.1", "y"), ("2.2.2.2", "z")], "ip STRING, country STRING")
    found = ips.upsert(rows, rows.repartition(3)).collect()
    assert {r.ip: r.country for r in found} == {"1.1.1.1": "y", "2.2.2.2": "z"}


def test_no_machine_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    Session.sparkContext.master = "local[2]"
    first, second = scratch_path(Session(), "x"), scratch_path(Session(), "x")
    assert first != second and first.split("/clickmart/")[0] == second.split("/clickmart/")[0]
