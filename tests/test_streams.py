import pytest

from clickmart.functions.urls import Stores
from clickmart.metrics import BatchCounts
from clickmart.operators import pages
from clickmart.streaming import resume
from clickmart.streaming.locations import current_locations, location_stream
from clickmart.streaming.resume import crawl_stream, read_crawl_stream, read_target_stream

HEADER = "product_id,candidate_url,source_event_type,url_source_field,event_count,first_seen_at,last_seen_at,url_rank\n"


def test_crawl_stream_resolves_each_product_once(spark, tmp_path):
    incoming, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    incoming.mkdir()
    stores = Stores("shop", ("www.shop.com",), ("www.shop.com",))
    pages = spark.createDataFrame(
        [("https://www.shop.com/catalog/product/view/id/1", None, 200, 'react_data = {"product_id": 1, "sku": "K"}')],
        "url STRING, resolved_url STRING, status_code INT, html STRING",
    )

    def go():
        crawl_stream(read_target_stream(spark, str(incoming)), pages, stores, out, state).awaitTermination()
        return sorted((r.requested_product_id, r.status) for r in read_crawl_stream(spark, out).collect())

    (incoming / "a.csv").write_text(HEADER + "1,u1,t,s,5,1,1,1\n2,u2,t,s,5,1,1,1\n")
    missing = "not_found_in_configured_stores"
    assert go() == [("1", "ok"), ("2", missing)]
    (incoming / "b.csv").write_text(HEADER + "2,u2,t,s,5,1,1,1\n3,u3,t,s,5,1,1,1\n")
    assert go() == [("1", "ok"), ("2", missing), ("3", missing)]
    assert len(go()) == 3


def test_crawl_stream_goes_on_after_a_loss(spark, tmp_path):
    """A run that ends in the middle of a batch: its products come once, also with more targets for them later."""
    incoming, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    incoming.mkdir()
    stores = Stores("shop", ("www.shop.com",), ("www.shop.com",))
    pages = spark.createDataFrame([], "url STRING, resolved_url STRING, status_code INT, html STRING")

    counts = str(tmp_path / "counts")

    def lost(*columns):
        raise RuntimeError("executor lost")

    def go(strategy=None, out=out):
        targets = read_target_stream(spark, str(incoming), maxFilesPerTrigger="1")
        crawl_stream(targets, pages, stores, out, state, strategy, counts_path=counts).awaitTermination()
        return sorted((r.requested_product_id, r.original_url) for r in read_crawl_stream(spark, out).collect())

    (incoming / "a.csv").write_text(HEADER + "1,u1b,t,s,5,1,1,2\n1,u1,t,s,5,1,1,1\n2,u2,t,s,5,1,1,1\n,u9,t,s,5,1,1,1\n3,,t,s,5,1,1,1\n")
    assert go() == [("1", "u1"), ("2", "u2")]
    (incoming / "b.csv").write_text(HEADER + "1,u0,t,s,5,1,1,1\n3,u3,t,s,5,1,1,1\n4,u4,t,s,5,1,1,1\n")
    with pytest.raises(Exception, match="executor lost"):
        go(lost)
    (incoming / "c.csv").write_text(HEADER + "4,u4c,t,s,5,1,1,1\n5,u5,t,s,5,1,1,1\n")
    wanted = [("1", "u1"), ("2", "u2"), ("3", "u3"), ("4", "u4"), ("5", "u5")]
    assert go() == wanted
    stored = BatchCounts(spark, counts).read().collect()
    written = read_crawl_stream(spark, out).groupBy("batch_id").count()
    assert {row.batch: row["rows"] for row in stored if row["rows"]} == {row.batch_id: row["count"] for row in written.collect()}
    # what earlier batches wrote is not looked at: another folder gets what is new
    (incoming / "d.csv").write_text(HEADER + "1,u1,t,s,5,1,1,1\n6,u6,t,s,5,1,1,1\n")
    assert go(out=str(tmp_path / "other")) == [("6", "u6")]


def test_pages_are_parsed_once_a_run(spark, tmp_path, monkeypatch):
    incoming, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    incoming.mkdir()
    stores, parsed = Stores("shop", ("www.shop.com",), ("www.shop.com",)), []
    collected = spark.createDataFrame(
        [("https://www.shop.com/catalog/product/view/id/1", None, 200, 'react_data = {"product_id": 1, "sku": "K"}')],
        "url STRING, resolved_url STRING, status_code INT, html STRING",
    )
    real = pages.page_features
    monkeypatch.setattr(resume, "page_features", lambda *given: parsed.append(1) or real(*given), raising=False)
    for number in (1, 2):
        (incoming / f"{number}.csv").write_text(HEADER + f"{number},u{number},t,s,5,1,1,1\n")
    targets = read_target_stream(spark, str(incoming), maxFilesPerTrigger="1")
    crawl_stream(targets, collected, stores, out, state).awaitTermination()
    found = read_crawl_stream(spark, out)
    assert sorted((r.requested_product_id, r.status) for r in found.collect()) == [("1", "ok"), ("2", pages.NOT_FOUND)]
    assert found.select("batch_id").distinct().count() == 2 and len(parsed) == 1


def test_location_stream_upserts(spark, tmp_path):
    incoming, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    schema = "n BIGINT, ip STRING"

    def add(*values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)
        rows.coalesce(1).write.mode("append").parquet(str(incoming))

    def go(ranges=None):
        stream = spark.readStream.schema(schema).parquet(str(incoming))
        location_stream(stream, "n", out, state, ranges).awaitTermination()
        return {r.ip: r.status for r in current_locations(spark, out).collect()}

    add("8.8.8.8", "8.8.8.8, 1.1.1.1", "bad")
    assert go() == {"8.8.8.8": "lookup_not_configured", "bad": "invalid_ip"}
    add("8.8.8.8", "9.9.9.9")
    ranges = spark.createDataFrame(
        [(0, 1, "A", "B", "C", 1.0, 2.0)],
        "ip_from BIGINT, ip_to BIGINT, country STRING, region STRING, city STRING, latitude DOUBLE, longitude DOUBLE",
    )
    assert go(ranges) == {"8.8.8.8": "ok", "9.9.9.9": "ok", "bad": "invalid_ip"}
