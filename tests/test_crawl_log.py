import json

import pytest

from pyspark.sql import functions as F

from clickmart.functions.urls import Stores
from clickmart.operators import crawl_log as L
from clickmart.plans import crawl as job
from clickmart.plans.counters import CrawlCounters
from clickmart.schemas import FAILED_TARGET_FIELDS, PRODUCT_INFO
from clickmart.sources.readers import read_jsonl_tolerant, with_file_order

TARGETS = "product_id STRING, candidate_url STRING"


def log(spark, tmp_path, *lines, name="log"):
    path = tmp_path / name
    path.mkdir(exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n"
    (path / "part.json").write_text(text, encoding="utf-8")
    return with_file_order(read_jsonl_tolerant(spark, str(path), PRODUCT_INFO))


OK = {"requested_product_id": "100", "status": "ok", "active": True, "country_store": "ie"}
MISSING = {"requested_product_id": "200", "status": "not_found_in_configured_stores", "active": False}


def test_counts(spark, tmp_path):
    rows = log(spark, tmp_path, OK, MISSING)
    assert L.checkpoint_summary(rows).first().asDict() == {
        "product_count": 2, "row_count": 2, "ok_count": 1, "active_count": 1, "invalid_line_count": 0,
    }
    assert {r.status: r.rows for r in L.status_counts(rows).collect()} == {"ok": 1, MISSING["status"]: 1}
    assert [tuple(r) for r in L.country_store_counts(rows).collect()] == [("ie", 1)]


def test_bad_and_blank_lines(spark, tmp_path):
    rows = log(spark, tmp_path, OK, "not-json", "", "   ", '["a list"]', {"status": "ok"})
    counts = L.checkpoint_summary(rows).first()
    assert (counts.row_count, counts.product_count, counts.invalid_line_count) == (1, 1, 2)


def test_limited_to_targets(spark, tmp_path):
    rows = log(spark, tmp_path, OK, {**OK, "requested_product_id": "999"})
    targets = spark.createDataFrame([("100", "u")], TARGETS)
    counts = L.checkpoint_summary(rows, targets).first()
    assert (counts.row_count, counts.ok_count, counts.product_count) == (1, 1, 1)
    assert L.logged(rows, targets).count() == 1


def test_missing_status_counts_as_none(spark, tmp_path):
    rows = log(spark, tmp_path, {"requested_product_id": "1"})
    assert [tuple(r) for r in L.status_counts(rows).collect()] == [("None", 1)]


def test_report_has_the_last_result(spark, tmp_path):
    failed = {"status": "not_found_in_configured_stores", "failure_reason": "not_found_in_configured_stores"}
    rows = log(
        spark, tmp_path,
        {"requested_product_id": "100", **failed, "source_url": "s100", "attempts": [{"url": "a"}]},
        {**OK, "source_url": "new"},
        {**OK, "requested_product_id": "200"},
        {"requested_product_id": "200", **failed, "source_url": "s200", "attempts": [{"url": "a"}, {"url": "b"}]},
        {"requested_product_id": "300", "source_url": "s300", "original_url": ""},
        {"requested_product_id": "400", **failed},
    )
    targets = spark.createDataFrame([("100", "t100"), ("200", "t200"), ("300", ""), ("500", "t500")], TARGETS)
    report = {r.product_id: r for r in L.failed_targets(rows, targets).collect()}
    assert set(report) == {"200", "300"}
    assert (report["200"].candidate_url, report["200"].attempt_count) == ("t200", 2)
    assert (report["300"].candidate_url, report["300"].attempt_count, report["300"].last_status) == ("s300", 0, None)


def test_pending(spark, tmp_path):
    rows = log(spark, tmp_path, MISSING)
    targets = spark.createDataFrame([("100", "u"), ("200", "u")], TARGETS)
    assert [r.product_id for r in L.pending_targets(targets, rows).collect()] == ["100"]


def test_last_row_of_a_hot_product(spark):
    """A third of all rows belong to one product."""
    rows = spark.range(6000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias(
            "requested_product_id"
        ),
        F.lit("ok").alias("status"),
    )
    last = {r.requested_product_id: r.seq for r in L.latest_rows(rows).collect()}
    assert last["hot"] == 5997 and len(last) == 51
    plan = L.latest_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


PAGE = '<script>var react_data = {"product_id": %s, "name": "N", "sku": "K"};</script>'


def test_crawl_job_resumes(spark, tmp_path):
    stores = Stores("shop", ("www.shop.com",), ("www.shop.com",))
    targets = spark.createDataFrame(
        [("1", "https://www.shop.com/1", 1), ("1", "https://www.shop.com/x", 2), ("2", "https://www.shop.com/2", 1),
         ("3", "https://www.shop.com/3", 1)],
        TARGETS + ", url_rank INT",
    )
    pages = spark.createDataFrame(
        [(f"https://www.shop.com/catalog/product/view/id/{n}", None, 200, PAGE % n) for n in (1, 3)],
        "url STRING, resolved_url STRING, status_code INT, html STRING",
    )
    out, failed = str(tmp_path / "out"), str(tmp_path / "failed")
    first = job.run(targets, pages, stores, out, failed, limit=2, resume=True, summary_path=str(tmp_path / "sum"))
    assert (first["target_count"], first["processed_this_run_count"], first["ok_count"]) == (2, 2, 1)
    assert (first["failed_target_count"], first["skipped_checkpoint_count"], first["remaining_count"]) == (1, 0, 0)
    assert first["success_rate_target_percent"] == 50.0 and first["counts"] is None
    second = job.run(targets, pages, stores, out, failed, resume=True, counts_path=str(tmp_path / "counts"))
    assert (second["target_count"], second["pending_target_count"], second["skipped_checkpoint_count"]) == (3, 1, 2)
    assert (second["processed_this_run_count"], second["processed_count"], second["checkpoint_row_count"]) == (1, 3, 2)
    counts = {r["status"]: r["rows"] for r in spark.read.json(f"{second['counts']}/status_counts").collect()}
    assert counts == {"ok": 2, "not_found_in_configured_stores": 1}
    report = spark.read.option("header", True).csv(failed)
    assert report.columns == FAILED_TARGET_FIELDS and [r.product_id for r in report.collect()] == ["2"]
    fresh = job.run(targets, pages, stores, out)
    assert (fresh["processed_count"], fresh["skipped_checkpoint_count"]) == (3, 0)


def counted_log(spark, *rows):
    schema = "requested_product_id STRING, status STRING, active BOOLEAN, country_store STRING, _corrupt_record STRING, seq INT"
    return spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], schema)


def test_counters_equal_a_recount(spark, tmp_path):
    runs = [
        [("1", "ok", True, "ie", None), ("2", "crawl_failed", False, "", None), (None, None, None, None, "bad"), ("1", "ok", True, "de", None)],
        [],
        [("2", "ok", None, "ie", None), ("3", None, False, None, None), (None, None, None, "ie", "bad"), ("4", "ok", True, "fr", None)],
    ]
    counters = CrawlCounters(spark, tmp_path / "counters", splits=2)
    assert (counters.next_run(), counters.product_ids().count(), counters.status_counts().count()) == (0, 0, 0)
    targets = spark.createDataFrame([("1",), ("3",), ("9",), ("9",)], "product_id STRING")
    for run, rows in enumerate(runs):
        for _ in range(2):  # adding a run again changes nothing
            counters.add(counted_log(spark, *rows), run)
        whole = counted_log(spark, *[row for each in runs[: run + 1] for row in each])
        before = counted_log(spark, *[row for each in runs[:run] for row in each])
        done = L.logged(before).selectExpr("requested_product_id AS product_id")
        assert counters.next_run() == run + 1
        assert counters.checkpoint_summary().first() == L.checkpoint_summary(whole).first()
        assert counters.totals(targets, run).first() == L.crawl_totals(whole, targets, done).first()
        for mine, wanted in ((counters.status_counts(), L.status_counts(L.logged(whole))), (counters.country_store_counts(), L.country_store_counts(L.logged(whole)))):
            assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, wanted.collect()))


def test_loss_between_the_tables_of_the_counters(spark, tmp_path):
    counters = CrawlCounters(spark, tmp_path / "counters", splits=1)
    rows = counted_log(spark, ("1", "ok", True, "ie", None))

    def lost(*_):
        raise RuntimeError("driver lost")

    counters.sums.merge = lost
    with pytest.raises(RuntimeError):
        counters.add(rows, 0)
    again = CrawlCounters(spark, tmp_path / "counters", splits=1)
    again.add(rows, again.next_run())
    assert again.checkpoint_summary().first() == L.checkpoint_summary(rows).first()
    assert [tuple(row) for row in again.status_counts().collect()] == [("ok", 1)]


def test_job_with_counters(spark, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "counters")
    targets = spark.createDataFrame([(str(n), f"https://www.shop.com/{n}", "1", "1") for n in range(5)], f"{TARGETS}, url_rank STRING, event_count STRING")
    pages = spark.createDataFrame([], "url STRING, resolved_url STRING, status_code INT, html STRING")
    stores = Stores("shop", ("www.shop.com",), ("www.shop.com",))
    same = ["target_count", "pending_target_count", "skipped_checkpoint_count", "remaining_count", "processed_count", "processed_this_run_count", "checkpoint_row_count", "failed_target_count"]
    for limit, wanted in ((2, [2, 2, 0, 0, 2, 2, 0, 2]), (4, [4, 2, 2, 0, 4, 2, 2, 4]), (4, [4, 0, 4, 0, 4, 0, 4, 4])):
        summary = job.run(targets, pages, stores, out, limit=limit, resume=True, counters_path=path)
        assert [summary[name] for name in same] == wanted
    # counters that begin with a log of earlier runs
    summary = job.run(targets, pages, stores, out, resume=True, counters_path=str(tmp_path / "later"))
    assert [summary[name] for name in same] == [5, 1, 4, 0, 5, 1, 4, 5]
    with pytest.raises(ValueError, match="another crawl"):
        job.run(targets, pages, stores, str(tmp_path / "new"), resume=True, counters_path=path)
