import csv
import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators.export import payload_archive, warehouse_products
from clickmart.plans import export as export_job
from clickmart.plans import targets as targets_job
from clickmart.schemas import EVENTS, PRODUCT_INFO, TARGETS, WAREHOUSE_FIELDS
from clickmart.sources import readers, writers


def lines(path):
    found = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, encoding="utf-8", newline="") as handle:
            found += handle.read().splitlines()
    return found


ROWS = [("P1", 'a "q", b\nc', "é", None, 10, "1", "", 1), (" P2 ", "u", None, "x", None, None, None, 2)]


def target_rows(spark):
    return spark.createDataFrame(ROWS, TARGETS)


def test_csv_roundtrip(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    writers.write_csv(target_rows(spark), path, TARGETS.fieldNames())
    back = {tuple(row) for row in readers.read_rows(spark, path, TARGETS).collect()}
    assert back == {
        ("P1", 'a "q", b\nc', "é", None, "10", "1", None, "1"), (" P2 ", "u", None, "x", None, None, None, "2"),
    }
    text = "".join(open(n, encoding="utf-8", newline="").read() for n in glob.glob(f"{path}/part-*"))
    assert ",".join(TARGETS.fieldNames()) in text and '""q""' in text and ',"",' not in text


def test_jsonl_keeps_null_keys(spark, tmp_path):
    path = str(tmp_path / "t.jsonl")
    writers.write_jsonl(target_rows(spark), path)
    objects = [json.loads(line) for line in lines(path)]
    assert all(list(row) == TARGETS.fieldNames() for row in objects)
    assert any("é" in line for line in lines(path))
    assert {tuple(r) for r in readers.read_rows(spark, path, TARGETS).collect()} == set(ROWS)


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Unsupported product target output format"):
        writers.writer_for("xml", "product target output")


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t.jsonl")
    writers.write_jsonl(target_rows(spark), path)
    writers.write_jsonl(target_rows(spark), path, mode="append")
    assert len(lines(path)) == 4
    writers.write_jsonl(target_rows(spark), path)
    assert len(lines(path)) == 2


def test_strict_lines(spark, tmp_path):
    (tmp_path / "good").write_text('{"product_id": "1"}\n\n{"product_id": 2, "other": [1]} \n{"product_id": {"a": 1}}\n')
    schema = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("other", T.LongType())])
    found = readers.read_jsonl_strict(spark, str(tmp_path / "good"), schema).collect()
    assert [tuple(row) for row in found] == [("1", None), ("2", None), ('{"a": 1}', None)]
    bad = ["not-json", "[1]", '"text"', "1", '{"a": 1} x', '{"a": 1} {"b": 2}', '{"a": 1}]', '{"a": 1},{"b": 2}', '{"a"', "}"]
    for place, line in enumerate(bad):
        path = tmp_path / f"bad-{place}"
        path.write_text('{"product_id": "1"}\n' + "\n" * place + line + '\n{"product_id": "2"}\nno\n')
        with pytest.raises(readers.BadLine) as error:
            readers.read_jsonl_strict(spark, str(path), schema)
        assert (error.value.file.endswith(path.name), error.value.line) == (True, place + 2), line


def test_places_of_bad_lines_over_blocks_and_files(spark, tmp_path):
    wanted, folder = [], tmp_path / "lines"
    folder.mkdir()
    for name in ("a.jsonl", "b.jsonl", "empty.jsonl"):
        lines = [json.dumps({"n": n, "text": "ü" * (n % 90)}) for n in range(0 if "empty" in name else 3_000)]
        for place in range(0, len(lines), 7 if name < "b" else 611):
            lines[place] = "" if place % 2 else f"bad {place}"
            if not place % 2:
                wanted.append((name, place + 1, f"bad {place}"))
        (folder / name).write_text("".join(line + "\n" for line in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = readers.bad_lines(spark, str(folder)).collect()
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((row.file.rsplit("/", 1)[1], row.line, row.value) for row in found) == sorted(wanted)


def test_file_order_over_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for place in range(5):
        (folder / f"part-{place}").write_text("".join(json.dumps({"product_id": f"{place}-{n}"}) + "\n" for n in range(3)))
    schema = T.StructType([T.StructField("product_id", T.StringType())])
    rows = readers.with_file_order(readers.read_jsonl(spark, str(folder), schema)).orderBy("seq")
    assert [r.product_id for r in rows.collect()] == [f"{p}-{n}" for p in range(5) for n in range(3)]


def test_target_ids(spark, tmp_path):
    (tmp_path / "t.csv").write_text("product_id,candidate_url\nP1,u\n P2 ,u\n,u\nP1,v\n")
    (tmp_path / "t.jsonl").write_text('{"pid": "P3"}\n{"pid": " "}\n{"other": 1}\n{"pid": 4}\n')
    assert {r[0] for r in readers.read_target_ids(spark, str(tmp_path / "t.csv")).collect()} == {"P1", "P2"}
    assert {r[0] for r in readers.read_target_ids(spark, str(tmp_path / "t.jsonl"), "pid").collect()} == {"P3", "4"}


def test_event_schema_reads_documents(spark, tmp_path):
    document = {
        "_id": "5ed8cb2bc671fc36b74653ad", "collection": "view_product_detail", "time_stamp": 1591266092, "ip": "8.8.8.8",
        "utm_source": False, "option": [{"option_id": "1"}], "order_id": 5.5, "is_paypal": None,
        "cart_products": [{"product_id": 1, "amount": 2, "option": ""}],
    }
    (tmp_path / "e").write_text(json.dumps(document) + "\n")
    row = readers.read_events(spark, str(tmp_path / "e"), "json", EVENTS).first()
    assert row.time_stamp == 1591266092 and row.utm_source.toPython() is False
    assert row.option.toPython() == [{"option_id": "1"}] and row.cart_products[0].amount == 2


FULL = {
    **{name: f"v_{name}" for name in WAREHOUSE_FIELDS if name not in ("active", "react_data_available")},
    "requested_product_id": "100", "product_id": "100", "active": True, "price": "100.00", "category": ["a", 1],
    "react_data_basic": {"product_id": 100}, "react_data": {"product_id": 100, "options": [{"id": "1"}]},
}
SHORT = {"requested_product_id": "200", "status": "not_found", "name": "N", "product_name": "", "react_data": {}}
TEXT = {"requested_product_id": "300", "product_id": "", "react_data": "text"}


@pytest.fixture(scope="module")
def products(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("products") / "p.jsonl"
    path.write_text("\n".join(json.dumps(row) for row in (FULL, SHORT, TEXT)) + "\n")
    return readers.read_jsonl_strict(spark, str(path), PRODUCT_INFO)


def test_projections(products):
    flat = {r.requested_product_id: r for r in warehouse_products(products).collect()}
    assert list(flat["100"].asDict()) == WAREHOUSE_FIELDS
    assert flat["100"].react_data_available and not flat["200"].react_data_available and not flat["300"].react_data_available
    assert (flat["200"].product_id, flat["200"].product_name, flat["300"].product_id) == ("200", "N", "300")
    archive = {r.requested_product_id: r.react_data.toPython() for r in payload_archive(products).collect()}
    assert archive == {"100": FULL["react_data"], "200": {}, "300": {}}
    own = warehouse_products(products, [F.upper("name").alias("name")]).filter("name IS NOT NULL")
    assert {r.name for r in own.collect()} == {"V_NAME", "N"}


def test_split_job(products, tmp_path):
    told = []
    result = export_job.run(
        products, str(tmp_path / "w"), "csv", str(tmp_path / "a"), on_event=lambda name, counts: told.append(name)
    )
    assert (result["warehouse_rows"], result["react_data_rows"]) == (3, 3)
    assert told == ["product_export_started"] + ["product_export_progress"] * 2 + ["product_export_completed"]
    rows = {r["requested_product_id"]: r for r in csv.DictReader(lines(tmp_path / "w"))}
    assert "react_data" not in rows["100"]
    assert (rows["100"]["active"], rows["100"]["react_data_available"], rows["100"]["category"]) == ("true", "true", '["a",1]')
    assert (rows["200"]["product_id"], rows["200"]["react_data_available"], rows["200"]["sku"]) == ("200", "false", "")
    payloads = {json.loads(t)["requested_product_id"]: json.loads(t)["react_data"] for t in lines(tmp_path / "a")}
    assert payloads == {"100": FULL["react_data"], "200": {}, "300": {}}


def test_warehouse_only_and_unknown_format(products, tmp_path):
    assert export_job.run(products, str(tmp_path / "w"), "jsonl")["react_data_rows"] == 0
    assert len(lines(tmp_path / "w")) == 3
    with pytest.raises(ValueError, match="Unsupported product export format"):
        export_job.run(products, str(tmp_path / "x"), "xml")


def test_targets_job(spark, tmp_path):
    events = spark.createDataFrame(
        [(n, "view_product_detail", p, u) for n, (p, u) in enumerate([("P2", "c"), ("P1", "a"), ("P1", "a"), ("P1", "b"), (None, "d")])],
        "n BIGINT, collection STRING, product_id STRING, current_url STRING",
    )
    best = targets_job.run(events, str(tmp_path / "best"), summary_path=str(tmp_path / "sum"))
    assert (best["scanned_records"], best["candidate_records"], best["grouped_url_count"]) == (5, 4, 3)
    assert (best["target_rows"], best["unique_products"], best["output_mode"]) == (2, 2, "one_best_target_per_product")
    rows = list(csv.DictReader(lines(tmp_path / "best")))
    assert {(r["product_id"], r["candidate_url"]) for r in rows} == {("P1", "a"), ("P2", "c")}
    everything = targets_job.run(events, str(tmp_path / "all"), "jsonl", include_all=True)
    assert everything["target_rows"] == 3
    assert [json.loads(t)["product_id"] for t in lines(tmp_path / "all")] == ["P1", "P1", "P2"]
    limited = targets_job.run(events, str(tmp_path / "lim"), limit=2, order_key="n")
    assert (limited["scanned_records"], limited["candidate_records"]) == (2, 2)
    assert json.loads(lines(tmp_path / "sum")[0])["stage"] == "extract_product_targets"
