import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from clickmart.functions import ip as I
from clickmart.operators import ips
from clickmart.operators.ranges import attach_ranges
from clickmart.plans import locations as job


def texts(spark, values):
    return spark.createDataFrame([(value,) for value in values], "ip STRING")


def test_normalize(spark):
    cases = {"8.8.8.8, 10.0.0.1": "8.8.8.8", " 1.1.1.1 ": "1.1.1.1", "None": None, ", 10.0.0.1": "", "": None, "nan,1": "nan"}
    rows = texts(spark, cases).withColumn("got", I.normalize_ip(F.col("ip"))).collect()
    assert {row.ip: row.got for row in rows} == cases


def addresses():
    generator = random.Random(5)
    found = ["8.8.8.8", "192.168.1.10", "not-an-ip", "1.2.3", "1.2.3.4.5", "01.2.3.4", "256.1.1.1", "+1.2.3.4", "1.2.3.٤",
             "1.2.3.4/32", "::", "::1", ":::", "1::2::3", ":1::2", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::",
             "::1.2.3.4", "::ffff:8.8.8.8", "::ffff:10.0.0.1", "::ffff:192.0.0.9", "1:2", "a:1.2.3.4", "2001:db8::1",
             "2001:4860:4860::8888", "fe80::1%eth0", "2600::1%a%b", "2600::1%", "12345::", "g::1", "2001:1::1", "2001:20::5",
             "2001:30::", "64:ff9b:1::1", "64:ff9b::808:808", "100::1", "2002:102:304::", "1:2:3:4:5:6:1.2.3.4",
             "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.256", "FC00::1", "2606:4700::ABCD", "192.0.0.9", "192.0.0.170", "1.2.3.4%eth0"]
    blocks = [ipaddress.ip_network(b) for b in I.V4_NOT_GLOBAL + I.V4_GLOBAL_AFTER_ALL + I.V6_NOT_GLOBAL + I.V6_GLOBAL_AFTER_ALL]
    for block in blocks:
        low, high = int(block.network_address), int(block.broadcast_address)
        top = 2 ** block.max_prefixlen - 1
        kind = ipaddress.IPv4Address if block.version == 4 else ipaddress.IPv6Address
        found += [str(kind(n)) for n in (low, high, max(0, low - 1), min(top, high + 1), generator.randint(low, high))]
    found += [str(ipaddress.IPv4Address(generator.getrandbits(32))) for _ in range(2000)]
    found += [str(ipaddress.IPv6Address(generator.getrandbits(128))) for _ in range(500)]
    found += [ipaddress.IPv6Address(generator.getrandbits(128)).exploded for _ in range(100)]
    return sorted(set(found))


def test_validity_and_numbers_equal_the_standard_library(spark):
    rows = texts(spark, addresses())
    strict = {r.ip: r for r in I.with_validity(rows, "ip").collect()}
    loose = {r.ip: r for r in I.with_validity(rows, "ip", allow_private=True).collect()}
    for text in addresses():
        try:
            known = ipaddress.ip_address(text)
        except ValueError:
            known = None
        row = strict[text]
        assert row.valid == (known is not None and known.is_global), text
        assert loose[text].valid == (known is not None), text
        number = int(known) if known is not None else None
        assert row.v4 == (number if known is not None and known.version == 4 else None), text
        assert row.v6 == (f"{number:032x}" if known is not None and known.version == 6 else None), text


def events(spark, *rows):
    return spark.createDataFrame(
        [(place, *row) for place, row in enumerate(rows)],
        "n BIGINT, ip STRING, collection STRING, product_id STRING, current_url STRING",
    )


def test_distinct_keeps_the_first_spelling(spark):
    rows = events(
        spark, ("8.8.8.8", "", "", ""), ("8.8.8.8, 10.0.0.1", "", "", ""), ("1.1.1.1", "", "", ""), (None, "", "", ""),
        (", 10.0.0.1", "", "", ""), ("", "", "", ""),
    )
    found = ips.distinct_ips(rows, "n").collect()
    assert sorted(r.ip for r in found) == [", 10.0.0.1", "1.1.1.1", "8.8.8.8"]
    raw = ips.distinct_ips(rows, discovery_mode="aggregate").collect()
    assert len(raw) == 4
    assert sorted(r.ip for r in ips.distinct_ips(rows, "n", limit=2).collect()) == ["1.1.1.1", "8.8.8.8"]
    assert [r.ip for r in ips.distinct_raw_ips(rows, limit=1).collect()] == [", 10.0.0.1"]
    assert ips.ip_record_count(rows).first()[0] == 4


@pytest.fixture(scope="module")
def target_events(spark):
    view = "view_product_detail"
    return events(
        spark, ("8.8.8.8", view, "P1", "u"), ("8.8.8.8, 10.0.0.1", view, "P1", "u"), ("1.1.1.1", view, "P2", "u"),
        ("9.9.9.9", view, "NULL", "u"), ("9.9.9.9", "view_home", "P1", "u"), ("7.7.7.7", view, "P1", "u"),
    )


def test_addresses_of_target_events(spark, target_events):
    ids = spark.createDataFrame([("P1",)], "product_id STRING")
    found = ips.target_event_ips(target_events, ids, "n").collect()
    assert sorted(r.ip for r in found) == ["7.7.7.7", "8.8.8.8"]
    assert tuple(ips.target_event_ip_stats(target_events, ids, "n").first()) == (5, 4, 3)
    # Counting stops at the event that brought the last address.
    assert tuple(ips.target_event_ip_stats(target_events, ids, "n", limit=1).first()) == (1, 1, 1)


GEO = "ip_from BIGINT, ip_to BIGINT, country STRING, region STRING, city STRING, latitude DOUBLE, longitude DOUBLE"


def number(text):
    return int(ipaddress.ip_address(text))


def test_locations(spark):
    ranges = spark.createDataFrame(
        [
            (number("8.8.8.0"), number("8.8.8.255"), "A", "-", " ", 1.0, 2.0),
            (number("8.8.9.0"), number("9.200.0.0"), "-", None, "x unavailable in selected .BIN file", 3.0, 4.0),
        ],
        GEO,
    )
    rows = texts(spark, ["8.8.8.8", "8.8.8.0", "8.8.8.255", "8.8.7.255", "9.9.9.9, 1.1.1.1", "9.200.0.0", "9.200.0.1",
                         "10.0.0.1", "zz", ", 1", "2606:4700::1"])
    found = {r.ip: r for r in ips.locate(rows, ranges).collect()}
    assert found["8.8.8.8"].country == found["8.8.8.0"].country == found["8.8.8.255"].country == "A"
    assert (found["8.8.8.8"].region, found["8.8.8.8"].city, found["8.8.8.8"].latitude) == (None, None, 1.0)
    for outside in ("8.8.7.255", "9.200.0.1", "2606:4700::1"):
        assert (found[outside].status, found[outside].country, found[outside].latitude) == ("ok", None, None)
    assert (found["9.9.9.9"].country, found["9.9.9.9"].city, found["9.9.9.9"].longitude) == (None, None, 4.0)
    assert found["9.200.0.0"].latitude == 3.0
    assert found["10.0.0.1"].status == found["zz"].status == found[""].status == "invalid_ip"
    assert found["8.8.8.8"].processed_at.endswith("+00:00")
    plain = {r.ip: r.status for r in ips.locate(rows).collect()}
    assert plain["8.8.8.8"] == "lookup_not_configured" and plain["zz"] == "invalid_ip"
    keys = {r.ip: r.location for r in ips.location_keys(ips.locate(rows, ranges)).collect()}
    assert keys["8.8.8.8"] == "A |  | " and keys["9.9.9.9"] == "3.0,4.0" and keys["8.8.7.255"] is None
    totals = ips.ip_totals(ips.locate(rows, ranges)).first()
    assert (totals.processed_count, totals.ok_count, totals.unique_location_count) == (11, 8, 2)


def test_range_lookup_equals_brute_force(spark):
    generator = random.Random(9)
    cuts = sorted(generator.sample(range(2**32), 400)) + [2**32]
    spans = [(low, generator.randint(low, high - 1)) for low, high in zip(cuts, cuts[1:])]
    spans += []
    ranges = spark.createDataFrame([(a, b, f"C{a}", None, None, None, None) for a, b in spans], GEO)
    points = [str(ipaddress.IPv4Address(generator.getrandbits(32))) for _ in range(600)]
    points += [str(ipaddress.IPv4Address(n)) for span in spans[:50] for n in span]
    # Half of all points in one block.
    points += [f"8.8.{i // 250}.{i % 250}" for i in range(600)]
    found = {r.ip: r.country for r in ips.locate(texts(spark, set(points)), ranges, allow_private=True).collect()}
    for point in set(points):
        wanted = [f"C{a}" for a, b in spans if a <= number(point) <= b]
        assert found[point] == (wanted[0] if wanted else None)


def test_address_in_very_many_spellings(spark):
    """One address is most of the rows; they are cut over tasks and every row keeps its range."""
    rows = spark.range(4000).select(F.concat(F.lit("8.8.8.8, 10.0.0."), "id").alias("ip"))
    ranges = spark.createDataFrame([(number("8.0.0.0"), number("8.255.255.255"), "A", None, None, None, None)], GEO)
    found = ips.locate(rows, ranges)
    assert [tuple(r) for r in found.groupBy("ip", "country").count().collect()] == [("8.8.8.8", "A", 4000)]


def test_one_block_spans_several_tasks(spark):
    """Addresses of one /16 block are sorted over tasks that hold no range start of their own."""
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    points = spark.range(3000).select((F.lit(8 << 24) + F.col("id")).alias("n")).repartition(4)
    ranges = spark.createDataFrame([(8 << 24, (8 << 24) + 2000, "A")], "ip_from BIGINT, ip_to BIGINT, country STRING")
    found = attach_ranges(points, ranges, F.col("n"))
    counts = {r.c: r["count"] for r in found.groupBy(F.col("range.country").alias("c")).count().collect()}
    assert counts == {"A": 2001, None: 999}
    assert counts == {r.c: r["count"] for r in found.groupBy(F.col("range.country").alias("c")).count().collect()}
    spark.conf.unset(merge)


def test_mapped_addresses_are_located(spark):
    ranges = spark.createDataFrame([(number("8.0.0.0"), number("8.255.255.255"), "A", None, None, None, None)], GEO)
    found = ips.locate(texts(spark, ["::ffff:8.8.8.8", "::ffff:10.0.0.1"]), ranges).collect()
    assert {(r.ip, r.status, r.country) for r in found} == {("::ffff:8.8.8.8", "ok", "A"), ("::ffff:10.0.0.1", "invalid_ip", None)}


def test_v6_ranges_equal_brute_force(spark):
    generator = random.Random(11)
    base = 0x2A02 << 112
    cuts = sorted(base + generator.getrandbits(112) for _ in range(200))
    spans = [(low, generator.randint(low, high - 1)) for low, high in zip(cuts, cuts[1:])] + [(0x2B00 << 112, 0x2C00 << 112)]
    ranges = spark.createDataFrame(
        [(f"{a:032x}", f"{b:032x}", f"C{place}", None, None, None, None) for place, (a, b) in enumerate(spans)],
        GEO.replace("BIGINT", "STRING"),
    )
    points = [ipaddress.IPv6Address(base + generator.getrandbits(112)) for _ in range(300)]
    points += [ipaddress.IPv6Address(n) for span in spans[:30] for n in span] + [ipaddress.IPv6Address(0x2B55 << 112)]
    found = {r.ip: r.country for r in ips.locate(texts(spark, map(str, points)), v6_ranges=ranges, allow_private=True).collect()}
    for point in points:
        wanted = [f"C{i}" for i, (a, b) in enumerate(spans) if a <= int(point) <= b]
        assert found[str(point)] == (wanted[0] if wanted else None)


def nest(generator, low, high, depth):
    """Ranges inside ``low`` to ``high``: some equal to the outer one, some that share an end with it, some side by side."""
    if depth == 0 or high < low:
        return []
    cuts = sorted(generator.randint(low, high) for _ in range(6))
    spans = [(low, cuts[0]), (cuts[1], cuts[2]), (cuts[2] + 1, cuts[3]), (cuts[4], high)]
    spans = [s for s in spans if s[0] <= s[1]]
    disjoint = [s for place, s in enumerate(spans) if not place or s[0] > spans[place - 1][1]]
    return [(low, high)] * generator.choice([0, 1, 2]) + [x for s in disjoint for x in [s, *nest(generator, *s, depth - 1)]]


@pytest.mark.parametrize(("kind", "bits"), [("BIGINT", 32), ("STRING", 128)])
def test_nested_ranges_equal_brute_force(spark, kind, bits):
    generator = random.Random(bits)
    base = 0 if bits == 32 else 0x2A02 << 112
    size = 2**32 if bits == 32 else 2**112
    spans = nest(generator, base + size // 8, base + size - 2, 4)
    code = (lambda n: n) if bits == 32 else (lambda n: f"{n:032x}")
    rows = [(code(a), code(b), f"C{place:04d}", None) for place, (a, b) in enumerate(spans)]
    rows += [(code(5 + base), code(1 + base), "empty", None), (None, code(base + size - 1), "open", None), (code(base), None, "open", None)]
    ranges = spark.createDataFrame(rows, f"ip_from {kind}, ip_to {kind}, country STRING, city STRING").repartition(3)
    points = [base + generator.randrange(size) for _ in range(500)] + [p for s in spans for end in s for p in (end - 1, end, end + 1)]
    # A third of all rows is one point.
    points += [spans[-1][0]] * (len(points) // 2)
    frame = spark.createDataFrame([(place, code(p)) for place, p in enumerate(points)] + [(-1, None)], f"place INT, n {kind}")
    found = {r.place: r.range and r.range.country for r in attach_ranges(frame, ranges, F.col("n"), nested=True).collect()}
    assert len(spans) > 150 and found.pop(-1) is None
    for place, point in enumerate(points):
        over = [(b - a, -at) for at, (a, b) in enumerate(spans) if a <= point <= b]
        assert found[place] == (f"C{-min(over)[1]:04d}" if over else None)


def test_nested_lookup_of_nothing_and_of_crossing_ranges(spark):
    schema = "ip_from BIGINT, ip_to BIGINT, country STRING"
    points = spark.createDataFrame([(1,), (7,)], "n BIGINT")
    none = attach_ranges(points, spark.createDataFrame([], schema), F.col("n"), nested=True)
    assert [r.range for r in none.collect()] == [None, None]
    flat = spark.createDataFrame([(1, 5, "A"), (6, 9, "B")], schema)
    assert attach_ranges(points.limit(0), flat, F.col("n"), nested=True).count() == 0
    for rows in ([(0, 10, "A"), (5, 15, "B")], [(0, 10, "A"), (10, 15, "B")], [(0, 10, "A"), (5, 15, "B"), (11, 15, "C")]):
        with pytest.raises(Exception, match="ranges cross"):
            attach_ranges(points, spark.createDataFrame(rows, schema), F.col("n"), nested=True).collect()


def test_nested_ranges_with_tasks_that_hold_no_start(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = spark.range(300).select(F.col("id").alias("ip_from"), (10_000 - F.col("id")).alias("ip_to"), "id")
        points = spark.range(3000).select((F.col("id") * 4).alias("n")).repartition(4)
        found = attach_ranges(points, ranges, F.col("n"), nested=True).select("n", "range.id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(r.id == (None if r.n > 10_000 else min(r.n, 299, 10_000 - r.n)) for r in found) and len(found) == 3000


def test_upsert(spark):
    schema = "ip STRING, status STRING"
    old = spark.createDataFrame([("1.1.1.1", "old"), ("2.2.2.2", "old"), ("", "old")], schema)
    new = spark.createDataFrame([("2.2.2.2", "new"), ("3.3.3.3", "new"), (None, "new")], schema)
    rows = {(r.ip, r.status) for r in ips.upsert(old, new).collect()}
    assert rows == {("1.1.1.1", "old"), ("2.2.2.2", "new"), ("3.3.3.3", "new")}


def test_job(spark, tmp_path, target_events):
    ranges = spark.createDataFrame([(number("8.0.0.0"), number("8.255.255.255"), "A", "B", "C", 1.0, 2.0)], GEO)
    ids = spark.createDataFrame([("P1",)], "product_id STRING")
    summary = job.run(
        target_events, str(tmp_path / "ips"), "n", ranges, target_ids=ids, table="located",
        counts_path=str(tmp_path / "counts"), summary_path=str(tmp_path / "summary"),
    )
    assert summary["discovery_scope"] == "product_target_events"
    assert (summary["product_event_matched_count"], summary["ip_count"], summary["table_written_count"]) == (3, 2, 2)
    assert summary["status_counts"] == {"ok": 2}
    assert spark.read.json(str(tmp_path / "counts" / "location_counts")).first()["location"] == "A | B | C"
    assert spark.read.json(str(tmp_path / "summary")).first()["unique_location_count"] == 1
    everything = job.run(target_events, str(tmp_path / "all"), "n", discovery_mode="aggregate")
    assert (everything["ip_record_count"], everything["ip_count"]) == (6, 5)


def test_filters_on_results_stay_cheap(spark):
    """Filters above the address steps must not be pushed into them, which would stall the optimizer."""
    rows = texts(spark, ["8.8.8.8", "10.0.0.1", "2606:4700::1", "zz", ", 1"])
    assert I.with_validity(rows, "ip").filter("valid").count() == 2
    assert I.with_validity(rows, "ip").filter("v6 IS NOT NULL").count() == 1
    ranges = spark.createDataFrame([(0, 2**32 - 1, "A", None, None, None, None)], GEO)
    located = ips.locate(rows, ranges)
    assert located.filter("ip <> ''").count() == 4
    assert located.filter("status = 'ok' AND country = 'A'").count() == 1
