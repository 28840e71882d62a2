"""Inputs of the operators, derived from the driver's tables.

Each table is a list of (column, expression) over one parquet table. Expressions are written once
and run in Spark and in DuckDB; where the two need other words, ``<name>`` marks the place.
"""

from functools import wraps

from pyspark.sql import functions as F

from clickmart.session import stored_path

DIALECTS = {
    "spark": {
        "k": "cast(get_json_object(props, '$.k') as bigint)",
        "epoch": "unix_seconds(cast(ts as timestamp))",
    },
    "duckdb": {
        "k": "cast(json_extract_string(props, '$.k') as bigint)",
        "epoch": "cast(floor(epoch(ts)) as bigint)",
    },
}

ADDRESS = (
    "concat(cast(8 + user_id % 100 as string), '.', cast((user_id * 7) % 256 as string), '.1.', "
    "cast(user_id % 4 as string))"
)

EVENT_RECORDS = [
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    (
        "collection",
        """CASE WHEN event_type = 'view' AND event_id % 11 = 0 THEN 'VIEW_PRODUCT_DETAIL'
            WHEN event_type = 'view' THEN 'view_product_detail'
            WHEN event_type = 'click' THEN 'product_view_all_recommend_clicked'
            WHEN event_type = 'purchase' THEN 'add_to_cart_action'
            WHEN event_type = 'error' THEN 'select_product_option'
            ELSE 'view_home' END""",
    ),
    (
        "event_type",
        """CASE WHEN event_id % 13 = 0 THEN 'Select_Product_Option'
            WHEN event_id % 29 = 0 THEN 'other' END""",
    ),
    (
        "product_id",
        """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 17 = 0 THEN ''
            WHEN event_id % 19 = 0 THEN ' NULL '
            ELSE concat('P', cast(<k> % 40 as string)) END""",
    ),
    (
        "viewing_product_id",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('P', cast(user_id % 40 as string)) END",
    ),
    (
        "current_url",
        """CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'nan'
            ELSE concat('https://www.shop.example/p/', cast(<k> % 40 as string), '?v=',
                        cast(user_id % 3 as string)) END""",
    ),
    (
        "referrer_url",
        """CASE WHEN event_id % 8 = 0 THEN ''
            ELSE concat('https://www.shop.example/r/', cast(user_id % 40 as string)) END""",
    ),
    # other names of the same values, on some of the rows that lack the first one and on some that have it
    (
        "productid",
        """CASE WHEN event_id % 14 = 0 THEN concat('A', cast(<k> % 40 as string))
            WHEN event_id % 3 = 0 THEN 'None' END""",
    ),
    ("url", "CASE WHEN event_id % 6 = 0 THEN concat('https://www.shop.example/u/', cast(<k> % 40 as string)) END"),
    ("event_time", "CASE WHEN event_id % 31 = 0 THEN '2019-01-01' END"),
    ("time_stamp", "<epoch>"),
    (
        "ip",
        f"""CASE event_id % 10 WHEN 0 THEN concat('192.168.1.', cast(user_id % 256 as string))
            WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'not-an-ip'
            WHEN 4 THEN concat({ADDRESS}, ', 10.0.0.1')
            WHEN 6 THEN '2001:4860:4860::8888'
            ELSE concat(' ', {ADDRESS}, ' ') END""",
    ),
]

GEO_RANGES = [
    ("ip_from", "cast((8 + n_nationkey * 4) as bigint) * 16777216"),
    ("ip_to", "cast((8 + n_nationkey * 4) as bigint) * 16777216 + 50331647"),
    ("country", "n_name"),
    ("region", "CASE WHEN n_nationkey % 5 = 0 THEN '-' ELSE r_name END"),
    ("city", "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE concat('City ', cast(n_nationkey as string)) END"),
    ("latitude", "cast(n_nationkey as double) * 1.5e0"),
    ("longitude", "cast(n_nationkey as double) * -0.5e0"),
]

# Blocks of 2^10 to 2^23 addresses at multiples of their size, so that they lie in one another, some of them twice.
_BITS = "cast(pow(2, 10 + c_custkey % 14) as bigint)"
_BLOCK = f"cast(floor(((8 + c_custkey % 100) * 16777216 + (c_custkey * 7) % 256 * 65536 + 256) / {_BITS}) as bigint) * {_BITS}"
NESTED_RANGES = [
    ("ip_from", _BLOCK),
    ("ip_to", f"{_BLOCK} + {_BITS} - 1"),
    ("country", "concat('C', cast(c_custkey as string))"),
    ("region", "CASE WHEN c_custkey % 5 = 0 THEN '-' ELSE 'r' END"),
    ("city", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('City ', cast(c_custkey as string)) END"),
    ("latitude", "cast(c_custkey as double) * 0.5e0"),
    ("longitude", "cast(c_custkey as double) * -0.25e0"),
]

# JSON records: fields of several types, empty objects, and objects ten levels down.
DEEP = ".".join(["d"] + ["a"] * 9 + ["x"])
RECORDS = [
    ("event_id", "event_id"),
    ("k", "<k>"),
    (
        "varied",
        """CASE event_id % 3 WHEN 0 THEN concat('"text ', cast(event_id % 50 as string), '"') WHEN 1 THEN '2.5'
            ELSE 'null' END""",
    ),
    ("deep", "CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END"),
]


def record_text(k, varied, deep):
    """The JSON of a record, as an expression over the columns of ``RECORDS``."""
    opened, closed = '{"a":' * 9 + '{"x":"', '"}' + "}" * 9
    return (
        f"""concat('{{"k":', cast({k} as string), ',"v":', {varied}, ',"e":{{}},"d":{opened}', {deep}, '{closed}}}')"""
    )


# All in one /16 block, two thirds of them inside a range; some map IPv4 addresses.
V6_ADDRESSES = [
    (
        "ip",
        f"""CASE WHEN user_id % 5 = 0 THEN concat('::ffff:', {ADDRESS})
            ELSE concat('2a02:', cast(1000 + user_id % 8000 as string), '::', cast(1 + event_id % 9 as string)) END""",
    ),
]

V6_RANGES = [
    ("ip_from", "concat('2a02', cast(1000 + n_nationkey * 300 as string), repeat('0', 24))"),
    ("ip_to", "concat('2a02', cast(1199 + n_nationkey * 300 as string), repeat('f', 24))"),
    ("country", "n_name"),
    ("region", "cast(NULL as string)"),
    ("city", "concat('City ', cast(n_nationkey as string))"),
    ("latitude", "cast(n_nationkey as double)"),
    ("longitude", "cast(n_nationkey as double) * -1e0"),
]

SHOP_DOMAINS = ("www.shop.com.au", "www.shop.com", "www.shop.de")

PART_TARGETS = [
    ("product_id", "cast(p_partkey as string)"),
    (
        "candidate_url",
        """concat('https://', CASE p_partkey % 3 WHEN 0 THEN 'www.shop.com' WHEN 1 THEN 'www.shop.de'
            ELSE 'www.shop.fr' END, '/item-', cast(p_partkey as string), '.html')""",
    ),
]


def page_columns(place, domain):
    """Snapshot of the part pages of one shop domain."""
    found_id = f"CASE WHEN (p_partkey + {place}) % 3 = 0 THEN p_partkey + 1 ELSE p_partkey END"
    name = "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END"
    brand = "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END"
    return [
        ("part_id", "p_partkey"),
        (
            "url",
            # a quarter of the pages lie where no attempt looks for them
            f"""concat('https://{domain}/', CASE WHEN (p_partkey * 3 + {place}) % 4 = 0 THEN 'moved/' ELSE
                'catalog/product/view/id/' END, cast(p_partkey as string))""",
        ),
        ("resolved_url", "cast(NULL as string)"),
        ("status_code", f"CASE WHEN (p_partkey + {place}) % 5 = 0 THEN 404 ELSE 200 END"),
        (
            "html",
            f"""CASE WHEN (p_partkey + {place}) % 7 = 0
                THEN concat('<html><head><title> No  product ', cast(p_partkey as string),
                            '</title></head></html>')
                ELSE concat('<html><head><title>', p_name, '</title></head><script>var react_data = ',
                            '{{"product_id": ', cast({found_id} as string), ', "name": "', {name},
                            '", "sku": "', {brand}, '", "price": "', cast(p_size as string),
                            '", "opt": {{"q": "a}}b"}}}}; var x = {{}};</script></html>') END""",
        ),
    ]


CRAWL_LOG = [
    ("seq", "o_orderkey"),
    ("requested_product_id", "cast(o_custkey as string)"),
    ("product_id", "CASE WHEN o_orderstatus = 'F' THEN cast(o_custkey as string) END"),
    ("source_url", "concat('https://www.shop.com/catalog/product/view/id/', cast(o_custkey as string))"),
    (
        "original_url",
        """CASE WHEN o_orderkey % 10 = 0 THEN ''
            ELSE concat('https://www.shop.de/item-', cast(o_custkey as string), '.html') END""",
    ),
    (
        "resolved_url",
        "CASE WHEN o_orderstatus = 'F' THEN concat('https://www.shop.com/p/', cast(o_custkey as string)) END",
    ),
    (
        "country_store",
        """CASE WHEN o_orderstatus = 'F'
            THEN CASE o_custkey % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'de' ELSE '' END END""",
    ),
    ("name", "CASE WHEN o_orderstatus = 'F' AND o_custkey % 4 <> 0 THEN o_orderpriority END"),
    ("sku", "CASE WHEN o_orderstatus = 'F' THEN concat('SKU-', cast(o_custkey as string)) END"),
    ("active", "o_orderstatus = 'F'"),
    ("scraped_at", "substring(cast(o_orderdate as string), 1, 19)"),
    (
        "status",
        """CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'not_found_in_configured_stores'
            ELSE 'crawl_failed' END""",
    ),
    (
        "failure_reason",
        """CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'not_found_in_configured_stores'
            ELSE 'crawl_failed' END""",
    ),
    ("error_message", "CASE WHEN o_orderstatus = 'P' THEN 'timeout' END"),
    (
        "react_data",
        """CASE WHEN o_orderstatus = 'F' THEN concat('{"product_id": ', cast(o_custkey as string),
                ', "name": "', o_orderpriority, '"}')
            WHEN o_orderkey % 2 = 0 THEN '{}' END""",
    ),
    (
        "attempts",
        """CASE WHEN o_orderkey % 9 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN '[{"url": "v"}]'
            WHEN o_orderkey % 3 = 1 THEN '[{"url": "u"}, {"url": "v"}]'
            ELSE '[{"url": "u"}, {"url": "u"}, {"url": "v"}]' END""",
    ),
]

CRAWL_TARGETS = [
    # a sixth of the targets was never crawled
    ("product_id", "concat(CASE WHEN c_custkey % 6 = 0 THEN 'new-' ELSE '' END, cast(c_custkey as string))"),
    (
        "candidate_url",
        """CASE WHEN c_custkey % 8 = 0 THEN ''
            ELSE concat('https://www.shop.de/t-', cast(c_custkey as string)) END""",
    ),
]


def expressions(columns, dialect):
    rendered = []
    for name, text in columns:
        for mark, own_words in DIALECTS[dialect].items():
            text = text.replace(f"<{mark}>", own_words)
        rendered.append(f"{text} AS {name}")
    return rendered


# Spark side


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED = {}


def kept(build):
    """Writes a derived table once per application to the shared scratch folder.

    The operators then scan a stored table, as they would in use, and not the derivation.
    """

    def place(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _STORED:
            rows = build(spark, sf_dir)
            _STORED[key] = (stored_path(rows, build.__name__), rows.schema)
        return _STORED[key]

    @wraps(build)
    def read(spark, sf_dir):
        path, schema = place(spark, sf_dir)
        return spark.read.schema(schema).parquet(path)

    read.path = lambda spark, sf_dir: place(spark, sf_dir)[0]
    return read


@kept
def event_records(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*expressions(EVENT_RECORDS, "spark"))


def geo_ranges(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.selectExpr(*expressions(GEO_RANGES, "spark"))


def nested_ranges(spark, sf_dir):
    inner = table(spark, sf_dir, "customer").selectExpr(*expressions(NESTED_RANGES, "spark"))
    return geo_ranges(spark, sf_dir).unionByName(inner)


def v6_addresses(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*expressions(V6_ADDRESSES, "spark")).distinct()


def v6_ranges(spark, sf_dir):
    return table(spark, sf_dir, "nation").selectExpr(*expressions(V6_RANGES, "spark"))


def part_targets(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*expressions(PART_TARGETS, "spark"))


@kept
def page_snapshot(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    snapshot = None
    for place, domain in enumerate(SHOP_DOMAINS):
        rows = part.selectExpr(*expressions(page_columns(place, domain), "spark"))
        snapshot = rows if snapshot is None else snapshot.unionAll(rows)
    return snapshot


@kept
def crawl_log(spark, sf_dir):
    """The log with its nested columns as values."""
    rows = table(spark, sf_dir, "orders").selectExpr(*expressions(CRAWL_LOG, "spark"))
    return rows.withColumns(
        {
            "react_data": F.try_parse_json("react_data"),
            "attempts": F.from_json("attempts", "array<struct<url string>>"),
        }
    )


def crawl_targets(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr(*expressions(CRAWL_TARGETS, "spark"))


# DuckDB side


def _select(columns, source, where=None):
    text = f"SELECT {', '.join(expressions(columns, 'duckdb'))} FROM {source}"
    return f"{text} WHERE {where}" if where else text


CTES = {
    "event_records": _select(EVENT_RECORDS, "events"),
    "v6_addresses": "SELECT DISTINCT * FROM (" + _select(V6_ADDRESSES, "events") + ")",
    "records": _select(RECORDS, "events"),
    "v6_ranges": _select(V6_RANGES, "nation"),
    "geo_ranges": _select(GEO_RANGES, "nation JOIN region ON n_regionkey = r_regionkey"),
    "nested_ranges": "SELECT * FROM geo_ranges UNION ALL " + _select(NESTED_RANGES, "customer"),
    "part_targets": _select(PART_TARGETS, "part"),
    "page_snapshot": " UNION ALL ".join(
        _select(page_columns(place, domain), "part")
        for place, domain in enumerate(SHOP_DOMAINS)
    ),
    "crawl_log": _select(CRAWL_LOG, "orders"),
    "crawl_targets": _select(CRAWL_TARGETS, "customer"),
}
