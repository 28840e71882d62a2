"""The same queries as SQL for DuckDB."""

import re

from checks.derive import CTES, DEEP, EVENT_RECORDS, SHOP_DOMAINS
from checks.queries import IP_LIMIT, PRODUCT_LIMIT, RECORD_LIMIT, SAMPLE_SEED, SAMPLE_SIZE
from clickmart.schemas import EVENTS

PRODUCT_EVENTS = """('view_product_detail', 'select_product_option', 'select_product_option_quality',
    'add_to_cart_action', 'product_detail_recommendation_visible',
    'product_detail_recommendation_noticed', 'product_view_all_recommend_clicked')"""
CLICK = "'product_view_all_recommend_clicked'"


def clean(text):
    return f"CASE WHEN lower(trim({text})) NOT IN ('', 'none', 'null', 'nan') THEN trim({text}) END"


def norm(text):
    return f"trim(split_part({clean(text)}, ',', 1))"


def octets(address):
    return " + ".join(
        f"cast(split_part({address}, '.', {place + 1}) as bigint) * {256 ** (3 - place)}" for place in range(4)
    )


OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def v4(address):
    return f"CASE WHEN regexp_full_match({address}, '{OCTET}([.]{OCTET}){{3}}') THEN {octets(address)} END"


def v6(address):
    """Enough for addresses with one ``::`` and no embedded IPv4 address."""

    def side(place):
        groups = f"string_split(split_part({address}, '::', {place}), ':')"
        return f"[lpad(g, 4, '0') for g in {groups} if g <> '']"

    def digits(place):
        return f"coalesce(array_to_string({side(place)}, ''), '')"

    gap = f"repeat('0000', cast(8 - len({side(1)}) - len({side(2)}) as bigint))"
    return f"CASE WHEN contains({address}, '::') THEN {digits(1)} || {gap} || {digits(2)} END"


BLOCKS = [
    (0, 16777215), (167772160, 184549375), (1681915904, 1686110207), (2130706432, 2147483647),
    (2851995648, 2852061183), (2886729728, 2887778303), (3221225472, 3221225727), (3221225984, 3221226239),
    (3232235520, 3232301055), (3323068416, 3323199487), (3325256704, 3325256959), (3405803776, 3405804031),
    (4026531840, 4294967295),
]
PRIVATE = " OR ".join(f"v4 BETWEEN {low} AND {high}" for low, high in BLOCKS)

TEXTS = {
    **CTES,
    "product_events": f"""SELECT * FROM event_records WHERE collection IN {PRODUCT_EVENTS}
        AND (current_url <> '' OR referrer_url <> '')""",
    "named_raw": """SELECT event_id, ip, lower(coalesce(event_type, collection)) AS t,
        coalesce(product_id, productid, viewing_product_id) AS own_id, viewing_product_id AS viewing_id,
        coalesce(current_url, url) AS page, referrer_url AS referrer,
        coalesce(event_time, cast(time_stamp as varchar)) AS event_time
        FROM product_events""",
    "named_clean": f"""SELECT event_id, ip, lower(coalesce({clean('event_type')}, {clean('collection')})) AS t,
        coalesce({clean('product_id')}, {clean('productid')}, {clean('viewing_product_id')}) AS own_id,
        {clean('viewing_product_id')} AS viewing_id, coalesce({clean('current_url')}, {clean('url')}) AS page,
        {clean('referrer_url')} AS referrer, coalesce({clean('event_time')}, cast(time_stamp as varchar)) AS event_time
        FROM product_events""",
}
for _mode in ("raw", "clean"):
    TEXTS[f"all_{_mode}"] = f"""SELECT CASE WHEN t = {CLICK} THEN viewing_id ELSE own_id END AS product_id,
        CASE WHEN t = {CLICK} THEN referrer ELSE page END AS candidate_url, t AS source_event_type,
        CASE WHEN t = {CLICK} THEN 'referrer_url' ELSE 'current_url' END AS url_source_field,
        event_time, event_id, ip FROM named_{_mode}"""
TEXTS["candidates_raw"] = """SELECT * FROM all_raw WHERE product_id NOT IN ('', 'none', 'null', 'nan')
    AND candidate_url NOT IN ('', 'none', 'null', 'nan')"""
TEXTS["candidates_clean"] = f"""SELECT * FROM all_clean WHERE source_event_type IN {PRODUCT_EVENTS}
    AND product_id IS NOT NULL AND candidate_url IS NOT NULL"""
for _mode in ("raw", "clean"):
    TEXTS[f"groups_{_mode}"] = f"""SELECT product_id, candidate_url, source_event_type, url_source_field,
        count(*) AS event_count, min(event_time) AS first_seen_at, max(event_time) AS last_seen_at
        FROM candidates_{_mode} GROUP BY ALL"""
    TEXTS[f"ranked_{_mode}"] = f"""SELECT *, cast(row_number() OVER (PARTITION BY product_id
        ORDER BY event_count DESC, last_seen_at DESC NULLS LAST, candidate_url, source_event_type,
        url_source_field) as integer) AS url_rank FROM groups_{_mode}"""
TEXTS["distinct_ips"] = f"""SELECT ip_key, arg_min(ip, event_id) AS ip, min(event_id) AS first_at
    FROM (SELECT event_id, ip, coalesce(nullif({norm('ip')}, ''), ip) AS ip_key FROM event_records
          WHERE ip <> '') GROUP BY ip_key"""
TEXTS["target_ids"] = "SELECT concat('P', cast(n_nationkey as string)) AS product_id FROM nation"
TEXTS["target_ips"] = f"""SELECT ip_key, arg_min(ip, event_id) AS ip, min(event_id) AS first_at
    FROM (SELECT event_id, ip, coalesce(nullif({norm('ip')}, ''), ip) AS ip_key FROM candidates_clean
          WHERE ip <> '' AND product_id IN (SELECT product_id FROM target_ids)) GROUP BY ip_key"""


def _located(source, found):
    TEXTS[f"{source}_numbers"] = f"""SELECT address, {v4('address')} AS v4, {v6('address')} AS v6
        FROM (SELECT {norm('ip')} AS address FROM {found})"""
    TEXTS[f"{source}_valid"] = f"""SELECT *, coalesce(CASE WHEN v4 IS NOT NULL THEN NOT ({PRIVATE})
        ELSE v6 IS NOT NULL END, false) AS valid FROM {source}_numbers"""
    TEXTS[source] = f"""SELECT coalesce(address, '') AS ip, country, nullif(region, '-') AS region, city,
        latitude, longitude, CASE WHEN valid THEN 'ok' ELSE 'invalid_ip' END AS status
        FROM {source}_valid LEFT JOIN geo_ranges ON valid AND v4 BETWEEN ip_from AND ip_to"""


_located("located", "distinct_ips")
_located("target_located", "target_ips")
TEXTS["raw_ips"] = "SELECT DISTINCT ip FROM event_records WHERE ip <> ''"
_located("raw_located", "raw_ips")
TEXTS["event_addresses"] = f"""SELECT event_id, address, {v4('address')} AS v4, {v6('address')} AS v6
    FROM (SELECT event_id, {norm('ip')} AS address FROM event_records)"""

TEXTS["nested_hits"] = """SELECT address, valid, country, nullif(region, '-') AS region, city
    FROM (SELECT DISTINCT * FROM raw_located_valid) LEFT JOIN nested_ranges ON valid AND v4 BETWEEN ip_from AND ip_to
    QUALIFY row_number() OVER (PARTITION BY address ORDER BY ip_to - ip_from, country DESC) = 1"""

TEXTS["v6_numbers"] = f"""SELECT ip, {v4("replace(ip, '::ffff:', '')")} AS v4, {v6('ip')} AS v6
    FROM v6_addresses"""

TEXTS["cells"] = f"""SELECT 'k' AS field_name, 'integer' AS kind, cast(k as varchar) AS text FROM records
    UNION ALL SELECT 'v', CASE event_id % 3 WHEN 0 THEN 'string' WHEN 1 THEN 'float' ELSE 'null' END,
        CASE WHEN event_id % 3 < 2 THEN replace(varied, '"', '') END FROM records
    UNION ALL SELECT '{DEEP}', 'string', deep FROM records"""
TEXTS["kinds"] = "SELECT field_name, kind, count(*) AS n FROM cells GROUP BY field_name, kind"

DOMAIN_LIST = ", ".join(f"('{domain}', {place})" for place, domain in enumerate(SHOP_DOMAINS))
TEXTS["domains"] = f"SELECT * FROM (VALUES {DOMAIN_LIST}) AS d(domain, place)"
TEXTS["choices"] = """
    SELECT product_id, candidate_url, 0 AS place, candidate_url AS url, 'original_url' AS strategy
    FROM part_targets
    UNION ALL SELECT product_id, candidate_url, 1,
        concat('https://www.shop.com/catalog/product/view/id/', product_id), 'source_domain_product_id_url'
    FROM part_targets WHERE candidate_url LIKE 'https://www.shop.com/%'
    UNION ALL SELECT product_id, candidate_url, 2 + place,
        concat('https://', domain, '/catalog/product/view/id/', product_id), 'fallback_domain_product_id_url'
    FROM part_targets CROSS JOIN domains
    UNION ALL SELECT product_id, candidate_url, 9,
        concat('https://', split_part(candidate_url, '/', 3), '/catalog/product/view/id/', product_id),
        'source_domain_product_id_url'
    FROM part_targets WHERE candidate_url NOT LIKE 'https://www.shop.com/%'"""
TEXTS["tries"] = """SELECT product_id, candidate_url,
    cast(row_number() OVER (PARTITION BY product_id ORDER BY place) as integer) AS attempt_no, url, strategy
    FROM (SELECT product_id, candidate_url, url, min(place) AS place, arg_min(strategy, place) AS strategy
          FROM choices GROUP BY product_id, candidate_url, url)"""
TEXTS["payloads"] = """SELECT part_id, url, status_code, html,
    nullif(regexp_extract(html, 'react_data = (\\{.*?\\}\\});', 1), '') AS payload FROM page_snapshot"""
TEXTS["read_pages"] = """SELECT part_id, url, status_code, payload,
    trim(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), ' +', ' ', 'g')) AS title,
    json_extract_string(payload, '$.product_id') AS found_id, json_extract_string(payload, '$.name') AS name,
    json_extract_string(payload, '$.sku') AS sku, json_extract_string(payload, '$.price') AS price,
    json_extract_string(payload, '$.opt.q') AS opt_q FROM payloads"""
TEXTS["checked"] = """SELECT *, cast(part_id as string) AS requested,
    coalesce(found_id = cast(part_id as string), false) AS same,
    coalesce(name <> '' OR sku <> '', false) AS useful FROM read_pages"""
TEXTS["joined"] = """SELECT t.*, p.status_code, p.sku, p.title, p.name,
    coalesce(p.status_code = 200 AND p.same AND p.useful, false) AS hit
    FROM tries t LEFT JOIN checked p ON t.url = p.url"""
TEXTS["hits"] = "SELECT product_id, min(attempt_no) AS hit_no FROM joined WHERE hit GROUP BY product_id"
TEXTS["kept"] = """SELECT j.*, h.hit_no FROM joined j LEFT JOIN hits h USING (product_id)
    WHERE h.hit_no IS NULL OR j.attempt_no <= h.hit_no"""
TEXTS["last_rows"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY requested_product_id
    ORDER BY seq DESC) AS place FROM crawl_log) WHERE place = 1"""


def _needed(text, order=None):
    """Names of the table expressions a query uses, each after the ones it uses itself."""
    order = [] if order is None else order
    for name, inner in TEXTS.items():
        if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
            _needed(inner, order)
            order.append(name)
    return order


def sql(text):
    names = _needed(text)
    if not names:
        return text
    return "WITH " + ",\n".join(f"{name} AS ({TEXTS[name]})" for name in names) + f"\n{text}"


TARGET_COLUMNS = """product_id, candidate_url, source_event_type, url_source_field, event_count, first_seen_at,
    last_seen_at, url_rank"""
CANDIDATE_COLUMNS = "product_id, candidate_url, source_event_type, url_source_field, event_time, event_id"
LOG_COUNTS = """count(DISTINCT requested_product_id) AS product_count, count(*) AS row_count,
    count(*) FILTER (status = 'ok') AS ok_count, count(*) FILTER (active) AS active_count"""


def _dictionary(fields):
    """Dictionary rows of event_records; ``fields`` are (name, type)."""
    parts = []
    for name, kind in fields:
        text = f"cast({name} as varchar)"
        filled = f"count(*) FILTER (trim({text}) <> '')"
        values = f"(SELECT list(v ORDER BY v) FROM (SELECT DISTINCT {text} AS v FROM event_records WHERE trim({text}) <> '' ORDER BY v LIMIT 3))"
        parts.append(
            f"""SELECT '{name}' AS field_name,
            CASE WHEN count(*) - count({name}) > count({name}) OR
                (count(*) - count({name}) = count({name}) AND 'null' < '{kind}') THEN 'null' ELSE '{kind}' END
                AS data_type,
            concat_ws(',', CASE WHEN count({name}) > 0 AND '{kind}' < 'null' THEN '{kind}' END,
                CASE WHEN count({name}) < count(*) THEN 'null' END,
                CASE WHEN count({name}) > 0 AND '{kind}' > 'null' THEN '{kind}' END) AS observed_types,
            {filled} AS non_null_count,
            round((count(*) - {filled}) * 100.0::double / count(*), 2) AS null_pct,
            coalesce({values}[1], '') AS example,
            coalesce(array_to_string({values}, ' | '), '') AS sample_values FROM event_records"""
        )
    return " UNION ALL ".join(parts)


def _types(fields):
    parts = []
    for name, column, kind in fields:
        parts.append(
            f"""SELECT '{name}' AS field_name, '{kind}' AS value_type, count({column}) AS "values",
            count(*) FILTER (trim(cast({column} as varchar)) <> '') AS filled FROM event_records
            HAVING count({column}) > 0
            UNION ALL SELECT '{name}', 'null', count(*) - count({column}), 0 FROM event_records
            HAVING count({column}) < count(*)"""
        )
    return " UNION ALL ".join(parts)


NESTED = [
    ("id", "event_id", "integer"), ("event.collection", "collection", "string"),
    ("event.event_type", "event_type", "string"), ("event.url.current_url", "current_url", "string"),
    ("event.url.referrer_url", "referrer_url", "string"), ("user.user_id", "user_id", "integer"),
    ("user.ip", "ip", "string"),
]
RECORD_FIELDS = [
    ("event_id", "integer"), ("user_id", "integer"), ("collection", "string"), ("event_type", "string"),
    ("product_id", "string"), ("viewing_product_id", "string"), ("current_url", "string"),
    ("referrer_url", "string"), ("productid", "string"), ("url", "string"), ("event_time", "string"),
    ("time_stamp", "integer"), ("ip", "string"),
]
HASH = f"cast(('0x' || substr(md5(concat(cast(event_id as varchar), ':{SAMPLE_SEED}')), 1, 15)) as bigint)"
HOST = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"

QUERIES = {
    "event_scan": f"SELECT {', '.join(name for name, _ in EVENT_RECORDS if name in EVENTS.fieldNames())} FROM event_records",
    "product_event_count": "SELECT count(*) AS event_count FROM product_events",
    "product_events": "SELECT event_id, collection, current_url, referrer_url FROM product_events",
    "clean_texts": "SELECT event_id, "
    + ", ".join(
        f"{clean(name)} AS {name}"
        for name in ("event_type", "product_id", "viewing_product_id", "current_url", "referrer_url", "ip")
    )
    + " FROM event_records",
    "candidates_raw": f"SELECT {CANDIDATE_COLUMNS} FROM candidates_raw",
    "candidates_clean": f"SELECT {CANDIDATE_COLUMNS} FROM candidates_clean",
    "candidate_groups": "SELECT * FROM groups_raw",
    "targets_best": f"SELECT {TARGET_COLUMNS} FROM ranked_raw WHERE url_rank = 1",
    "targets_best_clean": f"SELECT {TARGET_COLUMNS} FROM ranked_clean WHERE url_rank = 1",
    "targets_all": f"SELECT {TARGET_COLUMNS} FROM ranked_raw",
    "targets_kept": f"SELECT {TARGET_COLUMNS} FROM ranked_raw WHERE url_rank IN (2, 3)",
    "targets_in_order": """SELECT product_id, url_rank, candidate_url,
        row_number() OVER (ORDER BY product_id, url_rank) AS place FROM ranked_raw""",
    "targets_job_summary": """SELECT 'extract_product_targets' AS stage, 'raw' AS aggregation_mode,
        (SELECT count(*) FROM product_events) AS scanned_records,
        cast(sum(event_count) as bigint) AS candidate_records, count(*) AS grouped_url_count,
        count(DISTINCT product_id) AS target_rows, count(DISTINCT product_id) AS unique_products FROM groups_raw""",
    "table_replaced_then_extended": """SELECT product_id, candidate_url FROM part_targets
        UNION ALL SELECT concat('+', product_id), candidate_url FROM part_targets""",
    "targets_all_clean": f"SELECT {TARGET_COLUMNS} FROM ranked_clean",
    "target_stats": """SELECT count(*) AS grouped_url_count, cast(sum(event_count) as bigint) AS candidate_records,
        count(*) FILTER (url_rank = 1) AS target_rows, count(DISTINCT product_id) AS unique_products
        FROM ranked_raw""",
    "extraction_stats": """SELECT (SELECT count(*) FROM product_events) AS scanned_records,
        cast(sum(event_count) as bigint) AS candidate_records, count(*) AS grouped_url_count,
        count(DISTINCT product_id) AS unique_products FROM groups_clean""",
    "targets_csv_roundtrip": f"SELECT {TARGET_COLUMNS} FROM ranked_raw WHERE url_rank = 1",
    "targets_jsonl_roundtrip": f"SELECT {TARGET_COLUMNS} FROM ranked_raw WHERE url_rank = 1",
    "best_targets_first": "SELECT product_id, candidate_url, url_rank FROM ranked_raw WHERE url_rank = 1",
    "best_targets_limited": f"""SELECT product_id, candidate_url, url_rank FROM ranked_raw WHERE url_rank = 1
        ORDER BY product_id LIMIT {PRODUCT_LIMIT}""",
    "best_targets_pick": """SELECT product_id, candidate_url, event_count FROM (SELECT *, row_number() OVER
        (PARTITION BY product_id ORDER BY event_count DESC, candidate_url) AS place FROM groups_raw)
        WHERE place = 1""",
    "sample_first": f"SELECT * FROM event_records ORDER BY event_id LIMIT {SAMPLE_SIZE}",
    "sample_random": f"SELECT * FROM event_records ORDER BY {HASH}, event_id LIMIT {SAMPLE_SIZE}",
    "distinct_ips_raw": "SELECT DISTINCT ip FROM event_records WHERE ip <> ''",
    "distinct_ips_limited": f"SELECT DISTINCT ip FROM event_records WHERE ip <> '' ORDER BY ip LIMIT {IP_LIMIT}",
    "distinct_ips_normalized": "SELECT * FROM distinct_ips",
    "normalize_ips": f"SELECT event_id, {norm('ip')} AS address FROM event_records",
    "valid_ips": f"""SELECT event_id, coalesce(CASE WHEN v4 IS NOT NULL THEN NOT ({PRIVATE})
        ELSE v6 IS NOT NULL END, false) AS valid FROM event_addresses""",
    "valid_ips_allow_private": """SELECT event_id, v4 IS NOT NULL OR v6 IS NOT NULL AS valid
        FROM event_addresses""",
    "ip_to_long": "SELECT event_id, v4, v6 FROM event_addresses",
    "target_event_ips": "SELECT * FROM target_ips",
    "target_event_ip_stats": """SELECT
        (SELECT count(*) FROM product_events WHERE ip <> '') AS product_event_scanned_count,
        count(*) AS product_event_candidate_count,
        count(*) FILTER (product_id IN (SELECT product_id FROM target_ids)) AS product_event_matched_count
        FROM candidates_clean WHERE ip <> ''""",
    "ip_locations": "SELECT * FROM located",
    "ip_locations_v6": """SELECT ip, coalesce(g.country, r.country) AS country, coalesce(nullif(g.region, '-'), r.region) AS region,
            coalesce(g.city, r.city) AS city, coalesce(g.latitude, r.latitude) AS latitude,
            coalesce(g.longitude, r.longitude) AS longitude, 'ok' AS status
        FROM v6_numbers LEFT JOIN geo_ranges g ON v4 BETWEEN g.ip_from AND g.ip_to
            LEFT JOIN v6_ranges r ON v4 IS NULL AND v6 BETWEEN r.ip_from AND r.ip_to""",
    "ip_locations_nested": f"""SELECT coalesce(h.address, '') AS ip, country, region, city,
            CASE WHEN valid THEN 'ok' ELSE 'invalid_ip' END AS status, count(*) AS events
        FROM (SELECT {norm('ip')} AS address FROM event_records WHERE ip <> '') e
            JOIN nested_hits h ON e.address IS NOT DISTINCT FROM h.address GROUP BY ALL""",
    "ip_locations_aggregate": "SELECT * FROM raw_located",
    "ip_status_unconfigured": """SELECT ip, CASE WHEN status = 'ok' THEN 'lookup_not_configured' ELSE status END
        AS status FROM located""",
    "location_counts": """SELECT concat_ws(' | ', country, coalesce(region, ''), coalesce(city, '')) AS location,
        count(*) AS rows FROM located WHERE country IS NOT NULL GROUP BY 1""",
    "country_counts": "SELECT country, count(*) AS rows FROM located WHERE country <> '' GROUP BY country",
    "ip_summary": """SELECT count(*) AS processed_count, count(*) FILTER (status = 'ok') AS ok_count,
        count(*) FILTER (status = 'invalid_ip') AS invalid_count,
        count(DISTINCT concat_ws('|', country, coalesce(region, ''), coalesce(city, '')))
            FILTER (country IS NOT NULL) AS unique_location_count FROM located""",
    "ip_upsert": """SELECT l.ip, t.country, coalesce(t.status,
            CASE WHEN l.status = 'ok' THEN 'lookup_not_configured' ELSE l.status END) AS status
        FROM located l LEFT JOIN target_located t ON l.ip = t.ip WHERE l.ip <> ''""",
    "ip_upsert_stream": "SELECT * FROM located WHERE ip <> ''",
    "url_attempts": "SELECT * FROM tries",
    "url_attempts_own": """SELECT product_id, candidate_url, cast(1 as integer) AS attempt_no,
        concat('https://', split_part(candidate_url, '/', 3), '/id/', product_id) AS url, 'own' AS strategy
        FROM part_targets""",
    "store_from_url": f"""SELECT url, {HOST} AS host,
        nullif(regexp_replace({HOST}, '^(?:www[.])?shop[.]', ''), '') AS store
        FROM (SELECT url FROM page_snapshot UNION ALL SELECT url FROM pages)""",
    "extract_payload": """SELECT url, payload IS NOT NULL AS found, found_id AS product_id, name, sku, price, opt_q
        FROM read_pages""",
    "page_title": """SELECT url, nullif(trim(regexp_replace(regexp_extract(html,
        '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title
        FROM (SELECT url, html FROM page_snapshot UNION ALL SELECT url, html FROM pages)""",
    "page_classify": """SELECT requested AS requested_product_id, url AS source_url,
        CASE WHEN status_code = 200 AND same AND useful THEN 'ok' ELSE concat('http_', cast(status_code as string))
            END AS status,
        CASE WHEN status_code <> 200 THEN concat('http_', cast(status_code as string))
            WHEN payload IS NULL THEN 'react_data_not_found' WHEN NOT same THEN 'product_id_mismatch'
            WHEN NOT useful THEN 'missing_basic_product_fields' END AS failure_reason,
        status_code = 200 AND same AND useful AS active, found_id AS product_id,
        coalesce(nullif(name, ''), title) AS product_name, name, sku, price,
        regexp_extract(url, 'https://www[.]shop[.]([^/]*)', 1) AS country_store,
        url AS original_url, url AS resolved_url FROM checked""",
    "payload_basic": """SELECT url AS source_url, found_id AS product_id, name, sku, price,
        cast(CASE WHEN payload IS NULL THEN 0 ELSE 4 END as bigint) AS key_count FROM read_pages""",
    "resolve_products": """SELECT product_id AS requested_product_id,
        max(CASE WHEN hit THEN product_id END) AS product_id,
        coalesce(max(CASE WHEN hit THEN url END), max(candidate_url)) AS source_url,
        max(candidate_url) AS original_url, max(CASE WHEN hit THEN url END) AS resolved_url,
        max(CASE WHEN hit THEN regexp_extract(url, 'https://www[.]shop[.]([^/]*)', 1) END) AS country_store,
        max(CASE WHEN hit THEN strategy END) AS crawl_url_strategy,
        max(CASE WHEN hit THEN coalesce(nullif(name, ''), title) END) AS product_name,
        max(CASE WHEN hit THEN sku END) AS sku, bool_or(hit) AS active,
        CASE WHEN bool_or(hit) THEN 'ok' ELSE 'not_found_in_configured_stores' END AS status,
        CASE WHEN NOT bool_or(hit) THEN 'not_found_in_configured_stores' END AS failure_reason,
        CASE WHEN NOT bool_or(hit) AND bool_or(status_code IS NULL) THEN 'page not collected' END
            AS error_message,
        count(*) AS attempt_count,
        string_agg(coalesce(cast(status_code as string), 'request_failed'), ',' ORDER BY attempt_no)
            AS attempt_results
        FROM kept GROUP BY product_id""",
    "latest_crawl": "SELECT requested_product_id, seq, status FROM last_rows",
    "checkpoint_summary": f"""SELECT {LOG_COUNTS}, cast(0 as bigint) AS invalid_line_count FROM crawl_log
        WHERE requested_product_id IN (SELECT product_id FROM crawl_targets)""",
    "status_counts": "SELECT status, count(*) AS rows FROM crawl_log GROUP BY status",
    "country_store_counts": """SELECT country_store, count(*) AS rows FROM crawl_log WHERE country_store <> ''
        GROUP BY country_store""",
    "crawl_summary_resumed": """SELECT t.n AS target_count, t.n - t.done AS pending_target_count,
        t.done AS skipped_checkpoint_count, t.missing AS remaining_count, l.n AS processed_count,
        l.ok AS ok_count, l.active AS active_count,
        round(l.ok * 100.0::double / l.n, 2) AS success_rate_processed_percent,
        round(l.ok * 100.0::double / t.n, 2) AS success_rate_target_percent
        FROM (SELECT count(*) AS n, count(*) FILTER (product_id IN
                (SELECT requested_product_id FROM crawl_log WHERE status = 'ok')) AS done,
                count(*) FILTER (product_id NOT IN (SELECT requested_product_id FROM crawl_log)) AS missing
              FROM crawl_targets) t,
            (SELECT count(*) AS n, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (active) AS active
             FROM crawl_log) l""",
    "crawl_summary": """SELECT t.n AS target_count, t.n AS pending_target_count,
        cast(0 as bigint) AS skipped_checkpoint_count, t.missing AS remaining_count, l.n AS processed_count,
        l.ok AS ok_count, l.active AS active_count,
        round(l.ok * 100.0::double / l.n, 2) AS success_rate_processed_percent,
        round(l.ok * 100.0::double / t.n, 2) AS success_rate_target_percent
        FROM (SELECT count(*) AS n, count(*) FILTER (product_id NOT IN
                (SELECT requested_product_id FROM crawl_log)) AS missing FROM crawl_targets) t,
            (SELECT count(*) AS n, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (active) AS active
             FROM crawl_log) l""",
    "failed_targets": """SELECT t.product_id, coalesce(nullif(t.candidate_url, ''), nullif(l.original_url, ''),
            l.source_url, '') AS candidate_url,
        l.status AS last_status, l.failure_reason, l.error_message,
        cast(coalesce(json_array_length(l.attempts), 0) as integer) AS attempt_count,
        l.source_url AS last_source_url, l.resolved_url AS last_resolved_url, l.scraped_at
        FROM last_rows l JOIN crawl_targets t ON l.requested_product_id = t.product_id
        WHERE l.status <> 'ok'""",
    "pending_targets": """SELECT * FROM crawl_targets WHERE product_id NOT IN
        (SELECT requested_product_id FROM crawl_log)""",
    "strict_jsonl": "SELECT seq, requested_product_id, status, active, error_message FROM crawl_log",
    "corrupt_line_count": f"""SELECT {LOG_COUNTS},
        (SELECT count(*) FROM crawl_log WHERE status = 'crawl_failed') AS invalid_line_count
        FROM crawl_log WHERE status <> 'crawl_failed'""",
    "warehouse_products": """SELECT requested_product_id,
        coalesce(product_id, requested_product_id) AS product_id, source_url, original_url, resolved_url,
        country_store, cast(NULL as string) AS crawl_url_strategy, name AS product_name, name, sku,
        cast(NULL as string) AS category_name, cast(NULL as string) AS currency,
        cast(NULL as string) AS store_code, active, scraped_at, status, failure_reason, error_message,
        coalesce(react_data <> '{}', false) AS react_data_available FROM crawl_log""",
    "warehouse_columns_own": """SELECT requested_product_id, upper(status) AS state, sku IS NULL AS no_sku
        FROM crawl_log""",
    "payload_archive": """SELECT requested_product_id, coalesce(product_id, requested_product_id) AS product_id,
        scraped_at, status, json_extract_string(react_data, '$.product_id') AS payload_product_id,
        json_extract_string(react_data, '$.name') AS payload_name,
        coalesce(react_data <> '{}', false) AS filled FROM crawl_log""",
    "export_counts": "SELECT count(*) AS warehouse_rows, count(*) AS react_data_rows FROM crawl_log",
    "flatten_fields": "SELECT "
    + ", ".join(f'{column} AS "{name}"' for name, column, _ in NESTED)
    + " FROM event_records",
    "field_types": _types(NESTED),
    "data_dictionary": _dictionary(RECORD_FIELDS),
    "data_dictionary_variant": """SELECT field_name, (SELECT t.kind FROM kinds t WHERE t.field_name = c.field_name
            ORDER BY t.n DESC, t.kind LIMIT 1) AS data_type,
        (SELECT string_agg(t.kind, ',' ORDER BY t.kind) FROM kinds t WHERE t.field_name = c.field_name) AS observed_types,
        count(*) FILTER (kind <> 'null' AND trim(text) <> '') AS non_null_count,
        round(((SELECT count(*) FROM records) - count(*) FILTER (kind <> 'null' AND trim(text) <> '')) * 100.0::double
            / (SELECT count(*) FROM records), 2) AS null_pct,
        coalesce(min(text) FILTER (trim(text) <> ''), '') AS example,
        coalesce(array_to_string(list_slice(list_sort(list_distinct(list(text) FILTER (trim(text) <> ''))), 1, 3), ' | '), '')
            AS sample_values FROM cells c GROUP BY field_name""",
}
QUERIES["targets_limited"] = f"""SELECT {TARGET_COLUMNS} FROM (SELECT *, cast(row_number() OVER
    (PARTITION BY product_id ORDER BY event_count DESC, last_seen_at DESC NULLS LAST, candidate_url,
    source_event_type, url_source_field) as integer) AS url_rank
    FROM (SELECT product_id, candidate_url, source_event_type, url_source_field, count(*) AS event_count,
        min(event_time) AS first_seen_at, max(event_time) AS last_seen_at FROM candidates_raw
        WHERE event_id IN (SELECT event_id FROM product_events ORDER BY event_id LIMIT {RECORD_LIMIT})
        GROUP BY ALL)) WHERE url_rank = 1"""

QUERIES["crawl_stream_resumed"] = f"""SELECT requested_product_id, product_id, source_url, product_name, sku, active, status,
    failure_reason FROM ({QUERIES["resolve_products"]})"""
QUERIES["crawl_summary_counters"] = QUERIES["crawl_summary_resumed"].replace("WHERE status = 'ok')) AS done", "WHERE seq % 3 < 2)) AS done")
QUERIES["checkpoint_summary_counters"] = QUERIES["corrupt_line_count"]
QUERIES["status_counts_counters"] = """SELECT 'status' AS kind, status AS value, count(*) AS rows FROM crawl_log GROUP BY status
    UNION ALL SELECT 'store', country_store, count(*) FROM crawl_log WHERE country_store <> '' GROUP BY country_store"""
QUERIES["crawl_stream_counts"] = f"""SELECT count(*) AS rows, count(*) FILTER (active) AS ok
    FROM ({QUERIES["resolve_products"]})"""
QUERIES["bad_line_places"] = """SELECT line, seq FROM (SELECT seq, status, row_number() OVER (ORDER BY seq) AS line
    FROM crawl_log) WHERE status = 'crawl_failed'"""
QUERIES["ip_merge_batches"] = f"""SELECT ip, count(*) AS events, max(event_id) AS last_event, batch FROM (
    SELECT *, max(batch) OVER (PARTITION BY ip) AS last FROM (
        SELECT event_id, event_id % 4 AS batch, coalesce(nullif({norm('ip')}, ''), ip) AS ip
        FROM event_records WHERE ip <> '')) WHERE batch = last GROUP BY ip, batch"""

ORACLE = {name: sql(text) for name, text in QUERIES.items()}
