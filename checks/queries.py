"""One query per operator, over the whole derived tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import derive as D
from clickmart.functions import ip as I
from clickmart.functions import payload as P
from clickmart.functions.text import clean_text
from clickmart.functions.urls import Stores, country_store, url_host
from clickmart.metrics import BatchCounts
from clickmart.operators import crawl_log, dictionary, events, export, ips, pages, sampling, targets
from clickmart.plans import export as export_job
from clickmart.plans import targets as targets_job
from clickmart.plans.counters import CrawlCounters
from clickmart.schemas import EVENTS, TARGETS
from clickmart.session import prepare_session, scratch_path
from clickmart.sources import readers, writers
from clickmart.sources.keyed_table import KeyedTable
from clickmart.streaming.locations import current_locations, location_stream
from clickmart.streaming.resume import crawl_stream, read_crawl_stream, read_target_stream

STORES = Stores("shop", fallback_domains=D.SHOP_DOMAINS, english_domains=D.SHOP_DOMAINS[:2])
SAMPLE_SIZE = 1000
SAMPLE_SEED = 7
RECORD_LIMIT = 3000
PRODUCT_LIMIT = 20
IP_LIMIT = 50

QUERIES = {}


def query(function):
    """Registers a query under its name, on a prepared session."""

    def run(spark, sf_dir):
        return function(prepare_session(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# Events


@query
def event_scan(spark, sf_dir):
    """The stored events through the declared schema."""
    found = readers.read_events(spark, D.event_records.path(spark, sf_dir))
    return found.select(*[name for name, _ in D.EVENT_RECORDS if name in EVENTS.fieldNames()])


@query
def product_event_count(spark, sf_dir):
    return events.event_count(events.product_events(D.event_records(spark, sf_dir)))


@query
def product_events(spark, sf_dir):
    found = events.product_events(D.event_records(spark, sf_dir))
    return found.select("event_id", "collection", "current_url", "referrer_url")


@query
def clean_texts(spark, sf_dir):
    names = ["event_type", "product_id", "viewing_product_id", "current_url", "referrer_url", "ip"]
    return D.event_records(spark, sf_dir).select("event_id", *[clean_text(F.col(n)).alias(n) for n in names])


def _candidates(spark, sf_dir, mode):
    found = events.product_events(D.event_records(spark, sf_dir))
    return events.candidates(found, mode, keep=["event_id"])


@query
def candidates_raw(spark, sf_dir):
    return _candidates(spark, sf_dir, "raw")


@query
def candidates_clean(spark, sf_dir):
    return _candidates(spark, sf_dir, "clean")


@query
def candidate_groups(spark, sf_dir):
    return events.grouped_events(D.event_records(spark, sf_dir))


# Targets


@query
def targets_best(spark, sf_dir):
    return targets.extract_targets(D.event_records(spark, sf_dir))


@query
def targets_best_clean(spark, sf_dir):
    return targets.extract_targets(D.event_records(spark, sf_dir), "clean")


@query
def targets_all(spark, sf_dir):
    return targets.extract_targets(D.event_records(spark, sf_dir), include_all=True)


@query
def targets_kept(spark, sf_dir):
    """An own condition on ranks: the second and third URL of each product."""
    groups = events.grouped_events(D.event_records(spark, sf_dir))
    return targets.ranked_targets(groups, keep=F.col("url_rank").between(2, 3))


@query
def targets_in_order(spark, sf_dir):
    """The file that the job writes, with the place of each row in it."""
    path = scratch_path(spark, "targets-job")
    targets_job.run(D.event_records(spark, sf_dir), path, fmt="jsonl", include_all=True, summary_path=f"{path}-summary")
    rows = readers.with_file_order(readers.read_jsonl(spark, path, TARGETS), "seq")
    place = F.row_number().over(Window.orderBy("seq")).cast("bigint")
    return rows.select("product_id", "url_rank", "candidate_url", place.alias("place"))


@query
def targets_job_summary(spark, sf_dir):
    """The summary file of the job, read back."""
    path = scratch_path(spark, "targets-job")
    targets_job.run(D.event_records(spark, sf_dir), path, summary_path=f"{path}-summary")
    counts = ["scanned_records", "candidate_records", "grouped_url_count", "target_rows", "unique_products"]
    return spark.read.json(f"{path}-summary").select("stage", "aggregation_mode", *counts)


@query
def table_replaced_then_extended(spark, sf_dir):
    """A table written twice, then extended: the first rows are gone."""
    rows = D.part_targets(spark, sf_dir)
    folder = scratch_path(spark, "tables")
    name = f"clickmart_targets_{folder.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE TABLE {name} (product_id STRING, candidate_url STRING) USING parquet LOCATION '{folder}'")
    writers.write_table(rows.select(F.lit("old").alias("product_id"), "candidate_url"), name, keep=True)
    writers.write_table(rows, name)
    writers.write_table(rows.select(F.concat(F.lit("+"), "product_id").alias("product_id"), "candidate_url"), name, keep=True)
    return spark.table(name)


@query
def targets_all_clean(spark, sf_dir):
    return targets.extract_targets(D.event_records(spark, sf_dir), "clean", include_all=True)


@query
def targets_limited(spark, sf_dir):
    return targets.extract_targets(D.event_records(spark, sf_dir), limit=RECORD_LIMIT, order_key="event_id")


@query
def target_stats(spark, sf_dir):
    return targets.target_stats(targets_all(spark, sf_dir))


@query
def extraction_stats(spark, sf_dir):
    return targets.extraction_stats(D.event_records(spark, sf_dir))


def _written(spark, sf_dir, fmt):
    path = scratch_path(spark, "targets") + f".{fmt}"
    rows = targets_best(spark, sf_dir).orderBy("product_id", "url_rank")
    writers.writer_for(fmt)(rows, path, TARGETS.fieldNames())
    back = readers.read_rows(spark, path, TARGETS)
    return back.select(*[F.col(field.name).cast(field.dataType) for field in TARGETS])


@query
def targets_csv_roundtrip(spark, sf_dir):
    return _written(spark, sf_dir, "csv")


@query
def targets_jsonl_roundtrip(spark, sf_dir):
    return _written(spark, sf_dir, "jsonl")


@query
def best_targets_first(spark, sf_dir):
    found = targets.best_targets_first(targets_all(spark, sf_dir))
    return found.select("product_id", "candidate_url", "url_rank")


@query
def best_targets_pick(spark, sf_dir):
    found = targets.best_targets_pick(events.grouped_events(D.event_records(spark, sf_dir)).withColumn("url_rank", F.lit(None).cast("int")))
    return found.select("product_id", "candidate_url", "event_count")


@query
def best_targets_limited(spark, sf_dir):
    found = targets.best_targets_first(targets_best(spark, sf_dir), PRODUCT_LIMIT)
    return found.select("product_id", "candidate_url", "url_rank")


# Samples


@query
def sample_first(spark, sf_dir):
    return sampling.sample(D.event_records(spark, sf_dir), SAMPLE_SIZE, "event_id", "first")


@query
def sample_random(spark, sf_dir):
    return sampling.sample(D.event_records(spark, sf_dir), SAMPLE_SIZE, "event_id", "random", SAMPLE_SEED)


# Addresses


@query
def distinct_ips_raw(spark, sf_dir):
    return ips.distinct_raw_ips(D.event_records(spark, sf_dir))


@query
def distinct_ips_limited(spark, sf_dir):
    return ips.distinct_raw_ips(D.event_records(spark, sf_dir), limit=IP_LIMIT)


@query
def distinct_ips_normalized(spark, sf_dir):
    return ips.distinct_normalized_ips(D.event_records(spark, sf_dir), "event_id")


@query
def normalize_ips(spark, sf_dir):
    return D.event_records(spark, sf_dir).select("event_id", I.normalize_ip(F.col("ip")).alias("address"))


@query
def valid_ips(spark, sf_dir):
    return I.with_validity(D.event_records(spark, sf_dir).select("event_id", "ip"), "ip").select("event_id", "valid")


@query
def valid_ips_allow_private(spark, sf_dir):
    rows = D.event_records(spark, sf_dir).select("event_id", "ip")
    return I.with_validity(rows, "ip", allow_private=True).select("event_id", "valid")


@query
def ip_to_long(spark, sf_dir):
    return I.with_address(D.event_records(spark, sf_dir).select("event_id", "ip"), "ip").select(
        "event_id", "v4", "v6"
    )


def _target_ids(spark, sf_dir):
    nation = D.table(spark, sf_dir, "nation")
    return nation.select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("product_id"))


@query
def target_event_ips(spark, sf_dir):
    return ips.target_event_ips(D.event_records(spark, sf_dir), _target_ids(spark, sf_dir), "event_id")


@query
def target_event_ip_stats(spark, sf_dir):
    return ips.target_event_ip_stats(D.event_records(spark, sf_dir), _target_ids(spark, sf_dir), "event_id")


def _locations(spark, sf_dir):
    found = ips.distinct_normalized_ips(D.event_records(spark, sf_dir), "event_id")
    return ips.locate(found, D.geo_ranges(spark, sf_dir), stamp=False).drop("processed_at", "error_message")


@query
def ip_locations(spark, sf_dir):
    return _locations(spark, sf_dir)


@query
def ip_locations_v6(spark, sf_dir):
    """IPv6 addresses of one block, and IPv4 addresses mapped into IPv6."""
    found = D.v6_addresses(spark, sf_dir)
    located = ips.locate(found, D.geo_ranges(spark, sf_dir), D.v6_ranges(spark, sf_dir), stamp=False)
    return located.drop("processed_at", "error_message")


@query
def ip_locations_nested(spark, sf_dir):
    """Blocks of providers inside those of countries, the innermost counts; addresses come as often as events have them."""
    found = ips.with_ip(D.event_records(spark, sf_dir), "ip").select("ip")
    located = ips.locate(found, D.nested_ranges(spark, sf_dir), stamp=False, nested=True)
    return located.groupBy("ip", "country", "region", "city", "status").agg(F.count(F.lit(1)).alias("events"))


@query
def ip_locations_aggregate(spark, sf_dir):
    """Distinct stored values, located one by one: an address in several spellings has several rows."""
    found = ips.distinct_ips(D.event_records(spark, sf_dir), discovery_mode="aggregate")
    return ips.locate(found, D.geo_ranges(spark, sf_dir), stamp=False).drop("processed_at", "error_message")


@query
def ip_status_unconfigured(spark, sf_dir):
    found = ips.distinct_normalized_ips(D.event_records(spark, sf_dir), "event_id")
    return ips.locate(found, stamp=False).select("ip", "status")


@query
def location_counts(spark, sf_dir):
    return ips.location_counts(_locations(spark, sf_dir))


@query
def country_counts(spark, sf_dir):
    return ips.country_counts(_locations(spark, sf_dir))


@query
def ip_summary(spark, sf_dir):
    return ips.ip_totals(_locations(spark, sf_dir))


@query
def ip_upsert(spark, sf_dir):
    """All addresses without a lookup, then those of target events with one."""
    records = D.event_records(spark, sf_dir)
    old = ips.locate(ips.distinct_normalized_ips(records, "event_id"), stamp=False)
    found = ips.target_event_ips(records, _target_ids(spark, sf_dir), "event_id")
    new = ips.locate(found, D.geo_ranges(spark, sf_dir), stamp=False)
    return ips.upsert(old, new).select("ip", "country", "status")


@query
def ip_upsert_stream(spark, sf_dir):
    """The same addresses as ``ip_locations``, through micro-batches."""
    schema = D.table(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of files.
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    records = raw.selectExpr(*D.expressions(D.EVENT_RECORDS, "spark"))
    path, checkpoint = scratch_path(spark, "locations"), scratch_path(spark, "stream")
    stream = location_stream(records, "event_id", path, checkpoint, D.geo_ranges(spark, sf_dir))
    stream.awaitTermination()
    return current_locations(spark, path).drop("processed_at", "error_message")


@query
def ip_merge_batches(spark, sf_dir):
    """A keyed table after four batches: each event key's addresses, the later batch wins, an old batch comes twice."""
    records = ips.with_ip(D.event_records(spark, sf_dir), "ip")
    table = KeyedTable(spark, scratch_path(spark, "merged"), "ip", splits=8, most_layers=2)
    for batch_id in (0, 1, 1, 2, 3):
        part = records.filter(F.col("event_id") % 4 == batch_id)
        rows = part.groupBy(I.distinct_key(F.col("ip")).alias("ip"))
        rows = rows.agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event"))
        table.merge(rows.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)
    return table.read()


# Pages


@query
def url_attempts(spark, sf_dir):
    return pages.exploded_attempts(D.part_targets(spark, sf_dir), STORES)


def _catalog_only(product_id, source_url, host, stores):
    return F.array(
        F.struct(F.concat(F.lit("https://"), host, F.lit("/id/"), product_id).alias("url"), F.lit("own").alias("strategy"))
    )


@query
def url_attempts_own(spark, sf_dir):
    """Attempts of a strategy that the caller brings."""
    return pages.exploded_attempts(D.part_targets(spark, sf_dir), STORES, _catalog_only)


@query
def store_from_url(spark, sf_dir):
    snapshot = D.page_snapshot(spark, sf_dir).select("url")
    found = snapshot.unionAll(D.table(spark, sf_dir, "pages").select("url"))
    return found.select(
        "url", url_host(F.col("url")).alias("host"), country_store(F.col("url"), STORES).alias("store")
    )


@query
def extract_payload(spark, sf_dir):
    found = D.page_snapshot(spark, sf_dir).select("url", P.page_payload(F.col("html")).alias("payload"))
    payload = F.col("payload")
    return found.select(
        "url",
        payload.isNotNull().alias("found"),
        *[P.text_of(payload, key).alias(key) for key in ("product_id", "name", "sku", "price")],
        F.try_variant_get(payload, "$.opt.q", "string").alias("opt_q"),
    )


@query
def page_title(spark, sf_dir):
    snapshot = D.page_snapshot(spark, sf_dir).select("url", "html")
    found = snapshot.unionAll(D.table(spark, sf_dir, "pages").select("url", "html"))
    return found.select("url", P.page_title(F.col("html")).alias("title"))


def _requested(spark, sf_dir):
    return D.page_snapshot(spark, sf_dir).select(
        F.col("part_id").cast("string").alias("requested_product_id"),
        F.col("url").alias("source_url"),
        "status_code",
        "html",
    )


@query
def page_classify(spark, sf_dir):
    return pages.classify_pages(_requested(spark, sf_dir), STORES, stamp=False).select(
        "requested_product_id", "source_url", "status", "failure_reason", "active", "product_id",
        "product_name", "name", "sku", F.col("price").try_cast("string").alias("price"), "country_store",
        "original_url", "resolved_url",
    )


@query
def payload_basic(spark, sf_dir):
    found = pages.classify_pages(_requested(spark, sf_dir), STORES, stamp=False)
    basic = F.col("react_data_basic")
    return found.select(
        "source_url",
        *[P.text_of(basic, key).alias(key) for key in ("product_id", "name", "sku", "price")],
        F.size(basic.try_cast("map<string,variant>")).cast("bigint").alias("key_count"),
    )


@query
def resolve_products(spark, sf_dir):
    found = pages.resolve_products(
        D.part_targets(spark, sf_dir), D.page_snapshot(spark, sf_dir), STORES, stamp=False
    )
    return found.select(
        "requested_product_id", "product_id", "source_url", "original_url", "resolved_url", "country_store",
        "crawl_url_strategy", "product_name", "sku", "active", "status", "failure_reason", "error_message",
        F.size("attempts").cast("bigint").alias("attempt_count"),
        F.array_join(F.transform("attempts", lambda a: F.coalesce(a["status_code"].cast("string"), a["status"])), ",")
        .alias("attempt_results"),
    )


def _crawled(spark, sf_dir, counts=None):
    """Output of a crawl stream that was stopped and started again."""
    wanted = D.part_targets(spark, sf_dir)
    incoming, out, state = (scratch_path(spark, name) for name in ("incoming", "crawled", "stream"))
    part = F.pmod(F.xxhash64("product_id"), F.lit(4))
    for chosen in (part < 2, part > 0):
        rows = wanted.filter(chosen).select("product_id", "candidate_url")
        rows = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit("1").alias(f.name) for f in TARGETS])
        rows.repartition(2).write.mode("append").options(**readers.CSV_OPTIONS).csv(incoming)
        stream = read_target_stream(spark, incoming, maxFilesPerTrigger="1")
        crawl_stream(stream, D.page_snapshot(spark, sf_dir), STORES, out, state, counts_path=counts).awaitTermination()
    return out


@query
def crawl_stream_counts(spark, sf_dir):
    """What the batches of both runs have counted while they were written."""
    counts = scratch_path(spark, "counts")
    _crawled(spark, sf_dir, counts)
    found = BatchCounts(spark, counts).read()
    return found.agg(F.sum("rows").alias("rows"), F.sum("ok").alias("ok"))


@query
def crawl_stream_resumed(spark, sf_dir):
    """The same products as ``resolve_products``, crawled by a stream that is stopped and started again.

    The second run finds half of the products of the first one once more, in files of two batches.
    """
    out = _crawled(spark, sf_dir)
    found = read_crawl_stream(spark, out)
    return found.select("requested_product_id", "product_id", "source_url", "product_name", "sku", "active", "status", "failure_reason")


# Crawl log


@query
def latest_crawl(spark, sf_dir):
    return crawl_log.latest_rows(D.crawl_log(spark, sf_dir)).select("requested_product_id", "seq", "status")


@query
def checkpoint_summary(spark, sf_dir):
    return crawl_log.checkpoint_summary(D.crawl_log(spark, sf_dir), D.crawl_targets(spark, sf_dir))


@query
def status_counts(spark, sf_dir):
    return crawl_log.status_counts(D.crawl_log(spark, sf_dir))


@query
def country_store_counts(spark, sf_dir):
    return crawl_log.country_store_counts(D.crawl_log(spark, sf_dir))


@query
def crawl_summary(spark, sf_dir):
    return crawl_log.crawl_totals(D.crawl_log(spark, sf_dir), D.crawl_targets(spark, sf_dir))


@query
def crawl_summary_resumed(spark, sf_dir):
    """The same when the products of finished orders were done before this run."""
    log = D.crawl_log(spark, sf_dir)
    before = log.filter("status = 'ok'").select(F.col("requested_product_id").alias("product_id"))
    return crawl_log.crawl_totals(log, D.crawl_targets(spark, sf_dir), before)


@query
def crawl_summary_counters(spark, sf_dir):
    """The summary of the last of three runs, whose counters go on from those of the runs before it."""
    log, counters = D.crawl_log(spark, sf_dir), CrawlCounters(spark, scratch_path(spark, "counters"), splits=8)
    for run in range(3):
        counters.add(log.filter(F.col("seq") % 3 == run), run)
    counters.add(log.filter("seq % 3 = 1"), 1)  # a run that is added again
    return counters.totals(D.crawl_targets(spark, sf_dir), 2)


@query
def checkpoint_summary_counters(spark, sf_dir):
    """The checkpoint summary of a log with unreadable lines, from counters of two runs."""
    log, counters = D.crawl_log(spark, sf_dir), CrawlCounters(spark, scratch_path(spark, "counters"), splits=8)
    bad = F.col("status") == "crawl_failed"
    lines = log.withColumn(readers.BAD_LINE, F.when(bad, F.lit("not-json")))
    lines = lines.withColumn("requested_product_id", F.when(~bad, F.col("requested_product_id")))
    for run in range(2):
        counters.add(lines.filter(F.col("seq") % 2 == run), run)
    return counters.checkpoint_summary()


@query
def status_counts_counters(spark, sf_dir):
    """Rows per status and per store from counters of two runs."""
    log, counters = D.crawl_log(spark, sf_dir), CrawlCounters(spark, scratch_path(spark, "counters"), splits=8)
    for run in range(2):
        counters.add(log.filter(F.col("seq") % 2 == run), run)
    named = counters.status_counts().select(F.lit("status").alias("kind"), F.col("status").alias("value"), "rows")
    return named.unionAll(counters.country_store_counts().select(F.lit("store"), "country_store", "rows"))


@query
def failed_targets(spark, sf_dir):
    return crawl_log.failed_targets(D.crawl_log(spark, sf_dir), D.crawl_targets(spark, sf_dir))


@query
def pending_targets(spark, sf_dir):
    return crawl_log.pending_targets(D.crawl_targets(spark, sf_dir), D.crawl_log(spark, sf_dir))


LOG_FIELDS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("requested_product_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
    ]
)


@query
def strict_jsonl(spark, sf_dir):
    path = scratch_path(spark, "log")
    writers.write_jsonl(D.crawl_log(spark, sf_dir), path, LOG_FIELDS.fieldNames())
    return readers.read_jsonl_strict(spark, path, LOG_FIELDS)


@query
def bad_line_places(spark, sf_dir):
    """Where lines that are no object stand in one file of the whole log."""
    path = scratch_path(spark, "places")
    log = D.crawl_log(spark, sf_dir)
    line = F.to_json(F.struct(*LOG_FIELDS.fieldNames()))
    value = F.when(F.col("status") == "crawl_failed", F.concat(line, F.lit(" }"))).otherwise(line)
    log.orderBy("seq").select(value.alias("value")).coalesce(1).write.text(path)
    return readers.bad_lines(spark, path).select("line", F.get_json_object("value", "$.seq").cast("bigint").alias("seq"))


@query
def corrupt_line_count(spark, sf_dir):
    """The log as text, where the crawls that failed left a line that is no JSON."""
    path = scratch_path(spark, "lines")
    log = D.crawl_log(spark, sf_dir)
    line = F.to_json(F.struct(*LOG_FIELDS.fieldNames()))
    log.select(F.when(F.col("status") == "crawl_failed", "not-json").otherwise(line).alias("value")).write.text(path)
    return crawl_log.checkpoint_summary(readers.read_jsonl_tolerant(spark, path, LOG_FIELDS))


# Export


@query
def warehouse_products(spark, sf_dir):
    found = export.warehouse_products(D.crawl_log(spark, sf_dir))
    return found.drop("category", "price")


@query
def warehouse_columns_own(spark, sf_dir):
    """A projection that the caller brings."""
    columns = ["requested_product_id", F.upper("status").alias("state"), F.col("sku").isNull().alias("no_sku")]
    return export.warehouse_products(D.crawl_log(spark, sf_dir), columns)


@query
def payload_archive(spark, sf_dir):
    payload = F.col("react_data")
    return export.payload_archive(D.crawl_log(spark, sf_dir)).select(
        "requested_product_id", "product_id", "scraped_at", "status",
        P.text_of(payload, "product_id").alias("payload_product_id"),
        P.text_of(payload, "name").alias("payload_name"),
        P.is_filled_object(payload).alias("filled"),
    )


@query
def export_counts(spark, sf_dir):
    path = scratch_path(spark, "export")
    counts = export_job.run(D.crawl_log(spark, sf_dir), f"{path}/warehouse", "csv", f"{path}/archive")
    return spark.createDataFrame(
        [(counts["warehouse_rows"], counts["react_data_rows"])], "warehouse_rows BIGINT, react_data_rows BIGINT"
    )


# Dictionary


def _nested(spark, sf_dir):
    return D.event_records(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.struct("collection", "event_type", F.struct("current_url", "referrer_url").alias("url")).alias("event"),
        F.struct("user_id", "ip").alias("user"),
    )


@query
def flatten_fields(spark, sf_dir):
    return dictionary.flatten(_nested(spark, sf_dir))


@query
def field_types(spark, sf_dir):
    return dictionary.field_types(_nested(spark, sf_dir))


@query
def data_dictionary(spark, sf_dir):
    return dictionary.profile(D.event_records(spark, sf_dir))


@query
def data_dictionary_variant(spark, sf_dir):
    """Objects made of the raw events, whose fields are not declared."""
    raw = D.table(spark, sf_dir, "events").selectExpr(*D.expressions(D.RECORDS, "spark"))
    text = F.expr(D.record_text("k", "varied", "deep"))
    return dictionary.profile_variants(raw.select(F.parse_json(text).alias("record")), "record")
