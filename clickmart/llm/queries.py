"""The queries of the operators, each over its whole tables."""

from pyspark.sql import functions as F

from clickmart.llm import conversations, decontaminate, divergence, imatch, jaccard_join, katz, licenses, minmax, ordinal
from clickmart.llm import packing, substring_dedup, warc, wavelet
from clickmart.llm.tokens import shared_tokenizer
from clickmart.session import prepare_session

QUERIES = {}


def query(function):
    def run(spark, sf_dir):
        return function(prepare_session(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def tokenizer_path(name):
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_substring_dedup(spark, sf_dir):
    found = substring_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query
def op9_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tokenizer = shared_tokenizer(spark, tokenizer_path("word_bpe_49k.json"), keeps_blanks=False)
    return packing.pack(packing.pieces(docs, tokenizer))


@query
def op8_wavelet_shards(spark, sf_dir):
    tokenizer = shared_tokenizer(spark, tokenizer_path("byte_bpe_50k.json"), keeps_blanks=True)
    folder = wavelet.new_folder(spark)
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), folder, tokenizer)
    return wavelet.read_shards(spark, folder, shards)


@query
def op5_imatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return imatch.compare_edits(docs, imatch.lexicon(docs))


@query
def op6_decontamination(spark, sf_dir):
    found = decontaminate.benchmark_hits(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query
def op7_katz_backoff(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query
def op1_ordinal_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = ordinal.fit_sample(docs, table(spark, sf_dir, "labels"))
    return ordinal.rate(docs.select("doc_id", "text"), model).drop("text")


@query
def op2_licence_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op4_warc_archives(spark, sf_dir):
    folder = warc.new_folder(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, archives).drop("url")


@query
def op11_conversation_repair(spark, sf_dir):
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_digests(*turns)


@query
def op12_minmax_dedup(spark, sf_dir):
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))
