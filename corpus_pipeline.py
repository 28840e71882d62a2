"""From raw documents to packed training sequences: five stages, each one operator of ``clickmart.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of ``docs``; extra columns, whatever their names, pass through. Rows with null ids or texts are documents like others.
"""

from pyspark.sql import functions as F

from clickmart.llm import decontaminate, jaccard_join, ordinal, packing, substring_dedup
from clickmart.llm.queries import tokenizer_path
from clickmart.llm.tokens import shared_tokenizer
from clickmart.session import prepare_session, stored


def _apart(docs):
    """``docs`` with all columns but ``doc_id`` and ``text`` renamed, so that none clashes, and the way back."""
    other = [name for name in docs.columns if name not in ("doc_id", "text")]
    names = {name: f"column {n}" for n, name in enumerate(other)}

    def back(frame):
        return frame.select([F.col(names.get(name, name)).alias(name) for name in docs.columns])

    return docs.withColumnsRenamed(names), back


def quality_classifier(spark, docs, sf_dir):
    """Keeps the documents whose tail probability of the best grade is at least one half.

    The model is fitted on a bounded sample of the documents that ``labels`` rates.
    """
    prepare_session(spark)
    docs, back = _apart(docs)
    model = ordinal.fit_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(ordinal.rate(docs, model).where("selected"))


def ngram_jaccard_join(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near duplicates."""
    prepare_session(spark)
    return jaccard_join.first_of_each_class(docs)


def substring_dedup_stage(spark, docs, sf_dir):
    """Removes every word of windows that occur more than once; other texts stay as they are.

    A changed text is its kept words joined by blanks, and ``n_chars`` its new length.
    """
    prepare_session(spark)
    docs, back = _apart(docs)
    found = substring_dedup.repeated_spans(docs)
    changed = F.col("n_removed") > 0
    found = back(found.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text"))))
    if "n_chars" in found.columns:
        kind = dict(found.dtypes)["n_chars"]
        found = found.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found


def benchmark_decontamination(spark, docs, sf_dir):
    """Drops contaminated documents: those of whose words at least one, and one in twenty, lies in benchmark windows."""
    prepare_session(spark)
    docs, back = _apart(docs)
    found = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return back(found.where(~decontaminate.contaminated()))


def best_fit_packing(spark, docs, sf_dir):
    """Packs all documents into sequences: one row per piece with its place."""
    prepare_session(spark)
    tokenizer = shared_tokenizer(spark, tokenizer_path("word_bpe_49k.json"), keeps_blanks=False)
    return packing.pack(packing.pieces(docs, tokenizer))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# The first stage fits a model, which SQL can't express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over the table ``documents``; every other stage's are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
