"""I-Match fingerprints: hashes of the sorted distinct terms of a text inside an inverse-document-frequency band.

Besides the whole lexicon, fingerprints take randomised subsets of it at halving rates, so that a long text with a few
changed terms still agrees in the sparse subsets and a short one in the dense ones.
"""

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from clickmart.llm import exchange as X
from clickmart.llm.words import WordHashes, mixed, split_words, utf8
from clickmart.session import stored

LOW, HIGH = 0.0005, 0.2
RATES = (1.0, *(0.5**n for n in range(1, 9) for _ in range(2)))
_CHUNK = 3 << 20
_POWER = np.uint64(0x9E3779B97F4A7C15)


def _terms(rows, words):
    """Distinct term hashes of each row, sorted, and the number per row."""
    each = [np.unique(words.array(list(set(split_words(data, lower=True))))) for data in rows]
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    return np.concatenate(each) if each else np.empty(0, np.uint64), sizes


def document_frequencies(docs, text="text"):
    """``term`` (64-bit hash of a word, A-Z in lower case) and ``df`` (documents it occurs in), over all documents.

    Batches send each distinct term once with its count, so a word that is in every document costs one entry per batch.
    """

    def send(batches):
        words = WordHashes()

        def sent():
            for table in X.row_groups(batches, text, 6 * X.BATCH_WORDS):
                terms, _ = _terms(utf8(table.column(text)), words)
                keys, counts = np.unique(terms, return_counts=True)
                yield from X.requests(0, 0, keys, parts, [counts])

        yield from X.ask(sent())

    def add_up(table: pa.Table) -> pa.Table:
        found = X.Gathered(table)
        totals = found.total(np.concatenate([X.arrays_of(d, np.int64)[0] for d in found.counts]))
        return pa.table({"term": found.keys.view(np.int64), "df": totals.astype(np.int64)})

    # A batch gives far fewer distinct terms than words; owners follow the session's shuffle partitions.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(text).mapInArrow(send, X.REQUEST).groupBy("part").applyInArrow(add_up, "term long, df long")


def lexicon(docs, text="text", low=LOW, high=HIGH):
    """Sorted hashes of all terms in at least ``low`` and at most ``high`` of all documents, two documents at least.

    Each of them counts for ``low`` of the documents or more, so there are no more than (mean distinct terms of a document)
    / ``low``, however many documents there are: at 300 distinct terms a document 600,000 terms, 5 MB to every worker. Null
    and empty texts count as documents without terms; an empty table gives an empty lexicon.
    """
    total = docs.count()
    band = stored(document_frequencies(docs, text).where(F.col("df").between(max(2, low * total), high * total)), "lexicon")
    return np.sort(np.fromiter((row[0] for row in band.select("term").toLocalIterator()), np.int64).view(np.uint64))


def fingerprints(rows, terms, words):
    """One row of ``len(RATES)`` hashes per text, 0 where a subset has none of its terms.

    A text without any term of the lexicon is hashed over all of its terms.
    """
    found, sizes = _terms(rows, words)
    doc = np.repeat(np.arange(len(rows)), sizes)
    if len(terms):
        inside = terms[np.minimum(np.searchsorted(terms, found), len(terms) - 1)] == found
    else:
        inside = np.zeros(len(found), bool)
    some = np.bincount(doc[inside], minlength=len(rows)) > 0
    keep = inside | ~some[doc]
    found, doc = found[keep], doc[keep]
    marks = np.zeros((len(rows), len(RATES)), np.uint64)
    for n, rate in enumerate(RATES):
        salted = mixed(found + np.uint64((2 * n + 1) * int(_POWER) % 2**64))
        chosen = salted < np.uint64(min(int(rate * 2.0**64), 2**64 - 1))
        mine, owner = found[chosen], doc[chosen]
        if not len(mine):
            continue
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        place = np.arange(len(mine)) - np.repeat(starts, np.diff(starts, append=len(mine)))
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _POWER, np.uint64))
        marks[owner[starts], n] = mixed(np.add.reduceat(mine * powers[place], starts)) | np.uint64(1)
    return marks


def as_text(marks):
    return ["-".join(f"{int(mark) >> 32:08x}" if mark else "0" for mark in row) for row in marks]


def likeness(left, right):
    """Share of subsets with equal hashes among those where either text has terms; 1 for two texts without terms."""
    either = ((left != 0) | (right != 0)).sum(axis=1)
    equal = ((left == right) & (left != 0)).sum(axis=1)
    return np.where(either == 0, 1.0, equal / np.maximum(either, 1))


def with_next(docs, text="text"):
    """Rows ``to, donor, doc_id, text`` such that each row is followed by the next in descending ``doc_id``.

    Rows are dealt by ranges of ids, and each range also gets the first row of the range below it (the lowest gets the
    first of all), flagged ``donor``: one shuffle of the texts, and only range bounds and first ids reach the driver, no
    more than there are shuffle partitions. Equal ids are ordered by text, null ids come last.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", text)
    edges = rows.where("doc_id is not null").select(
        F.percentile_approx("doc_id", [n / parts for n in range(1, parts)] or [0.5], 10_000)
    ).first()[0]
    edges = sorted(set(edges or []))
    bounds = F.array(*[F.lit(e).cast("long") for e in edges])
    own = F.coalesce(F.size(F.filter(bounds, lambda edge: edge <= F.col("doc_id"))), F.lit(-1))
    rows = rows.withColumn("own", own)
    first = rows.groupBy("own").agg(F.max("doc_id").alias("head")).orderBy("own").collect()
    # the range above each range gets its head; the lowest range gets the head of the highest
    takers = [(row["head"], first[(n + 1) % len(first)]["own"]) for n, row in enumerate(first)]
    taker = F.broadcast(spark.createDataFrame(takers, "head long, taker int"))
    dealt = rows.join(taker, F.col("doc_id").eqNullSafe(F.col("head")), "left")
    targets = F.array(F.struct(F.col("own").alias("to"), F.lit(False).alias("donor")))
    donated = F.array(F.struct(F.col("taker").alias("to"), F.lit(True).alias("donor")))
    both = F.when(F.col("taker").isNull(), targets).otherwise(F.concat(targets, donated))
    return (
        dealt.select(F.explode(both).alias("at"), "doc_id", text)
        .select("at.to", "at.donor", "doc_id", text)
        .repartition("to")
        .sortWithinPartitions("to", "donor", F.desc_nulls_last("doc_id"), text)
    )


def compare_edits(docs, terms, text="text"):
    """Fingerprints of all texts and of their edited texts, and how like they and the next document's are.

    The edited text: the last ``n_chars // 3`` code points replaced by as many first ones (or all) of the next document
    in descending ``doc_id``, after the last one the first. Null texts are empty. A single row is its own next, repeated
    rows are separate rows, an empty table gives no row. Texts are taken whole, however long; other columns of ``docs``
    are left out. ``terms``: a lexicon, which is bounded by the length of the mean document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def finished(run, words):
        """Results of all rows of a run but the last, which is only a next one."""
        texts = [row[3] or "" for row in run]
        edited = []
        for mine, after in zip(texts, texts[1:], strict=False):
            cut = len(mine) // 3
            edited.append((mine[: len(mine) - cut] + after[:cut]).encode())
        own = fingerprints([t.encode() for t in texts], shared.value, words)
        other = fingerprints(edited, shared.value, words)
        columns = [
            [row[2] for row in run[:-1]],
            [len(t) for t in texts[:-1]],
            [hashlib.sha256(t).hexdigest() for t in edited],
            as_text(own[:-1]),
            as_text(other),
            likeness(own[:-1], other),
            likeness(own[:-1], own[1:]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def compare(batches):
        words, run, size = WordHashes(), [], 0
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if run and run[-1][0] != row[0]:
                    # the range ended with its donors, of which the first is the next of its last own row
                    yield finished(run, words)
                    run, size = [], 0
                if run and run[-1][1]:
                    continue
                run.append(row)
                size += len(row[3] or "")
                if size > _CHUNK:
                    if len(run) > 1:
                        yield finished(run, words)
                    run, size = run[-1:], len(row[3] or "")
        if len(run) > 1:
            yield finished(run, words)

    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, text).mapInArrow(compare, columns)
