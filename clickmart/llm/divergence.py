"""How far the sources of a language diverge in their words, by in-mapper stripes.

1. Each task folds whole documents into stripes, one per language and term: the number of documents that have the term, and
   its occurrences by source. A task that holds ``HELD_COUNTS`` counts spills its stripes as rows and begins anew, so a
   frequent term costs one row per spill and not one per document.
2. Stripes of a key meet in key order and are merged as they stream by; terms in too few documents end there.
3. Merged stripes are dealt to groups of about ``GROUP_TERMS`` terms of one language, beside the totals of its sources. Each
   group turns its stripes into sums of divergences per pair of sources and into its candidates for the leading terms; sums
   and ranks over the groups of a language are the result.

All arithmetic is in whole numbers and exact for totals up to 9 * 10^13 occurrences in a language.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.session import stored

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
PRIOR = 5
HELD_COUNTS = 500_000
GROUP_TERMS = 20_000
SLICE_BYTES = 1 << 20

# Letters A-Z in lower case, a-z and all bytes outside ASCII stay; everything else parts terms.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_STRIPES = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("documents", pa.int64()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)
STRIPES = "lang string, term string, documents long, sources array<string>, counts array<long>"


def term_slices(data):
    """Lists of the terms of a text in UTF-8, in order. Long texts are cut between terms, so that they are never held as one."""
    start, data = 0, (data or b"").translate(_LETTERS)
    while len(data) - start > SLICE_BYTES and (end := data.find(b" ", start + SLICE_BYTES)) >= 0:
        yield data[start:end].split()
        start = end
    yield data[start:].split()


class Stripes:
    """Stripes of one task, held by column: tables from term to documents per language, and to occurrences per source of it."""

    def __init__(self):
        self.documents, self.counts, self.size = {}, {}, 0

    def fold(self, lang, source, data):
        documents = self.documents.setdefault(lang, Counter())
        counts = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        before = len(documents) + len(counts)
        terms = set()
        for words in term_slices(data):
            counts.update(words)
            terms.update(words)
        documents.update(terms)
        self.size += len(documents) + len(counts) - before

    def spill(self, rows=20_000):
        """All stripes as record batches, one row per language and term; none are left."""
        for lang, documents in self.documents.items():
            sources = self.counts[lang]
            place = dict(zip(documents, range(len(documents)), strict=True))
            stripe = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in sources.values()])
            source = np.repeat(np.arange(len(sources)), [len(c) for c in sources.values()])
            numbers = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in sources.values()])
            order = np.argsort(stripe, kind="stable")
            names, source, numbers = pa.array(sources, pa.string()), source[order], pa.array(numbers[order])
            offsets = pa.array(np.searchsorted(stripe[order], np.arange(len(documents) + 1)).astype(np.int32))
            columns = [
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(documents), np.int64))),
                pa.array(documents, pa.binary()).cast(pa.string()),
                pa.array(documents.values(), pa.int64()),
                pa.ListArray.from_arrays(offsets, names.take(pa.array(source))),
                pa.ListArray.from_arrays(offsets, numbers),
            ]
            yield from pa.Table.from_arrays(columns, schema=_STRIPES).to_batches(max_chunksize=rows)
        self.documents, self.counts, self.size = {}, {}, 0


def _fold(batches):
    stripes = Stripes()
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
            stripes.fold(lang, source, text.as_py())
            if stripes.size >= HELD_COUNTS:
                yield from stripes.spill()
    yield from stripes.spill()


def _merged(table, starts, least):
    """One stripe for each run of rows that begins at ``starts``, without those in fewer than ``least`` documents."""
    documents = np.add.reduceat(table.column("documents").to_numpy(), starts)
    run = np.repeat(np.arange(len(starts)), np.diff([*starts, len(table)]))
    wanted = np.flatnonzero(documents >= least)
    place = np.full(len(starts), -1)
    place[wanted] = np.arange(len(wanted))
    rows = table.filter(pa.array(place[run] >= 0)).combine_chunks()
    lengths = pc.list_value_length(rows.column("sources")).to_numpy()
    sources = pc.list_flatten(rows.column("sources")).combine_chunks().dictionary_encode()
    cells = np.repeat(place[run][place[run] >= 0], lengths) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], pc.list_flatten(rows.column("counts")).to_numpy()[order]
    firsts = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.add.reduceat(counts, firsts) if len(firsts) else counts
    stripe, source = divmod(cells[firsts], max(1, len(sources.dictionary)))
    offsets = pa.array(np.searchsorted(stripe, np.arange(len(wanted) + 1)).astype(np.int32))
    heads = table.take(pa.array(np.asarray(starts)[wanted]))
    columns = [
        heads.column("lang").combine_chunks(),
        heads.column("term").combine_chunks(),
        pa.array(documents[wanted]),
        pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(source))),
        pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
    ]
    return pa.Table.from_arrays(columns, schema=_STRIPES)


def _merge(least):
    """Merges sorted stripes as they stream by. What is left over of a batch is its last key, merged so far."""

    def merge(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]).cast(_STRIPES)
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            if not len(table):
                continue
            new = np.ones(len(table), bool)
            new[1:] = False
            for name in ("lang", "term"):
                column = table.column(name)
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            held = _merged(table.slice(starts[-1]), [0], 0)
            if len(starts) > 1:
                yield from _merged(table.slice(0, starts[-1]), starts[:-1], least).to_batches()
        if held is not None:
            yield from held.filter(pc.greater_equal(held.column("documents"), least)).to_batches()

    return merge


def kept_stripes(docs, least=LEAST_DOCUMENTS):
    """Merged stripes of the terms that at least ``least`` documents of their language have. ``docs`` has no nulls."""
    stripes = docs.select("lang", "source", "text").mapInArrow(_fold, STRIPES)
    return stripes.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge(least), STRIPES)


def scaled_shares(counts, totals):
    """1 + floor(10^9 * counts / totals) for counts of at most ``totals``, by long division, so that nothing overflows."""
    high, rest = np.divmod(counts * 100_000, totals)
    return 1 + high * 10_000 + rest * 10_000 // totals


_OUT = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
)


def _diverge(top):
    """Sums per pair and candidate terms of one group of stripes (left), given the totals of its language (right)."""

    def rows(lang, source, part, items, values):
        columns = [[lang] * len(items), [source] * len(items), [part] * len(items), items, values]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, _OUT.types, strict=True)]
        return pa.Table.from_arrays(arrays, schema=_OUT)

    def diverge(left: pa.Table, right: pa.Table) -> pa.Table:
        order = right.take(pc.sort_indices(right, [("source", "ascending")])).combine_chunks()
        names, lang, terms = order.column("source").to_pylist(), order.column("lang")[0].as_py(), order.column("terms")[0].as_py()
        weights = order.column("total").to_numpy() + PRIOR * terms
        whole = np.int64(order.column("total").to_numpy().sum() + PRIOR * terms)
        at = {name: place for place, name in enumerate(names)}
        sums = np.zeros((len(names), len(names)), np.int64)
        best = [[] for _ in names]
        step = max(1, 1_000_000 // len(names))
        for start in range(0, len(left), step):
            part = left.slice(start, step).combine_chunks()
            words = part.column("term").to_pylist()
            lengths = pc.list_value_length(part.column("sources")).to_numpy()
            columns = [at[name] for name in pc.list_flatten(part.column("sources")).to_pylist()]
            counts = np.zeros((len(part), len(names)), np.int64)
            counts[np.repeat(np.arange(len(part)), lengths), columns] = pc.list_flatten(part.column("counts")).to_numpy()
            shares = scaled_shares(counts + PRIOR, weights)
            general = scaled_shares(counts.sum(axis=1) + PRIOR, whole)
            for place in range(len(names)):
                sums[place] += np.abs(shares - shares[:, place : place + 1]).sum(axis=0)
                over = np.flatnonzero((counts[:, place] > 0) & (shares[:, place] > general))
                found = [(-int(shares[row, place] - general[row]), words[row].encode(), words[row]) for row in over.tolist()]
                best[place] = sorted(best[place] + found)[:top]
        found = [_OUT.empty_table()]
        for place, name in enumerate(names):
            others = [other for other in range(len(names)) if other != place]
            found.append(rows(lang, name, "pair", [names[other] for other in others], sums[place, others].tolist()))
            found.append(rows(lang, name, "term", [word for _, _, word in best[place]], [-value for value, _, _ in best[place]]))
        return pa.concat_tables(found)

    return diverge


def source_divergence(docs, least=LEAST_DOCUMENTS, top=TOP_TERMS):
    """(lang, source, part, item, value, rank): every pair of sources of a language, and the leading terms of each source.

    Null texts, languages and sources count as empty ones. Empty texts have no terms, but their source is there and
    compared. A language without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. Equal
    values rank by the UTF-8 of the item. Repeated rows count as often as they are there, texts of any length count whole,
    other columns of ``docs`` are not read, and an empty table gives an empty result.
    """
    docs = docs.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    kept = stored(kept_stripes(docs, least), "stripes")
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("cell"))
    totals = cells.groupBy("lang", F.col("cell.sources").alias("source")).agg(F.sum("cell.counts").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms"])
    cuts = F.ceil(F.greatest(F.col("terms"), F.lit(1)) / GROUP_TERMS)
    groups = groups.withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), cuts - 1)))
    stripes = kept.join(sizes, "lang").withColumn("group", F.pmod(F.xxhash64("term"), cuts)).drop("terms", "documents")

    parts = stripes.groupBy("lang", "group").cogroup(groups.groupBy("lang", "group"))
    found = stored(
        parts.applyInArrow(_diverge(top), "lang string, source string, part string, item string, value long"), "divergences"
    )
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
